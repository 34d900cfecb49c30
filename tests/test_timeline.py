"""As-of joins, sessions and interval joins against plain loops, with a key that has a third of all rows."""

import random
from datetime import datetime, timedelta

import pytest

from assaymill.operators.intervals import overlapping, point_in_interval
from assaymill.operators.timeline import asof_join, sessions, stream_sessions
from assaymill.session import setting

START = datetime(2026, 1, 1)


@pytest.fixture
def many_slices(spark):
    """Small slices, so that a hot key lies in many of them."""
    with setting(spark, "spark.sql.shuffle.partitions", "9"):
        with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            yield


def at(minutes):
    return START + timedelta(minutes=minutes)


def key(rng):
    return "hot" if rng.random() < 0.4 else rng.choice([None, *(f"k{i}" for i in range(9))])


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, many_slices, strict):
    rng = random.Random(4)
    left = [(n, key(rng), None if rng.random() < 0.05 else at(rng.randrange(200))) for n in range(250)]
    right = [(key(rng), at(rng.randrange(200)) if rng.random() > 0.05 else None, n, None if n % 9 == 0 else n * 1.5) for n in range(200)]
    found = asof_join(
        spark.createDataFrame(left, "id int, k string, t timestamp"),
        spark.createDataFrame(right, "k string, u timestamp, number int, value double"),
        ["k"], "t", "u", ["number", "value"], tie=["number"], strict=strict,
    )
    expected = []
    for n, k, t in left:
        fits = [r for r in right if t and r[1] and k is not None and r[0] == k and (r[1] < t or (r[1] == t and not strict))]
        best = max(fits, key=lambda r: (r[1], r[2]), default=(None,) * 4)
        expected.append((n, k, t, best[2], best[3]))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_asof_join_without_rows_on_a_side(spark):
    none = spark.createDataFrame([], "k string, u timestamp, value int")
    some = spark.createDataFrame([("a", at(1))], "k string, t timestamp")
    assert [tuple(r) for r in asof_join(some, none, ["k"], "t", "u", ["value"]).collect()] == [("a", at(1), None)]
    assert asof_join(some.limit(0), none, ["k"], "t", "u", ["value"]).count() == 0


def by_hand(rows, gap):
    out = []
    for k in {r[0] for r in rows}:
        times = sorted(t for own, t in rows if own == k and t is not None)
        for n, t in enumerate(times):
            if n and t - times[n - 1] <= timedelta(minutes=gap):
                out[-1] = (k, out[-1][1], t, out[-1][3] + 1)
            else:
                out.append((k, t, t, 1))
    return sorted(map(str, out))


def session_rows(rng):
    rows = [(key(rng), at(rng.randrange(3000))) for _ in range(400)] + [("a", None)]
    # One session over many slices, then events just at and just past the gap.
    return rows + [("long", at(5 * n)) for n in range(200)] + [("edge", at(n)) for n in (0, 10, 21, 21)]


def test_sessions(spark, many_slices):
    rows = session_rows(random.Random(6))
    found = sessions(spark.createDataFrame(rows, "k string, t timestamp"), ["k"], "t", 600)
    assert sorted(str(tuple(r)) for r in found.collect()) == by_hand(rows, 10)


def test_sessions_of_a_stream(spark, tmp_path):
    rows = [r for r in session_rows(random.Random(7)) if r[1] is not None]
    for part in range(3):
        spark.createDataFrame(rows[part::3], "k string, t timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    made = stream_sessions(events, ["k"], "t", 600, "100 days")
    query = made.writeStream.outputMode("complete").format("memory").queryName("sessions_made").trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.table("sessions_made")
    assert sorted(str(tuple(r)) for r in found.collect()) == by_hand(rows, 10)


def spans(rng, n):
    out = []
    for number in range(n):
        first = rng.randrange(-50, 300)
        last = first + rng.choice([-3, 0, 1, 5, 40, 200])
        out.append((number, key(rng), None if rng.random() < 0.05 else first, last))
    return out


def test_points_in_intervals(spark):
    rng = random.Random(8)
    points = [(n, key(rng), rng.choice([None, *range(-60, 400)])) for n in range(150)]
    intervals = spans(rng, 120)
    found = point_in_interval(
        spark.createDataFrame(points, "id int, k string, p int"),
        spark.createDataFrame(intervals, "other int, k string, first int, last int"), ["k"], "p", "first", "last",
    ).select("id", "other")
    expected = [
        (i, o) for i, k, p in points for o, k2, a, b in intervals if k is not None and k == k2 and p is not None and a is not None and a <= p <= b
    ]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_overlapping_intervals(spark):
    rng = random.Random(9)
    left, right = spans(rng, 120), spans(rng, 110)
    found = overlapping(
        spark.createDataFrame(left, "id int, k string, a int, b int"),
        spark.createDataFrame(right, "other int, k string, c int, d int"), ["k"], ("a", "b"), ("c", "d"),
    ).select("id", "other")
    expected = [
        (i, o) for i, k, a, b in left for o, k2, c, d in right
        if k is not None and k == k2 and a is not None and c is not None and a <= b and c <= d and a <= d and c <= b
    ]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_rows_are_bounded_by_the_logarithm(spark):
    from pyspark.sql import functions as F

    from assaymill.operators.intervals import _covered

    df = spark.range(1).select(F.lit(-1234567).alias("a"), F.lit(7654321).alias("b"))
    cells = _covered(df, F.col("a").cast("bigint"), F.col("b").cast("bigint"), 24).collect()
    assert len(cells) <= 2 * 24
    assert sum(1 << r["_level"] for r in cells) == 7654321 + 1234567 + 1
