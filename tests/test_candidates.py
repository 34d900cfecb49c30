import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assaymill.functions.columns import exact_mean
from assaymill.operators.dedup import latest_per_key
from assaymill.operators.ranking import rank_within, rank_within_slices
from assaymill.plans.candidates import (
    criteria,
    event_order,
    material_candidates,
    material_summary,
    top_candidates,
)
from assaymill.plans.experiments import valid_events, validated_events
from assaymill.schemas import CANDIDATE_COLUMNS
from sample_events import EVENTS, changed


@pytest.fixture
def events(raw):
    return valid_events(validated_events(raw(*EVENTS)))


def by_material(candidates):
    return {r.material_id: r for r in candidates.collect()}


def test_worked_example(events):
    candidates = material_candidates(events)
    assert tuple(candidates.columns) == CANDIDATE_COLUMNS
    rows = by_material(candidates)
    scores = {
        m: (r.strength_score, r.conductivity_score, r.density_score, r.candidate_score)
        for m, r in rows.items()
    }
    assert scores == {
        "MAT-AL-001": (0.0, 1.0, 1.0, 0.55),
        "MAT-AL-002": (1.0, 0.0, 0.0, 0.45),
        "MAT-COMP-001": (1.0, 1.0, 1.0, 1.0),
    }
    ranks = {m: r.candidate_rank for m, r in rows.items()}
    assert ranks == {"MAT-AL-001": 1, "MAT-AL-002": 2, "MAT-COMP-001": 1}


def test_types(events):
    types = dict(material_candidates(events).dtypes)
    assert types["experiment_count"] == "bigint"
    assert types["candidate_rank"] == "int"
    assert types["candidate_score"] == "double"
    assert types["latest_experiment_at"] == "timestamp"


def test_repeated_events_count_once(events):
    row = by_material(material_candidates(events.unionByName(events)))["MAT-AL-001"]
    assert (row.experiment_count, row.average_tensile_strength_mpa) == (1, 310.0)


def test_averages_are_per_event_and_counts_per_experiment(raw):
    again = changed("event_id", "00000000-0000-4000-8000-000000000099")
    again["experiment"]["measurements"]["tensile_strength_mpa"] = 320.0
    again["occurred_at"] = "2026-07-01T00:00:00Z"
    valid = valid_events(validated_events(raw(EVENTS[0], again)))
    row = material_summary(valid).first()
    assert (row.experiment_count, row.average_tensile_strength_mpa) == (1, 315.0)
    assert row.latest_experiment_at == datetime(2026, 7, 1)


def test_other_weights(events):
    rows = by_material(material_candidates(events, 1.0, 0.0, 0.0))
    assert (rows["MAT-AL-001"].candidate_score, rows["MAT-AL-002"].candidate_rank) == (0.0, 1)


def test_weights_have_to_add_up(events):
    with pytest.raises(ValueError, match="weights sum to"):
        material_candidates(events, 0.5, 0.5, 0.5)
    assert criteria(1.5, -0.25, -0.25)


def test_top(events):
    top = top_candidates(material_candidates(events), 1).collect()
    assert sorted(r.material_id for r in top) == ["MAT-AL-001", "MAT-COMP-001"]


def test_no_events(events):
    assert material_candidates(events.filter("false")).count() == 0


def test_nan_measure_does_not_fail(raw):
    odd = changed("experiment.measurements.conductivity_s_per_m", float("nan"))
    valid = valid_events(validated_events(raw(odd, EVENTS[1])))
    assert material_candidates(valid, scale=2).count() == 2


def conflicting(spark):
    """300 copies each of some events that disagree on everything but their id."""
    dice = random.Random(7)
    rows = [
        (
            f"event-{i % 20 if i % 3 else 0}",
            datetime(2026, 1, 1 + dice.randrange(3)),
            datetime(2026, 2, 1),
            f"{dice.getrandbits(64):016x}",
            f"EXP-{dice.randrange(50)}",
            "P",
            f"M-{dice.randrange(4)}",
            "F",
            *(float(dice.randrange(1, 10**6)) / 100 for _ in range(3)),
        )
        for i in range(3000)
    ]
    schema = (
        "event_id string, occurred_at timestamp, ingested_at timestamp, payload_sha256 string,"
        " experiment_id string, program_id string, material_id string, material_family string,"
        " tensile_strength_mpa double, conductivity_s_per_m double, density_g_per_cm3 double"
    )
    return rows, spark.createDataFrame(rows, schema)


def test_the_latest_copy_is_kept(spark):
    rows, events = conflicting(spark)
    best = {}
    # Smallest hash first, then the stable sort by the two times, latest first.
    for row in sorted(sorted(rows, key=lambda r: r[3]), key=lambda r: (r[1], r[2]), reverse=True):
        kept = best.setdefault(row[0], row)
        if (row[1], row[2]) == (kept[1], kept[2]) and row[3] < kept[3]:
            best[row[0]] = row
    kept = latest_per_key(events, ["event_id"], event_order(events.columns))
    assert sorted(map(tuple, kept.collect())) == sorted(best.values())


@pytest.mark.parametrize("scale", [None, 2])
def test_result_does_not_depend_on_partitions(spark, scale):
    _, events = conflicting(spark)
    results = [
        sorted(map(tuple, material_candidates(events.repartition(n), scale=scale).collect()))
        for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]


def test_exact_mean_falls_back_on_other_values(spark):
    df = spark.createDataFrame(
        [("fits", 0.1), ("fits", 0.2), ("long", 0.123), ("long", 1.0), ("nan", float("nan")),
         ("huge", 1e300), ("none", None), ("half", None), ("half", 3.0)],
        "k string, v double",
    )
    rows = dict(
        map(tuple, df.groupBy("k").agg(exact_mean(F.col("v"), 2)).collect())
    )
    assert rows["fits"] == 0.15
    assert rows["long"] == pytest.approx(0.5615)
    assert rows["nan"] != rows["nan"]
    assert (rows["huge"], rows["none"], rows["half"]) == (1e300, None, 3.0)


def test_equal_measures_in_another_order_score_alike(spark):
    _, like = conflicting(spark)
    when = datetime(2026, 1, 1)
    rows = [
        (f"{material}-{i}", when, when, "", f"E{i}", "P", material, "F", value, 1.0, 1.0)
        for material, values in (("M1", (0.1, 0.2, 0.3)), ("M2", (0.3, 0.2, 0.1)))
        for i, value in enumerate(values)
    ]
    found = material_candidates(spark.createDataFrame(rows, like.schema).coalesce(1)).collect()
    assert [r.strength_score for r in found] == [1.0, 1.0]
    assert [r.candidate_score for r in found] == [1.0, 1.0]


def test_exact_mean_without_a_scale(spark):
    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("a", 0.3), ("big", 2.5e7), ("big", 1e-9), ("tiny", 1e-30), ("sum", 9e19),
         ("sum", 9e19), ("none", None)],
        "k string, v double",
    )
    rows = dict(map(tuple, df.groupBy("k").agg(exact_mean(F.col("v"))).collect()))
    assert rows == {"a": 0.6 / 3, "big": 12500000.0000000005, "tiny": 1e-30, "sum": 9e19, "none": None}


def test_events_without_lineage(spark):
    _, events = conflicting(spark)
    bare = events.drop("ingested_at", "payload_sha256")
    results = [
        sorted(map(tuple, material_candidates(bare.repartition(n), scale=2).collect()))
        for n in (1, 5)
    ]
    assert results[0] == results[1]


def test_equal_material_in_two_families_has_a_fixed_rank(raw):
    other = changed("experiment.material.family", "a-family")
    other["event_id"] = "00000000-0000-4000-8000-000000000098"
    valid = valid_events(validated_events(raw(EVENTS[0], other)))
    for n in (1, 3):
        rows = material_candidates(valid.repartition(n)).orderBy("candidate_rank").collect()
        assert [(r.candidate_rank, r.material_family) for r in rows] == [
            (1, "a-family"),
            (2, "aluminum-alloy"),
        ]


def test_slices_number_like_one_window(spark):
    dice = random.Random(3)
    rows = [
        # One group has two thirds of the rows, most of them with the same score.
        (
            "hot" if i % 3 else None if i % 2 else f"g{i % 5}",
            1.0 if dice.random() < 0.8 else dice.random(),
            f"id{i}",
        )
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "g string, score double, id string").repartition(5)
    order = [F.desc("score"), F.asc("id")]
    whole = rank_within(df, "g", order, "n")
    cut = rank_within_slices(df, "g", order, "n")
    assert whole.columns == cut.columns and whole.dtypes == cut.dtypes
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_rows_without_a_program_are_a_program(events):
    anonymous = events.withColumn("program_id", F.lit(None).cast("string"))
    rows = material_candidates(anonymous).collect()
    assert sorted(r.candidate_rank for r in rows) == [1, 2, 3]


def by_hand(rows, weights):
    """Candidates from events in plain Python."""
    materials = {}
    for event, when, _, _, experiment, program, material, family, *measures in rows:
        materials.setdefault((program, material, family), []).append((experiment, when, measures))
    summary = {
        key: (
            len({e for e, _, _ in found}),
            [sum(Decimal(str(m[i])) for _, _, m in found) for i in range(3)],
            len(found),
            max(w for _, w, _ in found),
        )
        for key, found in materials.items()
    }
    result = []
    for program in {key[0] for key in summary}:
        scored = []
        inside = {
            key: (n, [float(total) / size for total in totals], latest)
            for key, (n, totals, size, latest) in summary.items()
            if key[0] == program
        }
        for key, (n, means, latest) in inside.items():
            scores = []
            for i, mean in enumerate(means):
                low = min(m[i] for _, m, _ in inside.values())
                high = max(m[i] for _, m, _ in inside.values())
                distance = mean - low if i < 2 else high - mean
                scores.append(1.0 if low == high else distance / (high - low))
            total = scores[0] * weights[0] + scores[1] * weights[1] + scores[2] * weights[2]
            rounded = float(Decimal(repr(total)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
            scored.append((-rounded, -means[0], -means[1], means[2], *key[1:], n, scores, latest))
        for rank, (total, a, b, c, material, family, n, scores, latest) in enumerate(sorted(scored)):
            means = (-a, -b, c)
            result.append(
                (program, material, family, n, *means, *scores, -total, rank + 1, latest)
            )
    return sorted(result)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.data())
def test_candidates_against_plain_python(spark, data):
    measure = st.integers(0, 400).map(lambda n: n / 100)
    count = data.draw(st.integers(1, 40))
    rows = [
        (
            f"event-{i}",
            datetime(2026, 1, 1 + data.draw(st.integers(0, 20))),
            datetime(2026, 2, 1),
            f"{i:064x}",
            f"EXP-{data.draw(st.integers(0, 5))}",
            f"P{data.draw(st.integers(0, 1))}",
            f"M{data.draw(st.integers(0, 4))}",
            f"F{data.draw(st.integers(0, 1))}",
            *(data.draw(measure) for _ in range(3)),
        )
        for i in range(count)
    ]
    _, like = conflicting(spark)
    events = spark.createDataFrame(rows, like.schema)
    weights = data.draw(st.sampled_from([(0.45, 0.35, 0.2), (1.0, 0.0, 0.0), (0.5, -0.25, 0.75)]))
    expected = by_hand(rows, weights)
    for scale in (None, 2):
        candidates = material_candidates(events, *weights, scale=scale)
        assert sorted(map(tuple, candidates.collect())) == expected
