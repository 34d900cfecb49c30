"""As-of joins and sessions over time lines of any length.

Rows are range-partitioned on key and time, so a key with a third of all rows is cut into consecutive slices like any
other stretch of the order. Each slice is worked on alone; what has to cross a border is one row per key and
slice, and only keys that lie in several slices have such rows: as many as there are slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.operators.ranking import sliced
from assaymill.session import materialise

_SLICE = ("_key", "_slice")


def _earlier_slices() -> Window:
    return Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    tie: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Each left row with the ``values`` of the last right row of its key at or before its time.

    All left rows stay; without such a right row the values are null, as they are for a null key or time. With
    ``strict`` the right row is before the left one's time. Of right rows at one time the one with the largest ``tie``
    columns counts; give enough of them to make that one row. Names must not clash.
    """
    # At equal times what sorts first is seen by what comes after it.
    of_left, of_right = (0, 1) if strict else (1, 0)
    key = F.struct(*by).alias("_by")
    kind = right.select(F.struct(*values).alias("v")).schema["v"].dataType
    ties = F.struct(F.lit(0).alias("_none"), *tie)
    tie_kind = right.select(ties.alias("t")).schema["t"].dataType
    rows = F.struct(*(F.col(c) for c in left.columns))
    row_kind = left.select(rows.alias("r")).schema["r"].dataType
    lefts = left.select(
        key, F.col(left_time).alias("_time"), F.lit(of_left).alias("_side"),
        F.lit(None).cast(tie_kind).alias("_tie"), rows.alias("_left"), F.lit(None).cast(kind).alias("_right"),
    )
    rights = right.dropna(subset=[*by, right_time]).select(
        key, F.col(right_time).alias("_time"), F.lit(of_right).alias("_side"),
        ties.alias("_tie"), F.lit(None).cast(row_kind).alias("_left"), F.struct(*values).alias("_right"),
    )
    order = [F.col(c) for c in ("_time", "_side", "_tie")]
    both = materialise(sliced(lefts.unionByName(rights), "_by", order))

    here = Window.partitionBy(*_SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_seen", F.last("_right", ignorenulls=True).over(here)).where("_left IS NOT NULL")
    place = F.when(F.col("_right").isNotNull(), F.struct(*order))
    ends = both.groupBy(*_SLICE).agg(F.max_by("_right", place).alias("_end"))
    carried = ends.select(*_SLICE, F.last("_end", ignorenulls=True).over(_earlier_slices()).alias("_carried"))
    carried = carried.where("_carried IS NOT NULL")
    return (
        seen.join(carried, list(_SLICE), "left")
        .withColumn("_found", F.when(F.col("_time").isNotNull(), F.coalesce("_seen", "_carried")))
        .select("_left.*", *(F.col(f"_found.{v}").alias(v) for v in values))
    )


def sessions(df: DataFrame, by: Sequence[str], time: str, gap_seconds: int) -> DataFrame:
    """``by``, ``session_start``, ``session_end`` and ``n_events``: runs of events no more than a gap apart.

    A session ends with its last event. Events without a time belong to none; null keys are a key. Sessions are made
    within slices; only the first and the last one of a slice can go on across its border, and they are put together
    from their starts, ends and counts.
    """
    gap = F.lit(gap_seconds * 1_000_000)
    rows = df.where(F.col(time).isNotNull()).select(
        F.struct(*by).alias("_by"), F.unix_micros(F.col(time).cast("timestamp")).alias("_at")
    )
    rows = materialise(sliced(rows, "_by", [F.col("_at")]))
    order = Window.partitionBy(*_SLICE).orderBy("_at")
    apart = F.coalesce(F.col("_at") - F.lag("_at").over(order) > gap, F.lit(True))
    numbered = rows.withColumn("_new", apart.cast("int")).withColumn(
        "_number", F.sum("_new").over(order.rangeBetween(Window.unboundedPreceding, 0))
    )
    local = materialise(
        numbered.groupBy(*_SLICE, "_by", "_number").agg(
            F.min("_at").alias("_start"), F.max("_at").alias("_end"), F.count("*").alias("n_events")
        )
    )
    # How many sessions each slice of a key has, and whether the key lies in several slices.
    spans = local.groupBy(*_SLICE).agg(F.max("_number").alias("_last"))
    several = spans.join(
        spans.groupBy("_key").agg(F.count("*").alias("_slices")).where("_slices > 1").drop("_slices"), "_key"
    )
    marked = local.join(several, list(_SLICE), "left")
    border = F.coalesce((F.col("_number") == 1) | (F.col("_number") == F.col("_last")), F.lit(False))
    inside = marked.where(~border).select("_by", "_start", "_end", "n_events")
    along = Window.partitionBy("_key").orderBy("_slice", "_number")
    parted = F.coalesce(F.col("_start") - F.lag("_end").over(along) > gap, F.lit(True)).cast("int")
    chained = (
        marked.where(border)
        .withColumn("_new", parted)
        .withColumn("_chain", F.sum("_new").over(along))
        .groupBy("_key", "_by", "_chain")
        .agg(F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("n_events").alias("n_events"))
        .drop("_key", "_chain")
    )
    return inside.unionByName(chained).select(
        *(F.col(f"_by.{c}").alias(c) for c in by),
        F.timestamp_micros("_start").alias("session_start"),
        F.timestamp_micros("_end").alias("session_end"),
        "n_events",
    )


def stream_sessions(events: DataFrame, by: Sequence[str], time: str, gap_seconds: int, delay: str) -> DataFrame:
    """The same sessions of a stream, by Spark's session windows; state goes ``delay`` after a session's end."""
    # A window is open for events less than its gap away; one a full gap later still belongs.
    window = F.session_window(time, f"{gap_seconds * 1_000_000 + 1} microseconds")
    return (
        events.withWatermark(time, delay)
        .groupBy(*by, window)
        .agg(F.count("*").alias("n_events"), F.max(time).alias("session_end"))
        .select(*by, F.col("session_window.start").alias("session_start"), "session_end", "n_events")
    )
