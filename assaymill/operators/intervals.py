"""Joins of points with intervals and of intervals with each other, as equi-joins on cells.

The axis is divided in cells of 1, 2, 4 and so on. An interval is covered by at most two cells of each size, which
do not overlap; a point lies in one cell of each size. So a point and an interval that holds it meet in exactly
one cell, and the rows of either are bounded by twice the logarithm of the longest interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVEL, _CELL = "_level", "_cell"


def _covered(df: DataFrame, first: Column, last: Column, levels: int) -> DataFrame:
    """One row for each cell that covers the whole numbers from ``first`` to ``last``."""
    # Shifts round down; the first cell is the first that starts in the interval.
    low = F.expr(f"-shiftright(-_first, {_LEVEL})")
    high = F.expr(f"shiftright(_last + 1, {_LEVEL})")
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    left = F.when((low < high) & odd(low), low)
    right = F.when((low < high) & odd(high), high - 1)
    cells = F.filter(F.array(left, right), lambda c: c.isNotNull())
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias(_LEVEL)
    placed = df.withColumns({"_first": first, "_last": last}).where("_first <= _last").select("*", level)
    return placed.select("*", F.explode(cells).alias(_CELL)).drop("_first", "_last")


def _pointed(df: DataFrame, point: Column, levels: int) -> DataFrame:
    """One row for each cell that a point lies in."""
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias(_LEVEL)
    cell = F.expr(f"shiftright(_point, {_LEVEL})").alias(_CELL)
    placed = df.withColumn("_point", point).where("_point IS NOT NULL").select("*", level)
    return placed.select("*", cell).drop("_point")


def point_in_interval(
    points: DataFrame, intervals: DataFrame, by: Sequence[str], point: str, first: str, last: str
) -> DataFrame:
    """All pairs of a point and an interval of the same key that holds it; ends included.

    ``point``, ``first`` and ``last`` are whole numbers. Nulls match nothing, and neither does an interval that ends
    before it starts. The columns are those of both sides, the key once; other names must not clash.
    """
    longest = intervals.agg(F.max(F.col(last) - F.col(first) + 1)).first()[0]
    levels = max(0, int(longest or 1)).bit_length()
    a = _pointed(points.dropna(subset=list(by)), F.col(point).cast("bigint"), levels)
    b = _covered(intervals.dropna(subset=list(by)), F.col(first).cast("bigint"), F.col(last).cast("bigint"), levels)
    return a.join(b, [*by, _LEVEL, _CELL]).drop(_LEVEL, _CELL)


def overlapping(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str]
) -> DataFrame:
    """All pairs of intervals of the same key that share a whole number, each pair once.

    Of two that overlap, either the right one starts inside the left one, or the left one starts inside the right
    one but not at its start.
    """
    (a, b), (c, d) = left_span, right_span
    starts_in_left = point_in_interval(right.where(F.col(c) <= F.col(d)), left, by, c, a, b)
    inner = right.withColumn("_inner", F.col(c) + 1)
    starts_in_right = point_in_interval(left.where(F.col(a) <= F.col(b)), inner, by, a, "_inner", d).drop("_inner")
    return starts_in_left.unionByName(starts_in_right)
