"""Min-max scores per group and their weighted sum."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions.columns import min_max_scaled

WEIGHT_TOLERANCE = 1e-6


@dataclass(frozen=True)
class Criterion:
    """A column to scale within its group into ``score``, and what it counts for."""

    column: str
    score: str
    weight: float
    higher_is_better: bool = True

    @property
    def low(self) -> str:
        return f"minimum_{self.column}"

    @property
    def high(self) -> str:
        return f"maximum_{self.column}"


def check_weights(criteria: Sequence[Criterion]) -> None:
    if abs(sum(c.weight for c in criteria) - 1.0) > WEIGHT_TOLERANCE:
        raise ValueError(f"The criteria's weights sum to {sum(c.weight for c in criteria)}, not 1.")


def bounds(df: DataFrame, group: str, criteria: Sequence[Criterion]) -> DataFrame:
    """Lowest and highest value of every criterion per group, and the group's size.

    An aggregate and not a window: it combines on the map side, so a group with
    a third of all rows is never sorted or buffered in one task.
    """
    extremes = [
        column
        for c in criteria
        for column in (F.min(c.column).alias(c.low), F.max(c.column).alias(c.high))
    ]
    return df.groupBy(group).agg(*extremes, F.count(F.lit(1)).alias("group_rows"))


def score(
    df: DataFrame, limits: DataFrame, group: str, criteria: Sequence[Criterion], total: str
) -> DataFrame:
    """Scale each criterion within its group and add the weighted scores.

    ``limits`` has one row per group. Adaptive execution broadcasts it when it turns out small
    in bytes; past that the join is a sort-merge join, in which the partition of an
    oversized group is split.
    """
    # Null-safe, so that rows without a group are a group, as they are in ``bounds``.
    limits = limits.withColumnRenamed(group, "_group")
    scaled = df.join(limits, F.col(group).eqNullSafe(F.col("_group"))).select(
        *df.columns,
        *(
            min_max_scaled(F.col(c.column), F.col(c.low), F.col(c.high), c.higher_is_better).alias(
                c.score
            )
            for c in criteria
        ),
    )
    weighted = reduce(Column.__add__, (F.col(c.score) * c.weight for c in criteria))
    return scaled.withColumn(total, F.round(weighted, 4))
