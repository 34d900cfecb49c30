"""Grouped summaries of measurements."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions.columns import exact_mean


@dataclass(frozen=True)
class Measure:
    """A column to average into ``average``; see ``exact_mean`` for ``scale``."""

    column: str
    average: str
    scale: int | None = None


def summarise(
    df: DataFrame,
    groups: Sequence[str],
    measures: Sequence[Measure],
    distinct: str,
    count_name: str,
    latest: str,
    latest_name: str,
) -> DataFrame:
    """Exact distinct count, averages and latest time per group.

    All buffers are fixed-width, so this is a hash aggregate that combines on the
    map side. The distinct count spreads a group over its distinct values
    first, so no group is gathered whole.
    """
    return df.groupBy(*groups).agg(
        F.count_distinct(distinct).alias(count_name),
        *(exact_mean(F.col(m.column), m.scale).alias(m.average) for m in measures),
        F.max(latest).alias(latest_name),
    )
