"""Dense positions 1..n within groups of any size.

Slices carry the group once more as ``_key``, a struct that is not NULL even where the group is:
the window and the join over it then need one and the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.session import materialise


def rank_within(df: DataFrame, group: str, order: Sequence[Column], into: str) -> DataFrame:
    """Number the rows of each group by ``order``, each group within one task."""
    return df.withColumn(into, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def rank_within_slices(df: DataFrame, group: str, order: Sequence[Column], into: str) -> DataFrame:
    """The same numbers when a group is too large for one task.

    Rows are range-partitioned on the group and the full order, so a large group
    is cut into consecutive slices of about equal size. A row's number is its place in
    its slice plus the rows in the group's earlier slices. ``order`` must be total.
    """
    return rank_sliced(materialise(sliced(df, group, order)), group, order, into)


def sliced(df: DataFrame, group: str, order: Sequence[Column]) -> DataFrame:
    """Rows in range partitions, each with the number of its partition in ``_slice``.

    Write or checkpoint the result before using it twice: the cut points come
    from a sample, and all readers have to see the same ones.
    """
    ranged = df.repartitionByRange(F.col(group), *order)
    return ranged.withColumn("_slice", F.spark_partition_id()).withColumn("_key", F.struct(group))


def rank_sliced(df: DataFrame, group: str, order: Sequence[Column], into: str) -> DataFrame:
    """Positions from rows that ``sliced`` made."""
    # One row per group and slice: as many as there are groups and partitions.
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("_key", "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_key", "_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_key", "_slice").orderBy(*order))
    position = (F.col("_before") + F.col("_place")).cast("int").alias(into)
    kept = [c for c in df.columns if c not in ("_slice", "_key")]
    return df.withColumn("_place", place).join(offsets, ["_key", "_slice"]).select(*kept, position)
