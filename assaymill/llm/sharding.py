"""Minimax contiguous partition of documents into shards of near equal bytes.

Groups of equal texts are atoms and stand in the order of their digests. The smallest shard
capacity for which a greedy pass needs no more shards than asked for is found by binary search;
that pass's cuts are the shards' borders. The running sums are a distributed table, and a pass
over it asks for one maximum per shard: no list of groups reaches the driver or one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored

#: Levels of the binary search that one round of passes decides: 2^5 - 1 capacities at once.
LEVELS = 5
#: Place of a row in its task, and the task, as ``monotonically_increasing_id`` gives them.
PLACE_BITS = 33


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` stored in range order with ``task`` and ``place``, the row's place in it.

    Ranges are found by sampling rows, so a key of many rows is spread as far as the later
    order columns tell its rows apart.
    """
    at = F.monotonically_increasing_id()
    return stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.shiftright(at, PLACE_BITS).alias("task"), at.bitwiseAND((1 << PLACE_BITS) - 1).alias("place")),
        "numbered",
    )


def before_tasks(rows: DataFrame, **sums: str) -> DataFrame:
    """For each task of ``numbered`` the sums over the tasks before it: one row per task."""
    totals = rows.groupBy("task").agg(*(F.expr(e).alias(n) for n, e in sums.items()))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("task", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums))


def running_sums(groups: DataFrame) -> DataFrame:
    """Groups with ``end`` and ``end_rows``: bytes and rows up to and with the group."""
    rows = numbered(groups, "key")
    so_far = Window.partitionBy("task").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = before_tasks(rows, bytes_before="sum(bytes)", rows_before="sum(n_rows)")
    return stored(
        rows.select(
            "task", "place", "key", "bytes",
            F.sum("bytes").over(so_far).alias("bytes_here"),
            F.sum("n_rows").over(so_far).alias("rows_here"),
        )
        .join(F.broadcast(before), "task")
        .select(
            "key",
            "bytes",
            (F.col("bytes_before") + F.col("bytes_here")).alias("end"),
            (F.col("rows_before") + F.col("rows_here")).alias("end_rows"),
        ),
        "running-sums",
    )


def greedy_cuts(sums: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity the ends of ``shards`` shards that are filled one after the other."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards):
        bounds = [a + c for a, c in zip(at, capacities)]
        end = F.col("end")
        found = (
            sums.where(end.between(min(at), max(bounds)))
            .agg(*(F.max(F.when(end <= b, end)).alias(f"cut{j}") for j, b in enumerate(bounds)))
            .first()
        )
        at = [max(a, f or 0) for a, f in zip(at, found)]
        for own, a in zip(cuts, at):
            own.append(a)
    return cuts


def smallest_capacity(sums: DataFrame, total: int, largest: int, shards: int) -> int:
    """Binary search between what some shard must hold and what is always enough."""
    mean = -(-total // shards)
    low, high = max(mean, largest), mean + largest
    while low < high:
        step = max(1, (high - low) >> LEVELS)
        tested = list(range(low, high, step))
        ends = [own[-1] for own in greedy_cuts(sums, tested, shards)]
        fits = [c for c, end in zip(tested, ends) if end == total]
        fails = [c for c, end in zip(tested, ends) if end != total]
        high = min(fits, default=high)
        low = max(fails, default=low - 1) + 1
    return high


def minimax_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document with its shard and slot, equal texts together.

    The law is ``bytes``: the largest shard is as small as contiguous groups allow. A document's
    size is the UTF-8 bytes of its text plus 1. A null text counts as empty and joins the
    group of empty texts. Slots are gapless from 0 in the order of digest and id, repeated rows
    taking one each. An empty table gives no rows; with fewer groups than shards the
    last ones stay empty. Other columns are not looked at.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        columns(docs, doc_id="doc_id", text="text").select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("key"),
        ),
        "sizes",
    )
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    sums = running_sums(groups)
    total, largest = sums.agg(F.max("end"), F.max("bytes")).first()
    borders = []
    if total:
        capacity = smallest_capacity(sums, total, largest, shards)
        cuts = sorted(set(greedy_cuts(sums, [capacity], shards)[0][:-1]))
        found = {r["end"]: r for r in sums.where(F.col("end").isin(cuts)).collect()}
        borders = [found[c] for c in cuts]

    placed = numbered(rows.withColumn("copy", F.monotonically_increasing_id()), "key", "doc_id", "copy")
    before = before_tasks(placed, rows_before="count(*)")
    shard, first = F.lit(0), F.lit(0).cast("long")
    for border in borders:
        behind = F.col("key") > border["key"]
        shard = shard + behind.cast("int")
        first = F.when(behind, F.lit(border["end_rows"])).otherwise(first)
    return placed.join(F.broadcast(before), "task").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        shard.alias("shard"),
        (F.col("rows_before") + F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
