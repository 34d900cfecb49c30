"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

1. Every text becomes its set of shingle hashes and a sketch; texts with equal sets are one class.
2. Classes that share a band of their sketches are candidates. A bucket is joined to its least member
   only, and the components of these stars are candidate clusters: no pair of a bucket is emitted.
3. Each cluster's full sets meet in blocks of bounded size, where all similarities are counted
   exactly; a block pair returns a spanning forest of its links, never the links themselves.
4. The components of the forests are the answer.

A class of a third of all rows is one row per task from step 1 on. A cluster larger than a
block is dealt to pairs of blocks, so that a task's memory is bounded; its
comparisons then grow with the square of its number of blocks, which exact links inside one
huge group of different texts ask for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored
from assaymill.llm.components import components
from assaymill.llm.shingles import band_keys, shingle_sets, sketches

#: Coordinates of a sketch, and of a band by the similarity asked for: a pair exactly at 0.85
#: is missed with a chance of 2e-9, one at 0.8 of 7e-12.
SKETCH = 512
BAND_ROWS = {85: 8, 80: 6}
#: Texts and shingles that one block holds, about.
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 1 << 20
#: Tasks that compare blocks at most; a task takes several groups beyond that, one after the other.
TASKS = 20_000
#: Bytes of text that are hashed at once.
AT_ONCE = 1 << 21


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``low:high`` of a string column as bytes and offsets, a bounded number of bytes at once."""
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(places, places[low] + AT_ONCE, side="right")) - 1)
        yield low, high, data[places[low] : places[high]], places[low : high + 1] - places[low]
        low = high


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def sketched(docs: DataFrame, k: int, band_rows: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``set_key``, ``n_shingles`` and ``bands``; key and bands are null for empty sets."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_chunks(batch.column("text")):
                hashes, bounds = shingle_sets(data, offsets, k)
                keys = band_keys(sketches(hashes, bounds, SKETCH), band_rows)
                sizes = np.diff(bounds)
                own = [
                    hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
                    for a, b in zip(bounds[:-1], bounds[1:])
                ]
                full = np.where(sizes > 0, keys.shape[1], 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[low:high],
                        batch.column("text_hash")[low:high],
                        pa.array(own, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        _lists(keys[sizes > 0].reshape(-1), np.concatenate(([0], np.cumsum(full)))),
                    ],
                    names=["doc_id", "text_hash", "set_key", "n_shingles", "bands"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, set_key binary, n_shingles bigint, bands array<bigint>"
    return docs.select("doc_id", _text_hash(), "text").mapInArrow(of, schema)


def _text_hash() -> Column:
    """Tells the texts of rows apart that share an id."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """The columns of ``docs`` but ``text``, which becomes ``shingles``, its sorted set."""
    names = [c for c in docs.columns if c != "text"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [batch.column(c) for c in names]
            for low, high, data, offsets in text_chunks(batch.column("text")):
                hashes, bounds = shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays(
                    [c[low:high] for c in others] + [_lists(hashes, bounds)], names=[*names, "shingles"]
                )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.mapInArrow(of, f"{kinds}, shingles array<bigint>")


def similar_pairs(sets: list[np.ndarray], percent: int, half: int | None = None) -> np.ndarray:
    """Pairs (i, j), i < j, of sets with ``100 * common >= percent * union``.

    With ``half``, only pairs across that border. Common elements are counted as a product of
    membership matrices over the elements that two sets have, some columns at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    common = np.zeros((n, n), dtype=np.float32)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    first = np.append(True, elements[1:] != elements[:-1])
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    if len(column):
        column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1
        width = max(64, (1 << 22) // n)
        for low in range(0, int(column[-1]) + 1, width):
            a, b = np.searchsorted(column, [low, low + width])
            member = np.zeros((n, width), dtype=np.float32)
            member[owner[a:b], column[a:b] - low] = 1
            common += member @ member.T
    common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = np.triu(100 * common >= percent * union, 1)
    if half is not None:
        linked[:half, :half] = linked[half:, half:] = False
    return np.argwhere(linked)


def forest(nodes: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Every node of a linked group with the least node of the group."""
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in pairs:
        i, j = find(i), find(j)
        if nodes[i] > nodes[j]:
            i, j = j, i
        root[j] = i
    return [(int(nodes[find(x)]), int(nodes[x])) for x in range(len(nodes)) if find(x) != x]


def _links(percent: int):
    def of(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby("cluster", sort=False):
            part = part.sort_values(["side", "node"], kind="stable")
            half = int((part["side"] == 0).sum()) if part["crossed"].iloc[0] else None
            nodes = part["node"].to_numpy()
            out += forest(nodes, similar_pairs(list(part["shingles"]), percent, half))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return of


def linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``sketched`` rows, and ``set_key`` with its ``component_id``."""
    rows = stored(sketched(docs, k, BAND_ROWS[percent]), "sketches")
    # A class is a set of shingles, whatever ids its rows have; its first row stands for it.
    classes = stored(
        rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("head"), F.max("n_shingles").alias("size"))
        .select(
            F.monotonically_increasing_id().alias("node"), "set_key", "size",
            F.col("head.doc_id").alias("class_id"), F.col("head.text_hash").alias("class_text"),
        ),
        "classes",
    )
    head = (
        (rows["set_key"] == classes["set_key"])
        & (rows["doc_id"] == classes["class_id"])
        & (rows["text_hash"] == classes["class_text"])
    )
    members = rows.join(classes, head).select("node", "bands").dropDuplicates(["node"])
    in_bands = stored(members.select("node", F.explode("bands").alias("band")), "bands")
    buckets = stored(
        in_bands.groupBy("band")
        .agg(F.min("node").alias("least"), F.max("node").alias("last"))
        .where("least < last")
        .select("band", "least"),
        "buckets",
    )
    stars = in_bands.join(buckets, "band").where("node > least")
    clusters = stored(components(stars.select(F.col("least").alias("a"), F.col("node").alias("b"))), "clusters")

    heads = stored(
        classes.join(clusters, "node").select("node", "class_id", "class_text", "size", F.col("component").alias("cluster")),
        "clustered",
    )
    shares = stored(
        heads.groupBy("cluster")
        .agg(F.count("*").alias("texts"), F.sum("size").alias("shingles_of"))
        .withColumn(
            "blocks",
            F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("shingles_of") / BLOCK_SHINGLES)).cast("int"),
        ),
        "cluster-sizes",
    )
    members = heads.join(shares.select("cluster", "blocks"), "cluster")
    # Text of the members; identical rows of one id count once.
    texts = docs.select("doc_id", "text", _text_hash())
    member = (texts["doc_id"] == members["class_id"]) & (texts["text_hash"] == members["class_text"])
    sets = _sets(texts.join(members, member).select("node", "cluster", "blocks", "text"), k).dropDuplicates(["node"])
    # Small clusters share groups of about two blocks; a pair of blocks of a large one is a group of its own.
    small, pairs = F.col("blocks") == 1, F.col("blocks") * (F.col("blocks") + 1) / 2
    load = F.greatest(F.col("texts") / (2 * BLOCK_TEXTS), F.col("shingles_of") / (2 * BLOCK_SHINGLES))
    shared, own_groups = shares.agg(F.sum(F.when(small, load)), F.sum(F.when(~small, pairs))).first()
    groups = int(shared or 0) + 1
    tasks = min(TASKS, groups + int(own_groups or 0))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        sets.withColumn("own", own)
        .withColumn("other", other)
        .select(
            "node",
            "cluster",
            "shingles",
            (F.col("own") != F.col("other")).alias("crossed"),
            F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(groups)))
            .otherwise(
                F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other"))
            )
            .alias("group"),
        )
    )
    # By groups and not by bytes: what a group costs is its comparisons.
    edges = dealt.repartition(tasks, "group").groupBy("group").applyInPandas(_links(percent), "a bigint, b bigint")
    found = stored(components(edges), "components")
    own_classes = stored(
        classes.join(found, "node", "left").select("set_key", "class_id", F.coalesce("component", "node").alias("of")),
        "classes-components",
    )
    least = stored(own_classes.groupBy("of").agg(F.min("class_id").alias("component_id")), "component-ids")
    keys = own_classes.join(least, "of").select(F.col("set_key").alias("key"), "component_id")
    return rows, stored(keys, "class-components")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """One row per document: size of its shingle set, its component and whether it is kept.

    Documents are linked when ``percent`` of the union of their sets is common; the component is
    the least id that links reach, and that document is kept. Texts without words (null, empty)
    are linked with nothing. Rows without an id have no component and are kept. Repeated
    rows are answered each; rows that share an id and differ are linked each by its own text, and
    may be in different components. An empty table gives no rows. Other columns are not looked at. Ids
    are whole numbers.
    """
    docs = columns(docs, doc_id="doc_id", text="text")
    rows, keys = linked(docs, k, percent)
    component = F.coalesce("component_id", "doc_id")
    return rows.join(keys, rows["set_key"] == keys["key"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the one kept of its group, with all their columns.

    Rows without words or without an id stay, repeated rows of a kept id too. A row goes when any row of its id
    does. An empty table gives no rows.
    """
    gone = near_duplicates(docs, k, percent).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def keep_one_row(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, with all its columns: the one of the least id.

    Unlike in ``keep_one``, rows that repeat an id or have none are rows like all others, as each row
    gets a key of its own. Of rows that share the least id, the one of the least text hash stays; rows
    without an id stay only in groups without any. Texts without words are linked with nothing, so all
    their rows stay.
    """
    # The keys are written, so that every later read sees the same ones.
    keyed = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_key")), "keyed-rows")
    rows, keys = linked(keyed.select(F.col("row_key").alias("doc_id"), F.col("row.text").alias("text")), k, percent)
    placed = rows.join(keys, rows["set_key"] == keys["key"]).select(F.col("doc_id").alias("placed_key"), "component_id")
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row.text"), F.col("row_key").alias("first_key"))
    ranked = keyed.select("row_key", order.alias("rank"))
    ranked = stored(
        ranked.join(placed, ranked["row_key"] == placed["placed_key"]).select("row_key", "rank", "component_id"), "ranked-rows"
    )
    first = ranked.groupBy("component_id").agg(F.min("rank").alias("least"), F.count("*").alias("n"))
    first = stored(first.where("n > 1").select(F.col("component_id").alias("group_id"), "least.first_key"), "first-rows")
    gone = ranked.join(first, ranked["component_id"] == first["group_id"]).where("row_key <> first_key")
    gone = gone.select(F.col("row_key").alias("gone_key"))
    return keyed.join(gone, keyed["row_key"] == gone["gone_key"], "left_anti").select("row.*")
