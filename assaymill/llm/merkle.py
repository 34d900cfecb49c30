"""Merkle manifest of a dataset, and a proof for every row by a recursive query.

Rows are leaves. Per language, runs of eight consecutive nodes become their parent until one
node is left, the subroot; subroots become the root in the same way. Each level is stored as
rows that name their parent and hold their siblings' digests. A recursive query then climbs
from all leaves at once: each step appends the siblings it meets and folds every leaf's digest with
them, until it arrives at the root. The leaves of a run meet the same siblings above it, so they climb
in one row, which holds those siblings once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import ascii_lower, columns, stored
from assaymill.llm.sharding import before_tasks, numbered
from assaymill.session import setting

#: Consecutive nodes that become one parent.
ARITY = 8
#: Leaves to a block. A node above the leaves has one row for each block it covers, so that no more
#: than this many climbing rows meet in one row, whatever the level.
BLOCK = 4096
#: Leaves are tampered with where this divides the checksum of their id.
TAMPERED = 3

# The tree over the subroots; a language's own tree has its number, from 0.
TOP = -1
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of all parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value with its length in front, so that no two rows give the same bytes; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def positions(df: DataFrame, into: str, *order: str) -> DataFrame:
    """``df`` with the place of each row in the whole order, from 0, over range partitions."""
    rows = numbered(df, *order)
    before = before_tasks(rows, rows_before="count(*)")
    place = (F.col("rows_before") + F.col("place")).alias(into)
    return rows.join(F.broadcast(before), "task").select(*df.columns, place)


def leaves(docs: DataFrame) -> DataFrame:
    """Digest of every row, and of the row after tampering, where there is any."""
    rows = columns(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    fields = [framed(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = digest(*fields, framed(F.col("text")))
    forged = digest(*fields, framed(ascii_lower(F.col("text"))))
    checksum = F.crc32(F.col("doc_id").cast("string"))
    tampered = F.coalesce(checksum % TAMPERED == 0, F.lit(False))
    return stored(
        rows.select(
            "doc_id", "lang", F.unhex(leaf).alias("hash"),
            F.unhex(F.when(tampered, forged).otherwise(leaf)).alias("forged"),
        ),
        "leaves",
    )


def _joined(nodes: Column) -> Column:
    """The digests of some nodes as one binary."""
    return F.aggregate(nodes, F.lit(b""), lambda all_, node: F.concat(all_, node["hash"]))


def _before(nodes: str, pos: Column) -> Column:
    return _joined(F.filter(nodes, lambda x: x["pos"] < pos))


def _after(nodes: str, pos: Column) -> Column:
    return _joined(F.filter(nodes, lambda x: x["pos"] > pos))


def runs_of(level: DataFrame, *more: str) -> DataFrame:
    """One row per run of nodes, at most ``ARITY`` of them in order; ``n`` are the nodes of the tree's level."""
    run = F.array_sort(F.collect_list(F.struct("pos", "hash", *more)))
    return level.groupBy("tree", F.expr(f"pos div {ARITY}").alias("run"), "n").agg(
        run.alias("nodes"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def above(runs: DataFrame) -> DataFrame:
    """The parents of runs: the next level."""
    return runs.select(
        "tree",
        F.col("run").alias("pos"),
        F.unhex(F.sha2(hex_text(_joined(F.col("nodes"))), 256)).alias("hash"),
        F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
        "lo",
        "hi",
    )


def links(runs: DataFrame, level: int) -> DataFrame:
    """The nodes of runs as rows that name their parent and hold the digests before and after their own.

    One row for each block of leaves from ``lo`` to ``hi`` that the run covers.
    """
    blocks = F.sequence(F.expr(f"lo div {BLOCK}"), F.expr(f"hi div {BLOCK}"))
    each = runs.select("*", F.explode("nodes").alias("node")).select(
        "tree", "run", "n", "nodes", "node.pos", "node.lo", "node.hi"
    )
    return each.select(
        "tree",
        F.lit(level).alias("level"),
        "pos",
        *parent(F.lit(level + 1)),
        _before("nodes", F.col("pos")).alias("left"),
        _after("nodes", F.col("pos")).alias("right"),
        F.explode(blocks).alias("block"),
    )


def parent(level: Column) -> list[Column]:
    """Where a run's nodes go on: to their parent, which for a language's last run is a leaf of the tree above."""
    subroot = (F.col("n") <= ARITY) & (F.col("tree") != TOP)
    return [
        F.when(subroot, TOP).otherwise(F.col("tree")).cast("long").alias("parent_tree"),
        F.when(subroot, 0).otherwise(level).alias("parent_level"),
        F.when(subroot, F.col("tree")).otherwise(F.col("run")).alias("parent_pos"),
    ]


def built(level: DataFrame, number: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Link rows from a level upwards until one node a tree is left, and the levels."""
    rows, levels = [], [level]
    while levels[-1].where("n > 1").limit(1).count():
        runs = stored(runs_of(levels[-1].where("n > 1"), "lo", "hi"), "runs")
        rows.append(links(runs, number + len(rows)))
        levels.append(stored(above(runs), "level"))
    return rows, levels


CLIMB = """
    WITH RECURSIVE climb(run, block, tree, level, pos, proof, folded) AS (
        SELECT run, block, tree, level, pos, proof, folded FROM {start}
        UNION ALL
        SELECT c.run, c.block, n.parent_tree, n.parent_level, n.parent_pos,
            concat(c.proof, n.left, n.right),
            transform(c.folded, x -> unhex(sha2(
                concat(lower(hex(n.left)), lower(hex(x)), lower(hex(n.right))), 256)))
        FROM climb c JOIN {nodes} n
            ON c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.pos = n.pos
    )
    SELECT run, proof, folded FROM climb WHERE tree = {top} AND level = {height}
"""


def climb_start(runs: DataFrame) -> DataFrame:
    """The leaves' runs at their parents, with the digests folded from tampered leaves.

    A leaf that is its language's only one is a subroot as it is.
    """
    alone = F.col("n") == 1
    folded = F.transform(
        "nodes",
        lambda x: F.unhex(
            F.sha2(
                F.concat(hex_text(_before("nodes", x["pos"])), hex_text(x["forged"]), hex_text(_after("nodes", x["pos"]))),
                256,
            )
        ),
    )
    tree, level, pos = parent(F.lit(1))
    return runs.select(
        F.col("lo").alias("run"),
        F.expr(f"lo div {BLOCK}").alias("block"),
        tree.alias("tree"),
        level.alias("level"),
        pos.alias("pos"),
        F.lit(b"").alias("proof"),
        F.when(alone, F.transform("nodes", lambda x: x["forged"])).otherwise(folded).alias("folded"),
    )


def climbed(start: DataFrame, nodes: DataFrame, height: int) -> DataFrame:
    """All runs at the root, with the siblings above them and the roots folded on the way."""
    spark = start.sparkSession
    with setting(spark, ROW_LIMIT, "-1"):
        return stored(spark.sql(CLIMB, start=start, nodes=nodes, top=TOP, height=height), "climbed")


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per document with its leaf, subroot, root, proof and the root folded from its tampered leaf.

    A leaf is the digest of the row's five columns, each null written as ``-``. Leaves stand by language
    (null first, then by UTF-8 bytes), id (null first) and digest, so rows with the same id are told apart by
    what they hold, and equal rows are leaves of their own. A row without an id is never tampered with.
    Texts of any length are hashed whole. A table with one row has an empty proof and its leaf as root.
    An empty table gives no rows. Other columns are not looked at.
    """
    placed = stored(positions(leaves(docs), "row", "lang", "doc_id", "hash"), "placed-leaves")
    langs = placed.groupBy("lang").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    trees = stored(positions(langs, "tree", "lang"), "trees")
    bottom = placed.join(trees, placed["lang"].eqNullSafe(trees["lang"])).select(
        "tree",
        (F.col("row") - F.col("first")).alias("pos"),
        "hash",
        (F.col("last") - F.col("first") + 1).alias("n"),
        F.col("row").alias("lo"),
        F.col("row").alias("hi"),
        "forged",
        "doc_id",
    )
    leaf_runs = stored(runs_of(bottom, "forged", "doc_id"), "leaf-runs")
    low, levels = built(stored(above(leaf_runs.where("n > 1")), "level"), 1)
    alone = leaf_runs.where("n = 1").select("tree", F.col("nodes")[0]["hash"].alias("hash"))
    subroots = reduce(
        DataFrame.unionByName, (x.where("n = 1").select("tree", "hash") for x in levels), alone
    ).join(trees, "tree")
    n_trees = F.lit(trees.count()).cast("long")
    top = stored(
        subroots.select(
            F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", n_trees.alias("n"),
            F.col("first").alias("lo"), F.col("last").alias("hi"),
        ),
        "subroots",
    )
    high, top_levels = built(top, 0)

    names = "tree long, level int, pos long, parent_tree long, parent_level int, parent_pos long, left binary, right binary, block long"
    none = docs.sparkSession.createDataFrame([], names)
    nodes = stored(reduce(DataFrame.unionByName, low + high, none), "links")
    proofs = climbed(stored(climb_start(leaf_runs), "climb-start"), nodes, len(high))

    last = top_levels[-1].select(hex_text(F.col("hash"))).first()
    root = F.lit(last[0] if last else "")
    subroot = top.select(F.col("pos").alias("of_tree"), hex_text(F.col("hash")).alias("subroot"))
    siblings = F.concat(_before("nodes", F.col("node.pos")), _after("nodes", F.col("node.pos")))
    folded = hex_text(F.element_at("folded", F.col("place") + 1))
    each = leaf_runs.join(proofs.withColumnRenamed("run", "of_run"), F.col("lo") == F.col("of_run")).select(
        "*", F.posexplode("nodes").alias("place", "node")
    )
    return each.join(subroot, F.col("tree") == F.col("of_tree")).select(
        "node.doc_id",
        hex_text(F.col("node.hash")).alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(hex_text(F.concat(siblings, "proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
