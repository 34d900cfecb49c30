"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors of a label by random directions, again and again, until a leaf is small.
Vectors near a split go to both sides. What shares a leaf of any tree is compared exactly; pairs of at
least the wanted cosine are counted once over the forest and joined into components.

The trees grow in rounds. A round fits the next levels of every leaf that still is too large on a bounded
sample of it and sends all its vectors down, so no list of vectors is ever in one place. Groups that a
split would tear apart, such as one of very many near copies, stay one leaf and are compared block by block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored
from assaymill.llm.components import components

COSINE = 0.93
TREES = 8
#: Vectors to a leaf at most, unless no split parts them.
LEAF = 1024
#: Vectors that a leaf's next levels are fitted on, about, and the levels that one round adds at most.
SAMPLE = 4096
LEVELS = 10
#: Sampled vectors on which a split is fitted at least; a larger leaf is split on in the next round.
LEAST_SAMPLE = 32
#: Half the width of the zone that goes to both sides of a split, in parts of the spread that a
#: random direction gives to the difference of two vectors just similar enough.
SPILL = 0.25
#: Directions tried for a split; the one with the fewest vectors in its zone, for what it parts, is taken.
DIRECTIONS = 4
#: A split with a larger part of the vectors in its zone is not made: it would part too many links.
CROWDED = 0.15
#: Where a split may lie among the vectors it parts, as quantiles.
QUANTILES = np.arange(0.15, 0.851, 0.05)
_BITS = -(QUANTILES * np.log2(QUANTILES) + (1 - QUANTILES) * np.log2(1 - QUANTILES))
#: Vectors that a task sends down or holds of one leaf.
CHUNK = 1 << 13
#: Rows of products held at once.
ROWS = 512


def _direction(leaf: int, heap: int, attempt: int, size: int) -> np.ndarray:
    """The random unit direction of a node: always the same."""
    made = np.random.default_rng([leaf & 0xFFFFFFFFFFFFFFFF, heap, attempt]).standard_normal(size)
    return made / np.linalg.norm(made)


def zone(cosine: float, size: int) -> float:
    """Half the width of a split's zone."""
    return SPILL * np.sqrt((2 - 2 * cosine) / size)


def unit(vectors) -> np.ndarray:
    """Vectors as rows of doubles of length 1."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1)[:, None]  # so that squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def fit(leaf: int, sample: np.ndarray, size: int, cosine: float) -> list[tuple[int, int, float]]:
    """Splits of a leaf of ``size`` vectors, from a sample: (node in heap order, direction, threshold).

    A node without a split is a leaf of its own.
    """
    width, splits = zone(cosine, sample.shape[1]), []
    least = max(LEAST_SAMPLE, LEAF * len(sample) / size)
    todo = [(1, np.arange(len(sample)))]
    while todo:
        heap, own = todo.pop()
        if len(own) <= least or heap >= 1 << LEVELS:
            continue
        tried = []
        for attempt in range(DIRECTIONS):
            at = np.sort(sample[own] @ _direction(leaf, heap, attempt, sample.shape[1]))
            cuts = np.quantile(at, QUANTILES)
            crowd = (np.searchsorted(at, cuts + width) - np.searchsorted(at, cuts - width)) / len(own)
            cost = (crowd + 1 / len(own)) / _BITS
            best = int(np.argmin(cost))
            tried.append((float(cost[best]), attempt, float(cuts[best]), float(crowd[best])))
        _, attempt, cut, crowd = min(tried)
        if crowd > CROWDED:
            continue
        splits.append((heap, attempt, cut))
        at = sample[own] @ _direction(leaf, heap, attempt, sample.shape[1])
        todo += [(2 * heap, own[at < cut + width]), (2 * heap + 1, own[at >= cut - width])]
    return splits


def send_down(leaf: int, splits: dict[int, tuple[int, float]], vectors: np.ndarray, cosine: float):
    """Yield (node, rows) of the nodes without a split that the vectors arrive at."""
    width, todo = zone(cosine, vectors.shape[1]), [(1, np.arange(len(vectors)))]
    while todo:
        heap, own = todo.pop()
        if heap not in splits or not len(own):
            yield heap, own
            continue
        attempt, cut = splits[heap]
        at = vectors[own] @ _direction(leaf, heap, attempt, vectors.shape[1])
        todo += [(2 * heap, own[at < cut + width]), (2 * heap + 1, own[at >= cut - width])]


def _fitting(cosine: float):
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        leaf, size = int(rows["leaf"].iloc[0]), int(rows["size"].iloc[0])
        rows = rows.sort_values("node")
        splits = fit(leaf, unit(rows["vector"]), size, cosine)
        heaps, attempts, cuts = ([s[i] for s in splits] for i in range(3))
        return pd.DataFrame({"leaf": [leaf], "heaps": [heaps], "attempts": [attempts], "cuts": [cuts]})

    return of


def _sending(cosine: float):
    def of(rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"node": [], "leaf": [], "heap": [], "split": []})
        leaf, splits = int(rows["leaf"].iloc[0]), {}
        for tree in trees.itertuples():
            splits = {int(h): (int(a), float(c)) for h, a, c in zip(tree.heaps, tree.attempts, tree.cuts)}
        nodes = rows["node"].to_numpy()
        found = list(send_down(leaf, splits, unit(rows["vector"]), cosine))
        return pd.DataFrame(
            {
                "node": np.concatenate([nodes[own] for _, own in found]),
                "leaf": leaf,
                "heap": np.repeat([h for h, _ in found], [len(own) for _, own in found]),
                "split": bool(splits),
            }
        )

    return of


def grown(vectors: DataFrame, cosine: float) -> DataFrame:
    """``node``, ``label`` and ``leaf`` of every leaf that a vector arrives at, over all trees.

    A label with few vectors is one leaf of one tree. Rounds go on until each leaf is small or cannot be
    split; with ``SAMPLE`` / ``LEAF`` and more leaves from each round there are few.
    """
    labels = vectors.groupBy("label").agg(F.count("*").alias("size"))
    trees = F.sequence(F.lit(0), F.when(F.col("size") > LEAF, TREES - 1).otherwise(0))
    roots = labels.select("label", F.explode(trees).alias("tree"), (F.col("size") <= LEAF).alias("done"))
    roots = stored(roots.withColumn("leaf", F.xxhash64("label", "tree")), "roots")
    members = stored(vectors.select("node", "label").join(roots.drop("tree"), "label"), "members")
    closed = []
    while True:
        closed.append(members.where("done").select("node", "label", "leaf"))
        sizes = members.where("not done").groupBy("leaf").agg(F.count("*").alias("size"))
        sizes = stored(sizes, "leaf-sizes")
        closed.append(
            members.where("not done").join(sizes.where(F.col("size") <= LEAF), "leaf").select("node", "label", "leaf")
        )
        large = sizes.where(F.col("size") > LEAF)
        if not large.limit(1).count():
            break
        still = members.where("not done").join(large, "leaf").select("node", "label", "leaf", "size")
        opened = stored(still.join(vectors.select("node", "vector"), "node"), "open")
        share = F.pmod(F.xxhash64("node", "leaf", F.lit(1)), F.col("size")) < SAMPLE
        kinds = "leaf bigint, heaps array<bigint>, attempts array<bigint>, cuts array<double>"
        trees = opened.where(share).groupBy("leaf").applyInPandas(_fitting(cosine), kinds)
        chunks = F.ceil(F.col("size") / CHUNK)
        sown = stored(trees, "subtrees").join(large, "leaf")
        sown = sown.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        dealt = opened.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
        sent = (
            dealt.select("node", "vector", "leaf", "chunk").groupBy("leaf", "chunk")
            .cogroup(sown.select("leaf", "chunk", "heaps", "attempts", "cuts").groupBy("leaf", "chunk"))
            .applyInPandas(_sending(cosine), "node bigint, leaf bigint, heap bigint, split boolean")
        )
        # A vector has its label from its former leaf; a leaf that could not be split is done.
        of_leaf = opened.select("leaf", "label").distinct()
        members = stored(
            sent.join(of_leaf, "leaf").select(
                "node",
                "label",
                F.when(F.col("split"), F.xxhash64("leaf", "heap")).otherwise(F.col("leaf")).alias("leaf"),
                (~F.col("split")).alias("done"),
            ),
            "members",
        )
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return stored(out, "forest")


def _reached(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the component of each row and each column of a link matrix; -1 without links."""
    rows, cols = np.full(links.shape[0], -1), np.full(links.shape[1], -1)
    number = 0
    for start in np.flatnonzero(links.any(axis=1)):
        if rows[start] >= 0:
            continue
        front = np.array([start])
        rows[start] = number
        while len(front):
            met = np.flatnonzero(links[front].any(axis=0) & (cols < 0))
            cols[met] = number
            front = np.flatnonzero(links[:, met].any(axis=1) & (rows < 0)) if len(met) else met
            rows[front] = number
        number += 1
    return rows, cols


def _shared_before(a, b, leaf: int) -> np.ndarray:
    """Which pairs also share a leaf with a smaller number, where they are counted instead."""
    numbers = {}
    tables = []
    for leaves in (a, b):
        places = [
            (row, numbers.setdefault(int(x), len(numbers))) for row, own in enumerate(leaves) for x in own if x < leaf
        ]
        tables.append(places)
    marks = []
    for leaves, places in zip((a, b), tables):
        mark = np.zeros((len(leaves), max(1, len(numbers))), np.float32)
        if places:
            mark[tuple(np.array(places).T)] = 1
        marks.append(mark)
    return marks[0] @ marks[1].T > 0


def compare(leaf: int, a: pd.DataFrame, b: pd.DataFrame | None, cosine: float):
    """Links between two blocks of a leaf, or within one: counts by node, and a spanning forest.

    Returns rows (node, other): for ``other`` null ``n`` is the copies linked that no other leaf
    counts, else a link of the forest. With ``b`` None the block is compared with itself.
    """
    other = a if b is None else b
    left, right = unit(a["vector"]), unit(other["vector"])
    links = np.zeros((len(a), len(other)), bool)
    for at in range(0, len(a), ROWS):
        links[at : at + ROWS] = left[at : at + ROWS] @ right.T >= cosine
    if b is None:
        np.fill_diagonal(links, False)
    rows, cols = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    if not len(rows):
        return [], [], []
    links = links[np.ix_(rows, cols)]
    owned = links & ~_shared_before(a["leaves"].iloc[rows], other["leaves"].iloc[cols], leaf)
    nodes, counts = [a["node"].to_numpy()[rows]], [owned @ other["copies"].to_numpy()[cols]]
    if b is not None:
        nodes.append(other["node"].to_numpy()[cols])
        counts.append(owned.T @ a["copies"].to_numpy()[rows])
    row_of, col_of = _reached(links)
    ids = np.concatenate([a["node"].to_numpy()[rows], other["node"].to_numpy()[cols]])
    of = np.concatenate([row_of, col_of])
    if b is None:  # a row and its column are one vector
        whole, _ = _reached(links | np.eye(len(rows), dtype=bool))
        ids, of = a["node"].to_numpy()[rows], whole
    order = np.lexsort((ids, of))
    ids, of = ids[order], of[order]
    head = ids[np.searchsorted(of, of)]
    kept = ids != head
    return np.concatenate(nodes), np.concatenate(counts), np.stack([ids[kept], head[kept]], axis=1)


def _comparing(cosine: float):
    def of(key, rows):
        leaf, blocks = key[1].as_py(), sorted(set(rows["block"].to_pylist()))
        frame = rows.select(["node", "copies", "vector", "leaves", "block"]).to_pandas()
        parts = [frame[frame["block"] == x] for x in blocks]
        if key[2].as_py() == key[3].as_py():
            parts.append(None)
        if len(parts) < 2:
            nodes, counts, links = [], [], []
        else:
            nodes, counts, links = compare(leaf, parts[0], parts[1], cosine)
        none = [None] * len(nodes)
        return pa.table(
            {
                "node": pa.array([*nodes, *(x[0] for x in links)], pa.int64()),
                "n": pa.array([*counts, *([0] * len(links))], pa.int64()),
                "other": pa.array([*none, *(x[1] for x in links)], pa.int64()),
            }
        )

    return of


def compared(vectors: DataFrame, forest: DataFrame, cosine: float) -> DataFrame:
    """All leaves' comparisons: ``node`` with ``n`` linked copies, or with ``other`` as a link.

    A leaf of more than ``CHUNK`` vectors is dealt in blocks, and each pair of blocks is a group of its own.
    """
    leaves = forest.groupBy("node").agg(F.collect_set("leaf").alias("leaves"))
    sizes = stored(forest.groupBy("label", "leaf").agg(F.ceil(F.count("*") / CHUNK).alias("blocks")), "blocks")
    rows = forest.join(sizes, ["label", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("low"), F.greatest(x, F.col("block")).alias("high")),
    )
    groups = (
        rows.withColumn("pair", F.explode(pairs))
        .join(vectors.select("node", "copies", "vector").join(leaves, "node"), "node")
        .select("node", "label", "leaf", "block", "copies", "vector", "leaves", F.col("pair.low").alias("low"), F.col("pair.high").alias("high"))
    )
    found = groups.groupBy("label", "leaf", "low", "high").applyInArrow(
        _comparing(cosine), "node bigint, n bigint, other bigint"
    )
    return stored(found, "compared")


def usable(vector: F.Column) -> F.Column:
    """Whether a vector has a direction: not null or empty, all components finite, some not 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: links to other vectors, component, and whether it is kept.

    Vectors are compared within a label. A null label, and a vector that is null, empty, zero or has a null
    or non-finite component, links with nothing; nor do vectors of different lengths. Equal vectors are
    one class with its number of copies, so copies are counted and not compared. Rows are vectors each for
    itself: repeated rows link with each other. A component is named by its smallest vec_id; one of rows
    without ids has none, and such a row is kept if it stands alone. An empty table gives no rows. Other
    columns are not looked at.
    """
    names = columns(embeddings, vec_id="vec_id", embedding="embedding", label="label")
    rows = names.withColumn("size", F.when(usable(F.col("embedding")) & F.col("label").isNotNull(), F.size("embedding")))
    same = ["label", "embedding"]
    classes = rows.where("size is not null").groupBy(*same, "size").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    # Vectors of another length are another space.
    vectors = classes.select("node", "copies", F.struct("label", "size").alias("label"), F.col("embedding").alias("vector"))
    found = compared(vectors, grown(vectors, cosine), cosine)
    linked = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    of_class = classes.join(linked, "node", "left").join(joined, "node", "left").select(
        *same, "least", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "node").alias("component")
    )
    of_class = stored(of_class, "linked-classes")
    least = stored(of_class.groupBy("component").agg(F.min("least").alias("least_id")), "least-ids")
    named = of_class.drop("least").join(least, "component")
    named = named.select(*(F.col(c).alias(f"{c}_") for c in same), "copies", "n", "least_id")
    own = rows["size"].isNotNull() & (rows["label"] == named["label_"]) & (rows["embedding"] == named["embedding_"])
    n_links = F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0))
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("least_id"))
    kept = F.when(F.col("vec_id").isNull(), n_links == 0).otherwise(F.col("vec_id") == component)
    return rows.join(named, own, "left").select(
        "vec_id",
        n_links.alias("n_links"),
        component.alias("component_id"),
        kept.alias("kept"),
    )

