"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

import brute
from assaymill.llm import forest
from assaymill.llm.forest import near_vectors
from cases import CLASHING

KINDS = "vec_id bigint, embedding array<float>, label int"
COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def listed(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def made(spark, rows):
    df = spark.createDataFrame(rows, KINDS)
    for name in [c for c in CLASHING] + ["leaf", "vector", "copies", "size", "least", "tree"]:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return near_vectors(df)


def test_query_table(spark):
    """Small labels are one leaf each, so nothing may be missed."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert listed(near_vectors(df)) == sorted(brute.vector_links(rows), key=repr)


def test_odd_rows(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 0.0], 1), (5, [nan, 1.0, 0.0], 1),
        (6, [inf, 0.0, 0.0], 1), (7, a, None), (8, a, None), (9, a, 1), (9, a, 1), (10, a, 2), (11, b, 2),
        (12, [1.0, 0.0], 2), (None, b, 1), (None, [0.0, 1.0, 0.0], 1), (13, [3e38, 0.0, 0.0], 1), (14, [1e-38, 0.0, 0.0], 1),
        (15, [-0.0, 0.0, 1.0], 3), (16, [0.0, 0.0, 1.0], 3), (None, None, None),
    ]
    assert listed(made(spark, rows)) == sorted(brute.vector_links(rows), key=repr)


def test_empty_table(spark):
    assert listed(made(spark, [])) == []


def planted(rng, n, size=32):
    """Vectors with near and exact copies in groups of many sizes, some a chain, one a third of all."""
    rows = []
    base = rng.standard_normal((n, size))
    for i, v in enumerate(base):
        rows.append(v)
        copies = n // 2 if i == 0 else i % 4 if i % 3 == 0 else 0
        for _ in range(copies):
            rows.append(v + 0.05 * rng.standard_normal(size) * np.linalg.norm(v) / np.sqrt(size) * rng.uniform(0, 5))
        if i % 10 == 0:
            rows.append(v)
    chain = rng.standard_normal(size)
    for _ in range(20):
        chain = chain + 0.3 * rng.standard_normal(size) * np.linalg.norm(chain) / np.sqrt(size)
        rows.append(chain)
    return [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(rows)]


@pytest.mark.parametrize("leaf, chunk", [(64, 8192), (64, 50)])
def test_recall_of_a_forest_that_grows_in_rounds(spark, monkeypatch, leaf, chunk):
    """Many rounds, leaves and blocks: at least 0.9 of all links, and no link that is none."""
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "SAMPLE", 200)
    monkeypatch.setattr(forest, "LEVELS", 2)
    monkeypatch.setattr(forest, "CHUNK", chunk)
    rows = planted(np.random.default_rng(5), 600)
    truth = {r[0]: r for r in brute.vector_links(rows)}
    found = {r[0]: r for r in listed(made(spark, rows))}
    assert found.keys() == truth.keys()
    assert all(found[i][1] <= truth[i][1] for i in truth)
    assert sum(r[1] for r in found.values()) >= 0.9 * sum(r[1] for r in truth.values())
    same = sum(found[i][2] == truth[i][2] for i in truth)
    assert same >= 0.95 * len(truth)


def test_recall_of_pairs_just_similar_enough():
    """Pairs at a cosine of 0.93 to 0.94 under the production parameters, down nine levels."""
    rng = np.random.default_rng(3)
    size, pairs = 64, 400
    rows = rng.standard_normal((16384, size))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    a = rows[:pairs]
    side = rng.standard_normal((pairs, size))
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    cosine = rng.uniform(0.93, 0.94, pairs)[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    together = np.zeros(pairs, bool)
    leaves = 0
    for tree in range(forest.TREES):
        splits = {h: (t, c) for h, t, c in forest.fit(tree, rows, 1_000_000, 0.93)}
        leaves = max(leaves, len(splits) + 1)
        of_a, of_b = ([set() for _ in range(pairs)] for _ in range(2))
        for table, own in ((a, of_a), (b, of_b)):
            for heap, members in forest.send_down(tree, splits, table, 0.93):
                for m in members:
                    own[m].add(heap)
        together |= np.array([bool(x & y) for x, y in zip(of_a, of_b)])
    assert leaves >= 400
    assert together.mean() >= 0.9
