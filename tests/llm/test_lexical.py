"""Ranked search against scores added up one by one."""

import brute
from assaymill.llm import lexical
from assaymill.llm.lexical import rank_documents
from cases import CLASHING, ODD, SF

COLUMNS = ("item_id", "rank", "doc_id", "score")


def listed(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def expected(docs, items, k=50):
    return sorted(brute.ranking(docs, items, k), key=repr)


def tables(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    for name in [c for c in CLASHING if c != "text"] + ["m", "n", "item", "score", "term", "number", "block"]:
        docs, items = docs.selectExpr("*", f"'x' AS `{name}`"), items.selectExpr("*", f"'x' AS `{name}`")
    return docs, items


def test_query_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    asked = [tuple(r) for r in items.select("item_id", "text").collect()]
    assert listed(rank_documents(docs, items)) == expected(rows, asked)


ITEMS = [
    (1, "Word3 other, word3 WORD7 nowhere"),
    (2, None),
    (3, " \t"),
    (4, "one MORE"),
    (4, "end"),
    (None, "é word1"),
    (None, "more"),
    (5, "x" * 70_000 + " one"),
    (6, "nowhere at all to be found"),
]


def test_odd_rows(spark):
    docs = ODD + [(20, "one"), (20, "one"), (21, "One one-one"), (19, "one")]
    assert listed(rank_documents(*tables(spark, docs, ITEMS))) == expected(docs, ITEMS)


def test_a_third_of_all_rows_are_copies(spark):
    docs = [(i, f"common word{i % 7} tail{i}") for i in range(200)] + [(1000 + i, "common hot word3") for i in range(100)]
    items = [(1, "common hot"), (2, "word3 tail5"), (3, "tail7 hot common word1")]
    found = rank_documents(*tables(spark, docs, items), k=5)
    assert listed(found) == expected(docs, items, 5)


def test_small_blocks_and_several_passes(spark, monkeypatch):
    for name, value in (
        ("VOCABULARY", 4), ("ITEM_TERMS", 4), ("BLOCK_POSTINGS", 3), ("BLOCK_DOCUMENTS", 2), ("ITEMS", 2),
    ):
        monkeypatch.setattr(lexical, name, value)
    docs = [(i % 37, f"alpha beta{i % 5} gamma{i % 3} {'alpha ' * (i % 4)}") for i in range(60)] + ODD
    items = [(i, f"alpha beta{i} gamma{i % 2} delta one") for i in range(6)]
    assert listed(rank_documents(*tables(spark, docs, items), k=3)) == expected(docs, items, 3)


def test_empty_tables(spark):
    docs, items = tables(spark, [], ITEMS)
    assert listed(rank_documents(docs, items)) == []
    docs, items = tables(spark, ODD, [])
    assert listed(rank_documents(docs, items)) == []
