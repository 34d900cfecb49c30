"""The manifest and its recursive climb against a plain tree."""

import pytest

import brute
from assaymill.llm import merkle
from assaymill.llm.merkle import merkle_manifest
from cases import CLASHING, ODD, SF

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
KINDS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def listed(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def made(spark, rows):
    names = [c for c in CLASHING if c not in ("text",)] + ["left", "level", "tree", "lo", "n"]
    df = spark.createDataFrame(rows, KINDS)
    for name in names:
        df = df.selectExpr("*", f"'other' AS `{name}`")
    return merkle_manifest(df)


def test_query_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = listed(merkle_manifest(docs))
    assert found == sorted(brute.manifest(rows), key=repr)
    assert 0 < sum(r[-1] for r in found) < len(found)


@pytest.mark.parametrize("block", [1, 4, 4096])
def test_odd_rows(spark, monkeypatch, block):
    """Null, empty and long texts, null ids and languages, ties, equal rows and a hot language."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    langs = [None, "en", "", "en", "é"]
    rows = [(i, None if n % 3 else "s", langs[n % 5], n, t) for n, (i, t) in enumerate(ODD)]
    rows += [(100 + n, "hot", "en", None, f"Text {n}") for n in range(90)]
    rows += [(500, "hot", "en", 1, "Equal")] * 20
    assert listed(made(spark, rows)) == sorted(brute.manifest(rows), key=repr)


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_sizes_around_full_runs(spark, n):
    rows = [(i, "s", "en", 3, "ABC") for i in range(n)]
    assert listed(made(spark, rows)) == sorted(brute.manifest(rows), key=repr)


def test_many_languages_of_one_row(spark):
    rows = [(i, "s", f"l{i:03d}", 3, "ABC") for i in range(70)]
    assert listed(made(spark, rows)) == sorted(brute.manifest(rows), key=repr)


def test_empty_table(spark):
    assert listed(made(spark, [])) == []
