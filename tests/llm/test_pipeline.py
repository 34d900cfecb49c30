"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from assaymill.llm.quality import BUCKETS, THRESHOLD  # noqa: E402
from cases import SF, rows  # noqa: E402
from test_free import check_packing  # noqa: E402


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read as the next one's documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(folder)
        docs = out[name] = spark.read.parquet(folder)
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages(stages):
    assert list(stages) == ["documents", "quality", "near_duplicates", "decontamination", "secrets", "packing"]
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality(spark, stages):
    docs = pairs(stages["documents"])
    score = brute.scores(docs, rows(spark, "labels", "doc_id", "quality", "toxic"), BUCKETS)
    kept = [d for d, s in zip(docs, score) if not brute.base_counts(d[1])["base_failed"] and s >= THRESHOLD]
    assert sorted(pairs(stages["quality"])) == sorted(kept)


def test_near_duplicates(stages):
    docs = pairs(stages["quality"])
    component = brute.near_components(docs, 5, 80)
    assert sorted(pairs(stages["near_duplicates"])) == sorted(d for d in docs if component[d[0]] == d[0])


def test_decontamination(spark, stages):
    docs = pairs(stages["near_duplicates"])
    bad = {r[0] for r in brute.contamination(docs, rows(spark, "benchmark", "item_id", "text")) if r[5]}
    assert sorted(pairs(stages["decontamination"])) == sorted(d for d in docs if d[0] not in bad)


def test_secrets(stages):
    before, after = dict(pairs(stages["decontamination"])), dict(pairs(stages["secrets"]))
    assert set(before) == set(after)
    for doc_id, text in before.items():
        spans = brute.base_spans(text)
        if not spans and text == after[doc_id]:
            continue
        assert "[SECRET]" in after[doc_id] and not brute.base_spans(after[doc_id])
        first = min([s[0] for s in spans], default=len(text))
        assert after[doc_id][:first].split("[SECRET]")[0] == text[:first][: len(after[doc_id][:first].split("[SECRET]")[0])]


def test_packing(spark, stages):
    check_packing(pairs(stages["secrets"]), stages["packing"].collect())
    names = ["doc_id", "piece", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(tuple(r) for r in whole.select(names).collect()) == Counter(
        tuple(r) for r in stages["packing"].select(names).collect()
    )


@pytest.mark.parametrize("which", ["odd", "nothing"])
def test_all_stages_on_odd_rows_and_on_none(spark, which, request, tmp_path):
    """Null ids and texts, empty, long and repeated ones, and further columns of clashing names."""
    docs = request.getfixturevalue(which)
    given = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == given
    assert {"doc_id", "piece", "sequence_id"} <= set(docs.columns)
    if which == "nothing":
        assert docs.count() == 0
