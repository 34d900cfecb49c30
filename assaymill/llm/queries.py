"""The registered queries of the operators, and SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaymill.llm import checks
from assaymill.llm.common import table
from assaymill.llm.decontaminate import decontaminate
from assaymill.llm.extraction import extract
from assaymill.llm.forest import near_vectors
from assaymill.llm.lexical import rank_documents
from assaymill.llm.merkle import merkle_manifest
from assaymill.llm.near_duplicates import near_duplicates
from assaymill.llm.packing import pack
from assaymill.llm.quality import quality_rules
from assaymill.llm.repeats import remove_repeats
from assaymill.llm.secret_scan import scan_secrets
from assaymill.llm.sharding import minimax_shards
from assaymill.llm.units import remove_repeated_units
from assaymill.llm.warc import archived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(checks.SQL)


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(table(spark, sf_dir, "documents"))


@query
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), tokenizer)


@query
def op8_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_units(table(spark, sf_dir, "documents"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


@query
def op7_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))
