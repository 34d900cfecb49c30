"""Helpers shared by the operators: words, stored steps, table reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.session import shared_folder

#: White space between words, as a class for Java and RE2.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that others cannot clash."""
    return df.select(*(df[f"`{source}`"].alias(name) for name, source in named.items()))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage.

    The folder is on storage that all executors see, so a lost executor costs
    only the tasks it was running. An aggregate that is stored before a join on its keys also lets
    adaptive execution split the join's hot keys, which it cannot above an aggregate.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` does just that when all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
