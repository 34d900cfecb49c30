"""JSON text to columns, parsed once per record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters cannot pull back into themselves.

    Catalyst moves a filter below the projection it reads from and repeats the
    projected expression inside it, once per use. For a JSON parse that means
    dozens of parses per row. A filter does not move below a generator's output,
    so the value goes through an ``explode`` of a one-element array: one row in,
    one row out, also when the value is NULL and also on a stream.

    Project values with lambdas first: a generator's arguments are only compiled
    when all of them can be.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def compute_in_place(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The same, compiled together with the steps around it instead of a generator's copy of every row.

    The value hangs on a condition that always holds and that Catalyst takes for one that may change, so neither
    a filter nor a projection above repeats it. For plans whose compiled methods stay small: the JVM
    leaves a method of more than 8,000 bytes to its interpreter.
    """
    return df.select("*", F.when(F.spark_partition_id() >= 0, value).alias(name))


def parse_json(df: DataFrame, column: str, schema: str, into: str = "parsed") -> DataFrame:
    """Parse ``column`` permissively into a struct, the text of a failure kept inside."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return compute_once(df, into, F.from_json(column, f"{schema}, {CORRUPT} string", options))


def parse_succeeded(parsed: str = "parsed") -> Column:
    """False for broken or mistyped documents and for text that holds no document."""
    return F.col(parsed).isNotNull() & F.col(f"{parsed}.{CORRUPT}").isNull()


def flatten(parsed: str, paths: Mapping[str, str]) -> list[Column]:
    """One top-level column per entry of ``paths`` (new name to dotted path)."""
    return [F.col(f"{parsed}.{path}").alias(name) for name, path in paths.items()]
