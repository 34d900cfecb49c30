"""Row rules as data: which codes fire on a row, and where the row goes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MALFORMED = "MALFORMED_JSON"


@dataclass(frozen=True)
class Rule:
    """``code`` is reported on rows where the SQL condition ``fires``. NULL does not fire."""

    code: str
    fires: str


def error_codes(rules: Sequence[Rule], readable: Column) -> Column:
    """Codes of all rules that fire, in rule order; an unreadable row has just one."""
    fired = F.array_compact(F.array(*(F.when(F.expr(r.fires), F.lit(r.code)) for r in rules)))
    return F.when(readable, fired).otherwise(F.array(F.lit(MALFORMED)))


def passes(rules: Sequence[Rule], readable: Column) -> Column:
    """True when the row is readable and no rule fires; never NULL.

    The same verdict as an empty list of codes, but as plain conditions, so a
    filter on it stops at the first rule that fires and builds no arrays.
    """
    any_fires = reduce(Column.__or__, (F.coalesce(F.expr(r.fires), F.lit(False)) for r in rules))
    return readable & ~any_fires


def validate(df: DataFrame, rules: Sequence[Rule], readable: Column) -> DataFrame:
    """Add ``validation_errors`` and ``is_valid``."""
    return df.select(
        "*",
        error_codes(rules, readable).alias("validation_errors"),
        passes(rules, readable).alias("is_valid"),
    )


def valid(df: DataFrame) -> DataFrame:
    return df.filter("is_valid")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter("NOT is_valid")
