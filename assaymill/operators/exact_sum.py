"""Sums of doubles that are exact until they are rounded once, so the order of addition does not matter.

A double is written as four digits of 24 bits on one grid for all doubles; which four is its class. Digits are
whole numbers, so they add up without loss in any order and over any partitions. A group is first summed by
class, of which ordinary data has one or two, on the map side; then the few rows of
digits are carried, put together and rounded to the nearest double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a digit. A long holds the sum of 2^39 of them.
BITS = 24
_DIGITS = 4
_BASE = 1 << BITS


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _scaled(value: Column, exponent: Column) -> Column:
    """``value`` times a power of two, in two steps as the power alone may be no double."""
    half = F.floor(exponent / 2)
    return value * _power(half) * _power(exponent - half)


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _with_digits(df: DataFrame, name: str) -> DataFrame:
    """Columns ``{name}_class`` and ``{name}_0`` to ``_3``; null class for what has no digits."""
    value = F.col(name)
    # Close to a power of two the logarithm may be off by one class, for which there is room.
    level = F.when(_finite(value) & (value != 0), F.floor(F.log2(F.abs(value)) / BITS).cast("int"))
    df = df.withColumn(f"{name}_class", level)
    rest = _scaled(value, -BITS * F.col(f"{name}_class"))
    for i in range(_DIGITS):
        df = df.withColumn(f"{name}_rest", rest).withColumn(f"{name}_{i}", F.col(f"{name}_rest").cast("bigint"))
        rest = (F.col(f"{name}_rest") - F.col(f"{name}_{i}")) * _BASE
    return df.drop(f"{name}_rest")


_ZERO = "cast(0 as bigint)"


def _grid(rows: str) -> Column:
    """The digits that rows of class and digits add up to, lowest first, with two more for what is carried out."""
    low, high = F.array_min(F.col(f"{rows}.class")) - (_DIGITS - 1), F.array_max(F.col(f"{rows}.class"))

    def digit(place: Column) -> Column:
        def add(total: Column, row: Column) -> Column:
            own = F.get(row["digits"], row["class"] - place)
            return total + F.coalesce(own, F.expr(_ZERO))

        return F.aggregate(rows, F.expr(_ZERO), add)

    return F.concat(F.transform(F.sequence(low, high), digit), F.array(F.expr(_ZERO), F.expr(_ZERO)))


def _carried(digits: Column) -> Column:
    """``digits`` from 0 up, and what is carried out of the highest."""
    start = F.struct(F.array().cast("array<bigint>").alias("digits"), F.expr(_ZERO).alias("carry"))

    def step(state: Column, own: Column) -> Column:
        # An arithmetic shift and a mask are quotient and rest, below 0 too.
        total = state["carry"] + own
        return F.struct(
            F.concat(state["digits"], F.array(total.bitwiseAND(F.lit(_BASE - 1).cast("bigint")))).alias("digits"),
            F.shiftright(total, BITS).alias("carry"),
        )

    return F.aggregate(digits, start, step)


def _fold(df: DataFrame, rows: str, into: str) -> DataFrame:
    """The double nearest to what rows of class and digits stand for.

    Step by step in columns, for each step is used several times by the next one.
    """
    df = df.withColumn("_grid", _grid(rows))
    df = df.withColumn("_negative", _carried(F.col("_grid"))["carry"] < 0)
    upward = F.transform("_grid", lambda d: F.when(F.col("_negative"), -d).otherwise(d))
    df = df.withColumn("_digits", _carried(upward)["digits"])
    df = df.withColumn("_top", F.array_max(F.transform("_digits", lambda d, i: F.when(d != 0, i).otherwise(-1))))
    at = [F.coalesce(F.get("_digits", F.col("_top") - back), F.expr(_ZERO)).alias(f"_at{back}") for back in range(4)]
    # What is below the four highest digits only matters by being there.
    rest = F.exists(F.slice("_digits", 1, F.greatest(F.col("_top") - 3, F.lit(0))), lambda d: d != 0)
    df = df.select("*", *at, rest.alias("_rest")).withColumn("_bits", F.length(F.bin("_at0")))
    # From the highest digit that is not 0 down: 55 to 63 bits, with a last bit for any that are left.
    word = """CASE
        WHEN _bits > 15 THEN shiftleft(shiftleft(_at0, 24) + _at1, 15) + shiftright(_at2, 9)
        WHEN _bits >= 7 THEN shiftleft(shiftleft(_at0, 24) + _at1, 24) + _at2
        ELSE shiftleft(shiftleft(shiftleft(_at0, 24) + _at1, 24) + _at2, 8) + shiftright(_at3, 16) END"""
    left = """CASE
        WHEN _bits > 15 THEN (_at2 & 511) <> 0 OR _at3 <> 0 OR _rest
        WHEN _bits >= 7 THEN _at3 <> 0 OR _rest
        ELSE (_at3 & 65535) <> 0 OR _rest END"""
    used = "CASE WHEN _bits > 15 THEN 39 WHEN _bits >= 7 THEN 48 ELSE 56 END"
    low = F.array_min(F.col(f"{rows}.class")) - (_DIGITS - 1)
    df = df.select(
        "*",
        F.expr(word).bitwiseOR(F.expr(left).cast("bigint")).cast("double").alias("_word"),
        (BITS * (low + F.col("_top")) - F.expr(used)).alias("_exponent"),
    )
    value = _scaled(F.col("_word"), F.col("_exponent"))
    total = F.when(F.col("_negative"), -value).otherwise(value)
    none = (F.array_size(rows) == 0) | (F.col("_top") < 0)
    scratch = ["_grid", "_negative", "_digits", "_top", "_rest", "_bits", "_word", "_exponent", *(f"_at{i}" for i in range(4))]
    return df.withColumn(into, F.when(none, F.lit(0.0)).otherwise(total)).drop(*scratch)


def exact_sums(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``{column}_n``, ``{column}_sum`` and ``{column}_mean`` of double columns per group, the same on every run.

    The sum is the double nearest to the exact one; a mean is that divided by the number of values. Nulls do not
    count; a group without values has null for both. NaN, or infinities of both signs, make NaN; else an infinity
    makes itself. A sum past the largest double is infinite. Zeros add up to 0.0.
    """
    rows = df.select(*groups, *columns)
    for c in columns:
        rows = _with_digits(rows, c)
    classes = [f"{c}_class" for c in columns]
    count = lambda test, name: F.count_if(test).alias(name)
    partial = rows.groupBy(*groups, *classes).agg(
        *(F.sum(f"{c}_{i}").alias(f"{c}_{i}") for c in columns for i in range(_DIGITS)),
        *(F.count(c).alias(f"{c}_n") for c in columns),
        *(count(F.isnan(c), f"{c}_nan") for c in columns),
        *(count(F.col(c) == float("inf"), f"{c}_up") for c in columns),
        *(count(F.col(c) == float("-inf"), f"{c}_down") for c in columns),
    )

    def own_rows(c: str) -> Column:
        digits = F.array(*(F.col(f"{c}_{i}") for i in range(_DIGITS))).alias("digits")
        row = F.struct(F.col(f"{c}_class").alias("class"), digits)
        return F.collect_list(F.when(F.col(f"{c}_class").isNotNull(), row)).alias(f"{c}_rows")

    counted = [f"{c}_{what}" for c in columns for what in ("n", "nan", "up", "down")]
    summed = partial.groupBy(*groups).agg(
        *(own_rows(c) for c in columns), *(F.sum(name).alias(name) for name in counted)
    )
    for c in columns:
        nan = (F.col(f"{c}_nan") > 0) | ((F.col(f"{c}_up") > 0) & (F.col(f"{c}_down") > 0))
        summed = _fold(summed, f"{c}_rows", f"{c}_sum").withColumn(
            f"{c}_sum",
            F.when(F.col(f"{c}_n") == 0, None)
            .when(nan, float("nan"))
            .when(F.col(f"{c}_up") > 0, float("inf"))
            .when(F.col(f"{c}_down") > 0, float("-inf"))
            .otherwise(F.col(f"{c}_sum")),
        )
    means = (F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum") / F.col(f"{c}_n")).alias(f"{c}_mean") for c in columns)
    wanted = (f"{c}_{what}" for c in columns for what in ("n", "sum"))
    return summed.select("*", *means).select(*groups, *wanted, *(f"{c}_mean" for c in columns))
