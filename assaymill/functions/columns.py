"""Column functions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint(payload: Column) -> Column:
    """Lower-case hex SHA-256 of the text, byte for byte."""
    return F.sha2(payload, 256)


def has_text(value: Column) -> Column:
    """True when something other than spaces is left. A tab counts as text."""
    # Compared and not measured: a length counts the characters of the whole line.
    return F.trim(value) != ""


def array_total(items: Column, field: str) -> Column:
    """Sum of one field over an array of structs.

    An empty array gives 0. A NULL array, item or field gives NULL.
    """
    return F.aggregate(items, F.lit(0.0), lambda total, item: total + item[field])


# Digits of the widest decimal, and its decimals: values below 1e20 with up to 18 decimals fit.
WIDEST = "decimal(38,18)"


def exact_mean(value: Column, scale: int | None = None) -> Column:
    """Average of a double column, the same whatever the order of addition.

    Adding doubles in another order changes the last digits, so the sum is taken in decimal
    arithmetic, which has no such order. Where all values are known to have at most ``scale``
    decimals, a narrower and faster decimal does. A group with a value or a sum that does not
    fit (more decimals, NaN, infinite or too large) falls back to the plain average.
    """
    exact = value.try_cast(WIDEST if scale is None else f"decimal(18,{scale})")
    fits = F.count_if(exact.cast("double") == value)
    total = F.try_sum(exact).cast("double")
    whole = (fits == F.count(value)) & total.isNotNull()
    return F.when(whole, total / F.count(value)).otherwise(F.avg(value))


def min_max_scaled(value: Column, low: Column, high: Column, higher_is_better: bool) -> Column:
    """Position of ``value`` between ``low`` and ``high``, 1.0 at the better end.

    A group without any spread scores 1.0 throughout.
    """
    distance = value - low if higher_is_better else high - value
    return F.when(low == high, 1.0).otherwise(distance / (high - low))
