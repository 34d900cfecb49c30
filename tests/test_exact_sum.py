"""Sums against exact rational arithmetic, bit by bit."""

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assaymill.operators.exact_sum import exact_sums

KINDS = "g int, v double, w double"


def nearest(values):
    total = sum(map(Fraction, values), Fraction(0))
    try:
        return float(total)  # rounds to nearest, ties to even
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def expected(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(map(math.isnan, values)) or (math.inf in values and -math.inf in values):
        return math.nan
    if math.inf in values or -math.inf in values:
        return math.inf if math.inf in values else -math.inf
    return nearest(values)


def bits(x):
    return None if x is None else struct.pack("<d", math.nan if math.isnan(x) else x + 0.0)


def check(spark, groups, partitions=3):
    rows = [(g, v, -v if v is not None else None) for g, values in enumerate(groups) for v in values]
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, KINDS).repartition(partitions)
    found = {r["g"]: r for r in exact_sums(df, ["g"], ["v", "w"]).collect()}
    for g, values in enumerate(groups):
        if not values:
            continue
        own = expected(values)
        assert bits(found[g]["v_sum"]) == bits(own), (values, found[g]["v_sum"], own)
        other = expected([None if v is None else -v for v in values])
        assert bits(found[g]["w_sum"]) == bits(other), values
        n = sum(v is not None for v in values)
        assert found[g]["v_n"] == n
        assert bits(found[g]["v_mean"]) == bits(None if own is None else own / n)


def of_any_size(rng):
    return math.ldexp(rng.uniform(-1, 1), rng.randrange(-1080, 1020))


@pytest.mark.parametrize("partitions", [1, 7])
def test_random_doubles_of_all_magnitudes(spark, partitions):
    rng = random.Random(partitions)
    groups = []
    for _ in range(80):
        kind = rng.randrange(4)
        n = rng.randrange(1, 40)
        if kind == 0:
            groups.append([of_any_size(rng) for _ in range(n)])
        elif kind == 1:  # close together, so that digits carry
            shift = rng.randrange(-1000, 960)
            groups.append([math.ldexp(rng.uniform(-1, 1), shift + rng.randrange(0, 60)) for _ in range(n)])
        elif kind == 2:  # nearly all of it cancels
            big = [of_any_size(rng) for _ in range(n)]
            groups.append(big + [-x for x in big] + [of_any_size(rng)])
        else:
            groups.append([round(rng.uniform(-1e6, 1e6), 2) for _ in range(n)])
    check(spark, groups, partitions)


def test_edges(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    check(
        spark,
        [
            [0.0], [-0.0, -0.0], [None], [None, 1.5], [tiny], [-tiny, tiny], [tiny] * 3, [huge], [huge, huge], [-huge, -huge], [huge, huge, -huge],
            [huge, -huge, tiny], [1.0, 2.0**-53], [1.0, 2.0**-53, 2.0**-200], [1.0, -(2.0**-54)], [1.0, 2.0**-52, 2.0**-53], [2.0**53, 1.0],
            [2.0**53, 1.0, 2.0**-300], [2.0**24, 1.0], [2.0**48 - 1] * 5, [-(2.0**72), 2.0**72 - 2.0**20], [math.nan, 1.0], [math.inf, 1.0],
            [-math.inf, 1.0], [math.inf, -math.inf], [2.2250738585072014e-308, -tiny], [0.1] * 10, [1e16, 1.0, -1e16], [2.0**1000, 2.0**-1000, -(2.0**1000)],
        ],
    )


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12), min_size=1, max_size=12))
def test_any_doubles(spark, groups):
    check(spark, groups)
