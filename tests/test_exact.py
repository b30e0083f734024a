"""Exact sums against Python's own, for every partitioning."""

import math
import random
import struct
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from levyflow.operators import summarize
from levyflow.operators.exact import exact_sums, ratio

FINITE = st.floats(allow_nan=False, allow_infinity=False)
EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 1e16, 1.0, -1e16, 2.0**32,
         2.0**-32, math.nextafter(2.0**32, 0), math.nextafter(2.0**31, 2.0**40), 0.1, 0.2, 0.3, 1e-6, 1e12]


def expected(values):
    total = sum(map(Fraction, values), Fraction(0))
    return tuple(_nearest(x) for x in (total, total / len(values)))


def _nearest(x):
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


def odd_doubles(count, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < count:
        value = struct.unpack("d", rng.randbytes(8))[0]
        if math.isfinite(value):
            out.append(value)
    return out


@pytest.mark.parametrize("partitions", [1, 3, 200])
def test_sums_are_rounded_once(spark, partitions):
    groups = {1: EDGES, 2: odd_doubles(300, 1), 3: [x * 1e-290 for x in odd_doubles(200, 2)], 4: [0.1] * 1000, 5: [1e308, 1e308, -1e308],
              6: [1e308] * 3, 7: [2.0**k for k in range(-1074, 1024)], 8: [-(2.0**k) for k in range(-1074, 900, 7)] + [1e12, 1e-6] * 50}
    rows = [(g, v) for g, values in groups.items() for v in values]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(partitions)
    got = {r["g"]: r for r in exact_sums(df, ["g"], ["v"]).collect()}
    for g, values in groups.items():
        [s] = got[g]["sums"]
        assert (s["total"], s["average"], s["values"], got[g]["rows"]) == (*expected(values), len(values), len(values)), g


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(-135, 128), st.integers(-(2**62), 2**62), st.integers(0, 2**62), st.integers(0, 2**62)), min_size=1, max_size=9))
def test_bins_are_put_together_exactly(bins):
    numerator, denominator = ratio(bins)
    want = sum((Fraction(h * 2**42 + m * 2**21 + low) * Fraction(2) ** (8 * b - 52) for b, h, m, low in bins), Fraction(0))
    assert Fraction(numerator, denominator) == want


def test_nulls_specials_and_groups_without_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 2.0), (1, 1.5, None), (2, None, None), (None, inf, 1.0), (None, 1.0, -inf), (3, inf, nan), (3, -inf, 0.0), (4, nan, 1.0)]
    got = {r["k"]: r for r in exact_sums(spark.createDataFrame(rows, "k int, a double, b double"), ["k"], ["a", "b"]).collect()}
    assert {k: r["rows"] for k, r in got.items()} == {1: 2, 2: 1, None: 2, 3: 2, 4: 1}
    flat = {k: [(s["total"], s["average"], s["values"]) for s in r["sums"]] for k, r in got.items()}
    assert flat[1] == [(1.5, 1.5, 1), (2.0, 2.0, 1)] and flat[2] == [(None, None, 0)] * 2
    assert flat[None] == [(inf, inf, 2), (-inf, -inf, 2)]
    assert all(math.isnan(x) for x in (*flat[3][0][:2], *flat[3][1][:2], *flat[4][0][:2]))


def test_other_number_types_and_columns_named_like_helpers(spark):
    df = spark.range(7).select(
        (F.col("id") % 2).alias("bin"), F.col("id").cast("decimal(12,2)").alias("rows"), F.col("id").alias("sums"), F.lit(0.5).alias("high"))
    got = [tuple(r) for r in summarize(df, ["bin"], {"rows": "a", "sums": "b", "high": "c"}).collect()]
    assert got == [(0, 12.0, 3.0, 12.0, 3.0, 2.0, 0.5, 4), (1, 9.0, 3.0, 9.0, 3.0, 1.5, 0.5, 3)]


def test_no_rows_and_a_single_group(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert summarize(empty, ["k"], {"v": "v"}).count() == 0
    assert [r["k"] for r in exact_sums(spark.range(3).select(F.lit(1).alias("k"), "id"), ["k"], ["id"]).collect()] == [1]


@pytest.mark.parametrize("partitions", [1, 3, 200])
def test_averages_just_below_a_half(spark, partitions):
    df = spark.range(2_000_000, numPartitions=partitions).select(
        F.lit(1).alias("k"), F.when(F.col("id") == 7, 1.0049).otherwise(1.005).alias("v"))
    assert tuple(summarize(df, ["k"], {"v": "v"}).first()) == (1, 2010000.0, 1.0, 2_000_000)
    thirds = spark.createDataFrame([(1, 1.0001), (1, 1.0002), (1, 1.0002)], "k int, v double")
    assert summarize(thirds, ["k"], {"v": "v"}, places=8).first()["avg_v"] == 1.00016667


@given(st.lists(FINITE, min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_any_doubles(values):
    from tests.oracle import session

    df = session().createDataFrame([(1, v) for v in values], "g int, v double")
    [s] = exact_sums(df, ["g"], ["v"]).first()["sums"]
    assert (s["total"], s["average"]) == expected(values)


def test_moments_are_the_same_for_every_partitioning(spark):
    from levyflow.operators import feature_stats, fit_scaling, label_stats, moments

    values = [1e9 + rng * 1e-3 for rng in range(1000)] + [0.1] * 500
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, -v, 7.0, None) for v in values], "a double, b double, flat double, gone double")
    found = [moments(df.repartition(n), ["a", "b", "flat", "gone"]) for n in (1, 3, 200)]
    assert found[0] == found[1] == found[2]
    mean = float(sum(map(Fraction, values)) / len(values))
    squares = float(sum((Fraction(v) - Fraction(mean)) ** 2 for v in values))
    assert found[0]["a"].mean == mean == -found[0]["b"].mean
    assert math.isclose(found[0]["a"].squares, squares, rel_tol=1e-15 * 4)
    assert (found[0]["flat"].sample_std, found[0]["gone"].mean, found[0]["gone"].sample_std) == (0.0, None, None)
    scaled = [fit_scaling(df.repartition(n), ["a", "flat"], "b") for n in (1, 7)]
    assert scaled[0] == scaled[1] and scaled[0].label[0] == -mean
    assert [tuple(r) for r in feature_stats(df, ["a"], exact=True).collect()] == [("a", mean, found[0]["a"].sample_std)]
    assert tuple(label_stats(df.select("flat"), "flat", exact=True).first()) == (7.0, 1e-6)
    assert tuple(label_stats(df, "gone", exact=True).first()) == tuple(label_stats(df, "gone").first()) == (None, 1e-6)
