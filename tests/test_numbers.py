import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from levyflow.functions import clean_number, malformed, net_amount, scale, to_integer, two_way_label, unscale


def evaluate(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")
    return [r["out"] for r in rows.select("id", expression(F.col("v")).alias("out")).orderBy("id").collect()]


def test_clean_number_reads_grouped_and_plain_text(spark):
    values = ["1,257.60", "12", "", None, " 1.5 ", "1,234,567.89", "-3,000", "1d", "0x1p3"]
    expected = [1257.6, 12.0, None, None, 1.5, 1234567.89, -3000.0, 1.0, 8.0]
    got = evaluate(spark, values, clean_number)
    assert got == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=200))
def test_grouped_text_comes_back_as_the_same_number(spark, cents):
    assert evaluate(spark, [f"{c / 100:,.2f}" for c in cents], clean_number) == [c / 100 for c in cents]


def test_clean_number_reads_nan_and_infinity(spark):
    nan, inf = evaluate(spark, ["NaN", "Infinity"], clean_number)
    assert math.isnan(nan) and inf == math.inf


def test_european_form_is_read_as_is_unless_strict(spark):
    lenient = evaluate(spark, ["1.257,60"], clean_number)
    strict = evaluate(spark, ["1.257,60", "1,257.60", "12.5"],
                      lambda c: clean_number(c, on_error="null", strict=True))
    assert lenient == [1.2576]
    assert strict == [None, 1257.6, 12.5]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["abc", "-", ",", "  "])
def test_malformed_number_fails_whatever_the_ansi_setting(spark, ansi, text):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="malformed number"):
            evaluate(spark, [text], clean_number)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_malformed_number_can_become_null_and_be_counted(spark):
    values = ["abc", "-", "7", "", None]
    assert evaluate(spark, values, lambda c: clean_number(c, on_error="null")) == [None, None, 7.0, None, None]
    assert evaluate(spark, values, malformed) == [True, True, False, False, False]


def test_unknown_error_mode_is_refused():
    with pytest.raises(ValueError):
        clean_number(F.lit("1"), on_error="skip")


def test_to_integer_is_lenient(spark):
    assert evaluate(spark, ["2025", "", None, "20x5", "2025.7", "-3", "99999999999"], to_integer) == [
        2025, None, None, None, 2025, -3, None,
    ]


def test_to_integer_is_the_cast_without_ansi(spark):
    values = [".", ".5", "-.7", "+.5", "5.", " .5 ", "+.", ".5e1", "-", "", "1 2", "2147483648", "-0.9", None, "+7", "7-"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    got = evaluate(spark, values, to_integer)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert got == evaluate(spark, values, lambda v: v.cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_net_amount_is_null_with_any_null_term_and_rounds_half_up(spark):
    rows = spark.createDataFrame(
        [(1, 10.0, 5.0, 2.5), (2, 10.0, None, 1.0), (3, 1.0, 1.0, 9.0), (4, 0.125, 0.0, 0.0)],
        "id int, a double, b double, d double",
    )
    got = rows.select(net_amount(["a", "b"], ["d"]).alias("n")).collect()
    assert [r["n"] for r in got] == [12.5, None, -7.0, 0.13]


def test_two_way_label_sends_null_to_other(spark):
    values = [100.0, 99.99, 0.0, None]
    got = evaluate(spark, values, lambda c: two_way_label(c, 100.0, "own", "shared"), "double")
    assert got == ["own", "shared", "shared", "shared"]


def test_scaling_and_back(spark):
    got = evaluate(spark, [3.0, None], lambda c: unscale(scale(c, 1.0, 4.0), 1.0, 4.0), "double")
    assert got == [3.0, None]
    assert evaluate(spark, [3.0, None], lambda c: scale(c, 3.0, 0.0), "double") == [0.0, None]
