"""Column expressions against plain Python."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from skyledger import functions as fn
from skyledger.functions.months import month_bits, month_block, months_from_bits


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def nearest(value, digits):
    rounded = round(value, digits)
    return 0.0 if rounded == 0 else rounded


@pytest.mark.parametrize("digits", [2, 4])
def test_round_half_even_on_decimal_ties(spark, digits):
    ties = spark.range(-300_000, 300_000).select(((F.col("id") * 10 + 5) / float(10 ** (digits + 1))).alias("x"))
    got = ties.select("x", fn.round_half_even(F.col("x"), digits).alias("r")).toPandas()
    assert all(r == nearest(x, digits) for x, r in zip(got.x, got.r))


def test_round_half_even_on_quotients_and_extremes(spark):
    generator = random.Random(5)
    values = [generator.randint(-10**6, 10**6) / generator.randint(1, 5000) for _ in range(20_000)]
    values += [0.125, -0.125, 0.375, 1e15, 1.5e300, -2.5e12, 5e-05, -5e-05, 1e-9, -1e-9, 0.0, None]
    for digits in (2, 4):
        got = column(spark, values, "double", lambda c: fn.round_half_even(c, digits))
        assert got == [None if v is None else nearest(v, digits) for v in values]


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200))
def test_round_half_even_on_any_double(spark, values):
    got = column(spark, values, "double", lambda c: fn.round_half_even(c, 2))
    assert got == [nearest(v, 2) for v in values]


def test_round_half_up_goes_by_the_printed_decimal(spark):
    assert column(spark, [1.005, 2.675, -2.675, 0.125], "double", lambda c: fn.round_half_up(c, 2)) == [
        1.01,
        2.68,
        -2.68,
        0.13,
    ]


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 4), (6.0, 0), (None, 0), (0.0, 3)], "s double, n bigint")
    assert [tuple(r) for r in df.select(
        fn.safe_divide(F.col("s"), F.col("n")), fn.safe_divide(F.col("s"), F.col("n"), 0.0)
    ).collect()] == [(1.5, 1.5), (None, 0.0), (None, 0.0), (0.0, 0.0)]


def test_number_text_has_no_exponent(spark):
    values = [0.0005, 0.0001, -44.0, 0.0, 8.43, 1e7, 123456789.25]
    assert column(spark, values, "double", fn.number_text) == [
        "0.0005", "0.0001", "-44.0", "0.0", "8.43", "10000000.0", "123456789.25",
    ]


def test_text_functions(spark):
    values = [" 7 ", "None", "", " \t", None, "late", "-3.5", " None\n"]
    assert column(spark, values, "string", fn.null_sentinel) == ["7", None, None, None, None, "late", "-3.5", None]
    assert column(spark, values, "string", lambda c: fn.try_number(c, "double")) == [
        7.0, None, None, None, None, None, -3.5, None,
    ]
    assert column(spark, [" 7 ", "7.0", "x", None], "string", lambda c: fn.try_number(c, "int")) == [
        7, None, None, None,
    ]


def test_strip_equals_python_on_ascii_white_space(spark):
    values = ["", " ", "a", " a", "a\t", "\n a b \r\x0b\x0c", "\x01", "\x01a ", "è ", " é", "a\xa0", "-", '"q" ']
    blank = " \t\n\r\x0b\x0c"
    assert column(spark, values, "string", fn.strip) == [v.strip(blank) for v in values]
    assert column(spark, values, "string", fn.is_filled) == [v.strip(blank) != "" for v in values]


def test_months_keep_any_whole_number(spark):
    months = [1, 12, 12, 0, 31, 32, 99, -1, -33, 2147483647, None]
    df = spark.createDataFrame([(m,) for m in months], "month int")
    blocks = df.groupBy(month_block(F.col("month")).alias("block")).agg(month_bits(F.col("month")).alias("bits"))
    kept = blocks.select(F.explode(months_from_bits(F.col("block"), F.col("bits")))).collect()
    assert sorted(r[0] for r in kept) == sorted({m for m in months if m is not None})


def test_months_text_sorts_as_text(spark):
    df = spark.createDataFrame([([1, 2, 10, 11],)], "m array<int>")
    assert df.select(fn.months_text(F.col("m"))).first()[0] == "1,10,11,2"
