import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mastline.functions.numeric import (
    Moments,
    as_long,
    is_number_text,
    round_half_even,
    text_to_double,
    text_to_long,
)

NUMBER_TEXTS = [
    "1", "-1", "+7", "101.5", "101.0", "1e3", "1E-2", ".5", "5.", " 12 ", "-0.25", "1.5f", "2d", "0x10",
    "0x1p3", "abc", "bad", "12-5", "1,000", "--1", "1e", "inf", "-inf", "Infinity", "9007199254740993", "1 2",
]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def test_text_to_double_agrees_with_coercing_parse(spark):
    got = texts(spark, NUMBER_TEXTS).select("i", "s", text_to_double(F.col("s")).alias("d")).orderBy("i").collect()
    want = pd.to_numeric(pd.Series(NUMBER_TEXTS), errors="coerce")
    for row, expected in zip(got, want):
        if math.isnan(expected):
            assert row.d is None, row.s
        else:
            assert row.d == expected, row.s


def test_text_to_double_turns_nan_into_null(spark):
    df = texts(spark, ["nan", "NaN", None, ""])
    assert [r.d for r in df.select(text_to_double(F.col("s")).alias("d")).collect()] == [None] * 4


@pytest.mark.parametrize(
    "text, expected",
    [
        ("101", 101), ("101.0", 101), ("1e3", 1000), (" 101 ", 101), ("-5", -5), ("101.5", None), ("abc", None),
        ("Infinity", None), ("", None), (None, None), ("9007199254740993", 9007199254740993),
        ("99999999999999999999", None),
    ],
)
def test_text_to_long(spark, text, expected):
    assert texts(spark, [text]).select(text_to_long(F.col("s")).alias("n")).first().n == expected


def test_as_long_of_doubles_keeps_whole_numbers_only(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (float("nan"),), (None,)], "v double")
    assert [r.n for r in df.select(as_long(df, "v").alias("n")).collect()] == [1, None, None, None]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    values = [0.125, 0.135, 1.005, 1.015, 0.145, -0.125, 2.675, 1234.565, -83.66665, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.r for r in df.select(round_half_even(F.col("v"), 2).alias("r")).collect()]
    assert got == list(np.round(np.array(values), 2))


def moments(spark, values, partitions=3, parts=1):
    """Sum, mean and deviation, over ``parts`` states that are merged."""
    m = Moments("v", squares=True)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    states = m.prepare(df.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))).groupBy("part").agg(*m.state())
    merged = states.agg(*m.merge()) if parts > 1 else states
    return merged.select(m.sum().alias("s"), m.mean().alias("m"), m.deviation().alias("d")).first()


def stable(spark, values, partitions=3):
    return tuple(moments(spark, values, partitions))[:2]


@pytest.mark.parametrize(
    "values",
    [
        [-83.25, -70.5, -91.125, -60.0],
        [1e8 + k / 1000 for k in range(200)],  # a deviation far below the mean
        [k / 3 for k in range(300)],
        [5e-7, 7e-7, 6e-7],
        [-120.0 + k * 0.01 for k in range(500)],
        [123456.789, -123456.789],
    ],
)
def test_deviation_is_that_of_a_sample(spark, values):
    import statistics

    want = statistics.stdev(Fraction(v) for v in values)
    for parts in (1, 3):
        got = moments(spark, values, 4, parts).d
        assert got == pytest.approx(want, rel=1e-5, abs=1e-6)


def test_deviation_has_equal_bits_in_any_order(spark):
    rng = random.Random(7)
    values = [rng.gauss(-80, 12) for _ in range(3000)]
    seen = set()
    for k in range(8):
        rng.shuffle(values)
        seen.add(tuple(moments(spark, values, 1 + k, 1 + k % 4)))
    assert len(seen) == 1
    (row,) = seen
    assert row[2] == pytest.approx(np.std(values, ddof=1), rel=1e-12)


def test_deviation_of_few_or_odd_values(spark):
    assert moments(spark, [3.5]).d is None and moments(spark, [None]).d is None
    assert moments(spark, [2.5, None, 2.5]).d == 0
    assert moments(spark, [1.0, math.inf, 2.0]).d is None
    assert moments(spark, [1e12, 3e12]).d == pytest.approx(2**0.5 * 1e12)


def test_sum_is_exact_for_decimal_values_in_any_order(spark):
    rng = random.Random(1)
    values = [rng.randrange(-12_000, 50_000) / 100 for _ in range(2000)]
    exact = float(sum(Fraction(round(v * 100), 100) for v in values))
    for n in (1, 3, 7):
        rng.shuffle(values)
        total, mean = stable(spark, values, n)
        assert total == exact
        assert mean == exact / len(values)


def test_sum_absorbs_subtraction_residue(spark):
    # -120 + 120.01 leaves 0.010000000000005: a tie must not hinge on that.
    noisy = [-120.0 + 120.01, -120.0 + 39.99, -120.0 + 56.78]
    assert stable(spark, noisy)[0] == float(Fraction(1, 100) + Fraction(-8001, 100) + Fraction(-6322, 100))


def test_sum_falls_back_for_values_off_the_grid(spark):
    values = [1 / 3, 1e-9, 2.5]
    assert stable(spark, values, 1)[0] == pytest.approx(sum(values), rel=1e-15)


def test_sum_survives_integer_overflow_and_infinities(spark):
    assert stable(spark, [9e8] * 20_000, 2)[0] == pytest.approx(9e8 * 20_000)
    assert stable(spark, [9.0e14] * 12_000, 2)[0] == pytest.approx(9.0e14 * 12_000)
    assert stable(spark, [1.0, math.inf])[0] == math.inf
    assert stable(spark, [math.inf, -math.inf])[0] is None


def test_sum_and_mean_of_nothing(spark):
    assert stable(spark, [None, None]) == (None, None)


def test_sum_of_fine_decimals_does_not_depend_on_order(spark):
    import random

    rng = random.Random(5)
    values = [rng.randrange(-12_000, 50_000) / 100 for _ in range(2000)] + [0.12345678, 2e9]
    seen = set()
    for k in range(4):
        rng.shuffle(values)
        seen.add(moments(spark, values, 3 + k).s)
    assert len(seen) == 1


def test_whole_text_must_fit_a_bigint(spark):
    from mastline.functions.numeric import is_whole_text
    from pyspark.sql import functions as F

    rows = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "12"]
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    assert [r[0] for r in df.select(is_whole_text(F.col("x"))).collect()] == [True, False, True, True]


def test_shuffles_widen_with_the_input(spark):
    from mastline.session import size_shuffles

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 10) == 4
        assert size_shuffles(spark, 1 << 40) == 16384
        assert spark.conf.get(key) == "16384"
    finally:
        spark.conf.unset(key)


def test_infinity_is_told_without_folding_every_text(spark):
    fits = ["inf", "+INF", "-Inf", " infinity ", "-INFINITY"]
    others = ["\u0130nf", "\u0131nf", "inf\n", "\tinf", "in f", "+-inf", "infinit", "1inf", ""]
    found = spark.createDataFrame([(t,) for t in fits + others], "t string").select("t", is_number_text(F.col("t")).alias("n"))
    assert [r.t for r in found.collect() if r.n] == fits
    assert "lower" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
