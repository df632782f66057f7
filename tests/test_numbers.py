import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.functions import clip, number_text, outside, parse_number, round_places, write_number


def _values(spark, df):
    return [row[0] for row in df.collect()]


def test_parse_text(spark):
    cases = {
        "$+5": 5.0,
        "$.5": 0.5,
        "$5.": 5.0,
        "$1e3": 1000.0,
        "$ 12 ": 12.0,
        "$\t7\n": 7.0,
        "$-12.5": -12.5,
        "$1E-2": 0.01,
        "$00012": 12.0,
        "€9": 9.0,  # the prefix is dropped unseen
        "$1e400": math.inf,
        **{bad: None for bad in ("$abc", "$", "", "$1 2", "$12d", "$12f", "$1_0", "$inf", "$nan", "$Infinity", "$0x1p3")},
        **{bad: None for bad in ("$.", "$+", "$e5", "$1e", "$--1", "$1.2.3", "$1,000", "$٣")},
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string").coalesce(1)
    got = _values(spark, df.select(parse_number(F.col("s"), T.StringType(), "$")))
    assert got == list(cases.values())


def test_parse_prefix_and_suffix(spark):
    df = spark.createDataFrame([("US$1.5 m",), ("US$m",), ("x",), ("€€€2 m",), (None,)], "s string").coalesce(1)
    loose = parse_number(F.col("s"), T.StringType(), "US$", " m")
    strict = parse_number(F.col("s"), T.StringType(), "US$", " m", strict_affix=True)
    assert _values(spark, df.select(loose)) == [1.5, None, None, 2.0, None]
    assert _values(spark, df.select(strict)) == [1.5, None, None, None, None]


def test_strict_affixes_do_not_overlap(spark):
    df = spark.createDataFrame([("aba",)], "s string")
    assert _values(spark, df.select(parse_number(F.col("s"), T.StringType(), "ab", "ba", True))) == [None]


def test_parse_numbers(spark):
    df = spark.createDataFrame([(1.5,), (math.nan,), (None,), (math.inf,)], "x double").coalesce(1)
    assert _values(spark, df.select(parse_number(F.col("x"), T.DoubleType()))) == [1.5, None, None, math.inf]
    df = spark.sql("select cast(1.25 as decimal(5,2)) d, cast(3 as tinyint) t")
    row = df.select(parse_number(F.col("d"), df.schema["d"].dataType), parse_number(F.col("t"), T.ByteType())).first()
    assert tuple(row) == (1.25, 3.0)


@pytest.mark.parametrize("places", [0, 1, 2, 6, -2])
def test_rounding_is_that_of_numpy(spark, places):
    rng = random.Random(places)
    values = [rng.uniform(-1e4, 1e4) for _ in range(2000)]
    values += [k / 8 for k in range(-400, 400)] + [k + 0.5 for k in range(-50, 50)] + [0.125, 1.015, 2.675, 1e17]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    got = _values(spark, df.select(round_places(F.col("x"), places)))
    assert got == list(pd.Series(values).round(places))


@pytest.mark.parametrize("places", [0, 1, 2, 3, 4, 6, 9])
def test_text_is_that_of_python(spark, places):
    rng = random.Random(places)
    values = [float(np.round(rng.uniform(-1, 1) * 10 ** rng.uniform(-8, 21), places)) for _ in range(6000)]
    values += [0.0, 12345678.9, 100.0, 1e7, 9999999.0, 1e15, 9999999999999998.0, 1e16, 1.5e16, 1.25e22, -2e300, 1e100]
    values += [float(np.round(v, places)) for v in (0.0001, 0.00012, 0.001, 0.000999, 1e-5, 2.5e-5, 1e-9)]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    got = _values(spark, df.select(number_text(F.col("x"), places)))
    digits = [len(repr(v).split("e")[0].strip("-0.").replace(".", "")) for v in values]
    assert sum(d <= 15 for d in digits) > 3000
    for value, text, length in zip(values, got, digits):
        if length <= 15:
            assert text == repr(value + 0.0)
        else:
            assert float(text) == value
            assert ("e" in text) == ("e" in repr(value))


def test_unrounded_text(spark):
    values = [0.1, 1 / 3, 12345678.9, 1e16, 1e-5, 3.0, 123456789.12345679, 0.00012345, 1.25e-7]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    assert _values(spark, df.select(number_text(F.col("x")))) == [repr(v) for v in values]


def test_negative_zero_has_no_sign_in_text(spark):
    df = spark.createDataFrame([(-0.3,)], "x double")
    assert _values(spark, df.select(number_text(round_places(F.col("x"), 0), 0))) == ["0.0"]


def test_write_number(spark):
    df = spark.createDataFrame([(2.0,), (300.0,), (None,)], "x double").coalesce(1)
    assert _values(spark, df.select(write_number(F.col("x"), T.ByteType()))) == [2, None, None]
    assert _values(spark, df.select(write_number(F.col("x"), T.StringType(), "$", "%", 1))) == ["$2.0%", "$300.0%", None]


def test_clip_keeps_missing_values(spark):
    df = spark.createDataFrame([(None,), (0.0,), (5.0,), (9.0,)], "x double").coalesce(1)
    x = F.col("x")
    assert _values(spark, df.select(clip(x, 1.0, 8.0))) == [None, 1.0, 5.0, 8.0]
    assert _values(spark, df.select(clip(x, None, 8.0))) == [None, 0.0, 5.0, 8.0]
    assert _values(spark, df.select(clip(x, 8.0, 1.0))) == [None, 1.0, 5.0, 8.0]
    assert _values(spark, df.select(outside(x, 1.0, 8.0))) == [None, True, False, True]
    assert clip(x, None, None) is x and outside(x, None, None) is None
