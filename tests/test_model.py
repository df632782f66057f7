import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from numprep import ColumnSpec, FittedModel, fit, load_specs


def _frame(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], f"c {ddl}").coalesce(1)


def _column(df, name="c"):
    return [row[name] for row in df.collect()]


def _triples(df):
    return [(r["c"], r["c_valid"], r["c_error"]) for r in df.collect()]


def test_clipped_fit(spark):
    df = _frame(spark, ["0.5cm", "1.0cm", "51.0cm", "101.0cm"], "string")
    model = fit(df, [ColumnSpec("c", suffix="cm", min_val=1, rounding=2, clip=True)])
    assert (model["c"].norm_min, model["c"].norm_scale) == (1.0, 100.0)
    scaled = model.transform(df)
    assert _column(scaled) == [0.0, 0.0, 0.5, 1.0]
    assert _column(model.inverse_transform(scaled)) == ["1.0cm", "1.0cm", "51.0cm", "101.0cm"]


def test_reject(spark):
    model = fit(_frame(spark, [1, 30], "bigint"), [ColumnSpec("c", reject=True, rounding=0)])
    back = model.inverse_transform(_frame(spark, [-0.1, 0.0, 1.0, 1.1, None], "double"), flags=True)
    message = "out of range [0,1]"
    assert _triples(back) == [
        (None, False, message),
        (1, True, ""),
        (30, True, ""),
        (None, False, message),
        (None, True, ""),
    ]
    assert dict(back.dtypes)["c"] == "bigint"


def test_range_flag_is_tested_before_rounding(spark):
    model = fit(_frame(spark, [1, 30], "bigint"), [ColumnSpec("c", max_val=31, clip_oor=False, rounding=0)])
    back = model.inverse_transform(_frame(spark, [1.02, 1.1], "double"), flags=True)
    assert _triples(back) == [(31, True, ""), (None, False, "Out of range")]


def test_rejection_comes_before_the_range(spark):
    model = fit(_frame(spark, [0.0, 10.0], "double"), [ColumnSpec("c", max_val=5, clip_oor=False, reject=True)])
    back = model.inverse_transform(_frame(spark, [0.8, 1.2], "double"), flags=True)
    assert _triples(back) == [(None, False, "Out of range"), (None, False, "out of range [0,1]")]


def test_clip_makes_reject_inert(spark):
    model = fit(_frame(spark, [0.0, 10.0], "double"), [ColumnSpec("c", clip=True, reject=True)])
    assert _triples(model.inverse_transform(_frame(spark, [1.2], "double"), flags=True)) == [(10.0, True, "")]


def test_constant_column(spark):
    df = _frame(spark, [5, 5, 5], "int")
    model = fit(df, [ColumnSpec("c")])
    assert model["c"].norm_scale == 1.0
    assert _column(model.transform(df)) == [0.0] * 3
    assert _column(model.inverse_transform(model.transform(df))) == [5] * 3


def test_constant_column_clips_the_scaled_value_first(spark):
    model = fit(_frame(spark, [5.0], "double"), [ColumnSpec("c", clip=True)])
    assert _column(model.inverse_transform(_frame(spark, [2.0, -2.0], "double"))) == [6.0, 5.0]


def test_sign_after_prefix(spark):
    df = _frame(spark, ["$-12.5", "$12.5"], "string")
    model = fit(df, [ColumnSpec("c", prefix="$", rounding=2)])
    assert model["c"].norm_min == -12.5
    assert _column(model.inverse_transform(model.transform(df))) == ["$-12.5", "$12.5"]


def test_whole_numbers_in_text_get_one_decimal(spark):
    df = _frame(spark, ["0", "2.5", "10"], "string")
    model = fit(df, [ColumnSpec("c", rounding=0)])
    assert _column(model.inverse_transform(model.transform(df))) == ["0.0", "2.0", "10.0"]


def test_large_values_have_no_exponent(spark):
    df = _frame(spark, ["0", "12345678.9"], "string")
    model = fit(df, [ColumnSpec("c", rounding=2)])
    assert _column(model.inverse_transform(model.transform(df)))[1] == "12345678.9"


def test_bad_text(spark):
    df = _frame(spark, ["$1", "$abc", None, "$3", ""], "string")
    specs = [ColumnSpec("c", prefix="$")]
    model = fit(df, specs)
    assert _triples(model.transform(df, flags=True)) == [
        (0.0, True, ""),
        (None, False, "parse error"),
        (None, True, ""),
        (1.0, True, ""),
        (None, False, "parse error"),
    ]
    with pytest.raises(ValueError, match="parse error"):
        fit(df, specs, on_error="raise")
    with pytest.raises(PySparkException, match="parse error in c"):
        model.transform(df, on_error="raise").collect()
    good = df.where("c in ('$1', '$3') or c is null")
    assert _column(fit(good, specs, on_error="raise").transform(good, on_error="raise")) == [0.0, None, 1.0]


def test_flags_of_both_ways_are_merged(spark):
    df = _frame(spark, ["$1", "$abc", "$3", None], "string")
    model = fit(df, [ColumnSpec("c", prefix="$", max_val=2, clip_oor=False)])
    back = model.inverse_transform(model.transform(df, flags=True), flags=True)
    assert back.columns == ["c", "c_valid", "c_error"]
    assert _triples(back) == [
        ("$1.0", True, ""),
        (None, False, "parse error"),
        (None, False, "Out of range"),
        (None, True, ""),
    ]
    assert model.transform(model.transform(df, flags=True).withColumn("c", F.lit("$3")), flags=True).columns == back.columns


@pytest.mark.parametrize("values", [[], [None, None]])
@pytest.mark.parametrize("ddl", ["string", "bigint", "double"])
def test_no_values(spark, values, ddl):
    df = _frame(spark, values, ddl)
    model = fit(df, [ColumnSpec("c", min_val=True, max_val=True)])
    c = model["c"]
    assert (c.norm_min, c.norm_max, c.norm_scale, c.min_val, c.max_val) == (0.0, 1.0, 1.0, None, None)
    assert _column(model.inverse_transform(model.transform(df))) == values


def test_missing_values_are_not_clipped(spark):
    df = _frame(spark, [None, 0.0, 3.0], "double")
    model = fit(df, [ColumnSpec("c", min_val=1, clip=True)])
    scaled = model.transform(df, flags=True)
    assert _triples(scaled) == [(None, True, ""), (0.0, True, ""), (1.0, True, "")]
    assert _triples(model.inverse_transform(scaled.select("c"), flags=True))[0] == (None, True, "")


def test_nan_is_missing(spark):
    df = _frame(spark, [1.0, math.nan, 3.0], "double")
    model = fit(df, [ColumnSpec("c", clip=True)])
    assert (model["c"].norm_min, model["c"].norm_max) == (1.0, 3.0)
    assert _column(model.transform(df)) == [0.0, None, 1.0]
    assert _column(model.inverse_transform(_frame(spark, [math.nan], "double"))) == [None]


def test_new_data_beyond_the_fit(spark):
    old, new = _frame(spark, [0.0, 10.0], "double"), _frame(spark, [20.0], "double")
    assert _column(fit(old, [ColumnSpec("c", clip=True)]).transform(new)) == [1.0]
    assert _column(fit(old, [ColumnSpec("c")]).transform(new)) == [2.0]


def test_empirical_bound_against_a_fixed_one(spark):
    df = _frame(spark, [1.0, 3.0], "double")
    c = fit(df, [ColumnSpec("c", min_val=5, max_val=True)])["c"]
    assert (c.min_val, c.max_val, c.norm_min, c.norm_max) == (5.0, 3.0, 3.0, 3.0)


def test_infinite_values(spark):
    df = _frame(spark, [0.0, math.inf, 5.0], "double")
    assert _column(fit(df, [ColumnSpec("c", max_val=10)]).transform(df)) == [0.0, 1.0, 0.5]
    assert _column(fit(df, [ColumnSpec("c")]).transform(df)) == [0.0, None, 0.0]


def test_column_names_and_order(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (3, "y", 5.0)], "`a.b` int, other string, `c``d` double").coalesce(1)
    model = fit(df, [ColumnSpec("c`d"), ColumnSpec("a.b", rounding=0)])
    scaled = model.transform(df)
    assert scaled.columns == ["a.b", "other", "c`d"]
    assert [tuple(r) for r in scaled.collect()] == [(0.0, "x", 0.0), (1.0, "y", 1.0)]
    assert [tuple(r) for r in model.inverse_transform(scaled).collect()] == [(1, "x", 1.0), (3, "y", 5.0)]
    flagged = model.transform(df, flags=True)
    assert flagged.columns == ["a.b", "a.b_valid", "a.b_error", "other", "c`d", "c`d_valid", "c`d_error"]


def test_source_types_come_back(spark):
    df = spark.sql(
        "select cast(id as tinyint) t, cast(id as int) i, cast(id / 4 as float) f, cast(id / 4 as decimal(6,2)) d,"
        " cast(id / 4 as string) s from range(5)"
    )
    model = fit(df, [ColumnSpec(name) for name in df.columns])
    back = model.inverse_transform(model.transform(df))
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(
        (r.t, r.i, r.f, r.d, repr(float(r.s))) for r in df.collect()
    )


def test_wrong_columns(spark):
    df = spark.sql("select 1 a, true b, current_date() c")
    for name in ("b", "c", "z"):
        with pytest.raises(ValueError):
            fit(df, [ColumnSpec(name)])
    with pytest.raises(ValueError):
        fit(df, [ColumnSpec("a")], on_error="ignore")
    with pytest.raises(ValueError):
        fit(df, [])


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_stored_parameters_give_the_same_result(spark, tmp_path, file_format):
    df = spark.createDataFrame([(f"${k / 7}", k / 3, k) for k in range(50)], "a string, b double, c int")
    config = {
        "a": {"converter": {"prefix": "$", "max_val": True, "rounding": None}},
        "b": {"converter": {"min_val": 2, "clip_oor": False}, "normalizer": {"reject": True}},
        "c": {"converter": {"rounding": 0}, "normalizer": {"clip": True}},
    }
    model = fit(df, config)
    for name in config:
        fit(df, config, columns=[name]).save(spark, str(tmp_path / name), file_format)
    loaded = FittedModel(())
    for name in config:
        loaded = loaded.merge(FittedModel.load(spark, str(tmp_path / name), file_format))
    assert loaded == model
    with pytest.raises(ValueError, match="twice"):
        model.merge(loaded)
    assert FittedModel.from_params(model.params(spark)) == model


def test_fit_does_not_depend_on_partitions_or_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.rand(3) * 1000).alias("c"))
    df = spark.createDataFrame(df.collect(), df.schema)
    specs = [ColumnSpec("c", min_val=10)]
    models = {fit(df.repartition(n).orderBy(F.rand(n)), specs) for n in (1, 3, 13)}
    assert len(models) == 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30),
    places=st.integers(0, 4),
    affix=st.sampled_from([("", ""), ("$", ""), ("", "cm"), ("~", " kg")]),
)
def test_round_trip_property(spark, values, places, affix):
    prefix, suffix = affix
    df = _frame(spark, [f"{prefix}{v!r}{suffix}" for v in values], "string")
    model = fit(df, [ColumnSpec("c", prefix=prefix, suffix=suffix, rounding=places, clip=True)])
    scaled = model.transform(df)
    assert all(0.0 <= s <= 1.0 for s in _column(scaled))
    slack = 0.5 * 10.0**-places + 1e-8
    for value, text in zip(values, _column(model.inverse_transform(scaled))):
        assert text.startswith(prefix) and text.endswith(suffix)
        assert abs(float(text[len(prefix) : len(text) - len(suffix)]) - value) <= slack


def test_many_columns(spark):
    """As many as push Spark past whole-stage code generation."""
    rng = random.Random(1)
    names = [f"c{i}" for i in range(60)]
    rows = [tuple(f"${rng.randint(0, 999) / 10}" for _ in names) for _ in range(20)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    model = fit(df, [ColumnSpec(n, prefix="$", rounding=1) for n in names])
    back = model.inverse_transform(model.transform(df))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_config_is_accepted_as_it_is(spark):
    df = spark.createDataFrame([(1, "1.0cm"), (31, "9.5cm")], "day int, height string").coalesce(1)
    config = {
        "day": {"converter": {"min_val": 1, "max_val": 31, "clip_oor": False, "rounding": 0}, "normalizer": {"reject": True}},
        "height": {"converter": {"suffix": "cm", "rounding": 2}, "normalizer": {"clip": True}},
    }
    assert fit(df, config) == fit(df, load_specs(config))
