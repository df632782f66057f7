"""Fitting, scaling and restoring."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.catalog.registry import query, range_of, table
from numprep.functions import number_text, round_places
from numprep.operators import profile, round_trip
from numprep.plans import ColumnSpec, FittedModel, fit
from numprep.sources import read_table, scratch_path
from numprep.streaming import scale_new_files

# What DuckDB needs to read number text the same way.
NUMBER_SQL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

BRAND = {
    "p_brand": {"converter": {"prefix": "Brand#", "rounding": 0}, "normalizer": {"clip": True}},
    "p_size": {"converter": {"min_val": 1, "max_val": 31, "rounding": 0}, "normalizer": {"clip": True}},
}
_SETTINGS = Path(__file__).with_name("part.yaml")  # the same in a file
BALANCE = {"c_acctbal": {"converter": {"min_val": 0, "rounding": 2}, "normalizer": {"clip": True}}}
PROPS = {"props": {"converter": {"prefix": '{"k": ', "suffix": "}", "rounding": 0}, "normalizer": {"reject": True}}}

_BRAND_SQL = "cast(substr(p_brand, 7) as double)"
_SIZE_SQL = "cast(least(greatest(p_size, 1), 31) as double)"
_PARAMS = ("column_name", "source_type", "min_val", "max_val", "norm_min", "norm_max", "norm_scale")


@query(f"""
select 'p_brand' as column_name, 'string' as source_type, cast(null as double) as min_val,
  cast(null as double) as max_val, lo as norm_min, hi as norm_max, sc as norm_scale
from ({range_of(_BRAND_SQL, "part")})
union all
select 'p_size', 'int', 1.0, 31.0, lo, hi, sc from ({range_of(_SIZE_SQL, "part")})
union all
select 'c_acctbal', 'double', 0.0, null, lo, hi, sc from ({range_of("greatest(c_acctbal, 0.0)", "customer")})
""")
def fit_params(spark: SparkSession, folder: str) -> DataFrame:
    parts = fit(table(spark, folder, "part"), _SETTINGS)
    customers = fit(table(spark, folder, "customer"), BALANCE)
    return parts.merge(customers).params(spark).select(*_PARAMS)


@query(f"""
select p_partkey, p_name, ({_BRAND_SQL} - b.lo) / b.sc as p_brand, p_type, ({_SIZE_SQL} - s.lo) / s.sc as p_size,
  p_retailprice
from part, ({range_of(_BRAND_SQL, "part")}) b, ({range_of(_SIZE_SQL, "part")}) s
""")
def transform_affixed(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part")
    return fit(df, BRAND).transform(df)


_PROPS_SQL = "try_cast(substr(props, 7, length(props) - 7) as double)"


@query(f"""
select event_id, ({_PROPS_SQL} - r.lo) / r.sc as props from events, ({range_of(_PROPS_SQL, "events")}) r
""")
def transform_prefix_suffix(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "events").select("event_id", "props")
    return fit(df, PROPS).transform(df)


@query(f"""
select c_custkey, c_name, c_nationkey, (greatest(c_acctbal, 0.0) - r.lo) / r.sc as c_acctbal, c_mktsegment
from customer, ({range_of("greatest(c_acctbal, 0.0)", "customer")}) r
""")
def transform_clip_lower(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "customer")
    return fit(df, BALANCE).transform(df)


@query(f"""
select c_custkey, (greatest(c_acctbal, 0.0) - r.lo) / r.sc as c_acctbal
from customer, ({range_of("greatest(c_acctbal, 0.0)", "customer")}) r
""")
def transform_arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stored parameters applied to files as they arrive."""
    df = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    scratch = scratch_path(spark, "arriving")
    source = f"{folder}/customer.parque[t]"  # file or folder, but to a stream always a pattern
    stream = scale_new_files(spark, fit(df, BALANCE), source, df.schema, f"{scratch}/scaled", f"{scratch}/done")
    stream.awaitTermination()
    return read_table(spark, f"{scratch}/scaled")


@query(f"""
select o_orderkey, (case when o_totalprice * 2 < r.lo then r.lo when o_totalprice * 2 > r.hi then r.hi
  else o_totalprice * 2 end - r.lo) / r.sc as clipped, (o_totalprice * 2 - r.lo) / r.sc as unclipped
from orders, ({range_of("o_totalprice", "orders")}) r
""")
def transform_new_data(spark: SparkSession, folder: str) -> DataFrame:
    """Values beyond the fitted range."""
    df = table(spark, folder, "orders")
    fitted = df.select("o_orderkey", F.col("o_totalprice").alias("clipped"), F.col("o_totalprice").alias("unclipped"))
    twice = F.col("o_totalprice") * 2
    newer = df.select("o_orderkey", twice.alias("clipped"), twice.alias("unclipped"))
    return fit(fitted, [ColumnSpec("clipped", clip=True), ColumnSpec("unclipped")]).transform(newer)


_DIRTY = (
    (0, "abc"),
    (1, ""),
    (2, " 12 "),
    (3, "1e3"),
    (4, ".5"),
    (5, "5."),
    (6, "+5"),
    (7, "12d"),
    (8, "inf"),
    (9, "nan"),
    (10, "1_0"),
    (11, "1 2"),
    (12, "0x1p3"),
)
_DIRTY_SQL = (
    "case p_partkey % 17 "
    + " ".join(f"when {k} then '${text}'" for k, text in _DIRTY)
    + " when 13 then null else '$' || cast(p_retailprice as varchar) end"
)
_CLEAN_SQL = f"case when regexp_matches(substr(price, 2), '{NUMBER_SQL}') then try_cast(substr(price, 2) as double) end"


def _dirty(spark: SparkSession, folder: str) -> DataFrame:
    kind, price = F.pmod("p_partkey", F.lit(17)), F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))
    text = F.when(kind == 13, F.lit(None))
    for k, bad in _DIRTY:
        text = text.when(kind == k, F.lit("$" + bad))
    return table(spark, folder, "part").select("p_partkey", text.otherwise(price).alias("price"))


@query(f"""
with parsed as (select p_partkey, price, {_CLEAN_SQL} as v from (select p_partkey, {_DIRTY_SQL} as price from part))
select p_partkey, (v - r.lo) / r.sc as price, not (price is not null and v is null) as price_valid,
  case when price is not null and v is null then 'parse error' else '' end as price_error
from parsed, ({range_of("v", "parsed")}) r
""")
def malformed_text(spark: SparkSession, folder: str) -> DataFrame:
    df = _dirty(spark, folder)
    return fit(df, [ColumnSpec("price", prefix="$")]).transform(df, flags=True)


@query(f"""
with parsed as (select price, {_CLEAN_SQL} as v from (select {_DIRTY_SQL} as price from part))
select 'price' as column_name, 'string' as source_type, count(*) as rows, count(*) - count(price) as missing,
  count(*) filter (price is not null and v is null) as unparsable, count(*) filter (v < 5) as below_min,
  count(*) filter (v > 1000) as above_max, min(v) as min, max(v) as max
from parsed
""")
def profile_text(spark: SparkSession, folder: str) -> DataFrame:
    return profile(_dirty(spark, folder), [ColumnSpec("price", prefix="$", min_val=5, max_val=1000)])


@query("""
select 'c_acctbal' as column_name, 'double' as source_type, count(*) as rows, count(*) - count(c_acctbal) as missing,
  0::bigint as unparsable, count(*) filter (c_acctbal < 0) as below_min, 0::bigint as above_max, min(c_acctbal) as min,
  max(c_acctbal) as max from customer
union all
select 'c_nationkey', 'int', count(*), count(*) - count(c_nationkey), 0::bigint, count(*) filter (c_nationkey < 3),
  count(*) filter (c_nationkey > 20), min(c_nationkey), max(c_nationkey) from customer
""")
def profile_numbers(spark: SparkSession, folder: str) -> DataFrame:
    specs = [ColumnSpec("c_acctbal", min_val=0), ColumnSpec("c_nationkey", min_val=3, max_val=20)]
    return profile(table(spark, folder, "customer"), specs)


def _shifted(scaled: DataFrame, *names: str) -> DataFrame:
    """Scaled values stretched beyond both ends of [0, 1]."""
    return scaled.withColumns({name: F.col(name) * 1.4 - 0.2 for name in names})


_ORDER_RANGE = range_of("o_totalprice", "orders")
_SHIFTED_PRICE = f"""shifted as (
  select o_orderkey, ((o_totalprice - r.lo) / r.sc) * 1.4 - 0.2 as s, r.lo, r.hi, r.sc from orders, ({_ORDER_RANGE}) r)"""


@query(f"""
with {_SHIFTED_PRICE}
select o_orderkey, round_even((case when s < 0 then 0.0 when s > 1 then 1.0 else s end * sc + lo) * 100.0, 0) / 100.0
  as o_totalprice, true as o_totalprice_valid, '' as o_totalprice_error
from shifted
""")
def inverse_clip(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    model = fit(df, [ColumnSpec("o_totalprice", rounding=2, clip=True)])
    return model.inverse_transform(_shifted(model.transform(df), "o_totalprice"), flags=True)


@query(f"""
with {_SHIFTED_PRICE}
select o_orderkey, case when not (s < 0 or s > 1) then round_even((s * sc + lo) * 100.0, 0) / 100.0 end as o_totalprice,
  not (s < 0 or s > 1) as o_totalprice_valid,
  case when s < 0 or s > 1 then 'out of range [0,1]' else '' end as o_totalprice_error
from shifted
""")
def inverse_reject(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    model = fit(df, [ColumnSpec("o_totalprice", rounding=2, reject=True)])
    return model.inverse_transform(_shifted(model.transform(df), "o_totalprice"), flags=True)


_SHIFTED_SIZE = f"""shifted as (
  select p_partkey, ((cast(p_size as double) - r.lo) / r.sc) * 1.4 - 0.2 as s, r.lo, r.sc
  from part, ({range_of("cast(p_size as double)", "part")}) r)"""


@query(f"""
with {_SHIFTED_SIZE}, numbers as (select p_partkey, s * sc + lo as y from shifted)
select p_partkey, case when not (y < 1 or y > 45) then cast(round_even(y, 0) as int) end as p_size,
  not (y < 1 or y > 45) as p_size_valid, case when y < 1 or y > 45 then 'Out of range' else '' end as p_size_error
from numbers
""")
def inverse_flag_range(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", "p_size")
    model = fit(df, [ColumnSpec("p_size", min_val=1, max_val=45, clip_oor=False, rounding=0)])
    return model.inverse_transform(_shifted(model.transform(df), "p_size"), flags=True)


@query(f"""
with {_SHIFTED_SIZE}, numbers as (select p_partkey, s, s * sc + lo as y from shifted)
select p_partkey, case when not (s < 0 or s > 1 or y > 45) then cast(round_even(y, 0) as int) end as p_size,
  not (s < 0 or s > 1 or y > 45) as p_size_valid,
  case when s < 0 or s > 1 then 'out of range [0,1]' when y > 45 then 'Out of range' else '' end as p_size_error
from numbers
""")
def inverse_both_flags(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", "p_size")
    model = fit(df, [ColumnSpec("p_size", max_val=45, clip_oor=False, rounding=0, reject=True)])
    return model.inverse_transform(_shifted(model.transform(df), "p_size"), flags=True)


@query(f"""
with texts as (select s_suppkey, s_acctbal as v from supplier),
scaled as (select s_suppkey, (v - r.lo) / r.sc as s, r.lo, r.sc from texts, ({range_of("v", "texts")}) r)
select s_suppkey, '$' || cast(round_even((s * sc + lo) * 10.0, 0) / 10.0 + 0.0 as varchar) || ' USD' as s_acctbal
from scaled
""")
def inverse_text(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.concat(F.lit("$"), F.col("s_acctbal").cast("string"), F.lit(" USD"))
    df = table(spark, folder, "supplier").select("s_suppkey", balance.alias("s_acctbal"))
    model = fit(df, [ColumnSpec("s_acctbal", prefix="$", suffix=" USD", rounding=1)])
    return model.inverse_transform(model.transform(df))


@query(f"""
with scaled as (select p_partkey, ({_BRAND_SQL} - r.lo) / r.sc as s, r.lo, r.sc from part, ({range_of(_BRAND_SQL, "part")}) r)
select p_partkey, 'Brand#' || cast(round_even(s * sc + lo, 0) + 0.0 as varchar) as p_brand from scaled
""")
def inverse_affixed(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", "p_brand")
    model = fit(df, [ColumnSpec("p_brand", prefix="Brand#", rounding=0)])
    return model.inverse_transform(model.transform(df))


@query("""
select o_orderkey, cast(round_even(o_totalprice / 7 * 100.0, 0) / 100.0 as varchar) as plain,
  cast(round_even(o_totalprice * 1000 / 7 * 1000.0, 0) / 1000.0 as varchar) as large,
  cast(round_even(o_totalprice, 0) * 1e12 as varchar) as with_exponent,
  cast(round_even(o_totalprice / 1e8 * 1000000.0, 0) / 1000000.0 as varchar) as small
from orders
""")
def numbers_as_text(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        number_text(round_places(price / 7, 2), 2).alias("plain"),
        number_text(round_places(price * 1000 / 7, 3), 3).alias("large"),
        number_text(round_places(price, 0) * 1e12, 0).alias("with_exponent"),
        number_text(round_places(price / 1e8, 6), 6).alias("small"),
    )


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round_even(l_extendedprice * l_discount * 100.0, 0) / 100.0 as to_cents,
  round_even(l_quantity / 2, 0) as to_units, round_even(l_extendedprice / 1000.0, 0) * 1000.0 as to_thousands
from lineitem
""")
def rounding(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        round_places(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("to_cents"),
        round_places(F.col("l_quantity") / 2, 0).alias("to_units"),
        round_places(F.col("l_extendedprice"), -3).alias("to_thousands"),
    )


@query(f"""
with trip as (select o_totalprice as a, round_even((((o_totalprice - r.lo) / r.sc) * r.sc + r.lo) * 100.0, 0) / 100.0 as b
  from orders, ({_ORDER_RANGE}) r)
select 'o_totalprice' as column_name, 'number' as kind, count(*) as compared, max(abs(a - b)) as max_abs_diff,
  count(*) filter (abs(a - b) > 0.005) as mismatches, 0::bigint as null_mismatches, bool_and(a = b) as all_equal
from trip
""")
def round_trip_orders(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders")
    return round_trip(df, fit(df, [ColumnSpec("o_totalprice", rounding=2)]), tolerance=0.005)


@query(f"""
with shifted as (select p_partkey, ((cast(p_size as double) - r.lo) / r.sc) * 1.4 - 0.2 as s, r.lo, r.hi, r.sc
  from part, ({range_of("cast(p_size as double)", "part")}) r),
numbers as (select p_partkey, s * sc + lo as y, lo, hi from shifted)
select p_partkey, case when not (y < lo or y > hi) then cast(round_even(y, 0) as int) end as p_size,
  not (y < lo or y > hi) as p_size_valid, case when y < lo or y > hi then 'Out of range' else '' end as p_size_error
from numbers
""")
def empirical_bounds(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", "p_size")
    model = fit(df, [ColumnSpec("p_size", min_val=True, max_val=True, clip_oor=False, rounding=0)])
    return model.inverse_transform(_shifted(model.transform(df), "p_size"), flags=True)


@query("select p_partkey, 0.0::double as scaled, 5 as restored from part")
def constant_column(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", F.lit(5).alias("value"))
    model = fit(df, [ColumnSpec("value")])
    scaled = model.transform(df).withColumnRenamed("value", "scaled")
    restored = model.inverse_transform(scaled.withColumn("value", F.col("scaled")))
    return restored.withColumnRenamed("value", "restored")


_NARROW_SQL = "cast(5 * (p_size - lo) + lo as bigint)"


@query(f"""
select p_partkey, case when {_NARROW_SQL} <= 127 then {_NARROW_SQL} end as tiny, {_NARROW_SQL} <= 127 as tiny_valid,
  case when {_NARROW_SQL} <= 127 then '' else 'does not fit' end as tiny_error,
  case when 600 * {_NARROW_SQL} <= 32767 then 600 * {_NARROW_SQL} end as small, 600 * {_NARROW_SQL} <= 32767 as small_valid,
  case when 600 * {_NARROW_SQL} <= 32767 then '' else 'does not fit' end as small_error
from part, (select min(p_size) as lo from part)
""")
def restore_narrow_types(spark: SparkSession, folder: str) -> DataFrame:
    """Values that the column's integer type cannot hold are missing and flagged."""
    size = F.col("p_size")
    df = table(spark, folder, "part").select(
        "p_partkey", size.cast("tinyint").alias("tiny"), (size * 600).cast("smallint").alias("small")
    )
    model = fit(df, [ColumnSpec("tiny", rounding=0), ColumnSpec("small", rounding=0)])
    scaled = model.transform(df)
    larger = scaled.withColumns({name: F.col(name) * 5 for name in ("tiny", "small")})
    restored = model.inverse_transform(larger, flags=True)
    return restored.withColumns({name: F.col(name).cast("long") for name in ("tiny", "small")})


@query("""
select 'p_size' as column_name, 'int' as source_type, cast(null as double) as min_val, cast(null as double) as max_val,
  coalesce(min(p_size), 0)::double as norm_min, coalesce(max(p_size), 1)::double as norm_max,
  1.0::double as norm_scale
from part where p_size < 0
""")
def empty_input(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").where("p_size < 0")
    return fit(df, [ColumnSpec("p_size", min_val=True)]).params(spark).select(*_PARAMS)


@query(f"""
with clipped as (select p_partkey, least({_BRAND_SQL}, 20.0) as v from part)
select p_partkey, (v - r.lo) / r.sc as p_brand from clipped, ({range_of("v", "clipped")}) r
""")
def text_bounds(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part").select("p_partkey", "p_brand")
    return fit(df, [ColumnSpec("p_brand", prefix="Brand#", max_val="Brand#20")]).transform(df)


@query(f"""
select c_custkey, (cast(substr(c_name, 10) as double) - n.lo) / n.sc as c_name,
  (greatest(c_acctbal, 0.0) - r.lo) / r.sc as c_acctbal
from customer, ({range_of("cast(substr(c_name, 10) as double)", "customer")}) n,
  ({range_of("greatest(c_acctbal, 0.0)", "customer")}) r
""")
def params_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Columns fitted apart, stored, read back together and applied."""
    df = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    config = {**BALANCE, "c_name": {"converter": {"prefix": "Customer#"}}}
    path = scratch_path(spark, "params")
    for name in config:
        fit(df, config, columns=[name]).save(spark, f"{path}/{name}")
    stored = [FittedModel.load(spark, f"{path}/{name}") for name in config]
    return stored[0].merge(stored[1]).transform(df)


@query(f"""
select count(*) as rows, count(s) as transformed, count(s) filter (s >= 0) as restored,
  count(*) filter (s is null or s >= 0) as valid
from (select ({_BRAND_SQL} - 5 - r.lo) / r.sc as s from part, ({range_of(_BRAND_SQL, "part")}) r)
""")
def stored_params_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    """Stored parameters applied both ways to shifted values, and the results counted in one pass."""
    df = table(spark, folder, "part").select("p_brand")
    path = scratch_path(spark, "params")
    fit(df, [ColumnSpec("p_brand", prefix="Brand#", rounding=0, reject=True)]).save(spark, path)
    model = FittedModel.load(spark, path)
    lower = F.concat(F.lit("Brand#"), F.expr("substring(p_brand, 7)").cast("int") - 5)
    scaled = model.transform(df.select(lower.alias("p_brand"))).withColumn("scaled", F.col("p_brand"))
    return model.inverse_transform(scaled, flags=True).agg(
        F.count("*").alias("rows"),
        F.count("scaled").alias("transformed"),
        F.count("p_brand").alias("restored"),
        F.count_if("p_brand_valid").alias("valid"),
    )


@query(f"""
with converted as (select c_custkey, c_acctbal, greatest(c_acctbal, 100.0) as v from customer),
scaled as (select c_custkey, v, (v - r.lo) / r.sc as s, r.lo, r.sc, r.hi from converted, ({range_of("v", "converted")}) r),
shifted as (select *, s * 1.4 - 0.2 as t from scaled)
select c_custkey, v as converted, s as normalized, case when not (t < 0 or t > 1) then t * sc + lo end as number_data,
  not (t < 0 or t > 1) as number_valid, case when t < 0 or t > 1 then 'out of range [0,1]' else '' end as number_error,
  round_even((case when t * sc + lo < 100.0 then 100.0 else t * sc + lo end) * 10.0, 0) / 10.0 as value_data,
  true as value_valid, '' as value_error
from shifted
""")
def column_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The four steps of a column one by one: convert, normalize, and the two inverses with their flags."""
    df = table(spark, folder, "customer")
    step = fit(df, [ColumnSpec("c_acctbal", min_val=100, rounding=1, reject=True)])["c_acctbal"]
    df = df.select("c_custkey", step.convert(F.col("c_acctbal")).alias("converted"))
    df = df.withColumn("normalized", step.normalize(F.col("converted")))
    df = df.withColumn("shifted", F.col("normalized") * 1.4 - 0.2)
    df = df.withColumn("number", step.inverse_normalize(F.col("shifted")))
    df = df.withColumn("value", step.inverse_convert(step.unscale(F.col("shifted"))))
    parts = [F.col(f"{c}.{p}").alias(f"{c}_{p}") for c in ("number", "value") for p in ("data", "valid", "error")]
    return df.select("c_custkey", "converted", "normalized", *parts)
