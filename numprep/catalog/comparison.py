"""Comparison of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.catalog.registry import query, table
from numprep.operators import diff_repeated, diff_rows, diff_summary, pair_repeated

# The second table: some prices and statuses changed, some keys moved, and expensive orders doubled.
_CHANGED_SQL = """changed as (
  select case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then -1 - o_orderkey else o_orderkey end
      as o_orderkey,
    case o_orderpriority when '1-URGENT' then o_totalprice + o_custkey / 8.0::double when '2-HIGH' then null
      else o_totalprice + 5e-7 end as o_totalprice,
    case o_orderpriority when '3-MEDIUM' then null when '4-NOT SPECIFIED' then 'X' else o_orderstatus end
      as o_orderstatus
  from orders
  union all select o_orderkey, o_totalprice, o_orderstatus from orders where o_totalprice > 450000)"""
_MATCHED_SQL = """once as (select o_orderkey from changed group by o_orderkey having count(*) = 1),
matched as (
  select a.o_orderkey, a.o_totalprice as ln, b.o_totalprice as rn, a.o_orderstatus as lt, b.o_orderstatus as rt
  from orders a join changed b using (o_orderkey) join once using (o_orderkey))"""


def _tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    df = table(spark, folder, "orders")
    orders = df.select("o_orderkey", "o_totalprice", "o_orderstatus")
    key, price, status, priority = (
        F.col(name) for name in ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    )
    moved = (priority == "5-LOW") & (status == "P")
    changed = df.select(
        F.when(moved, -1 - key).otherwise(key).alias("o_orderkey"),
        F.when(priority == "1-URGENT", price + F.col("o_custkey") / 8.0)
        .when(priority == "2-HIGH", F.lit(None))
        .otherwise(price + 5e-7)
        .alias("o_totalprice"),
        F.when(priority == "3-MEDIUM", F.lit(None))
        .when(priority == "4-NOT SPECIFIED", F.lit("X"))
        .otherwise(status)
        .alias("o_orderstatus"),
    )
    return orders, changed.unionByName(orders.where(price > 450_000))


_KEYS_SQL = """keys as (
  select coalesce(l.o_orderkey, r.o_orderkey) as k, coalesce(l.n, 0) as n_l, coalesce(r.n, 0) as n_r
  from (select o_orderkey, count(*) as n from orders group by all) l
  full join (select o_orderkey, count(*) as n from changed group by all) r on l.o_orderkey = r.o_orderkey),
seen as (select count(*) filter (n_l = 1 and n_r = 1) as compared, count(*) filter (n_l = 1 and n_r = 0) as left_only,
  count(*) filter (n_l = 0 and n_r = 1) as right_only, count(*) filter (n_l > 1 or n_r > 1) as duplicate_keys from keys)"""


@query(f"""
with {_CHANGED_SQL}, {_MATCHED_SQL}, {_KEYS_SQL},
measured as (
  select 'o_totalprice' as column_name, 'number' as kind, max(abs(ln - rn)) as max_abs_diff,
    count(*) filter (abs(ln - rn) > 1e-6) as mismatches, count(*) filter ((ln is null) != (rn is null)) as null_mismatches,
    bool_and(ln is not distinct from rn) as all_equal from matched
  union all
  select 'o_orderstatus', 'text', null, count(*) filter (lt is distinct from rt),
    count(*) filter ((lt is null) != (rt is null)), bool_and(lt is not distinct from rt) from matched)
select * from measured, seen
""")
def diff_tables(spark: SparkSession, folder: str) -> DataFrame:
    return diff_summary(*_tables(spark, folder), keys=["o_orderkey"])


@query(f"""
with {_CHANGED_SQL}, {_MATCHED_SQL},
found as (
  select 'o_totalprice' as column_name, o_orderkey, cast(ln as varchar) as left_value, cast(rn as varchar) as right_value,
    abs(ln - rn) as difference from matched where abs(ln - rn) > 1e-6
  union all
  select 'o_orderstatus', o_orderkey, lt, rt, null from matched where lt is distinct from rt)
select column_name, row_number() over w as position, o_orderkey, left_value, right_value, difference from found
window w as (partition by column_name order by difference desc nulls last, o_orderkey)
qualify row_number() over w <= 10
""")
def diff_samples(spark: SparkSession, folder: str) -> DataFrame:
    return diff_rows(*_tables(spark, folder), keys=["o_orderkey"])


# Whole numbers and prices that differ only in digits a double does not hold, and infinite ones.
_WIDE = 2**53
_EXACT_SQL = f"""pairs as (
  select o_orderkey, {_WIDE}::bigint + o_orderkey as a, {_WIDE}::bigint + o_orderkey + o_orderkey % 2 as b,
    o_custkey::decimal(38,9) * 1000000000000 as c, o_custkey::decimal(38,9) * 1000000000000 + 0.000000001 as d,
    case when o_orderkey % 3 = 0 then 'inf'::double else o_totalprice end as e,
    case when o_orderkey % 3 = 0 then 'inf'::double else o_totalprice end as f from orders)"""


@query(f"""
with {_EXACT_SQL}
select 'id' as column_name, 'number' as kind, count(*) as compared, max(b - a)::double as max_abs_diff,
  count(*) filter (a != b) as mismatches, 0::bigint as null_mismatches, bool_and(a = b) as all_equal from pairs
union all
select 'price', 'number', count(*), max(d - c)::double, count(*) filter (d - c > 1e-12), 0, bool_and(c = d) from pairs
union all
select 'rate', 'number', count(*), 0.0::double, 0, 0, true from pairs
""")
def diff_exact(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key, price = F.col("o_orderkey"), F.col("o_custkey").cast("decimal(20,9)") * F.lit(10**12).cast("decimal(13,0)")
    rate = F.when(key % 3 == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice")).alias("rate")
    wide = key + F.lit(_WIDE)
    one = orders.select("o_orderkey", wide.alias("id"), price.cast("decimal(36,9)").alias("price"), rate)
    changed = (price + F.lit("0.000000001").cast("decimal(10,9)")).cast("decimal(36,9)")
    other = orders.select("o_orderkey", (wide + key % 2).alias("id"), changed.alias("price"), rate)
    summary = diff_summary(one, other, keys=["o_orderkey"], tolerance=1e-12)
    return summary.drop("left_only", "right_only", "duplicate_keys")


# Lines of an order repeat their number. In the second table some quantities, parts and flags are changed, some lines are
# missing and some doubled.
_LINES_SQL = """one as (
  select l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag from lineitem),
other as (
  select l_orderkey, l_linenumber, case when l_suppkey % 11 = 0 then null else l_partkey end as l_partkey,
    case when l_partkey % 7 = 0 then l_quantity + l_linenumber else l_quantity end as l_quantity,
    case when l_partkey % 5 = 0 then 'X' when l_partkey % 13 = 0 then null else l_returnflag end as l_returnflag
  from lineitem where l_partkey % 17 != 0
  union all select l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag from lineitem where l_partkey % 19 = 0),
counted as (
  select l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, sum(n_l) as n_l, sum(n_r) as n_r
  from (select *, 1 as n_l, 0 as n_r from one union all select *, 0, 1 from other) group by all),
spread as (
  select *, case when n_l > n_r then 'l' else 'r' end as side, md5(concat_ws(chr(31), coalesce('=' || l_partkey, '-'),
    coalesce('=' || l_quantity, '-'), coalesce('=' || l_returnflag, '-'))) as digest, unnest(range(abs(n_l - n_r)::bigint)) as copy
  from counted where n_l != n_r),
ranked as (
  select *, row_number() over (partition by l_orderkey, l_linenumber, side order by digest, copy) as place from spread),
pairs as (
  select a.l_orderkey, a.l_linenumber, a.l_partkey as lp, b.l_partkey as rp, a.l_quantity as lq, b.l_quantity as rq,
    a.l_returnflag as lf, b.l_returnflag as rf
  from ranked a join ranked b on a.side = 'l' and b.side = 'r' and a.l_orderkey = b.l_orderkey
    and a.l_linenumber = b.l_linenumber and a.place = b.place)"""


def _lines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    df = table(spark, folder, "lineitem")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]
    part, quantity, flag = (F.col(name) for name in columns[2:])
    changed = df.where(part % 17 != 0).select(
        *columns[:2],
        F.when(F.col("l_suppkey") % 11 != 0, part).alias("l_partkey"),
        F.when(part % 7 == 0, quantity + F.col("l_linenumber")).otherwise(quantity).alias("l_quantity"),
        F.when(part % 5 == 0, "X").when(part % 13 == 0, F.lit(None)).otherwise(flag).alias("l_returnflag"),
    )
    return df.select(columns), changed.unionByName(df.where(part % 19 == 0).select(columns))


@query(f"""
with {_LINES_SQL},
totals as (
  select sum(least(n_l, n_r))::bigint as equal_rows, sum(greatest(n_l - n_r, 0))::bigint as more_left,
    sum(greatest(n_r - n_l, 0))::bigint as more_right, (select count(*) from pairs) as paired from counted),
measured as (
  select 'l_partkey' as column_name, 'number' as kind, max(abs(lp - rp))::double as max_abs_diff,
    count(*) filter (lp != rp) as mismatches, count(*) filter ((lp is null) != (rp is null)) as null_mismatches from pairs
  union all
  select 'l_quantity', 'number', max(abs(lq - rq)), count(*) filter (abs(lq - rq) > 1e-6), 0 from pairs
  union all
  select 'l_returnflag', 'text', null, count(*) filter (lf is distinct from rf),
    count(*) filter ((lf is null) != (rf is null)) from pairs)
select column_name, kind, equal_rows, paired, more_left - paired as left_only, more_right - paired as right_only, max_abs_diff,
  mismatches, null_mismatches from measured, totals
""")
def diff_repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return diff_repeated(*_lines(spark, folder), keys=["l_orderkey", "l_linenumber"])


@query(f"""
with {_LINES_SQL}
select l_orderkey, l_linenumber, lp as left_l_partkey, rp as right_l_partkey, lq as left_l_quantity, rq as right_l_quantity,
  lf as left_l_returnflag, rf as right_l_returnflag, count(*) as rows from pairs group by all
""")
def paired_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of one pair of rows that meet at several places count together."""
    pairs = pair_repeated(*_lines(spark, folder), keys=["l_orderkey", "l_linenumber"])
    return pairs.groupBy(*pairs.columns[:-1]).agg(F.sum("rows").alias("rows"))
