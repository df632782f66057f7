"""Rates, phases and summaries over the events table: a user is a source, an event type a phase."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.catalog.registry import query, table
from numprep.functions import round_places, ticks
from numprep.operators import (
    analyze,
    counter_rate,
    level,
    phase_bounds,
    phase_durations,
    phase_seconds,
    rescale_time,
    share,
    speed_up,
    split_by_phase,
    summarize,
    timing_cells,
    timing_table,
)
from numprep.operators import telemetry as fixed

_RATE_SQL = """
select event_id, (value - lag(value) over w) / nullif((epoch_us(ts) - lag(epoch_us(ts)) over w) / 1e6::double, 0.0)
    / 1048576.0::double
  + (k - lag(k) over w) / nullif((epoch_us(ts) - lag(epoch_us(ts)) over w) / 1e6::double, 0.0) / 1048576.0::double as rate
from (select *, cast(substr(props, 7, length(props) - 7) as double) as k from events)
window w as (partition by user_id order by ts, event_id)
"""


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    number = F.expr("substring(props, 7, length(props) - 7)").cast("double")
    return table(spark, folder, "events").select("event_id", "user_id", "ts", "value", number.alias("k"))


@query(_RATE_SQL)
def counter_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = counter_rate(_samples(spark, folder), "user_id", "ts", "event_id", ["value", "k"])
    return rates.select("event_id", "rate")


# Most users are one source, and the errors of a day are all taken at its start.
_HOT_SQL = """(select event_id, props, value, case when user_id % 10 > 0 then 0 else user_id end as user_id,
    case when event_type = 'error' then date_trunc('day', ts) else ts end as ts from events)"""


@query(_RATE_SQL.replace("from events)", f"from {_HOT_SQL} e)"))
def counter_rates_in_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a source that holds most samples, cut into cells of time, and of crowded instants by id."""
    number = F.expr("substring(props, 7, length(props) - 7)").cast("double")
    events = table(spark, folder, "events")
    instant = F.when(F.col("event_type") == "error", F.date_trunc("day", "ts")).otherwise(F.col("ts"))
    samples = events.select(
        "event_id",
        F.when(F.col("user_id") % 10 > 0, 0).otherwise(F.col("user_id")).alias("user_id"),
        instant.cast(events.schema["ts"].dataType).alias("ts"),
        "value",
        number.alias("k"),
    )
    rates = counter_rate(
        samples, "user_id", "ts", "event_id", ["value", "k"], cell_seconds=7200, rows_per_cell=20, id_block=500
    )
    return rates.select("event_id", "rate")


_DURATIONS_SQL = """select user_id, event_type, min(epoch_us(ts)) / 1e6::double as start,
  max(epoch_us(ts)) / 1e6::double as "end", (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::double as duration
  from events group by user_id, event_type"""


@query(_DURATIONS_SQL)
def phase_spans(spark: SparkSession, folder: str) -> DataFrame:
    return phase_durations(table(spark, folder, "events"), "user_id", "event_type", "ts")


_PHASES = ("signup", "view", "click", "purchase", "error")
_LENGTHS_SQL = ", ".join(f"coalesce(sum(duration) filter (event_type = '{p}'), 0.0) as d{i}" for i, p in enumerate(_PHASES))
_STARTS_SQL = [" + ".join(f"d{j}" for j in range(i)) or "0.0" for i in range(len(_PHASES) + 1)]
_BOUNDS_SQL = f"""select user_id, unnest({list(_PHASES)}) as phase, unnest([{", ".join(_STARTS_SQL[:-1])}]) as start,
  unnest([{", ".join(_STARTS_SQL[1:])}]) as "end"
  from (select user_id, {_LENGTHS_SQL} from ({_DURATIONS_SQL}) group by user_id)"""


def _bounds(spark: SparkSession, folder: str) -> DataFrame:
    durations = phase_durations(table(spark, folder, "events"), "user_id", "event_type", "ts")
    return phase_bounds(durations.withColumnRenamed("event_type", "phase"), "user_id", "phase", "duration", _PHASES)


@query(_BOUNDS_SQL)
def phases_in_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return _bounds(spark, folder)


# Time since the start of the month, times five so that it covers five phases in sequence.
_MONTH_START = 1_704_067_200_000_000  # 2024-01-01
_OFFSET_SQL = f"(epoch_us(ts) - {_MONTH_START}) / 1e6::double * 5"


def _timed(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    events = table(spark, folder, "events")
    micros, per_second = ticks(F.col("ts"), events.schema["ts"].dataType)
    moment = (micros - _MONTH_START) / per_second * 5
    return events.select("event_id", "user_id", "event_type", moment.alias("moment"), "value", *more)


@query(f"""
select e.event_id, e.user_id, e.event_type, e.moment, e.value, b.phase
from (select event_id, user_id, event_type, {_OFFSET_SQL} as moment, value from events) e
join ({_BOUNDS_SQL}) b on e.user_id = b.user_id and e.moment between b.start and b."end"
""")
def samples_by_phase(spark: SparkSession, folder: str) -> DataFrame:
    return split_by_phase(_timed(spark, folder), _bounds(spark, folder), "user_id", "moment")


# Many phases: every day of a user is one, and nothing names them beforehand. A sample is in the day's phase of its user.
_DAYS_SQL = f"""
with timed as (select *, strftime(ts, '%Y-%m-%d') as day from events),
lengths as (
  select user_id, day as phase, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::double as length from timed group by all),
placed as (
  select user_id, phase, length, coalesce(sum(length) over (partition by user_id order by phase
    rows between unbounded preceding and 1 preceding), 0.0) as start from lengths)"""


def _day_bounds(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("phase"))
    durations = phase_durations(events, "user_id", "phase", "ts")
    first = F.to_date(F.lit("2024-01-01"))
    days = durations.select("phase").distinct().withColumn("position", F.date_diff(F.to_date("phase"), first))
    return phase_bounds(durations, "user_id", "phase", "duration", days)


@query(_DAYS_SQL + """
select user_id, phase, round_even(start * 1000.0, 0) / 1000.0 as start,
  round_even((start + length) * 1000.0, 0) / 1000.0 as "end" from placed""")
def phases_of_any_name(spark: SparkSession, folder: str) -> DataFrame:
    bounds = _day_bounds(spark, folder)
    return bounds.withColumns({name: round_places(F.col(name), 3) for name in ("start", "end")})


# A hot source with many phases: all users but some are one, and each of its hours with an error is a phase.
_WINDOWS_SQL = f"""
with samples as (
  select event_id, case when user_id % 10 > 0 then 0 else user_id end as host, (epoch_us(ts) - {_MONTH_START}) / 1e6::double as at
  from events),
windows as (
  select case when user_id % 10 > 0 then 0 else user_id end as host, event_id as phase,
    (epoch_us(ts) - {_MONTH_START}) / 1e6::double as start,
    (epoch_us(ts) - {_MONTH_START}) / 1e6::double + value * (case when event_id % 97 = 0 then 100 else 1 end) as "end"
  from events where event_type = 'error')
select s.event_id, s.host, s.at, w.phase from samples s join windows w on s.host = w.host and s.at between w.start and w."end"
"""


@query(_WINDOWS_SQL)
def samples_in_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The samples that follow each error, within as many seconds as its value says, and a few windows much longer."""
    events = table(spark, folder, "events")
    micros, per_second = ticks(F.col("ts"), events.schema["ts"].dataType)
    at = (micros - _MONTH_START) / per_second
    host = F.when(F.col("user_id") % 10 > 0, F.lit(0)).otherwise(F.col("user_id")).alias("host")
    samples = events.select("event_id", host, at.alias("at"))
    longer = F.when(F.col("event_id") % 97 == 0, F.lit(100)).otherwise(F.lit(1))
    windows = events.where(F.col("event_type") == "error").select(
        host, F.col("event_id").alias("phase"), at.alias("start"), (at + F.col("value") * longer).alias("end")
    )
    return split_by_phase(samples, windows, "host", "at")


@query(f"""
with timed as (select event_id, user_id, event_type, {_OFFSET_SQL} as moment, value from events),
durations as ({_DURATIONS_SQL}),
tops as (select user_id, event_type, max(moment) as top from timed group by user_id, event_type)
select t.event_id, t.user_id, t.event_type, t.moment, t.value,
  case when top > 0 and duration > 0 then moment / top * duration end as rescaled
from timed t left join tops using (user_id, event_type) left join durations using (user_id, event_type)
""")
def rescaled_time(spark: SparkSession, folder: str) -> DataFrame:
    timed = _timed(spark, folder, "ts")
    return rescale_time(timed, phase_seconds(timed, "ts"), "user_id", "event_type", "moment").drop("ts")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums and averages of doubles depend on the order of addition in their last digits."""
    return df.withColumns({name: round_places(F.col(name), 6) for name in names})


@query("""
select event_type, count(*) as samples, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::double as seconds,
  round_even(avg(value) * 1000000.0, 0) / 1000000.0 as value_avg, max(value) as value_max, min(value) as value_min,
  round_even(avg(k) * 1000000.0, 0) / 1000000.0 as k_avg, max(k) as k_max,
  round_even(sum(k) * 0.5 * 1000000.0, 0) / 1000000.0 as k_total
from (select *, cast(substr(props, 7, length(props) - 7) as double) as k from events) group by event_type
""")
def metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    samples = table(spark, folder, "events").withColumn(
        "k", F.expr("substring(props, 7, length(props) - 7)").cast("double")
    )
    summary = summarize(samples, ["event_type"], ["value"], ["k"], sample_interval=0.5, time="ts")
    return _rounded(summary, "value_avg", "k_avg", "k_total")


@query("""
select user_id, case when avg(value) > 80 then 'high' when avg(value) > 50 then 'medium' else 'low' end as use_level
from events group by user_id
""")
def use_levels(spark: SparkSession, folder: str) -> DataFrame:
    averages = table(spark, folder, "events").groupBy("user_id").agg(F.avg("value").alias("a"))
    return averages.select("user_id", level(F.col("a")).alias("use_level"))


@query("""
select user_id, count(*) filter (event_type != 'error')
  / greatest(count(*) filter (event_type != 'error') + count(*) filter (event_type = 'error'), 1)::double as success_rate
from events group by user_id
""")
def success_rates(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.count_if(F.col("event_type") == "error")
    counts = table(spark, folder, "events").groupBy("user_id").agg(failed.alias("bad"), F.count("*").alias("n"))
    good = F.col("n") - F.col("bad")
    return counts.select("user_id", share(good, F.col("bad")).alias("success_rate"))


@query("""
select o_custkey, round_even(coalesce(sum(o_totalprice) filter (o_orderstatus = 'O'), 0)
  / greatest(coalesce(sum(o_totalprice) filter (o_orderstatus = 'F'), 0), 1) * 1000000.0, 0) / 1000000.0 as faster
from orders group by o_custkey
""")
def speed_ups(spark: SparkSession, folder: str) -> DataFrame:
    """A missing time counts as 0."""
    totals = table(spark, folder, "orders").groupBy("o_custkey")
    sums = [F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).otherwise(0.0)).alias(s) for s in ("O", "F")]
    faster = round_places(speed_up(F.col("O"), F.col("F")), 6)
    return totals.agg(*sums).select("o_custkey", faster.alias("faster"))


@query(f"""
with summary as (
  select user_id, avg(value) as cpu, max(value) as cpu_max, min(value) as cpu_min, avg(k) as memory, max(k) as memory_max,
    min(k) as memory_min, count(*) filter (event_type != 'error') as good, count(*) filter (event_type = 'error') as bad,
    count(*) filter (event_type = 'view') as used, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::double as total_time
  from (select *, cast(substr(props, 7, length(props) - 7) as double) as k from events) group by user_id)
select user_id, total_time, bad = 0 as success, round_even(cpu * 1000000.0, 0) / 1000000.0 as cpu_avg_usage,
  round_even(memory * 1000000.0, 0) / 1000000.0 as memory_avg_usage, cpu_max as cpu_max_usage,
  memory_max as memory_max_usage, cpu_min as cpu_min_usage, memory_min as memory_min_usage,
  case when cpu > 80 then 'high' when cpu > 50 then 'medium' else 'low' end as cpu_level,
  case when memory > 80 then 'high' when memory > 50 then 'medium' else 'low' end as memory_level,
  good / greatest(good + bad, 1)::double as stages_success_rate, 0.0::double as jobs_success_rate,
  used / greatest(good + bad, 1)::double as memory_utilization, 0.0::double as cores_utilization,
  concat_ws('; ', case when not cpu > 50 then '{fixed.ADVICE_CPU}' end,
    case when memory > 80 then '{fixed.ADVICE_MEMORY}' end,
    case when bad > 0 then '{fixed.ADVICE_STAGES}' end) as recommendations
from summary
""")
def metric_analysis(spark: SparkSession, folder: str) -> DataFrame:
    samples = table(spark, folder, "events").withColumn(
        "k", F.expr("substring(props, 7, length(props) - 7)").cast("double")
    )
    counts = {
        "stages_completed": F.count_if(F.col("event_type") != "error"),
        "stages_failed": F.count_if(F.col("event_type") == "error"),
        "memory_used": F.count_if(F.col("event_type") == "view"),
        "memory_max": F.count("*"),
    }
    finished = F.bool_and(F.col("event_type") != "error")
    table_ = analyze(samples, ["user_id"], "value", "k", counts, phase_seconds(samples, "ts"), finished)
    table_ = _rounded(table_, "cpu_avg_usage", "memory_avg_usage")
    return table_.withColumn("recommendations", F.concat_ws("; ", "recommendations"))


_STATUSES = ("O", "F", "P")


@query(f"""
with sums as (
  select o_orderpriority as operation, {", ".join(f"sum(o_totalprice) filter (o_orderstatus = '{s}') as {s}" for s in _STATUSES)}
  from orders group by o_orderpriority)
select operation, {", ".join(f'round_even(coalesce({s}, 0.0) * 100.0, 0) / 100.0 as "{s}_time"' for s in _STATUSES)} from sums
union all
select 'total', {", ".join(f"round_even(sum({s}) * 100.0, 0) / 100.0" for s in _STATUSES)} from sums
""")
def timings(spark: SparkSession, folder: str) -> DataFrame:
    """Every status is an engine; none is left out of the total."""
    orders = table(spark, folder, "orders")
    sums = timing_table(orders, "o_orderpriority", "o_orderstatus", "o_totalprice", _STATUSES)
    return sums.select("operation", *[round_places(F.col(f"{s}_time"), 2).alias(f"{s}_time") for s in _STATUSES])


_ENGINES = ("O", "F")


@query(f"""
with sums as (
  select o_orderpriority as operation, {", ".join(f"sum(o_totalprice) filter (o_orderstatus = '{s}') as {s}" for s in _ENGINES)},
    sum(o_totalprice) filter (o_orderstatus not in {_ENGINES}) as other, sum(o_totalprice) as everything
  from orders group by o_orderpriority)
select operation, {", ".join(f'round_even(coalesce({s}, 0.0) * 100.0, 0) / 100.0 as "{s}_time"' for s in _ENGINES)},
  round_even(coalesce(other, 0.0) * 100.0, 0) / 100.0 as other_time, round_even(everything * 100.0, 0) / 100.0 as all_time from sums
union all
select 'total', {", ".join(f"round_even(sum({s}) * 100.0, 0) / 100.0" for s in _ENGINES)},
  round_even(sum(other) * 100.0, 0) / 100.0, round_even(sum(everything) * 100.0, 0) / 100.0 from sums
""")
def timings_with_others(spark: SparkSession, folder: str) -> DataFrame:
    """A status that is not named has its time in a column of its own."""
    sums = timing_table(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice", _ENGINES)
    return sums.withColumns({c: round_places(F.col(c), 2) for c in sums.columns if c != "operation"})


@query("""
select o_orderpriority as operation, o_orderstatus as engine, grouping(o_orderpriority) = 1 as all_operations,
  grouping(o_orderstatus) = 1 as all_engines, round_even(sum(o_totalprice) * 100.0, 0) / 100.0 as seconds
from orders group by cube (o_orderpriority, o_orderstatus)
""")
def timings_of_all_engines(spark: SparkSession, folder: str) -> DataFrame:
    cells = timing_cells(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice")
    return cells.withColumn("seconds", round_places(F.col("seconds"), 2))
