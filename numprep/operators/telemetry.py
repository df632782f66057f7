"""Resource-metric time series: rates, phases, summaries and advice.

Samples are rows of (source, time, metrics...), where a source is one monitored run or host. A source may hold
a large part of all samples, so no operator puts one source's samples into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from numprep.functions import seconds, ticks
from numprep.operators.intervals import interval_join, total_before
from numprep.plans.model import quoted

MIB = 2**20

# The limits, words and texts users of the report already match on.
HIGH_ABOVE, MEDIUM_ABOVE = 80.0, 50.0
HIGH, MEDIUM, LOW = "high", "medium", "low"
ADVICE_CPU = "Consider increasing Spark parallelism to better utilize CPU"
ADVICE_MEMORY = "Consider increasing driver/executor memory or optimizing memory usage"
ADVICE_STAGES = "Some Spark stages failed - check logs for errors"

# A source's samples are ordered cell by cell: cells of time, and of crowded cells single instants and blocks of ids.
CELL_SECONDS = 3600.0
ROWS_PER_CELL = 1_000_000
ID_BLOCK = 1_000_000


def _ticks(df: DataFrame, time: str) -> tuple[Column, float]:
    return ticks(quoted(time), df.schema[time].dataType)


def counter_rate(
    samples: DataFrame,
    source: str,
    time: str,
    sample_id: str,
    counters: Sequence[str],
    name: str = "rate",
    unit: float = MIB,
    cell_seconds: float = CELL_SECONDS,
    rows_per_cell: int = ROWS_PER_CELL,
    id_block: int = ID_BLOCK,
) -> DataFrame:
    """Add the change of the counters per second since the source's previous sample, summed, in ``unit``.

    ``sample_id`` is a number that orders samples taken at the same time; it is unique within a source. The
    first sample of a source has no rate, nor has one taken at the time of its predecessor.

    A source is one window group per ``cell_seconds`` of its time: all samples are shuffled once, by cell, and take the
    sample before them in the cell. The first and last sample of each cell, two rows, are then ordered by source, and the
    first one takes the last one of the cell before, so the cuts do not show in the result. A cell of more than
    ``rows_per_cell`` samples is cut further, by instant and by ``id_block`` numbers of the id; the list of such cells is
    broadcast, and has at most a row for each ``rows_per_cell`` samples. Nothing runs before an action does, and no number of
    samples changes the plan.
    """
    tick, per_second = _ticks(samples, time)
    sample = {"__tick": tick}
    sample |= {f"__c{i}": quoted(counter).cast("double") for i, counter in enumerate(counters)}
    cell = F.floor(tick / F.lit(per_second * cell_seconds))
    df = samples.withColumns({"__source": quoted(source), "__cell": cell, **sample, "__id": quoted(sample_id)})
    counted = df.groupBy("__source", "__cell").agg(F.count("*").alias("__rows"))
    crowded = counted.where(F.col("__rows") > rows_per_cell).select("__source", "__cell", F.lit(True).alias("__crowded"))
    df = _join_same(df, F.broadcast(crowded), ["__source", "__cell"])
    df = df.withColumns(
        {
            "__instant": F.when(F.col("__crowded"), F.col("__tick")),
            "__block": F.when(F.col("__crowded"), F.floor(F.col("__id") / F.lit(id_block))),
        }
    )
    # Cells follow one another as their samples do, missing ones first.
    parts = ["__cell", "__instant", "__block"]
    order = [F.col("__tick").asc_nulls_first(), F.col("__id")]
    ordered = Window.partitionBy("__source", *parts).orderBy(*order)
    across = Window.partitionBy("__source").orderBy(*[F.col(part).asc_nulls_first() for part in parts], *order)

    def with_earlier(rows: DataFrame, window: Window) -> DataFrame:
        return rows.withColumns({f"{c}_before": F.lag(c).over(window) for c in sample})

    alone = {"__first": F.lag(F.lit(False), 1, True).over(ordered), "__last": F.lead(F.lit(False), 1, True).over(ordered)}
    df = df.withColumns(alone)
    inner = with_earlier(df, ordered).where(~F.col("__first"))
    edges = with_earlier(df.where(F.col("__first") | F.col("__last")), across).where("__first")
    df = inner.unionByName(edges)
    elapsed = F.nullif(seconds(F.col("__tick") - F.col("__tick_before"), per_second), F.lit(0.0))
    rates = [(F.col(c) - F.col(f"{c}_before")) / elapsed / F.lit(float(unit)) for c in sample if c != "__tick"]
    total = rates[0]
    for rate in rates[1:]:
        total = total + rate
    return df.select(*[quoted(column) for column in samples.columns], total.alias(name))


def _join_same(many: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a missing key matches itself."""
    renamed = few.withColumnsRenamed({key: f"{key}_of" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key}_of"))
    return many.join(renamed, same, "left").drop(*[f"{key}_of" for key in keys])


def phase_durations(samples: DataFrame, source: str, phase: str, time: str) -> DataFrame:
    """Start, end and length in seconds of each phase of a source: its first and last mark."""
    tick, per_second = _ticks(samples, time)
    return (
        samples.select(quoted(source).alias(source), quoted(phase).alias(phase), tick.alias("tick"))
        .groupBy(quoted(source), quoted(phase))
        .agg(
            seconds(F.min("tick"), per_second).alias("start"),
            seconds(F.max("tick"), per_second).alias("end"),
            seconds(F.max("tick") - F.min("tick"), per_second).alias("duration"),
        )
    )


def phase_bounds(
    durations: DataFrame, source: str, phase: str, duration: str, phases: Sequence[str] | DataFrame
) -> DataFrame:
    """Where each phase starts and ends if phases follow one another from 0, per source.

    ``phases`` names them in order, and every source has all of them, those without a duration with length 0: the durations
    of a source become one row, and the running sum is plain arithmetic on it. Or it is a table of (``phase``, ``position``)
    of any names and any number: then a source has the phases it has durations of, in order of position, and the running sum
    is taken by blocks of ``PHASE_BLOCK`` positions, so no source meets in one task. Phases that it lacks are left out.
    """
    if isinstance(phases, DataFrame):
        return _bounds_by_position(durations, source, phase, duration, phases)
    lengths = [
        F.coalesce(F.sum(F.when(quoted(phase) == name, quoted(duration))), F.lit(0.0)).alias(f"length{i}")
        for i, name in enumerate(phases)
    ]
    bounds, start = [], F.lit(0.0)
    for i, name in enumerate(phases):
        end = start + F.col(f"length{i}") if i else F.col("length0")
        bounds.append(F.struct(F.lit(name).alias(phase), start.alias("start"), end.alias("end")))
        start = end
    by_source = durations.groupBy(quoted(source)).agg(*lengths)
    return by_source.select(quoted(source), F.inline(F.array(*bounds)))


PHASE_BLOCK = 10_000


def _bounds_by_position(
    durations: DataFrame, source: str, phase: str, duration: str, phases: DataFrame
) -> DataFrame:
    known = phases.select(quoted(phase).alias("__phase"), F.col("position").alias("__position"))
    lengths = (
        durations.groupBy(quoted(source).alias("__source"), quoted(phase).alias("__phase"))
        .agg(F.coalesce(F.sum(quoted(duration)), F.lit(0.0)).alias("__length"))
        .join(known, "__phase")
        .withColumn("__block", F.floor(F.col("__position") / F.lit(PHASE_BLOCK)))
    )
    order = [F.col("__position"), F.col("__phase")]
    placed = total_before(lengths, ["__source"], "__block", order, "__length", "start")
    return placed.select(
        F.col("__source").alias(source),
        F.col("__phase").alias(phase),
        "start",
        (F.col("start") + F.col("__length")).alias("end"),
    )


def split_by_phase(samples: DataFrame, bounds: DataFrame, source: str, time: str, phase: str = "phase") -> DataFrame:
    """Samples with the phase they fall in. Both ends belong to a phase: a sample on a border is in two.

    ``bounds`` has ``start`` and ``end`` for each source and phase, in the unit of ``time`` (seconds for
    timestamps). Samples outside all phases are left out. A sample is compared with the phases near it (`interval_join`), not
    with all of its source.
    """
    tick, per_second = _ticks(samples, time)
    plain = isinstance(samples.schema[time].dataType, T.DoubleType)
    timed = samples if plain else samples.withColumn("__at", seconds(tick, per_second).cast("double"))
    wanted = bounds.select(
        quoted(source),
        quoted(phase).alias(phase),
        F.col("start").cast("double").alias("__start"),
        F.col("end").cast("double").alias("__end"),
    )
    inside = interval_join(timed, wanted, [source], time if plain else "__at", "__start", "__end")
    return inside.select(*[quoted(name) for name in samples.columns], quoted(phase))


def rescale_time(
    samples: DataFrame, durations: DataFrame | Column, source: str, phase: str, time: str, duration: str = "duration"
) -> DataFrame:
    """Add ``rescaled``: time stretched so that a phase's last sample is at the phase's duration.

    NULL for phases without a positive duration and phases whose last sample is not after 0. ``durations`` is a table of
    them, or an aggregate over the samples, which is then computed together with the last sample. Both are a row per
    source and phase; Spark chooses by their size, when it is known, how they are joined.
    """
    keys = [source, phase]
    last = F.max(quoted(time)).alias("__last")
    groups = samples.groupBy(*[quoted(key) for key in keys])
    if isinstance(durations, Column):
        factors = groups.agg(last, durations.alias("__seconds"))
    else:
        known = durations.select(*[quoted(key) for key in keys], quoted(duration).alias("__seconds"))
        factors = groups.agg(last).join(known, keys)
    joined = samples.join(factors, keys, "left")
    usable = (F.col("__last") > 0) & (F.col("__seconds") > 0)
    rescaled = F.when(usable, quoted(time) / F.col("__last") * F.col("__seconds"))
    return joined.select(*[quoted(name) for name in samples.columns], rescaled.alias("rescaled"))


def phase_seconds(samples: DataFrame, time: str) -> Column:
    """Aggregate: seconds from the first to the last sample."""
    tick, per_second = _ticks(samples, time)
    return seconds(F.max(tick) - F.min(tick), per_second)


def summarize(
    samples: DataFrame,
    by: Sequence[str],
    levels: Sequence[str] = (),
    rates: Sequence[str] = (),
    sample_interval: float = 1.0,
    time: str | None = None,
) -> DataFrame:
    """Per group: average, maximum and minimum of ``levels``, and average, maximum and total of ``rates``.

    A total is the sum over samples times the sampling interval. With ``time``, the span is added in seconds.
    """
    measures = [F.count("*").alias("samples")]
    if time is not None:
        tick, per_second = _ticks(samples, time)
        measures.append(seconds(F.max(tick) - F.min(tick), per_second).alias("seconds"))
    for name in (*levels, *rates):
        measures += [F.avg(quoted(name)).alias(f"{name}_avg"), F.max(quoted(name)).alias(f"{name}_max")]
        if name in levels:
            measures.append(F.min(quoted(name)).alias(f"{name}_min"))
        else:
            measures.append((F.sum(quoted(name)) * F.lit(float(sample_interval))).alias(f"{name}_total"))
    return samples.groupBy(*[quoted(key) for key in by]).agg(*measures)


def level(average: Column) -> Column:
    """``high``, ``medium`` or ``low`` use; NULL without an average."""
    return (
        F.when(average > HIGH_ABOVE, F.lit(HIGH))
        .when(average > MEDIUM_ABOVE, F.lit(MEDIUM))
        .when(average.isNotNull(), F.lit(LOW))
    )


def share(part: Column, rest: Column) -> Column:
    """Part of the whole, 0 where there is nothing: the whole counts as at least 1."""
    return part / F.greatest(part + rest, F.lit(1))


def speed_up(slow: Column, fast: Column) -> Column:
    """How many times faster, with the faster time taken as at least 1."""
    return slow / F.greatest(fast, F.lit(1))


def advise(cpu_level: Column, memory_level: Column, failed_stages: Column) -> Column:
    """Texts of the rules that apply."""
    return F.array_compact(
        F.array(
            F.when(cpu_level == LOW, F.lit(ADVICE_CPU)),
            F.when(memory_level == HIGH, F.lit(ADVICE_MEMORY)),
            F.when(failed_stages > 0, F.lit(ADVICE_STAGES)),
        )
    )


def analyze(
    samples: DataFrame,
    by: Sequence[str],
    cpu: str,
    memory: str,
    counts: Mapping[str, Column],
    total_time: Column | None = None,
    success: Column | None = None,
) -> DataFrame:
    """Summary, use levels, success rates, utilizations and advice per group, in one aggregate.

    ``total_time`` and ``success`` are aggregates that sum up the run; without them they are 0 and false.

    ``counts`` gives aggregate columns for any of ``stages_completed``, ``stages_failed``, ``jobs_completed``,
    ``jobs_failed``, ``memory_used``, ``memory_max``, ``cores_used`` and ``cores_max``. Missing ones are 0.
    """
    names = [f"{kind}_{state}" for kind in ("stages", "jobs") for state in ("completed", "failed")]
    names += [f"{kind}_{state}" for kind in ("memory", "cores") for state in ("used", "max")]
    unknown = [name for name in counts if name not in names]
    if unknown:
        raise ValueError(f"unknown counts: {', '.join(unknown)}")
    usage = [
        measure(quoted(metric)).alias(f"{kind}_{suffix}")
        for kind, metric in (("cpu", cpu), ("memory", memory))
        for suffix, measure in (("avg", F.avg), ("top", F.max), ("low", F.min))
    ]
    run = [
        F.coalesce(F.lit(0.0) if total_time is None else total_time, F.lit(0.0)).alias("total_time"),
        F.coalesce(F.lit(False) if success is None else success, F.lit(False)).alias("success"),
    ]
    totals = [F.coalesce(counts.get(name, F.lit(0)), F.lit(0)).alias(f"n_{name}") for name in names]
    table = samples.groupBy(*[quoted(key) for key in by]).agg(*usage, *totals, *run)
    cpu_level, memory_level = level(F.col("cpu_avg")), level(F.col("memory_avg"))
    return table.select(
        *[quoted(key) for key in by],
        "total_time",
        "success",
        *[F.col(f"{kind}_avg").alias(f"{kind}_avg_usage") for kind in ("cpu", "memory")],
        *[F.col(f"{kind}_top").alias(f"{kind}_max_usage") for kind in ("cpu", "memory")],
        *[F.col(f"{kind}_low").alias(f"{kind}_min_usage") for kind in ("cpu", "memory")],
        cpu_level.alias("cpu_level"),
        memory_level.alias("memory_level"),
        *[
            share(F.col(f"n_{kind}_completed"), F.col(f"n_{kind}_failed")).alias(f"{kind}_success_rate")
            for kind in ("stages", "jobs")
        ],
        *[
            (F.col(f"n_{kind}_used") / F.greatest(F.col(f"n_{kind}_max"), F.lit(1))).alias(f"{kind}_utilization")
            for kind in ("memory", "cores")
        ],
        advise(cpu_level, memory_level, F.col("n_stages_failed")).alias("recommendations"),
    )


def timing_cells(timings: DataFrame, operation: str, engine: str, duration: str) -> DataFrame:
    """Seconds of each operation and engine, of each operation, of each engine, and of all, in long form.

    ``all_operations`` and ``all_engines`` tell a total from a missing name. Totals are made from the sums of the cells.
    """
    cells = timings.groupBy(quoted(operation).alias("operation"), quoted(engine).alias("engine")).agg(
        F.sum(quoted(duration)).alias("seconds")
    )
    return cells.cube("operation", "engine").agg(
        (F.grouping("operation") == 1).alias("all_operations"),
        (F.grouping("engine") == 1).alias("all_engines"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"),
    )


def timing_table(
    timings: DataFrame, operation: str, engine: str, duration: str, engines: Sequence[str]
) -> DataFrame:
    """`timing_cells` as one row for each operation and one for the ``total``: a column for each of ``engines``,
    ``other_time`` for engines that are not named or missing, and ``all_time``, which is the sum of the others."""
    cells = timing_cells(timings, operation, engine, duration)
    named = F.coalesce(F.col("engine").isin(*engines), F.lit(False)) if engines else F.lit(False)
    picked = [F.sum(F.when(~F.col("all_engines") & (F.col("engine") == name), F.col("seconds"))) for name in engines]
    times = [F.coalesce(column, F.lit(0.0)).alias(f"{name}_time") for name, column in zip(engines, picked, strict=True)]
    return (
        cells.groupBy("all_operations", "operation")
        .agg(
            *times,
            F.coalesce(F.sum(F.when(~F.col("all_engines") & ~named, F.col("seconds"))), F.lit(0.0)).alias("other_time"),
            F.sum(F.when(F.col("all_engines"), F.col("seconds"))).alias("all_time"),
        )
        .withColumn("operation", F.when(F.col("all_operations"), F.lit("total")).otherwise(F.col("operation")))
        .drop("all_operations")
    )
