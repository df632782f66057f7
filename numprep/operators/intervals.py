"""Values matched with the intervals they lie in, and running totals that no group has to meet for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from numprep.plans.model import quoted

#: An interval of length x is listed under bins of the least power of this number that is no shorter.
BASE = 4.0
#: Shorter intervals count as this long, and so do those that are a trillionth of their place, for which doubles are too coarse.
LEAST, RELATIVE = 1e-9, 2.0**-40
#: Longer intervals are listed under shorter bins, of up to so many levels less, while that at most doubles the list.
DOWN = 5
#: Shorter intervals are listed under longer bins, where these hold at most so many of them, or no more than of others.
CROWD = 1024
#: Level of intervals without an end, or as long as no power: all are in one bin.
ENDLESS = 500


def _level(start: Column, end: Column) -> Column:
    length = F.greatest(end - start, F.greatest(F.abs(start), F.abs(end)) * F.lit(RELATIVE), F.lit(LEAST))
    usual = length < F.lit(BASE ** (ENDLESS - 1))
    return F.when(usual, F.ceil(F.log(length) / F.log(F.lit(BASE))).cast("int")).otherwise(F.lit(ENDLESS))


def _bin(value: Column, level: Column) -> Column:
    """Number of the value's bin. Ascends with the value; beyond the range of bigint it stays at its end."""
    return F.when(level < ENDLESS, F.floor(value / F.pow(F.lit(BASE), level))).otherwise(F.lit(0).cast("bigint"))


def matched_keys(keys: Sequence[str], suffix: str, null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        mine, theirs = quoted(key), quoted(f"{key}{suffix}")
        condition = condition & (mine.eqNullSafe(theirs) if null_safe else mine == theirs)
    return condition


def _level_plan(levelled: DataFrame) -> Column:
    """Which levels points ask for, as one small value: (low, high, levels), from how many intervals each level has.

    At least half of all intervals are of ``low`` or above; those above ``high``, by up to ``DOWN`` levels, have no more bins of
    ``high`` than there are intervals.
    """
    sizes = levelled.groupBy("__level").agg(F.count("*").alias("n"))
    counts = F.col("counts")
    usual = F.filter(counts, lambda c: c["__level"] < ENDLESS)

    def total(which: Column, weight=lambda c: c["n"].cast("double")) -> Column:
        return F.aggregate(which, F.lit(0.0), lambda done, c: done + weight(c))

    def below(c: Column) -> Column:
        return total(F.filter(counts, lambda d: d["__level"] < c["__level"]))

    def bins(c: Column) -> Column:
        longer = F.filter(usual, lambda d: (d["__level"] > c["__level"]) & (d["__level"] <= c["__level"] + DOWN))
        return total(longer, lambda d: d["n"] * F.pow(F.lit(BASE), d["__level"] - c["__level"]))

    low = F.array_max(F.transform(F.filter(usual, lambda c: 2 * below(c) <= total(usual)), lambda c: c["__level"]))
    fits = F.filter(usual, lambda c: (c["__level"] >= F.col("low")) & (bins(c) <= total(usual)))
    high = F.array_min(F.transform(fits, lambda c: c["__level"]))
    plan = sizes.agg(F.collect_list(F.struct("__level", "n")).alias("counts")).withColumn("low", F.coalesce(low, F.lit(ENDLESS)))
    plan = plan.withColumn("high", F.coalesce(high, F.lit(ENDLESS)))
    return plan.select(F.struct("low", "high", F.transform(counts, lambda c: c["__level"]).alias("levels"))).scalar()


def _crowded(alike: DataFrame, keys: Sequence[str], cells: Column, short: Column) -> DataFrame:
    """Keys and bins of the level ``low`` that have many more short intervals than others."""
    listed = alike.select(*[quoted(key) for key in keys], short.alias("__short"), F.explode(cells).alias("__cell"))
    few = F.count_if("__short").alias("short"), F.count_if(~F.col("__short")).alias("others")
    counted = listed.groupBy(*[quoted(key) for key in keys], "__cell").agg(*few)
    crowded = counted.where(F.col("short") > CROWD + F.col("others"))
    return crowded.select(*[quoted(key) for key in keys], "__cell", F.lit(True).alias("__full"))


def _marked(rows: DataFrame, crowded: DataFrame, keys: Sequence[str], suffix: str, cell: Column, name: str) -> DataFrame:
    """Add ``name``: whether the cell of the row's key is crowded. There is a crowded cell for each ``CROWD`` intervals at most."""
    renamed = crowded.withColumnsRenamed({key: f"{key}__in" for key in keys})
    same = cell == F.col("__cell")
    for key in keys:
        same = same & quoted(f"{key}{suffix}").eqNullSafe(quoted(f"{key}__in"))
    joined = rows.join(F.broadcast(renamed), same, "left").withColumn(name, F.col("__full").isNotNull())
    return joined.drop("__cell", "__full", *[f"{key}__in" for key in keys])


def binned(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str
) -> tuple[DataFrame, DataFrame]:
    """A row for each bin that a point asks for (``__asked``, ``__place``), and for each that an interval is listed under."""
    renamed = intervals.withColumnsRenamed({key: f"{key}__of" for key in keys}).where(quoted(start) <= quoted(end))
    levelled = renamed.withColumn("__level", _level(quoted(start), quoted(end)))
    plan = _level_plan(levelled)
    own, low, high = F.col("__level"), F.col("__plan.low"), F.col("__plan.high")

    def bins(level: Column) -> Column:
        return F.sequence(_bin(quoted(start), level), _bin(quoted(end), level))

    planned = levelled.withColumn("__plan", plan)
    of = [f"{key}__of" for key in keys]
    alike = planned.where((own <= low) | ((high == low) & (own < ENDLESS) & (own <= high + DOWN)))
    crowded = _crowded(alike, of, bins(low), own < low).withColumnsRenamed(dict(zip(of, keys, strict=True)))

    # A short interval is in one cell of the level low, or in two. It is listed there, and by itself for crowded cells.
    ends = [F.when(own < low, _bin(quoted(name), low)) for name in (start, end)]
    marked = _marked(planned, crowded, keys, "__of", ends[0], "__full0")
    marked = _marked(marked, crowded, keys, "__of", ends[1], "__full1")

    def listing(level: Column, places: Column) -> Column:
        return F.transform(places, lambda place: F.struct(level.alias("__level"), place.alias("__bin")))

    cells = F.array_compact(F.array(*[F.when(~F.col(f"__full{i}"), cell) for i, cell in enumerate(ends)]))
    apart = F.when(F.col("__full0") | F.col("__full1"), bins(own)).otherwise(F.array().cast("array<bigint>"))
    target = F.when((own > high) & (own <= high + DOWN) & (own < ENDLESS), high).otherwise(own)
    short = F.concat(listing(low, F.array_distinct(cells)), listing(own, apart))
    places = F.when(own < low, short).otherwise(listing(target, bins(target)))
    listed = marked.withColumn("__listed", F.explode(places)).drop("__plan", "__full0", "__full1", "__level")
    listed = listed.select("*", "__listed.*").drop("__listed")

    asking = points.withColumn("__plan", plan)
    asking = _marked(asking, crowded, keys, "", _bin(quoted(at), low), "__crowded")
    wanted = F.filter(
        "__plan.levels",
        lambda level: (F.col("__crowded") | (level >= low)) & ~((level > high) & (level <= high + DOWN) & (level < ENDLESS)),
    )
    asked = asking.withColumn("__asked", F.explode(wanted)).drop("__plan", "__crowded")
    return asked.withColumn("__place", _bin(quoted(at), F.col("__asked"))), listed


def interval_candidates(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, null_safe: bool = False
) -> DataFrame:
    """Points with the intervals of their key that touch the point's bin. See `interval_join`."""
    asked, listed = binned(points, intervals, keys, at, start, end)
    same = (F.col("__asked") == F.col("__level")) & (F.col("__place") == F.col("__bin"))
    joined = asked.join(listed, matched_keys(keys, "__of", null_safe) & same)
    return joined.drop("__asked", "__place", "__level", "__bin", *[f"{key}__of" for key in keys])


def interval_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, null_safe: bool = False
) -> DataFrame:
    """Points with every interval of their key that they lie in, both ends included; ``at``, ``start``, ``end`` are numbers.

    Columns are those of the points, then those of the intervals apart from the keys; their names must differ.

    A binned equi-join: bins are as long as the power of ``BASE`` next to the interval's length, so an interval is in two
    bins or three, however long it is, and a point looks in one bin for each length class. Of intervals of a class only those
    near the point are compared with it, where a join on the key alone would compare all. A key with most points or most
    intervals is dealt out by its bins.

    Each class costs a row for each point, so rare classes are not asked for. Intervals shorter than half of all are listed as
    the class next to these, but not in bins that hold more than ``CROWD`` of them and more than of others; so a point is
    compared with at most ``CROWD`` intervals and as many as its class has besides. Those much longer than most are listed
    under many shorter bins, which at most doubles the list. How many intervals a class has is one small row, read before the
    join; crowded bins are counted on the intervals alone.

    Points without a place and intervals without an end or with their ends reversed match nothing. NULL keys match each other
    if ``null_safe``. Infinite ends are allowed: such intervals are compared with all points of their key.
    """
    candidates = interval_candidates(points, intervals, keys, at, start, end, null_safe)
    return candidates.where(quoted(at).between(quoted(start), quoted(end)))


def total_before(
    df: DataFrame, groups: Sequence[str], cell: str, order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that come before the row, 0 for the first.

    ``cell`` cuts a group into parts, which follow one another as their cells do; ``order`` orders a part. Only a part meets in
    a task, and one row for each part of a group. NULL is a group of its own.
    """
    parts = [*groups, cell]
    before = Window.partitionBy(*[quoted(g) for g in groups]).orderBy(F.col(cell).asc_nulls_first())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(*[quoted(p) for p in parts])
        .agg(F.sum(quoted(value)).alias("__sum"))
        .withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .drop("__sum")
        .withColumnsRenamed({part: f"{part}__of" for part in parts})
    )
    inner = Window.partitionBy(*[quoted(p) for p in parts]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("__within", F.coalesce(F.sum(quoted(value)).over(inner), F.lit(0)))
    joined = within.join(starts, matched_keys(parts, "__of", True), "left")
    return joined.withColumn(name, F.col("__start") + F.col("__within")).drop(
        "__start", "__within", *[f"{part}__of" for part in parts]
    )
