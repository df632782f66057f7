import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from numprep.operators import interval_join, total_before
from numprep.operators import intervals as module
from numprep.operators.intervals import binned, interval_candidates

POINTS, INTERVALS = "k string, id int, x double", "k string, name int, lo double, hi double"


def _pairs(df):
    return sorted((r.id, r.name) for r in df.collect())


def _by_hand(points, intervals, null_safe):
    return sorted(
        (i, n)
        for k, i, x in points
        for q, n, lo, hi in intervals
        if (k == q and (null_safe or k is not None)) and None not in (x, lo, hi) and lo <= x <= hi
    )


def _random(seed):
    rng = random.Random(seed)
    scale = [1e-12, 1.0, 1e9][seed % 3]
    points = [(rng.choice("abc"), i, rng.uniform(-100, 100) * scale) for i in range(300)]
    intervals = []
    for n in range(120):
        lo = rng.uniform(-110, 100) * scale
        hi = lo + rng.choice([0.0, 0.01, 1.0, 30.0, 400.0, -1.0]) * scale * rng.random()
        intervals.append((rng.choice("abcd"), n, lo, hi))
    # Points on borders, powers of the base, missing and infinite ones.
    points += [(k, 1000 + 2 * n + e, x) for n, (k, _, *ends) in enumerate(intervals[:40]) for e, x in enumerate(ends)]
    odd = [0.0, -0.0, 1.0, 4.0, -4.0, 1024.0, None, math.inf, -math.inf, 1e300, 5e-324]
    points += [("a", 2000 + i, x) for i, x in enumerate(odd)] + [(None, 3000, 1.0)]
    ends = [(0.0, 0.0), (4.0, 16.0), (-4.0, 4.0), (None, 1.0), (1.0, None), (-math.inf, 3.0), (2.0, math.inf), (-math.inf, math.inf),
        (1e300, 1.1e300), (-1e308, 1e308), (0.0, 5e-324), (1024.0, 1024.0)]
    intervals += [("a", 500 + n, lo, hi) for n, (lo, hi) in enumerate(ends)] + [(None, 600, 0.0, 2.0)]
    return points, intervals


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("null_safe", [False, True])
def test_against_all_pairs(spark, seed, null_safe):
    points, intervals = _random(seed)
    found = interval_join(
        spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS), ["k"], "x", "lo", "hi", null_safe
    )
    assert found.columns == ["k", "id", "x", "name", "lo", "hi"]
    assert _pairs(found) == _by_hand(points, intervals, null_safe)


def test_hot_key_with_many_intervals_costs_those_near(spark):
    """A thousand phases of one source, one of them as long as all others together."""
    phases = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("name"), F.expr("id * 10.0D").alias("lo"))
    phases = phases.withColumn("hi", F.col("lo") + 10.0)
    longest = spark.createDataFrame([("a", 5000, 0.0, 10_000.0)], "k string, name long, lo double, hi double")
    points = spark.range(20_000).select(F.lit("a").alias("k"), "id", (F.col("id") / 2.0).alias("x"))
    both = phases.unionByName(longest)
    args = (points, both, ["k"], "x", "lo", "hi")
    found = interval_join(*args).count()
    assert found == 20_000 + 20_000 + 999  # its phase, the longest, and the phase before of points on a border
    assert interval_candidates(*args).count() < 2 * found
    listed = interval_candidates(points.limit(0), both, ["k"], "x", "lo", "hi")
    assert listed.count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_crowded_bins_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(module, "CROWD", 1)
    points, intervals = _random(seed)
    intervals += [("b", 900 + n, n / 7, n / 7 + 0.001 * n) for n in range(40)] + [("a", 990, -50.0, 50_000.0)]
    tables = spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS)
    found = interval_join(*tables, ["k"], "x", "lo", "hi", True)
    assert _pairs(found) == _by_hand(points, intervals, True)


def test_rare_lengths_cost_no_rows(spark):
    """Of ten length classes two are common; a point asked for a bin of every class before."""
    lengths = "pow(4.0D, case when id % 50 < 10 then 2 - id % 10 when id % 50 > 48 then 5 else 3 + id % 2 end)"
    windows = spark.range(2000).selectExpr("'a' k", "id name", "id * 40.0D lo", f"id * 40.0D + {lengths} hi")
    points = spark.range(5000).selectExpr("'a' k", "id", "id * 16.0D x")
    asked, listed = binned(points, windows, ["k"], "x", "lo", "hi")
    assert asked.count() <= 2 * 5000 and listed.count() < 4 * 2000
    assert interval_candidates(points, windows, ["k"], "x", "lo", "hi").count() < 4 * interval_join(
        points, windows, ["k"], "x", "lo", "hi").count()


def test_crowded_bins_bound_what_a_point_meets(spark):
    """A burst of short windows in one key, while those of the other keys are long."""
    burst = spark.range(3000).selectExpr("'a' k", "id name", "id / 100.0D lo", "id / 100.0D + 0.01D hi")
    slow = spark.range(4000).selectExpr("'b' k", "id + 5000 name", "id * 50.0D lo", "id * 50.0D + 50.0D hi")
    points = spark.range(3000).selectExpr("'a' k", "id", "id / 100.0D x")
    args = (points, burst.unionByName(slow), ["k"], "x", "lo", "hi")
    assert interval_candidates(*args).count() < 4 * interval_join(*args).count()


def test_plan_is_an_equi_join(spark):
    points, intervals = _random(0)
    df = interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS), ["k"], "x", "lo", "hi")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_empty_sides(spark):
    points, intervals = (spark.createDataFrame(r, s) for r, s in zip(_random(0), (POINTS, INTERVALS)))
    assert interval_join(points, intervals.limit(0), ["k"], "x", "lo", "hi").collect() == []
    assert interval_join(points.limit(0), intervals, ["k"], "x", "lo", "hi").collect() == []


def test_totals_before(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i // 10 if i % 9 else None, i, rng.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, cell int, place int, n int").repartition(5)
    found = {r.place: r.total for r in total_before(df, ["g"], "cell", [F.col("place")], "n", "total").collect()}
    done, expected = Counter(), {}
    for g, _, place, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        expected[place] = done[g]
        done[g] += n
    assert found == expected
