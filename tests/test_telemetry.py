import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from numprep.operators import (
    advise,
    analyze,
    counter_rate,
    level,
    phase_bounds,
    phase_durations,
    rescale_time,
    share,
    speed_up,
    split_by_phase,
    summarize,
    telemetry,
    timing_cells,
    timing_table,
)


def _rates_by_hand(rows, unit=1.0):
    """rows: (id, source, ts, a, b)"""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(row)
    expected = {}
    for group in by_source.values():
        group.sort(key=lambda r: ((r[2] is not None, r[2] or 0.0), r[0]))
        for i, row in enumerate(group):
            before = group[i - 1] if i else None
            if before is None or row[2] is None or before[2] is None or row[2] == before[2]:
                expected[row[0]] = None
            else:
                dt = row[2] - before[2]
                expected[row[0]] = (row[3] - before[3]) / dt / unit + (row[4] - before[4]) / dt / unit
    return expected


def _samples(kind):
    rng = random.Random(kind)
    rows = []
    for k in range(900):
        source = rng.choice(["a", "b", None, "c"])
        ts = rng.uniform(0, 1000)
        if kind == "hot source" and k % 3:
            source = "a"
        if kind == "hot time" and k % 3:
            source, ts = "a", rng.choice([50.0, 500.0])
        if kind == "many sources" and k % 3:
            source = f"s{rng.randint(0, 99)}"
        if kind == "few times":
            ts = float(rng.randint(0, 3))
        if kind == "no time" and k % 4 == 0:
            ts = None
        rows.append((k, source, ts, rng.uniform(0, 10), rng.uniform(0, 10)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["even", "hot source", "hot time", "few times", "no time", "many sources"])
@pytest.mark.parametrize(("cell", "rows_per_cell", "block"), [(1e6, 10_000, 1), (100.0, 40, 7), (1.0, 2, 1), (300.0, 1, 1000)])
def test_counter_rate(spark, kind, cell, rows_per_cell, block):
    rows = _samples(kind)
    df = spark.createDataFrame(rows, "id bigint, source string, ts double, a double, b double")
    rates = counter_rate(
        df, "source", "ts", "id", ["a", "b"], unit=1.0, cell_seconds=cell, rows_per_cell=rows_per_cell, id_block=block
    )
    assert rates.columns == [*df.columns, "rate"]
    got = {row["id"]: row["rate"] for row in rates.collect()}
    expected = _rates_by_hand(rows)
    assert got.keys() == expected.keys() and len(got) == len(rows)
    assert got == expected


def test_first_sample_has_no_rate(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 5.0), (2, "a", 2.0, 9.0)], "id int, s string, t double, c double")
    rates = counter_rate(df, "s", "t", "id", ["c"], unit=1.0).orderBy("id").collect()
    assert [r.rate for r in rates] == [None, 2.0]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rate_over_timestamps(spark, kind):
    df = spark.sql(
        f"select * from values (1, 's', {kind}'2024-01-01 00:00:00', 0.0), (2, 's', {kind}'2024-01-01 00:00:00.5', 1048576.0)"
        " as t(id, s, ts, c)"
    )
    rates = counter_rate(df, "s", "ts", "id", ["c"]).orderBy("id").collect()
    assert [r.rate for r in rates] == [None, 2.0]


def test_rate_without_zone_ignores_the_clock_change(spark):
    df = spark.sql(
        "select * from values (1, 's', timestamp_ntz'2024-03-10 01:59:59', 0.0), (2, 's', timestamp_ntz'2024-03-10 02:00:01', 4.0),"
        " (3, 's', timestamp_ntz'2024-03-10 03:00:01', 3604.0) as t(id, s, ts, c)"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rates = counter_rate(df, "s", "ts", "id", ["c"], unit=1.0).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.rate for r in rates] == [None, 2.0, 1.0]


def _bounds(spark):
    durations = spark.createDataFrame(
        [("r1", "inverse", 3.0), ("r1", "fit", 10.0), ("r1", "transform", 2.0), ("r2", "fit", 1.0)],
        "run string, phase string, seconds double",
    )
    return phase_bounds(durations, "run", "phase", "seconds", ["fit", "transform", "inverse"])


def test_phases_follow_one_another(spark):
    got = sorted(map(tuple, _bounds(spark).collect()))
    assert got == [
        ("r1", "fit", 0.0, 10.0),
        ("r1", "inverse", 12.0, 15.0),
        ("r1", "transform", 10.0, 12.0),
        ("r2", "fit", 0.0, 1.0),
        ("r2", "inverse", 1.0, 1.0),
        ("r2", "transform", 1.0, 1.0),
    ]


def test_border_samples_are_in_both_phases(spark):
    samples = spark.createDataFrame(
        [("r1", 0.0), ("r1", 10.0), ("r1", 11.0), ("r1", 15.5), ("r2", 0.5), ("r3", 0.5)], "run string, ts double"
    )
    split = split_by_phase(samples, _bounds(spark), "run", "ts")
    assert split.columns == ["run", "ts", "phase"]
    assert sorted(map(tuple, split.collect())) == [
        ("r1", 0.0, "fit"),
        ("r1", 10.0, "fit"),
        ("r1", 10.0, "transform"),
        ("r1", 11.0, "transform"),
        ("r2", 0.5, "fit"),
    ]


def test_rescaled_time(spark):
    samples = spark.createDataFrame(
        [("r", "fit", 1.0), ("r", "fit", 4.0), ("r", "other", 2.0), ("r", "early", -1.0), ("r", "zero", 3.0), (None, None, 9.0)],
        "run string, phase string, ts double",
    )
    durations = spark.createDataFrame(
        [("r", "fit", 8.0), ("r", "early", 5.0), ("r", "zero", 0.0)], "run string, phase string, duration double"
    )
    got = {(r.phase, r.ts): r.rescaled for r in rescale_time(samples, durations, "run", "phase", "ts").collect()}
    assert got == {
        ("fit", 1.0): 2.0,
        ("fit", 4.0): 8.0,
        ("other", 2.0): None,
        ("early", -1.0): None,
        ("zero", 3.0): None,
        (None, 9.0): None,
    }


def test_phase_durations(spark):
    marks = spark.createDataFrame([("r", "fit", 1.5), ("r", "fit", 4.0), ("r", "t", 4.0)], "run string, p string, ts double")
    got = sorted(map(tuple, phase_durations(marks, "run", "p", "ts").collect()))
    assert got == [("r", "fit", 1.5, 4.0, 2.5), ("r", "t", 4.0, 4.0, 0.0)]


def test_summary(spark):
    df = spark.createDataFrame([("s", 0.0, 10.0, 1.0), ("s", 1.0, 30.0, 3.0)], "src string, ts double, cpu double, io double")
    row = summarize(df, ["src"], ["cpu"], ["io"], sample_interval=0.5, time="ts").first()
    assert row.asDict() == {
        "src": "s",
        "samples": 2,
        "seconds": 1.0,
        "cpu_avg": 20.0,
        "cpu_max": 30.0,
        "cpu_min": 10.0,
        "io_avg": 2.0,
        "io_max": 3.0,
        "io_total": 2.0,
    }
    assert summarize(df.where("ts > 5"), ["src"], ["cpu"]).collect() == []


def test_levels_and_ratios(spark):
    df = spark.createDataFrame([(80.1,), (80.0,), (50.1,), (50.0,), (None,)], "a double").coalesce(1)
    assert [r[0] for r in df.select(level(F.col("a"))).collect()] == ["high", "medium", "medium", "low", None]
    row = spark.range(1).select(
        share(F.lit(3), F.lit(1)), share(F.lit(0), F.lit(0)), speed_up(F.lit(9.0), F.lit(0.5)), speed_up(F.lit(9.0), F.lit(3.0))
    )
    assert tuple(row.first()) == (0.75, 0.0, 9.0, 3.0)


def test_advice(spark):
    row = spark.range(1).select(
        advise(F.lit("low"), F.lit("high"), F.lit(1)), advise(F.lit("high"), F.lit("low"), F.lit(0))
    ).first()
    assert row[0] == [telemetry.ADVICE_CPU, telemetry.ADVICE_MEMORY, telemetry.ADVICE_STAGES]
    assert row[1] == []


def test_analysis(spark):
    df = spark.createDataFrame([("s", 10.0, 90.0, 1), ("s", 30.0, 95.0, 0)], "src string, cpu double, mem double, bad int")
    counts = {"stages_completed": F.count("*"), "stages_failed": F.sum("bad"), "cores_used": F.lit(4), "cores_max": F.lit(8)}
    row = analyze(df, ["src"], "cpu", "mem", counts).first()
    assert (row.cpu_level, row.memory_level, row.cpu_avg_usage, row.memory_max_usage) == ("low", "high", 20.0, 95.0)
    assert row.stages_success_rate == pytest.approx(2 / 3) and row.jobs_success_rate == 0.0
    assert (row.cores_utilization, row.memory_utilization) == (0.5, 0.0)
    assert len(row.recommendations) == 3
    with pytest.raises(ValueError, match="unknown counts"):
        analyze(df, ["src"], "cpu", "mem", {"tasks": F.lit(1)})


def test_timing_table(spark):
    df = spark.createDataFrame(
        [("fit", "a", 2.0), ("fit", "b", 1.0), ("inverse", "a", 3.0), ("fit", "a", 0.5), (None, "b", 4.0)],
        "op string, engine string, s double",
    )
    got = {r.operation: (r.a_time, r.b_time) for r in timing_table(df, "op", "engine", "s", ["a", "b"]).collect()}
    assert got == {"fit": (2.5, 1.0), "inverse": (3.0, 0.0), None: (0.0, 4.0), "total": (5.5, 5.0)}


def test_unlisted_engines_are_in_the_total(spark):
    rows = [("fit", "pd", 1.0), ("fit", "sp", 2.0), ("fit", "gpu", 50.0), ("fit", None, 3.0), ("inverse", "gpu", 4.0), (None, "pd", 8.0)]
    df = spark.createDataFrame(rows, "op string, engine string, s double")
    found = {r.operation: (r.pd_time, r.sp_time, r.other_time, r.all_time) for r in timing_table(df, "op", "engine", "s", ["pd", "sp"]).collect()}
    assert found == {"fit": (1.0, 2.0, 53.0, 56.0), "inverse": (0.0, 0.0, 4.0, 4.0), None: (8.0, 0.0, 0.0, 8.0), "total": (9.0, 2.0, 57.0, 68.0)}
    cells = timing_cells(df, "op", "engine", "s").collect()
    assert sum(r.seconds for r in cells if not (r.all_operations or r.all_engines)) == 68.0
    assert [r.seconds for r in cells if r.all_operations and r.all_engines] == [68.0]
    assert {(r.engine, r.seconds) for r in cells if r.all_operations and not r.all_engines} == {
        ("pd", 9.0), ("sp", 2.0), ("gpu", 54.0), (None, 3.0)
    }
    assert [r.all_time for r in timing_table(df.limit(0), "op", "engine", "s", []).collect() if r.operation is None] == []


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_phases_of_any_name_and_number(spark, monkeypatch, block):
    monkeypatch.setattr(telemetry, "PHASE_BLOCK", block)
    rng = random.Random(3)
    names = [f"p{i}" for i in range(60)]
    order = {name: i for i, name in enumerate(rng.sample(names, len(names)))}
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([*names, "unranked"]), float(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "run string, phase string, seconds double")
    ranked = spark.createDataFrame(list(order.items()), "phase string, position int")
    found = {(r.run, r.phase): (r.start, r.end) for r in phase_bounds(df, "run", "phase", "seconds", ranked).collect()}
    expected = {}
    for run in {r[0] for r in rows}:
        at = 0.0
        for name in sorted({p for q, p, _ in rows if q == run and p in order}, key=order.get):
            length = sum(s for q, p, s in rows if (q, p) == (run, name))
            expected[run, name] = (at, at + length)
            at += length
    assert found == expected


def test_counter_rate_plan(spark, tmp_path):
    rows = _samples("hot source")
    path = str(tmp_path / "samples")
    spark.createDataFrame(rows, "id bigint, source string, ts double, a double, b double").write.parquet(path)
    df = counter_rate(spark.read.parquet(path), "source", "ts", "id", ["a", "b"])
    assert df.count() == len(rows)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "ReusedExchange" in plan
    assert plan.count("FileScan") + plan.count("Scan parquet") == 2
