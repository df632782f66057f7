"""The shape of the physical plans: what is scanned, shuffled and compiled."""

import re

import pytest
from pyspark.sql import functions as F

from numprep import ColumnSpec, fit
from numprep.catalog import QUERIES
from numprep.operators import counter_rate, diff_rows, diff_summary, profile, round_trip
from numprep.sources import generate, write_table

SPECS = [
    ColumnSpec("account_balance", prefix="$", min_val=0, rounding=2, clip=True),
    ColumnSpec("height", suffix="cm", min_val=1, rounding=2),
    ColumnSpec("day_of_month", min_val=1, max_val=31, clip_oor=False, rounding=0, reject=True),
]


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("people") / "t")
    write_table(generate(spark, 2000, partitions=2), path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, action):
    """Run the action as a job group, and count its jobs."""
    group = f"group-{id(action)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_fit_is_one_pass(spark, people, monkeypatch):
    plans = []
    first = type(people).first
    monkeypatch.setattr(type(people), "first", lambda df: (plans.append(plan(df)), first(df))[1])
    fit(people, SPECS)
    (text,) = plans
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "ReadSchema: struct<day_of_month:bigint,height:string,account_balance:string>" in text
    assert "Python" not in text


def test_scaling_moves_no_rows(spark, people):
    model = fit(people, SPECS)
    scaled, jobs = jobs_of(spark, lambda: model.transform(people))
    assert jobs == 0
    for df in (scaled, model.transform(people, flags=True), model.inverse_transform(scaled, flags=True)):
        text = plan(df)
        assert "Exchange" not in text and "Python" not in text and text.count("FileScan") == 1
        assert re.search(r"\*\(1\) Project", text)


def test_pruning_and_pushdown_pass_through(spark, people):
    model = fit(people, SPECS)
    text = plan(model.transform(people).where("leaderboard_rank > 5").select("height", "leaderboard_rank"))
    assert "ReadSchema: struct<height:string,leaderboard_rank:bigint>" in text
    assert "GreaterThan(leaderboard_rank,5)" in text


def test_generated_methods_can_be_compiled(spark, people):
    """The JVM compiles no method beyond 8000 bytes."""
    model = fit(people, SPECS)
    stages = model.inverse_transform(model.transform(people))._jdf.queryExecution().debug().codegenToSeq()
    sizes = [int(re.search(r"\((\d+)", stages.apply(i)._3().toString()).group(1)) for i in range(stages.size())]
    assert sizes and max(sizes) < 8000


def test_profile_and_round_trip_are_one_aggregate(spark, people):
    model = fit(people, SPECS)
    for df in (profile(people, SPECS), round_trip(people, model)):
        text = plan(df)
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text


def test_diff_shuffles_each_table_once(spark, people):
    keyed = people.withColumn("k", F.xxhash64(*people.columns))
    text = plan(diff_summary(keyed, keyed, ["k"], columns=["day_of_month", "leaderboard_rank"]))
    assert "Join" not in text and text.count("hashpartitioning") == 1 and "SortAggregate" not in text
    for columns in (None, ["height"]):
        text = plan(diff_summary(keyed, keyed, ["k"], columns=columns))
        assert "Join" not in text and "Sort" not in text
    text = plan(diff_rows(keyed, keyed, ["k"]))
    assert "SortMergeJoin" not in text and "SortAggregate" not in text
    assert "WindowGroupLimit" in text and "Partial" in text


def test_generator_is_a_projection(spark):
    text = plan(generate(spark, 1000))
    assert "Exchange" not in text and "Python" not in text


def test_rates_run_nothing_before_an_action(spark, tables):
    events = spark.read.parquet(f"{tables}/events.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rates", "rates")
    try:
        text = plan(counter_rate(events, "user_id", "ts", "event_id", ["value"], cell_seconds=60, rows_per_cell=5))
        assert not tracker.getJobIdsForGroup("rates")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Join" in text and "Cartesian" not in text


def test_rescaled_time_scans_twice(spark, tables):
    text = plan(QUERIES["rescaled_time"](spark, tables))
    assert text.count("FileScan") == 2
