"""Timings of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_ROWS (rows of the generated table; 0 skips it).

Every query's whole result is forced with the noop sink. The ``rows_*`` timings repeat the workload of
Best of three runs after a warm-up run, so that the timings are of the work and not of the JVM's start.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from numprep import fit  # noqa: E402
from numprep.catalog import QUERIES  # noqa: E402
from numprep.sources import generate, write_table  # noqa: E402

RUNS = 3
BASELINE_ROWS = 13_400_000

HEADLINE = (
    *("fit_params", "transform_affixed", "transform_prefix_suffix", "transform_clip_lower", "malformed_text"),
    *("inverse_clip", "inverse_reject", "inverse_flag_range", "inverse_text", "numbers_as_text", "rounding"),
    *("round_trip_orders", "params_reload", "profile_text", "profile_numbers", "generate_table"),
    *("diff_tables", "diff_samples", "counter_rates", "counter_rates_in_chunks", "samples_by_phase"),
    *("rescaled_time", "metric_summary", "metric_analysis", "timings"),
)

# The configuration of the baseline workload.
PEOPLE = {
    "day_of_month": {
        "converter": {"min_val": 1, "max_val": 31, "clip_oor": False, "rounding": 0},
        "normalizer": {"clip": False, "reject": True},
    },
    "height": {
        "converter": {"min_val": 1, "max_val": False, "clip_oor": True, "suffix": "cm", "rounding": 2},
        "normalizer": {"clip": True, "reject": False},
    },
    "account_balance": {
        "converter": {"min_val": 0, "max_val": False, "clip_oor": True, "prefix": "$", "rounding": 2},
        "normalizer": {"clip": True, "reject": False},
    },
    "net_profit": {
        "converter": {"min_val": False, "max_val": False, "clip_oor": False, "prefix": "$", "rounding": 2},
        "normalizer": {"clip": True, "reject": False},
    },
    "customer_ratings": {
        "converter": {"min_val": 0.0, "max_val": False, "clip_oor": False, "suffix": "stars", "rounding": 2},
        "normalizer": {"clip": True, "reject": False},
    },
    "leaderboard_rank": {
        "converter": {"min_val": 1, "max_val": True, "clip_oor": False, "rounding": 0},
        "normalizer": {"clip": True, "reject": False},
    },
}


def force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int = RUNS) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def baseline_workload(spark: SparkSession, folder: str, rows: int) -> dict[str, float]:
    path = f"{folder}/people"
    write_table(generate(spark, rows, seed=1, partitions=4 * spark.sparkContext.defaultParallelism), path)
    df = spark.read.parquet(path)
    model = fit(df, PEOPLE)
    write_table(model.transform(df), f"{folder}/scaled")
    scaled = spark.read.parquet(f"{folder}/scaled")
    return {
        "rows_fit": best(lambda: fit(df, PEOPLE)),
        "rows_transform": best(lambda: force(model.transform(df))),
        "rows_inverse": best(lambda: force(model.inverse_transform(scaled))),
        "rows_inverse_with_flags": best(lambda: force(model.inverse_transform(scaled, flags=True))),
    }


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_ROWS", BASELINE_ROWS))
    folder = tempfile.mkdtemp(prefix="numprep-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("numprep-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {name: best(lambda name=name: force(QUERIES[name](spark, tables))) for name in HEADLINE}
    total = round(sum(timings.values()), 3)
    workload = baseline_workload(spark, folder, rows) if rows else {}
    spark.stop()
    report = {
        "metric": "total time of the headline queries",
        "value": total,
        "unit": "sec",
        "queries": {**timings, **workload},
        "sf": tables.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
        "generated_rows": rows,
    }
    if workload:
        report["rows_per_second"] = {name: round(rows / seconds) for name, seconds in workload.items()}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
