import os

import pytest
from pyspark.sql import functions as F

from numprep import ColumnSpec, fit
from numprep.operators import align, conform, profile, restrict
from numprep.sources import (
    dataset_gib,
    generate,
    generate_columns,
    read_table,
    rows_for_bytes,
    scratch_path,
    stored_bytes,
    unpack_samples,
    write_table,
)


def test_generated_rows_do_not_depend_on_partitions(spark):
    few, many = (generate(spark, 500, seed=3, partitions=n) for n in (2, 7))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    other = generate(spark, 500, seed=4, partitions=2)
    assert sorted(map(tuple, few.collect())) != sorted(map(tuple, other.collect()))


def test_generated_distributions(spark):
    df = generate(spark, 40_000, seed=1)
    assert dict(df.dtypes) == {
        "day_of_month": "bigint",
        "height": "string",
        "account_balance": "string",
        "net_profit": "string",
        "customer_ratings": "string",
        "leaderboard_rank": "bigint",
    }
    numbers = df.select(
        "day_of_month",
        F.expr("double(substring(height, 1, length(height) - 2))").alias("height"),
        F.expr("double(substring(account_balance, 2))").alias("account_balance"),
        F.expr("double(substring(net_profit, 2))").alias("net_profit"),
        F.expr("double(substring(customer_ratings, 1, length(customer_ratings) - 5))").alias("customer_ratings"),
        "leaderboard_rank",
    )
    ranges = {
        "day_of_month": (1, 30),
        "height": (0, 100),
        "account_balance": (0, 10000),
        "net_profit": (-5000, 5000),
        "customer_ratings": (0, 5),
        "leaderboard_rank": (1, 99999),
    }
    names = list(ranges)
    row = numbers.agg(
        *[f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max, F.avg, F.stddev)],
        *[F.corr(a, b).alias(f"corr_{a}_{b}") for i, a in enumerate(names) for b in names[i + 1 :]],
    ).first()
    for name, (low, high) in ranges.items():
        width = high - low
        assert low <= row[f"min_{name}"] <= low + 0.01 * width and high - 0.01 * width <= row[f"max_{name}"] <= high
        assert abs(row[f"avg_{name}"] - (low + high) / 2) < 0.01 * width
        assert abs(row[f"stddev_{name}"] - width / 12**0.5) < 0.02 * width
    assert all(abs(row[c]) < 0.02 for c in row.asDict() if c.startswith("corr_"))
    assert df.select("day_of_month").distinct().count() == 30
    assert df.distinct().count() == 40_000


def test_generated_rows_differ_beyond_32_bits(spark):
    ids = spark.createDataFrame([(5,), (5 + 2**32,), (5 + 2**40,), (-5,)], "id bigint")
    assert generate_columns(ids, "id").drop("id").distinct().count() == 4


def test_size_planning(spark):
    assert rows_for_bytes(60_000) == 100 and rows_for_bytes(100, columns=1) == 1
    assert dataset_gib(2**30) == 600.0
    row = spark.sql("select 60599 b, 1073741824 n").select(rows_for_bytes(F.col("b")), dataset_gib(F.col("n"))).first()
    assert tuple(row) == (100, 600.0)


def test_chunks_keep_the_remainder(spark, tmp_path):
    path = str(tmp_path / "chunks")
    write_table(generate(spark, 1050, partitions=1), path, rows_per_file=500)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 3 and read_table(spark, path).count() == 1050
    row = stored_bytes(spark, path).first()
    size = sum(os.path.getsize(os.path.join(path, f)) for f in files)
    assert (row["files"], row["bytes"]) == (3, size) and row["gib"] == size / 2**30


@pytest.mark.parametrize("file_format", ["csv", "json", "orc", "parquet"])
def test_table_formats(spark, tmp_path, file_format):
    df = spark.createDataFrame([("fit", 1.5, None), ("a,b", None, 2)], "operation string, t double, n int")
    path = str(tmp_path / "t")
    write_table(df, path, file_format)
    back = read_table(spark, path, file_format, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    if file_format in ("csv", "json"):
        with pytest.raises(ValueError, match="schema"):
            read_table(spark, path, file_format)


@pytest.mark.parametrize("file_format", ["csv", "json", "orc", "parquet"])
def test_formats_lose_nothing(spark, tmp_path, file_format):
    texts = [None, "", " ", " 12 ", "a\nb", "\r\n", "\\", "\\n", "\\\\n\n", "\\N", '"', '""', ',"x\\"', "null", "#", "\t", "é\n", "\\\r"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").selectExpr(
        "*", "timestamp'2024-01-02 03:04:05.678901' ts", "timestamp_ntz'2024-01-02 03:04:05.678901' n", "if(id = 3, null, id / 3) d"
    )
    path = str(tmp_path / "t")
    write_table(df, path, file_format)
    back = read_table(spark, path, file_format, df.schema)
    assert back.orderBy("id").collect() == df.orderBy("id").collect()


def test_unpacked_samples(spark):
    runs = spark.createDataFrame(
        [("r1", [0.0, 1.0, 2.0], [5.0], [(1.0, 7), (2.0, 8)]), ("r2", [], None, None), ("r3", None, [1.0], [])],
        "run string, timestamps array<double>, cpu array<double>, process_metrics array<struct<cpu_percent: double, threads: int>>",
    )
    lists = {"t": "timestamps", "cpu": "cpu", "process_cpu": "process_metrics.cpu_percent", "threads": "process_metrics.threads"}
    got = unpack_samples(runs, ["run"], lists, position="n").orderBy("run", "n").collect()
    assert [tuple(r) for r in got] == [
        ("r1", 0, 0.0, 5.0, 1.0, 7),
        ("r1", 1, 1.0, None, 2.0, 8),
        ("r1", 2, 2.0, None, None, None),
        ("r3", 0, None, 1.0, None, None),
    ]


def test_scratch_is_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a").startswith(folder) and scratch_path(spark, "a") != scratch_path(spark, "a")


def test_conform_align_restrict(spark):
    df = spark.sql("select cast(1 as tinyint) a, 2L b, cast(1.5 as decimal(3,1)) c, float(2.5) d, 's' e")
    assert [t for _, t in conform(df).dtypes] == ["bigint", "bigint", "double", "double", "string"]
    assert tuple(conform(df).first()) == (1, 2, 1.5, 2.5, "s")
    assert align(df, spark.sql("select 1 e, 2 a")).columns == ["e", "a"]
    assert restrict(df, [ColumnSpec("d"), ColumnSpec("b")]).columns == ["d", "b"]
    with pytest.raises(ValueError):
        conform(spark.sql("select current_date() d"))


def test_profile(spark):
    df = spark.createDataFrame(
        [("1cm", 1.0), ("x", float("nan")), (None, None), ("250cm", -3.0), ("0cm", 4.0)], "h string, v double"
    )
    specs = [ColumnSpec("h", suffix="cm", min_val=1, max_val=200), ColumnSpec("v", min_val=0)]
    rows = {r.column_name: tuple(r)[2:] for r in profile(df, specs).collect()}
    assert rows == {"h": (5, 1, 1, 1, 1, 0.0, 250.0), "v": (5, 2, 0, 1, 0, -3.0, 4.0)}
    fitted = fit(df, [ColumnSpec("v", min_val=True, max_val=True)])
    assert profile(df.where("v = 4 or v = -3"), fitted).first()["below_min"] == 0


def test_foreign_csv_is_left_alone(spark, tmp_path):
    (tmp_path / "foreign.csv").write_text('id,path,note\n1,C:\\new\\report,"a\nb"\n2,\\N,"say ""no"""\n3,, x \n')
    got = read_table(spark, str(tmp_path / "foreign.csv"), "csv", "id long, path string, note string", foreign=True)
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, "C:\\new\\report", "a\nb"),
        (2, "\\N", 'say "no"'),
        (3, None, " x "),
    ]
