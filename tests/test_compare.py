import pytest
from pyspark.sql import functions as F

from numprep import ColumnSpec, fit
from numprep.operators import diff_rows, diff_summary, round_trip


def _rows(df, key="column_name"):
    return {row[key]: row.asDict() for row in df.collect()}


def test_tolerance(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 1.0)], "k int, x double")
    right = spark.createDataFrame([(1, 1.0 + 5e-7), (2, 1.0 + 2e-6)], "k int, x double")
    found = _rows(diff_summary(left, right, ["k"]))["x"]
    assert (found["compared"], found["mismatches"], found["all_equal"]) == (2, 1, False)
    assert found["max_abs_diff"] == pytest.approx(2e-6)


def test_missing_values(spark):
    left = spark.createDataFrame([(1, None, None), (2, None, 1.0), (3, "a", float("nan"))], "k int, t string, x double")
    right = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", None)], "k int, t string, x double")
    found = _rows(diff_summary(left, right, ["k"]))
    assert (found["t"]["mismatches"], found["t"]["null_mismatches"], found["t"]["all_equal"]) == (1, 1, False)
    assert (found["x"]["mismatches"], found["x"]["null_mismatches"], found["x"]["max_abs_diff"]) == (0, 1, None)
    rows = diff_rows(left, right, ["k"]).collect()
    assert [(r.column_name, r.k, r.left_value, r.right_value, r.difference) for r in rows] == [("t", 2, None, "a", None)]


def test_keys_of_one_side_and_duplicates(spark):
    left = spark.createDataFrame([(1, 5), (2, 5), (2, 5), (4, 5), (None, 7)], "k int, x int")
    right = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 6), (4, 7), (None, 8)], "k int, x int")
    found = _rows(diff_summary(left, right, ["k"]))["x"]
    assert (found["compared"], found["left_only"], found["right_only"], found["duplicate_keys"]) == (2, 0, 1, 2)
    assert (found["mismatches"], found["max_abs_diff"]) == (1, 1.0)  # the NULL keys match each other


def test_equal_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, None)], "k int, t string, x double")
    for found in _rows(diff_summary(df, df, ["k"])).values():
        assert (found["compared"], found["mismatches"], found["all_equal"]) == (2, 0, True)
    nothing = df.where("k > 5")
    for found in _rows(diff_summary(nothing, nothing, ["k"])).values():
        assert (found["compared"], found["max_abs_diff"], found["all_equal"]) == (0, None, True)
    assert diff_rows(df, df, ["k"]).collect() == []


def test_composite_keys_and_named_columns(spark):
    left = spark.createDataFrame([(1, "a", 1.0, 9), (1, "b", 2.0, 9)], "k int, `s.t` string, x double, y int")
    right = spark.createDataFrame([(1, "a", 1.0, 0), (1, "b", 4.0, 0)], "k int, `s.t` string, x double, y int")
    found = _rows(diff_summary(left, right, ["k", "s.t"], columns=["x"]))
    assert list(found) == ["x"] and found["x"]["mismatches"] == 1
    (row,) = diff_rows(left, right, ["k", "s.t"], columns=["x"]).collect()
    assert (row["k"], row["s.t"], row["left_value"], row["right_value"]) == (1, "b", "2.0", "4.0")


def test_wrong_use(spark):
    df = spark.sql("select 1 k, 'a' x")
    with pytest.raises(ValueError, match="key"):
        diff_summary(df, df, [])
    with pytest.raises(ValueError, match="in one table"):
        diff_summary(df, spark.sql("select 1 k, 2 x"), ["k"])


@pytest.mark.parametrize("limit", [3, 2000])
def test_first_rows_per_column(spark, limit):
    """Both below and above the number up to which Spark limits groups by itself."""
    left = spark.range(5000).select("id", F.lit(0.0).alias("x"), F.lit(0).alias("y"))
    right = spark.range(5000).select("id", (F.col("id") % 100).cast("double").alias("x"), F.lit(0).alias("y"))
    rows = diff_rows(left, right, ["id"], limit=limit).orderBy("position").collect()
    expected = sorted(((-(k % 100), k) for k in range(5000) if k % 100), key=lambda p: p)[:limit]
    assert [(-r.difference, r.id) for r in rows] == expected
    assert [r.position for r in rows] == list(range(1, limit + 1))


def test_hot_key_is_not_multiplied(spark):
    """A third of the rows on one key, on both sides: pairs would be 10^10 rows."""
    hot = spark.range(100_000).select(F.lit(-1).cast("bigint").alias("k"), F.lit(1.0).alias("x"))
    rest = spark.range(200_000).select(F.col("id").alias("k"), F.lit(1.0).alias("x"))
    df = rest.unionByName(hot)
    found = _rows(diff_summary(df, df, ["k"]))["x"]
    assert (found["compared"], found["duplicate_keys"], found["mismatches"]) == (200_000, 1, 0)


def test_round_trip(spark):
    df = spark.createDataFrame([(1, "$1.25", 7), (2, "$3.5", 8), (3, "$x", None)], "k int, price string, n int")
    model = fit(df, [ColumnSpec("price", prefix="$", rounding=1), ColumnSpec("n", rounding=0)])
    found = _rows(round_trip(df, model, tolerance=0.01))
    assert found["price"]["mismatches"] == 1 and found["price"]["max_abs_diff"] == pytest.approx(0.05)
    assert found["price"]["all_equal"] is False
    assert (found["n"]["compared"], found["n"]["mismatches"], found["n"]["all_equal"]) == (3, 0, True)


def test_exact_numbers_and_infinities(spark):
    left = spark.sql(
        "select 1 k, 9007199254740993L a, cast(1.000000000000000000001 as decimal(38,21)) b, double('inf') c, 1L d"
    )
    right = spark.sql("select 1 k, 9007199254740992L a, cast(1 as decimal(38,21)) b, double('inf') c, cast(1 as decimal(3,1)) d")
    rows = {r.column_name: r for r in diff_summary(left, right, ["k"]).collect()}
    assert (rows["a"].mismatches, rows["a"].all_equal, rows["a"].max_abs_diff) == (1, False, 1.0)
    assert (rows["b"].mismatches, rows["b"].all_equal) == (0, False)
    assert (rows["c"].mismatches, rows["c"].all_equal, rows["c"].max_abs_diff) == (0, True, 0.0)
    assert (rows["d"].mismatches, rows["d"].all_equal) == (0, True)
    found = diff_rows(left, right, ["k"]).collect()
    assert [(r.column_name, r.left_value, r.right_value) for r in found] == [("a", "9007199254740993", "9007199254740992")]
    opposite = diff_summary(left.select("k", "c"), right.selectExpr("k", "-c c"), ["k"]).first()
    assert (opposite.mismatches, opposite.max_abs_diff) == (1, float("inf"))
