"""Synthetic input tables, the same on any cluster.

``rand(seed)`` depends on how rows are spread over partitions. Here every value is a function of the row id,
the column and the seed, in plain 64-bit integer arithmetic: no shuffle, no state, and a lost partition is
computed again to the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.functions import compiled_apart, round_places, write_number

# The names here, and the ranges, places and affixes in generate_columns, are those of the known tables.
COLUMNS = ("day_of_month", "height", "account_balance", "net_profit", "customer_ratings", "leaderboard_rank")

# Assumed stored size of one value, for planning.
BYTES_PER_VALUE = 100

MASK = 0xFFFFFFFF
MULTIPLIER = 0x45D9F3B  # of a well-known public 32-bit integer hash; products stay below 2^63
_SPREAD = 0x9E3779B1  # 2^32 over the golden ratio, to spread neighbouring seeds


def stream_salt(seed: int, index: int) -> int:
    """Start value of the ``index``-th column under a seed."""
    return (seed * len(COLUMNS) + index + 1) * _SPREAD & MASK


def _scramble(x: Column) -> Column:
    return (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK))


def _with_uniforms(df: DataFrame, row_id: Column, seed: int) -> tuple[DataFrame, list[Column]]:
    names = [f"__u{i}" for i in range(len(COLUMNS))]
    low, high = row_id.bitwiseAND(F.lit(MASK)), F.shiftright(row_id, 32).bitwiseAND(F.lit(MASK))
    start = [low.bitwiseXOR(F.lit(stream_salt(seed, i))).alias(name) for i, name in enumerate(names)]
    df = df.select("*", high.alias("__high"), *start)
    # A step uses its input twice, so every step is a projection of its own.
    df = df.withColumns({name: _scramble(F.col(name)) for name in names})
    df = df.withColumns({name: _scramble(F.col(name).bitwiseXOR(F.col("__high"))) for name in names})
    df = df.withColumns({name: _scramble(F.col(name)) for name in names})
    return df, [F.shiftright(F.col(n), 16).bitwiseXOR(F.col(n)) / F.lit(float(MASK + 1)) for n in names]


def generate_columns(ids: DataFrame, id_column: str, seed: int = 0) -> DataFrame:
    """The id column and six generated ones for every row of ``ids``."""
    df = ids.select(F.col(id_column).cast("bigint").alias("__id"))
    df, (day, height, balance, profit, rating, rank) = _with_uniforms(df, F.col("__id"), seed)
    df = df.select(
        F.col("__id").alias(id_column),
        (F.floor(day * 30) + 1).alias("day_of_month"),
        round_places(height * 100.0, 2).alias("height"),
        round_places(balance * 10000.0, 2).alias("account_balance"),
        round_places((profit - 0.5) * 10000.0, 2).alias("net_profit"),
        round_places(rating * 5.0, 2).alias("customer_ratings"),
        (F.floor(rank * 99999) + 1).alias("leaderboard_rank"),
    )
    affixes = {
        "height": ("", "cm"),
        "account_balance": ("$", ""),
        "net_profit": ("$", ""),
        "customer_ratings": ("", "stars"),
    }
    written = {
        name: compiled_apart(write_number(F.col(name), T.StringType(), *affix, places=2)).alias(name)
        for name, affix in affixes.items()
    }
    return df.select(F.col(id_column), *[written.get(name, F.col(name)) for name in COLUMNS])


def generate(spark: SparkSession, rows: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Table of ``rows`` generated rows. Write it with ``write_table(..., rows_per_file=n)`` for chunks."""
    ids = spark.range(rows) if partitions is None else spark.range(0, rows, 1, partitions)
    return generate_columns(ids, "id", seed).drop("id")


def rows_for_bytes(target: Column | int, columns: int = len(COLUMNS)) -> Column | int:
    """How many rows make a table of about that many bytes."""
    size = columns * BYTES_PER_VALUE
    if isinstance(target, Column):
        return F.floor(target / F.lit(size))
    return int(target / size)


def dataset_gib(rows: Column | int, columns: int = len(COLUMNS)) -> Column | float:
    """Estimated size of that many rows."""
    if isinstance(rows, Column):
        return rows * F.lit(float(columns * BYTES_PER_VALUE)) / F.lit(2.0**30)
    return rows * columns * BYTES_PER_VALUE / 2**30
