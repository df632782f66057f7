"""Comparison of tables whose keys repeat: rows are counted, equal ones cancelled, and the rest paired."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprep.functions import parse_number
from numprep.operators.compare import TOLERANCE, _compared_columns, _difference, _kinds
from numprep.operators.intervals import total_before
from numprep.operators.shape import one_row_per
from numprep.plans.model import quoted


def _counted(left: DataFrame, right: DataFrame, keys: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """Each different row (key0.., v0..) with how often either side has it: n_l, n_r. Values of one type keep it."""

    def side(df: DataFrame, n_l: int, n_r: int) -> DataFrame:
        values = []
        for i, (name, kind) in enumerate(kinds.items()):
            types = [table.schema[name].dataType for table in (left, right)]
            if kind == "double":
                value = parse_number(quoted(name), df.schema[name].dataType)
            else:
                value = quoted(name) if types[0] == types[1] else quoted(name).cast(kind)
            values.append(value.alias(f"v{i}"))
        named = [quoted(key).alias(f"key{j}") for j, key in enumerate(keys)]
        return df.select(*named, *values, F.lit(n_l).alias("n_l"), F.lit(n_r).alias("n_r"))

    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    row = [*[f"key{j}" for j in range(len(keys))], *[f"v{i}" for i in range(len(kinds))]]
    return both.groupBy(*row).agg(F.sum("n_l").alias("n_l"), F.sum("n_r").alias("n_r"))


#: Ranks of a key that meet in one group of the pairing, and ranks that one row is first cut into.
_CHUNK, _BLOCK = 32, 1 << 20


def _paired(counted: DataFrame, n_keys: int, n_values: int) -> DataFrame:
    """Rows that one side has more often, paired by their rank within the key: key0.., l0.., r0.., rows.

    The order within a key is that of the MD5 of the values: it deals the rows of a key evenly into parts, so a key that holds
    a third of a table is no more than any other, and a rerun pairs alike. A row that is left many times stays one run of ranks,
    cut only at every ``_CHUNK`` ranks; a group is one such stretch of a key's ranks, at most that many runs of either side.
    """
    keys, values = [f"key{j}" for j in range(n_keys)], [f"v{i}" for i in range(n_values)]
    texts = [F.coalesce(F.concat(F.lit("="), F.col(v).cast("string")), F.lit("-")) for v in values]
    left_over = (
        counted.where("n_l != n_r")
        .withColumn("digest", F.md5(F.concat_ws("\x1f", *texts)))
        .withColumn("cell", F.substring("digest", 1, 2))
        .withColumn("on_left", F.col("n_l") > F.col("n_r"))
        .withColumn("rows", F.abs(F.col("n_l") - F.col("n_r")))
        .drop("n_l", "n_r")
    )
    order = [F.col("digest"), *[F.col(v).asc_nulls_first() for v in values]]
    ranked = total_before(left_over, [*keys, "on_left"], "cell", order, "rows", "first")
    last = F.col("first") + F.col("rows") - 1

    def cut(df: DataFrame, size: int, name: str) -> DataFrame:
        """Runs cut at multiples of ``size``: first and last become those of the part."""
        parts = F.sequence(F.floor(F.col("first") / size), F.floor(F.col("last") / size))
        df = df.withColumn(name, F.explode(parts))
        bounds = F.greatest("first", F.col(name) * size), F.least("last", (F.col(name) + 1) * size - 1)
        return df.withColumns(dict(zip(("first", "last"), bounds)))

    runs = cut(cut(ranked.withColumn("last", last), _BLOCK, "block"), _CHUNK, "chunk")
    run = F.struct("first", "last", *values)
    sides = [F.collect_list(F.when(side, run)).alias(name) for side, name in ((F.col("on_left"), "l"), (~F.col("on_left"), "r"))]

    def pair(one: Column, other: Column) -> Column:
        both = [one[v].alias(f"l{i}") for i, v in enumerate(values)] + [other[v].alias(f"r{i}") for i, v in enumerate(values)]
        shared = F.least(one["last"], other["last"]) - F.greatest(one["first"], other["first"]) + 1
        return F.struct(*both, shared.cast("bigint").alias("rows"))

    pairs = F.flatten(F.transform("l", lambda one: F.transform("r", lambda other: pair(one, other))))
    met = runs.groupBy(*keys, "chunk").agg(*sides)
    return met.select(*keys, F.inline(F.filter(pairs, lambda p: p["rows"] > 0)))


def pair_repeated(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of two tables that differ, paired within their key: the keys, left_ and right_ of each column, and ``rows``.

    Keys may repeat. A row that both tables have is matched as often as both have it, and what is then left of a key is paired
    by rank; ``rows`` says how many such pairs there are, and a pair may come in several parts. Rows without a partner are in no pair (`diff_repeated` counts them).
    """
    kinds = _kinds(left, right, _compared_columns(left, keys, columns))
    pairs = _paired(_counted(left, right, keys, kinds), len(keys), len(kinds))
    sides = (("l", "left", left), ("r", "right", right))
    named = [
        F.col(f"{short}{i}").cast(df.schema[name].dataType).alias(f"{side}_{name}")
        for i, name in enumerate(kinds)
        for short, side, df in sides
    ]
    return pairs.select(*[F.col(f"key{j}").alias(key) for j, key in enumerate(keys)], *named, "rows")


def diff_repeated(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per column: how two tables differ whose keys repeat.

    ``equal_rows`` rows are in both tables; of the others ``paired`` are compared with a row of the same key, and ``left_only``
    and ``right_only`` have no partner, so equal_rows + paired + left_only is the number of rows on the left. Numbers mismatch
    beyond the tolerance, texts if they are not the same; a value that one side lacks is in ``null_mismatches``, and of texts
    also in ``mismatches``. Columns, kinds and NULL keys are as in `diff_summary`.

    Rows are counted before they are shuffled, so copies cost nothing; only rows that differ are ranked and joined.
    """
    kinds = _kinds(left, right, _compared_columns(left, keys, columns))
    counted = _counted(left, right, keys, kinds)
    surplus = F.col("n_l") - F.col("n_r")
    totals = counted.agg(
        F.sum(F.least("n_l", "n_r")).alias("equal_rows"),
        F.sum(F.greatest(surplus, F.lit(0))).alias("more_left"),
        F.sum(F.greatest(-surplus, F.lit(0))).alias("more_right"),
    )
    measures = [F.sum("rows").alias("paired")]
    for i, kind in enumerate(kinds.values()):
        one, other = F.col(f"l{i}"), F.col(f"r{i}")
        difference = F.lit(None).cast("double") if kind == "string" else _difference(one.cast(kind), other.cast(kind))
        differs = ~one.eqNullSafe(other) if kind == "string" else F.coalesce(difference > tolerance, F.lit(False))
        measures += [
            F.max(difference).alias(f"max{i}"),
            F.sum(F.when(differs, F.col("rows"))).alias(f"differ{i}"),
            F.sum(F.when(one.isNull() != other.isNull(), F.col("rows"))).alias(f"null{i}"),
        ]
    pairs = _paired(counted, len(keys), len(kinds)).agg(*measures)
    both = totals.unionByName(pairs, allowMissingColumns=True)  # a row each, made one
    largest = {f"max{i}" for i in range(len(kinds))}
    one_row = both.agg(
        *[
            F.max(c).alias(c) if c in largest else F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
            for c in both.columns
        ]
    )
    rows = [
        {
            "column_name": F.lit(name),
            "kind": F.lit("text" if kind == "string" else "number"),
            "equal_rows": F.col("equal_rows"),
            "paired": F.col("paired"),
            "left_only": F.col("more_left") - F.col("paired"),
            "right_only": F.col("more_right") - F.col("paired"),
            "max_abs_diff": F.col(f"max{i}"),
            "mismatches": F.col(f"differ{i}"),
            "null_mismatches": F.col(f"null{i}"),
        }
        for i, (name, kind) in enumerate(kinds.items())
    ]
    return one_row_per(rows, one_row)
