"""Comparison of two tables, and of a table with its own round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from numprep.functions import number_text, parse_number
from numprep.operators.shape import one_row_per
from numprep.plans.model import FittedModel, quoted

TOLERANCE = 1e-6
SAMPLE_ROWS = 10

#: Rows to report up to this number are sent to all tasks to look up their texts.
BROADCAST_ROWS = 10_000
_SALTS = 64
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _digits(data_type: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(data_type))
    if whole is not None:
        return whole, 0
    if isinstance(data_type, T.DecimalType):
        return data_type.precision - data_type.scale, data_type.scale
    return None


def _kinds(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The type each column is compared in. Both tables have to agree on whether it is a number.

    Integers and decimals are compared exactly, as a decimal that holds both sides; other numbers as doubles.
    """
    kinds = {}
    for name in columns:
        types = [df.schema[name].dataType for df in (left, right)]
        numeric = {isinstance(t, T.NumericType) for t in types}
        if len(numeric) > 1:
            raise ValueError(f"column {name!r} is a number in one table and not in the other")
        if not numeric.pop():
            kinds[name] = "string"
            continue
        digits = [_digits(t) for t in types]
        if None in digits:
            kinds[name] = "double"
            continue
        whole, scale = (max(x) for x in zip(*digits))
        kinds[name] = f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"
    return kinds


def _difference(left: Column, right: Column) -> Column:
    """Absolute difference as a double; 0 for equal values, infinite ones included."""
    return F.when(left.eqNullSafe(right) & left.isNotNull(), F.lit(0.0)).otherwise(F.abs(left - right).cast("double"))


def _aligned(left: DataFrame, right: DataFrame, keys: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """One row per key with the row count and the values of either side.

    This is a full outer match without a join: both tables in one, grouped by key. A key that a third of all
    rows share shrinks to one row per task before the shuffle, where a join would pair its copies. NULL keys
    match each other. Values mean something only where a side has exactly one row. Of texts there are 128 bits of
    hashes, because an aggregate of texts would have to sort all rows.
    """

    def side(df: DataFrame, mine: str, theirs: str) -> DataFrame:
        counted = [F.lit(1).alias(f"n_{mine}"), F.lit(0).alias(f"n_{theirs}")]
        values = []
        for i, (name, kind) in enumerate(kinds.items()):
            if kind == "string":
                text = quoted(name).cast("string")
                hashes = (F.when(text.isNotNull(), F.xxhash64(*seed, text)) for seed in ((), (F.lit(1),)))
                found = dict(zip((f"{i}", f"{i}x"), hashes))
            elif kind == "double":
                found = {f"{i}": parse_number(quoted(name), df.schema[name].dataType)}
            else:
                found = {f"{i}": quoted(name).cast(kind)}
            nothing = F.lit(None).cast("bigint" if kind == "string" else kind)
            for place, value in found.items():
                values += [value.alias(f"{mine}{place}"), nothing.alias(f"{theirs}{place}")]
        return df.select(*[quoted(k).alias(f"key{j}") for j, k in enumerate(keys)], *counted, *values)

    both = side(left, "l", "r").unionByName(side(right, "r", "l"))
    places = [f"{i}" for i in range(len(kinds))] + [f"{i}x" for i, kind in enumerate(kinds.values()) if kind == "string"]
    sides = [F.max(f"{s}{place}").alias(f"{s}{place}") for place in places for s in "lr"]
    counts = [F.sum(n).alias(n) for n in ("n_l", "n_r")]
    return both.groupBy(*[f"key{j}" for j in range(len(keys))]).agg(*counts, *sides)


_MATCHED = "n_l = 1 and n_r = 1"


def _mismatch(i: int, numeric: bool, tolerance: float) -> Column:
    left, right = F.col(f"l{i}"), F.col(f"r{i}")
    if not numeric:
        return ~_same_text(i)
    return F.coalesce(_difference(left, right) > tolerance, F.lit(False))


def _same_text(i: int) -> Column:
    return F.col(f"l{i}").eqNullSafe(F.col(f"r{i}")) & F.col(f"l{i}x").eqNullSafe(F.col(f"r{i}x"))


def _column_measures(i: int, numeric: bool, tolerance: float, matched: Column) -> list[Column]:
    left, right = F.col(f"l{i}"), F.col(f"r{i}")
    difference = _difference(left, right) if numeric else F.lit(None).cast("double")
    return [
        F.max(F.when(matched, difference)).alias(f"max{i}"),
        F.count_if(matched & _mismatch(i, numeric, tolerance)).alias(f"differ{i}"),
        F.count_if(matched & (left.isNull() != right.isNull())).alias(f"null{i}"),
        F.coalesce(
            F.bool_and(F.when(matched, left.eqNullSafe(right) if numeric else _same_text(i))), F.lit(True)
        ).alias(f"equal{i}"),
    ]


def _column_row(i: int, name: str, numeric: bool) -> dict[str, Column]:
    return {
        "column_name": F.lit(name),
        "kind": F.lit("number" if numeric else "text"),
        "compared": F.col("compared"),
        "max_abs_diff": F.col(f"max{i}"),
        "mismatches": F.col(f"differ{i}"),
        "null_mismatches": F.col(f"null{i}"),
        "all_equal": F.col(f"equal{i}"),
    }


def _compared_columns(left: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    if not keys:
        raise ValueError("rows are matched by key columns; none are given")
    return [name for name in left.columns if name not in keys] if columns is None else list(columns)


def diff_summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per column: largest difference, mismatches, and how the keys of the two tables relate.

    A number mismatches if it is off by more than the tolerance (integers and decimals are subtracted exactly, and equal
    infinities are equal), text if it is not the same (two NULLs are).
    A value missing on one side is counted in ``null_mismatches``, for text also as a mismatch. Keys with
    several rows on a side cannot be matched; they are counted in ``duplicate_keys`` and not compared.
    """
    kinds = _kinds(left, right, _compared_columns(left, keys, columns))
    matched = F.expr(_MATCHED)
    measures = [
        F.count_if(matched).alias("compared"),
        F.count_if(F.expr("n_l = 1 and n_r = 0")).alias("left_only"),
        F.count_if(F.expr("n_l = 0 and n_r = 1")).alias("right_only"),
        F.count_if(F.expr("n_l > 1 or n_r > 1")).alias("duplicate_keys"),
    ]
    rows = []
    for i, (name, kind) in enumerate(kinds.items()):
        numeric = kind != "string"
        measures += _column_measures(i, numeric, tolerance, matched)
        keys_seen = {n: F.col(n) for n in ("left_only", "right_only", "duplicate_keys")}
        rows.append({**_column_row(i, name, numeric), **keys_seen})
    return one_row_per(rows, _aligned(left, right, keys, kinds).agg(*measures))


def diff_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    tolerance: float = TOLERANCE,
    limit: int = SAMPLE_ROWS,
) -> DataFrame:
    """The first mismatches of each column: largest difference first, then by key.

    Every task keeps its own first ``limit`` rows of a column before the shuffle, so a column that differs
    everywhere does not end up in one task.
    """
    kinds = _kinds(left, right, _compared_columns(left, keys, columns))
    found = []
    for i, (name, kind) in enumerate(kinds.items()):
        numeric, double = kind != "string", kind == "double"
        lefts, rights = F.col(f"l{i}"), F.col(f"r{i}")
        nothing = {t: F.lit(None).cast(t) for t in ("double", "string")}
        entry = F.struct(
            F.lit(name).alias("column_name"),
            (lefts if double else nothing["double"]).alias("ln"),
            (rights if double else nothing["double"]).alias("rn"),
            (lefts.cast("string") if numeric and not double else nothing["string"]).alias("lt"),
            (rights.cast("string") if numeric and not double else nothing["string"]).alias("rt"),
            (_difference(lefts, rights) if numeric else nothing["double"]).alias("difference"),
        )
        found.append(F.when(_mismatch(i, numeric, tolerance), entry))
    key_columns = [f"key{j}" for j in range(len(keys))]
    mismatches = (
        _aligned(left, right, keys, kinds)
        .where(_MATCHED)
        .select(*key_columns, F.explode(F.array_compact(F.array(*found))).alias("found"))
        .select(*key_columns, "found.*")
    )
    order = [F.col("difference").desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in key_columns]]

    def first(df: DataFrame, *groups: str | Column) -> DataFrame:
        numbered = df.withColumn("position", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
        return numbered.where(F.col("position") <= limit)

    # Spark itself keeps only the first rows per task up to a threshold. Beyond it, two rounds do the same.
    if limit > int(left.sparkSession.conf.get(_GROUP_LIMIT)):
        salt = F.pmod(F.xxhash64(*key_columns), F.lit(_SALTS))
        mismatches = first(mismatches.withColumn("salt", salt), "column_name", "salt").drop("salt", "position")
    found = first(mismatches, "column_name")
    texts = [name for name, kind in kinds.items() if kind == "string"]
    few = limit * len(kinds) <= BROADCAST_ROWS
    for df, out in ((left, "lt"), (right, "rt")) if texts else ():
        found = _with_text(F.broadcast(found) if few else found, df, keys, texts, out)
    return found.select(
        "column_name",
        F.col("position").cast("bigint").alias("position"),
        *[F.col(column).alias(name) for column, name in zip(key_columns, keys)],
        F.coalesce("lt", number_text(F.col("ln"))).alias("left_value"),
        F.coalesce("rt", number_text(F.col("rn"))).alias("right_value"),
        "difference",
    )


def _with_text(found: DataFrame, df: DataFrame, keys: Sequence[str], texts: Sequence[str], out: str) -> DataFrame:
    """The found rows with the text that the table has in their column. Their keys are in the table once."""
    own = df.select(
        *[quoted(key).alias(f"own{j}") for j, key in enumerate(keys)],
        *[quoted(name).cast("string").alias(f"text{i}") for i, name in enumerate(texts)],
    )
    same = F.lit(True)
    for j in range(len(keys)):
        same = same & F.col(f"key{j}").eqNullSafe(F.col(f"own{j}"))
    value = F.col(out)
    for i, name in enumerate(texts):
        value = F.when(F.col("column_name") == name, F.col(f"text{i}")).otherwise(value)
    return own.join(found, same).withColumn(out, value).select(found.columns)


def round_trip(df: DataFrame, model: FittedModel, tolerance: float = TOLERANCE) -> DataFrame:
    """Compare each fitted column with its value after scaling and restoring, one row per column.

    A row is compared with itself, so this needs neither a key nor a shuffle of rows: one scan, one aggregate.
    Text columns are compared by the numbers in them, and ``all_equal`` by the text.
    """
    names = [fitted.column_name for fitted in model.columns]
    sources = [quoted(name).alias(f"s{i}") for i, name in enumerate(names)]
    there = model.transform(df.select(*[quoted(name) for name in names], *sources))
    back = model.inverse_transform(there)
    numbers = []
    for i, fitted in enumerate(model.columns):
        data_type = df.schema[fitted.column_name].dataType
        restored = quoted(fitted.column_name)
        numbers += [
            fitted.parse(F.col(f"s{i}"), data_type).alias(f"l{i}"),
            fitted.parse(restored).alias(f"r{i}"),
            F.col(f"s{i}").cast("string").eqNullSafe(restored.cast("string")).alias(f"same{i}"),
        ]
    measures, rows = [F.count("*").alias("compared")], []
    for i, name in enumerate(names):
        largest, differ, nulls, _ = _column_measures(i, True, tolerance, F.lit(True))
        same = F.coalesce(F.bool_and(f"same{i}"), F.lit(True)).alias(f"equal{i}")
        measures += [largest, differ, nulls, same]
        rows.append(_column_row(i, name, True))
    return one_row_per(rows, back.select(*numbers).agg(*measures))
