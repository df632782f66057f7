"""What the operators of this package share: row keys, durable intermediate tables and distributed running totals."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Bytes and counts of words: the code points that separate words are blank, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Keys of a text, or of its row, that are sent to all tasks; more of them are shuffled, with the same result.
BROADCAST_KEYS = 200_000

_SHARED = "spark.checkpoint.dir"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they may not see the driver's folder."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        name = f"{tempfile.mkdtemp()}/{package.name}"
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system: workers live on from one step to the next, with what the largest of them took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    folder = spark.conf.get(_SHARED, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write the rows to the shared folder and read them back, which cuts the lineage durably."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def few(keys: DataFrame) -> DataFrame:
    """The stored keys, to be sent to all tasks if they are few: then what is joined with them is not shuffled."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def text_of(column: str = "text") -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """16 bytes that stand for the text; a missing text has the key of the empty one."""
    return F.unhex(F.substring(F.sha2(text_of(column).cast("binary"), 256), 1, 32))


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality on all names, where NULL equals NULL."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def left_by(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join on names where NULL equals NULL; the names come from the left side only."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{name}" for name in names])


def running_total(
    df: DataFrame, groups: list[str], cell: str, order: list[Column], value: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows of the group that come before the row.

    No group meets in one task: ``cell`` (not NULL, ascending with ``order``) cuts every group into parts of bounded
    size, rows are summed within their part, and the totals of the parts, one row each, give what comes before it.
    Groups may be NULL. ``order`` must be total up to equal rows.
    """
    part = [*groups, cell]
    totals = df.groupBy(*part).agg(F.sum(value).alias("_part_total"))
    before_part = F.sum("_part_total").over(
        W.Window.partitionBy(*groups).orderBy(cell).rowsBetween(W.Window.unboundedPreceding, -1)
    )
    starts = totals.select(*part, F.coalesce(before_part, F.lit(0)).alias("_part_start"))
    before_row = F.sum(value).over(
        W.Window.partitionBy(*part).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, -1)
    )
    inner = df.withColumn("_row_start", F.coalesce(before_row, F.lit(0)))
    joined = left_by(inner, starts, part)
    return joined.withColumn(name, F.col("_part_start") + F.col("_row_start")).drop("_part_start", "_row_start")


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key columns ..., runs) to the same with runs that overlap or touch made one."""
    for batch in batches:
        runs = batch.column(batch.num_columns - 1)
        flat, kind = runs.flatten(), runs.type.value_type
        starts, stops = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        offsets = np.asarray(runs.offsets).astype(np.int64)
        offsets -= offsets[0]
        # Each row's runs are moved behind all of the rows before it, so that they never meet.
        moved = np.repeat(np.arange(batch.num_rows), np.diff(offsets)) * (stops.max(initial=0) + 1)
        reached = np.maximum.accumulate(stops + moved)
        head = np.ones(len(starts), bool)
        head[1:] = (starts + moved)[1:] > reached[:-1]
        head[offsets[:-1][np.diff(offsets) > 0]] = True
        first = np.flatnonzero(head)
        last = np.append(first, len(starts))[1:] - 1
        merged = pa.StructArray.from_arrays(
            [pa.array(x, kind.field(i).type) for i, x in enumerate((starts[first], (reached - moved)[last]))],
            names=[kind.field(i).name for i in range(2)],
        )
        places = pa.array(np.searchsorted(first, offsets).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.ListArray.from_arrays(places, merged)], names=batch.schema.names
        )


def merge_runs(df: DataFrame) -> DataFrame:
    """The rows, with the runs of the last column merged: an ascending list of (start, stop), no list missing.

    Runs that overlap or touch become one. The time taken grows with the number of runs.
    """
    ship(df.sparkSession)
    return df.mapInArrow(_merging, df.schema)
