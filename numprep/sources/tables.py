"""Table files: scans, sinks and stored sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.plans.model import quoted

_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# A missing value is \\N in CSV, which no written text is: backslashes in texts are doubled.
_OPTIONS = {
    "csv": {
        "header": "true",
        "escape": '"',
        "nullValue": "\\N",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        **_TIMES,
    },
    "json": _TIMES,
}


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: change(quoted(name)) for name in names}) if names else df


def _one_line(text: Column) -> Column:
    """Backslashes doubled and line breaks as \\n and \\r, so that each row of a file is one line and files can be split."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _all_lines(text: Column) -> Column:
    """What ``_one_line`` was made from. Every sequence starts with a backslash, so pairs of them are found from the left."""

    def broken(part: Column) -> Column:
        for written, plain in (("\\n", "\n"), ("\\r", "\r")):
            part = F.replace(part, F.lit(written), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), broken), "\\")


def read_table(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    foreign: bool = False,
) -> DataFrame:
    """File, folder of part files, or glob. CSV and JSON need a schema: inferring one reads the data twice.

    Tables that ``write_table`` has written come back as they were, whatever their texts. CSV of other writers is
    ``foreign``: a backslash is a backslash, quoted cells may hold line breaks, and an empty cell is missing.
    """
    if schema is None and file_format in ("csv", "json"):
        raise ValueError(f"a schema is needed to read {file_format}")
    reader = spark.read.format(file_format).options(**_OPTIONS.get(file_format, {}))
    if foreign and file_format == "csv":
        reader = reader.options(nullValue="", multiLine="true")
    df = (reader if schema is None else reader.schema(schema)).load(path)
    return _texts(df, _all_lines) if file_format == "csv" and not foreign else df


def write_table(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "errorifexists",
    rows_per_file: int | None = None,
) -> None:
    """Write in parallel, one or more files per partition and none longer than ``rows_per_file`` rows.

    CSV keeps blanks, quotes, missing and empty texts apart; backslashes and line breaks in texts are escaped by a
    backslash, and a missing value is ``\\N``. Times have microseconds.
    """
    if file_format == "csv":
        df = _texts(df, _one_line)
    # An empty text is written as a pair of quotes, and read as what is between them.
    writer = df.write.format(file_format).mode(mode).options(**_OPTIONS.get(file_format, {}))
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)


def stored_bytes(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """File count, bytes and GiB below a path. Only the file listing is used; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("length")
    )
    total = F.coalesce(F.sum("length"), F.lit(0))
    return files.agg(F.count("*").alias("files"), total.alias("bytes"), (total / F.lit(2.0**30)).alias("gib"))
