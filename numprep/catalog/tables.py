"""Types, sinks, sizes and generated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.catalog.registry import query, table
from numprep.operators import align, conform, restrict
from numprep.plans import ColumnSpec
from numprep.sources import (
    dataset_gib,
    generate_columns,
    read_table,
    rows_for_bytes,
    scratch_path,
    stored_bytes,
    unpack_samples,
    write_table,
)
from numprep.sources.generate import COLUMNS, MASK, MULTIPLIER, stream_salt

_SEED = 7


@query("""
select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) as p_size, p_retailprice from part
""")
def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    return conform(table(spark, folder, "part"))


@query("select p_size, p_brand from part")
def align_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part")
    configured = restrict(df, [ColumnSpec("p_size"), ColumnSpec("p_brand", prefix="Brand#")])
    return align(df.select("p_name", "p_brand", "p_size"), configured)


@query("select c_custkey, c_name, c_acctbal from customer")
def chunked_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    write_table(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal"), path, rows_per_file=500)
    return read_table(spark, path)


@query("select count(*) as rows, cast(0 as bigint) as files_too_long from customer")
def chunk_lengths(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    write_table(table(spark, folder, "customer"), path, rows_per_file=500)
    files = read_table(spark, path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 500).alias("files_too_long"))


_TEXTS_SQL = """
select event_id, ts, value, props, case doc_id % 4 when 0 then null when 1 then '' when 2 then ' ' || text || ' '
  else '"' || text || '\\' || chr(13) || chr(10) end as text
from events left join documents on event_id = doc_id
"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Times to the microsecond, and texts with blanks, quotes, backslashes and line breaks, empty and missing ones."""
    events = table(spark, folder, "events").select("event_id", "ts", "value", "props")
    documents = table(spark, folder, "documents")
    kind, text = F.col("doc_id") % 4, F.col("text")
    odd = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(kind == 3, F.concat(F.lit('"'), text, F.lit("\\\r\n")))
    )
    return events.join(documents.select(F.col("doc_id").alias("event_id"), odd.alias("text")), "event_id", "left")


def _written(spark: SparkSession, folder: str, file_format: str) -> DataFrame:
    df, path = _texts(spark, folder), scratch_path(spark, file_format)
    write_table(df, path, file_format)
    return read_table(spark, path, file_format, df.schema)


@query(_TEXTS_SQL)
def csv_table(spark: SparkSession, folder: str) -> DataFrame:
    return _written(spark, folder, "csv")


@query(_TEXTS_SQL)
def json_table(spark: SparkSession, folder: str) -> DataFrame:
    return _written(spark, folder, "json")


def _uniforms_sql() -> str:
    """The generator's integer arithmetic, one subquery per step."""

    def columns(expression: str) -> str:
        return ", ".join(expression.format(i=i, salt=stream_salt(_SEED, i)) + f" as x{i}" for i in range(len(COLUMNS)))

    scrambled = f"((xor(x{{i}} >> 16, x{{i}}) * {MULTIPLIER}) & {MASK})"
    mixed = f"((xor(xor(x{{i}}, high) >> 16, xor(x{{i}}, high)) * {MULTIPLIER}) & {MASK})"
    sql = f"select o_orderkey as id, (o_orderkey >> 32) & {MASK} as high, "
    sql += columns(f"xor(o_orderkey & {MASK}, {{salt}}::bigint)") + " from orders"
    for step in (scrambled, mixed, scrambled):
        sql = f"select id, high, {columns(step)} from ({sql})"
    return f"select id, {columns(f'xor(x{{i}} >> 16, x{{i}}) / {MASK + 1}.0::double')} from ({sql})"


@query(f"""
select id as o_orderkey, cast(floor(x0 * 30) as bigint) + 1 as day_of_month,
  cast(round_even(x1 * 100.0 * 100.0, 0) / 100.0 + 0.0 as varchar) || 'cm' as height,
  '$' || cast(round_even(x2 * 10000.0 * 100.0, 0) / 100.0 + 0.0 as varchar) as account_balance,
  '$' || cast(round_even((x3 - 0.5) * 10000.0 * 100.0, 0) / 100.0 + 0.0 as varchar) as net_profit,
  cast(round_even(x4 * 5.0 * 100.0, 0) / 100.0 + 0.0 as varchar) || 'stars' as customer_ratings,
  cast(floor(x5 * 99999) as bigint) + 1 as leaderboard_rank
from ({_uniforms_sql()})
""")
def generate_table(spark: SparkSession, folder: str) -> DataFrame:
    """One generated row for every order."""
    return generate_columns(table(spark, folder, "orders"), "o_orderkey", seed=_SEED)


@query("""
select o_orderstatus, count(*) as rows, count(*) * 600 / 1073741824.0::double as gib,
  cast(floor(count(*) * 1000 / 600.0::double) as bigint) as rows_planned
from orders group by o_orderstatus
""")
def plan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Estimated size of the rows, and the rows that 1000 bytes for each would hold."""
    counted = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("rows"))
    return counted.select(
        "o_orderstatus",
        "rows",
        dataset_gib(F.col("rows")).alias("gib"),
        rows_for_bytes(F.col("rows") * 1000).alias("rows_planned"),
    )


@query("select sum(strlen(c_custkey || '|' || c_name) + 1)::bigint as bytes from customer")
def stored_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Size of a table written as lines of text."""
    path = scratch_path(spark, "lines")
    lines = table(spark, folder, "customer").select(F.concat_ws("|", "c_custkey", "c_name"))
    write_table(lines, path, "text")
    return stored_bytes(spark, path, "*.txt").select("bytes")


@query("""
select vec_id, generate_subscripts(embedding, 1) - 1 as sample, unnest(embedding)::double as level,
  unnest(embedding[1:3] || [null for x in embedding[4:]])::double as part from embeddings
""")
def metric_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Parallel lists of a run, of which one is shorter, as rows."""
    runs = table(spark, folder, "embeddings").withColumn("start", F.slice("embedding", 1, 3))
    samples = unpack_samples(runs, ["vec_id"], {"level": "embedding", "part": "start"}, position="sample")
    return samples.select("vec_id", F.col("sample").cast("long").alias("sample"), *[F.col(c).cast("double").alias(c) for c in ("level", "part")])
