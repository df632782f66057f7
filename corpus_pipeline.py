"""From raw documents to token files: quality rules, near-duplicates, benchmark passages, mixing, token output."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from numprep.llm.common import shared_folder
from numprep.llm.dart_minhash import keep_one
from numprep.llm.line_quality import keep_good
from numprep.llm.mixing import measured, mix
from numprep.llm.token_files import read_index, write_tokens
from numprep.llm.winnow import clean


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep enough of their own words, without the lines that too many documents of a source share."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    packed = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_doc"))
    mixed = mix(measured(packed, "mix").drop("text"))
    return mixed.select("_doc", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("_doc.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and from them one row for each: doc_id, start, n_tokens, ids_crc32."""
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_index(spark, path)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]

#: Hashes of words, darts and tokenizers are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on, each written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
