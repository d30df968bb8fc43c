"""The corpus pipeline: five stages from raw documents to a mix at target weights.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the last return the
columns of ``documents``. Null ids, null texts and repeated rows pass like others: stages remove rows, not
ids, and of each near-dedup group one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry.functions.scale import new_folder, settle
from opstelemetry.llm import decontam, mixing, quality, secrets, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.cascade(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id stays; null ids come last, then contents decide."""
    order = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*docs.columns).alias("content"), F.monotonically_increasing_id().alias("row")
    )
    keyed = settle(docs.withColumn("__order", order))
    found = simhash.near_duplicates(keyed, length=3, max_bits=2, key="__order")
    gone = settle(found.where("__order.row != component_id.row").select(F.col("__order.row").alias("__gone")))
    return keyed.join(gone, F.col("__order.row") == F.col("__gone"), "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, without those it leaves out."""
    return mixing.mixed(docs).where("taken > 0")


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("mixing sources", source_mix),
]

#: SimHash has no SQL counterpart; tests/llm compares the run with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
