"""A corpus from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but the
last return the columns of ``documents``. Null, empty, very long, repeated and tied rows are handled
as the operators' docstrings say; an empty table passes all stages as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credit_marts.llm import content_sort, curve_pack, minhash, secret_crf, toxicity
from credit_marts.llm.common import Steps, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a model of the labelled ones outside of fold 0."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    ship(spark)
    return docs.where(toxicity.score(model, F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those that differ in the case of A-Z at most: the one with the largest id."""
    return content_sort.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 of 100 five-word shingles: the one with the smallest
    id. Rows are compared and dropped each for itself, whatever ids they share. Documents with a null
    id are all kept."""
    named = docs.where("doc_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    rows = Steps(spark).store(named.select("row", F.struct(*docs.columns).alias("doc")), codec="zstd")
    texts = rows.select("row", F.col("doc.text").alias("text"))
    groups = minhash.near_duplicates(texts, size=5, percent=80, id_col="row").select("id", "component_id")
    ids = rows.select(F.col("row").alias("id"), F.col("doc.doc_id").alias("doc_id"))
    first = F.min(F.struct("doc_id", F.col("id").alias("row"))).alias("first")
    kept = groups.join(ids, "id").groupBy("component_id").agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select("doc.*").unionAll(docs.where("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked and their length brought up to date."""
    field = secret_crf.fit(docs)
    masked = docs.withColumn("text", secret_crf.mask_secrets(docs, F.col("text"), field))
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, in sequences of 1024 tokens."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return curve_pack.pack(docs, ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

# Scores of a trained model, masks and the order along a curve are beyond SQL; the tests hold every
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs, steps = spark.read.parquet(f"{sf_dir}/documents.parquet"), Steps(spark)
    for _, stage in STAGES[:-1]:
        docs = steps.store(stage(spark, docs, sf_dir), codec="zstd")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
