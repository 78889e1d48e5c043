"""A training corpus from raw documents: toxic documents go, one of each group of near copies stays, secrets are masked, the rest is packed.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm import jaccard_join, packing, secrets, toxicity
from screenlake.llm.common import scratch_path, table, written

SHINGLE_WORDS = 5
NEAR_PERCENT = 80
END_ID = 1
CAPACITY = 2048
BATCH_BYTES = 2 << 20


def bounded(spark: SparkSession) -> None:
    """Lets Arrow batches follow their bytes, as texts may be long: ten thousand of them at a time fill an executor's memory twice, beside the heap and in the Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half.

    Nulls and empty texts have the model's score of nothing. Repeated rows all stay or go; other columns, whatever their names, pass through. Without labelled
    toxic documents all stay.
    """
    bounded(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, keep=True)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group that near copies link.

    Rows that repeat an id are one document: one of them stays. Rows without an id stay, as do null texts and texts without words, which link with nothing.
    """
    bounded(spark)
    found = jaccard_join.linked_components(docs, SHINGLE_WORDS, NEAR_PERCENT)
    by_id = found.filter("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    moved = written(by_id.filter("component_id < doc_id or rows > 1"), "moved")
    once = docs.join(moved.filter("component_id = doc_id").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    once = once.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
    return docs.join(moved.select("doc_id"), "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text masked and n_chars brought up to date. Null texts stay null; repeated rows stay; other columns pass through."""
    bounded(spark)
    masked = secrets.redacted(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most CAPACITY. A null or empty text has the end id alone; repeated rows are packed once each."""
    bounded(spark)
    return packing.sequences(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [("toxicity", drop_toxic), ("near copies", one_of_near_copies), ("secrets", mask_secrets), ("packing", pack)]
ORACLE_SQL = None  # a learned classifier decides what the first stage drops


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"stage-{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
