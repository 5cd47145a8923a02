"""A training-data pipeline over the documents table: quality, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns the next one's documents, all but the last with
the columns of ``documents``; further columns of the input are dropped.  A null text is empty.
Every stage works on all rows it is given; a stage is written as Parquet before the next one reads.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.llm import anchor_pii, compression_quality, signature_join, slack_packing
from spendloom.session import scratch_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3  # a document of a lower probability of being good goes
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject; it learns from the labels of the given documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = compression_quality.fit(docs, labels)
    kept = compression_quality.scored(docs.select(*COLUMNS), model)
    return kept.where(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; documents without words stay.

    Repeated rows of that id are one document: the row of the smallest text digest, lang, source and length stays.
    Rows without an id belong to no group; of those with one text the smallest row stays.
    """
    found = signature_join.groups(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    copies = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    row = F.struct(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "n_chars")])
    told = F.struct(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), row.alias("row"), F.md5(F.to_json(F.struct(*COLUMNS))).alias("whole"))
    keyed = docs.select(*COLUMNS, key.alias("_key"))
    # A narrow table of what goes and what repeats, so texts are joined once.
    repeated = keyed.groupBy("_key").agg(F.count("*").alias("n"), F.min(told).alias("least")).where("n > 1")
    goes = copies.select(F.col("doc_id").cast("string").alias("_key"), F.lit(True).alias("goes"))
    decided = repeated.select("_key", "least").unionByName(goes, allowMissingColumns=True)
    decided = decided.groupBy("_key").agg(F.min("least").alias("_least"), F.max("goes").alias("_goes"))
    kept = keyed.join(decided, "_key", "left").where("_goes IS NULL")
    alone = kept.where("_least IS NULL").select(*COLUMNS)
    chosen = kept.where(told == F.col("_least"))
    one = chosen.groupBy("_key").agg(F.any_value(F.struct(*COLUMNS)).alias("one")).select("one.*")
    return alone.unionByName(one)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    clean = anchor_pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of each document in sequences of 1024 tokens."""
    pieces = slack_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]
ORACLE_SQL = None  # no stage can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_folder(spark)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
