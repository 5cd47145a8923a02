"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.session import scratch_folder

from . import (
    anchor_pii,
    compression_quality,
    context_mixing,
    hnsw,
    license_scan,
    merkle_manifest,
    quartile_digest,
    rank_profiles,
    signature_join,
    slack_packing,
    token_alignment,
    token_counts,
    transducer_bpe,
)
from .common import fold, table, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[build.__name__] = build
    return build


@query
def op2_transducer_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded with the word vocabulary."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return transducer_bpe.encode_digests(docs, transducer_bpe.build_lexicon(docs, tokenizer), tokenizer)


@query
def op4_minimum_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    pieces = slack_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_quartile_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's digest, next to that of its edited text and of the next document."""
    return quartile_digest.edited_fingerprints(table(spark, folder, "documents", "doc_id", "text"))


@query
def op6_anchor_expansion(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text."""
    found = anchor_pii.scan(table(spark, folder, "documents", "doc_id", "text"))

    def of(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = joined(F.filter("spans", lambda span: span["kind"].isin(*anchor_pii.BASE)))
    return found.select(
        "doc_id",
        *[of(kind) for kind in anchor_pii.KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op3_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's quality; four fifths of the ids may be learnt from."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality")
    model = compression_quality.fit(docs, labels.where(fold("doc_id", 5) != 0))
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return compression_quality.score(docs, model).select("doc_id", held_out, "score", predicted)


@query
def op7_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query
def op8_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's log probability, learnt from nine tenths of the ids."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    scored = context_mixing.score(docs, fold("doc_id", 10) != 0)
    held_out = (fold("doc_id", 10) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_signature_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose three-word shingles agree to nine tenths."""
    return signature_join.groups(table(spark, folder, "documents", "doc_id", "text"), 3, 90)


@query
def op10_license_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices and whole licence texts in every text."""
    known = license_scan.NOTICES | license_scan.whole_texts()
    templates = spark.createDataFrame(list(known.items()), "license string, text string")
    return license_scan.scan(table(spark, folder, "documents", "doc_id", "text"), templates)


@query
def op1_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Token totals after three commits: all documents come in, toxic ones go, and those of low quality are counted anew by words."""
    docs = table(spark, folder, "documents", "doc_id", "source", "lang", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    paths = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
    numbers = written(token_counts.token_numbers(docs, *paths))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    poor = labels.where("quality = 0").select("doc_id").distinct().join(toxic, "doc_id", "left_anti")
    counts = token_counts.of_version(numbers, "byte_tokens", "byte_bpe_50k")
    again = numbers.join(poor, "doc_id", "left_semi")
    old, new = token_counts.of_version(again, "byte_tokens", "byte_bpe_50k"), token_counts.of_version(again, "word_tokens", "word_bpe_49k")
    rollup = token_counts.TokenRollup(spark, scratch_folder(spark))
    load = token_counts.signed(counts, 1)
    rollup.apply("load", load)
    rollup.apply("toxic", token_counts.signed(counts.join(toxic, "doc_id", "left_semi"), -1))
    rollup.compact()
    rollup.apply("recount", token_counts.revised(old, new))
    rollup.apply("load", load)  # committed already: changes nothing
    return rollup.totals()


@query
def op11_rank_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's language; four fifths of the ids may be learnt from."""
    docs = table(spark, folder, "documents", "doc_id", "lang", "text")
    profiles = rank_profiles.learn(docs, fold("doc_id", 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return rank_profiles.predict(docs, profiles).select("doc_id", held_out, "lang_pred", "score", "margin")


@query
def op12_merkle_climb(spark: SparkSession, folder: str) -> DataFrame:
    """Every row's leaf and proof in the manifest of all documents, and what half of them, tampered with, fold to."""
    return merkle_manifest.verified(table(spark, folder, "documents", *merkle_manifest.COLUMNS))


@query
def op13_tokenizer_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every text's groups of tokens of two vocabularies, and how common their links are in the corpus."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
