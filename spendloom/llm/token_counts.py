"""Token counts as delta-maintained rollups.

A rollup holds additive totals (documents, tokens) by source, language and tokenizer version.  It is
changed by batches of signed rows: an insert adds a document and its tokens, a delete takes them
off, a revised count takes the old one off and adds the new one.  A batch is summed by key before it
is written (combined in each task, so a hot source is a few rows), and it is committed under a name
of its own: its folder is complete when Spark's ``_SUCCESS`` marker is there, readers see complete
folders only, and a batch whose name is committed is not applied again.  A failed or repeated job
therefore changes nothing, and totals are the sum over committed batches.  ``compact`` rewrites
the batches as one and remembers their names.

Defined results: null source, language or version is a key of its own; a null or empty text has no
tokens; a null number in a signed row counts as zero; repeated rows count repeatedly; keys whose
totals are zero stay, so that deletions can be seen; further columns are ignored; an empty batch
commits and changes nothing.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .byte_units import byte_bpe
from .common import small_batches, texts
from .transducer_bpe import units

KEYS = ["source", "lang", "tokenizer"]
SUMS = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
NAMES = "name string"
MEMO_ENTRIES = 400_000  # units a worker remembers; when full it starts anew


class WordTokens:
    """Numbers of tokens under a vocabulary that drops white space: of each unit once, all new units of a batch in one call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, int] = {}

    def counts(self, values: list[str]) -> list[int]:
        """Each text's number of tokens."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        split, memo = list(map(units, values)), self.memo
        new = [unit for unit in set(chain.from_iterable(split)) if unit not in memo]
        memo.update(zip(new, [len(x.ids) for x in self.tokenizer.encode_batch(new, add_special_tokens=False)], strict=True))
        return [sum(map(memo.__getitem__, parts)) for parts in split]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One counter, with its memory of units, per worker."""
    return WordTokens(path)


def token_numbers(docs: DataFrame, ranks: str, words: str, text: str = "text") -> DataFrame:
    """The rows (doc_id, source, lang) with their tokens under a byte-level and a word vocabulary, from one reading of the texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, counter = byte_bpe(ranks), word_tokens(words)
        for batch in batches:
            values = texts(batch)
            of_bytes = pa.array([len(coder.encode(value)) // 4 for value in values], pa.int64())
            of_words = pa.array(counter.counts(values), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], of_bytes, of_words], names=["doc_id", "source", "lang", "byte_tokens", "word_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, source string, lang string, byte_tokens bigint, word_tokens bigint")


def of_version(numbers: DataFrame, tokens: str, version: str) -> DataFrame:
    """Counted rows (doc_id, source, lang, tokens, tokenizer) of one of the columns of ``token_numbers``."""
    return numbers.select("doc_id", "source", "lang", F.col(tokens).alias("tokens"), F.lit(version).alias("tokenizer"))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Inserts (1) or deletes (-1) of counted documents."""
    tokens = F.coalesce("tokens", F.lit(0)) * F.lit(sign)
    return counts.select(*KEYS, F.lit(sign).cast("bigint").alias("documents"), tokens.cast("bigint").alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old counts off, the new ones on."""
    return signed(old, -1).unionByName(signed(new, 1))


class TokenRollup:
    """Totals kept in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.files = path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def complete(self, kind: str) -> list[str]:
        """Names of the complete folders of a kind."""
        top = self.path(f"{self.folder}/{kind}")
        found = self.files.listStatus(top) if self.files.exists(top) else []
        return sorted(s.getPath().getName() for s in found if self.files.exists(self.path(s.getPath(), "_SUCCESS")))

    def generation(self) -> tuple[str | None, set[str]]:
        """(newest compacted generation, names of the batches in it)."""
        done = self.complete("compacted")
        if not done:
            return None, set()
        path = f"{self.folder}/compacted/{done[-1]}"
        names = self.spark.read.schema(NAMES).parquet(f"{self.folder}/names/{done[-1]}")
        return path, {row.name for row in names.collect()}

    def committed(self) -> set[str]:
        """Names of all batches that have been applied."""
        return self.generation()[1] | set(self.complete("batches"))

    def apply(self, name: str, rows: DataFrame) -> bool:
        """Commit a batch of signed rows; False if its name is committed already."""
        if name in self.committed():
            return False
        sums = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        sums.repartition(1).write.mode("overwrite").parquet(f"{self.folder}/batches/{name}")  # one row for each key
        return True

    def parts(self) -> list[str]:
        """The folders that add up to the totals."""
        path, names = self.generation()
        return ([path] if path else []) + [f"{self.folder}/batches/{name}" for name in self.complete("batches") if name not in names]

    def totals(self) -> DataFrame:
        """Documents and tokens by key over all committed batches."""
        parts = self.parts()
        rows = self.spark.read.schema(SUMS).parquet(*parts) if parts else self.spark.createDataFrame([], SUMS)
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def compact(self) -> None:
        """Rewrite all committed batches as a new generation; the names are written first, the marker of the sums makes it valid."""
        names = sorted(self.committed())
        number = f"{len(self.complete('compacted')) + 1:09d}"
        self.spark.createDataFrame([(name,) for name in names], NAMES).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/names/{number}")
        self.totals().repartition(1).write.mode("overwrite").parquet(f"{self.folder}/compacted/{number}")
