"""Language identification by rank-order profiles.

A language's profile is its ``PROFILE`` most frequent n-grams of one to three characters, in order of
frequency over all texts to learn from.  A document's own most frequent n-grams are ranked the same way
and compared with each profile: an n-gram costs the difference of its two ranks, one that the profile
lacks costs ``PROFILE``.  The language of the least sum wins.

N-grams are taken from words (runs of letters and marks, in lower case) with a border on each side.  An
n-gram is one number, its code points side by side, so counting is sorting of numbers.  Tasks sum counts by
language before the shuffle, so neither a frequent language nor a frequent n-gram is a hot key; a
profile is a top-k that each task cuts first, and profiles are the only rows the driver sees:
languages times ``PROFILE``.

Defined results: a null text, and one without a letter, is ``und`` with score 0, as is every text when
nothing can be learnt; ties between n-grams go to the smaller code, between languages to the smaller
name; repeated rows are counted and returned repeatedly; rows with a null language or text teach nothing;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches

PROFILE = 400
BORDER = 32
SLICE = 1 << 20  # characters turned into n-grams at once
BUFFER = 1 << 22  # n-grams a task holds before it sums them
UNKNOWN = "und"


@lru_cache(maxsize=1)
def kinds() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter or mark, is a letter) by code point."""
    initials = np.array([ord(unicodedata.category(chr(point))[0]) for point in range(0x110000)], np.uint8)
    letters = initials == ord("L")
    return letters | (initials == ord("M")), letters


def points_of(text: str) -> np.ndarray:
    """Code points of a text in lower case."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text, as numbers, slice by slice."""
    words, _ = kinds()
    held = np.array([BORDER], np.int64)
    for start in range(0, len(text) + 1, SLICE):
        points = points_of(text[start : start + SLICE])
        points = np.where(words[points], points, BORDER).astype(np.int64)
        if start + SLICE > len(text):
            points = np.append(points, BORDER)
        before = len(held)
        stream = np.concatenate([held, points])
        border = stream == BORDER
        keep = np.ones(len(stream), bool)
        keep[1:] = ~(border[1:] & border[:-1])
        keep[:before] = True
        stream = stream[keep]
        new = stream[before:]
        yield new[new != BORDER]
        yield stream[before - 1 : -1] << 21 | new
        middle = stream[1:-1]
        yield (stream[:-2] << 42 | middle << 21 | stream[2:])[middle != BORDER]
        held = stream[-2:]


def has_letter(text: str) -> bool:
    """Whether any character is a letter."""
    _, letters = kinds()
    return any(letters[points_of(text[start : start + SLICE])].any() for start in range(0, len(text), SLICE))


def counted(parts: list[np.ndarray], weights: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct numbers in order, how often each occurs, or the sum of its weights)."""
    numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if weights is None:
        return np.unique(numbers, return_counts=True)
    distinct, places = np.unique(numbers, return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, places, np.concatenate(weights))
    return distinct, sums


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs in each language's texts (lang, text)."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def settle() -> None:
            for lang, parts in held.items():
                new = counted(parts)
                old = sums.get(lang)
                sums[lang] = new if old is None else counted([old[0], new[0]], [old[1], new[1]])
            held.clear()

        def told() -> Iterator[pa.RecordBatch]:
            for lang, (codes, counts) in sums.items():
                columns = [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in grams(text):
                    held[lang].append(part)
                    size += len(part)
                    if size > BUFFER:
                        settle()
                        size = 0
            if sum(len(codes) for codes, _ in sums.values()) > BUFFER:
                yield from told()
        settle()
        yield from told()

    known = texts.select(F.col("lang").cast("string").alias("lang"), F.col("text").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    found = known.mapInArrow(run, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Profiles:
    """The languages' ranked n-grams as one table: a row of ranks for each language, a column for each n-gram."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.langs = sorted(ranked)
        self.codes = np.unique(np.array([code for codes in ranked.values() for code in codes], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)  # the last column: in no profile
        for row, lang in enumerate(self.langs):
            self.ranks[row, np.searchsorted(self.codes, ranked[lang])] = np.arange(len(ranked[lang]))

    def distances(self, text: str) -> np.ndarray | None:
        """The out-of-place distance to each language, as a share of the largest possible; None without letters."""
        if not self.langs or not has_letter(text):
            return None
        codes, counts = counted(list(grams(text)))
        own = codes[np.lexsort((codes, -counts))[:PROFILE]]
        places = np.searchsorted(self.codes, own)
        places[places == len(self.codes)] = 0
        places = np.where(self.codes[places] == own, places, len(self.codes))
        ranks = self.ranks[:, places]
        apart = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))))
        return apart.sum(1) / (PROFILE * len(own))


def learn(docs: DataFrame, from_rows: Column, lang: str = "lang", text: str = "text") -> Profiles:
    """The profiles of all languages in the rows that may be learnt from."""
    counts = gram_counts(docs.where(from_rows).select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    ranked: dict[str, list[int]] = defaultdict(list)
    for row in sorted(top.collect(), key=lambda row: (row.lang, row.rank)):  # languages times PROFILE
        ranked[row.lang].append(row.gram)
    return Profiles(ranked)


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, margin): the nearest language, its closeness, and how much farther the next one is."""
    small_batches(docs.sparkSession)

    def one(value: str | None) -> tuple[str, float, float]:
        apart = profiles.distances(value or "")
        if apart is None:
            return UNKNOWN, 0.0, 0.0
        best, *others = np.argsort(apart, kind="stable")[:2]
        return profiles.langs[best], float(1 - apart[best]), float(apart[others[0]] - apart[best]) if others else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(value) for value in batch.column(1).to_pylist()]
            langs, scores, margins = zip(*found, strict=True) if found else ((), (), ())
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "lang_pred", "score", "margin"])

    rows = docs.select(key, F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, lang_pred string, score double, margin double")
