"""Quality by compression: two zstandard dictionaries and a calibrated size difference.

One dictionary is trained on text labelled good, one on text labelled bad.  A text is cut into
blocks of ``BLOCK_BYTES``, so that a long text cannot outgrow the dictionaries, and every block is
compressed with both.  The difference of the two sizes for each byte is the evidence; a logistic
calibration, which also sees the mean compressed size and the length that the evidence depends on,
turns it into a probability that the text is good.

Fitting reads a bounded sample: ``SAMPLE_ROWS`` labelled rows of each class in the order of a hash,
and of each a slice of ``SLICE_CHARS`` characters whose place the hash picks.  One half trains the
dictionaries, the other calibrates, weighted to the classes' shares among all labels.  Scoring
compresses every whole text where it is read.

Defined results: a null text is empty, an empty text has a score like any other; labels that are
null or neither 0 nor 1 are left out; if a class has no labelled text, every score is the share of
good labels (0.5 without labels); equal texts have equal scores; repeated rows stay; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, texts

SAMPLE_ROWS = 2000  # of each class
SLICE_CHARS = 2000
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 512
LEVEL = 1
RIDGE = 1.0


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; small enough to travel with each task."""

    good: bytes
    bad: bytes
    center: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """A compressor over a trained dictionary, plain text as dictionary, or none."""
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)


def blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


def trained(samples: list[str]) -> bytes:
    """A dictionary of the samples; their text itself where there is too little to train on."""
    parts = [block for sample in samples for block in blocks(sample)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def evidence(text: str, good: bytes, bad: bytes) -> tuple[float, float, float]:
    """(size difference, mean size) for each byte, and the length on a logarithmic scale."""
    with_good, with_bad = compressor(good).compress, compressor(bad).compress
    small = large = total = 0
    for block in blocks(text):
        small += len(with_good(block))
        large += len(with_bad(block))
        total += len(block)
    return ((large - small) / total, (large + small) / 2 / total, float(np.log(total))) if total else (0.0, 0.0, 0.0)


def design(features: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, bounded, with their squares and products."""
    z = np.clip((features - center) / scale, -6, 6)
    crossed = [z[:, i] * z[:, j] for i in range(z.shape[1]) for j in range(i, z.shape[1])]
    return np.column_stack([np.ones(len(z)), z, *crossed])


def calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps that are halved until the loss falls."""

    def loss(w: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, -(2 * y - 1) * (x @ w)) + RIDGE / 2 * w[1:] @ w[1:])

    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [RIDGE] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve((x.T * (weight * p * (1 - p) + 1e-9)) @ x + ridge, gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on a bounded sample of the labelled rows; give only labels that may be learnt from."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    shares = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    place = F.xxhash64("key")
    picked = [known.where(F.col("label") == c).orderBy(place, "key").limit(SAMPLE_ROWS) for c in (0, 1)]
    wanted = picked[0].union(picked[1])
    start = F.lit(1) + F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.lit(1), F.length("text") - SLICE_CHARS))
    sliced = F.substring(F.coalesce("text", F.lit("")), start.cast("int"), F.lit(SLICE_CHARS))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(wanted), "key")  # at most 2 * SAMPLE_ROWS
    found = rows.select("key", "label", sliced.alias("text"), place.alias("place")).dropDuplicates(["key", "label"]).collect()
    found.sort(key=lambda row: (row.place, row.key))
    total = sum(shares.values())
    by_class = [[row.text for row in found if row.label == c] for c in (0, 1)]
    if not all(len(each) > 1 for each in by_class):
        share = shares.get(1, 0) / total if total else 0.5
        return Model(b"", b"", (0.0,) * 3, (1.0,) * 3, (float(np.clip(np.log((share + 1e-12) / (1 - share + 1e-12)), -30, 30)), *[0.0] * 9))
    bad, good = (trained(each[::2]) for each in by_class)
    rest = [(c, text) for c in (0, 1) for text in by_class[c][1::2]]
    features = np.array([evidence(text, good, bad) for _, text in rest])
    y = np.array([c for c, _ in rest], float)
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (1 - y).sum())
    weight *= len(y) / weight.sum()
    center, scale = features.mean(0), features.std(0) + 1e-6
    weights = calibrated(design(features, center, scale), y, weight)
    return Model(good, bad, tuple(center), tuple(scale), tuple(weights))


def probabilities(values: list[str], model: Model) -> np.ndarray:
    features = np.array([evidence(value, model.good, model.bad) for value in values]).reshape(-1, 3)
    linear = design(features, np.array(model.center), np.array(model.scale)) @ np.array(model.weights)
    return 1 / (1 + np.exp(-np.clip(linear, -35, 35)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): the probability that each whole text is good."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = probabilities(texts(batch), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[key, "score"])

    rows = docs.select(key, F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, score double")


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The rows as they are, with a score; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    schema = docs.drop(name).schema
    place = schema.fieldNames().index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [value or "" for value in batch.column(place).to_pylist()]
            yield batch.append_column(name, pa.array(probabilities(values, model), pa.float64()))

    return docs.drop(name).mapInArrow(run, T.StructType([*schema.fields, T.StructField(name, T.DoubleType())]))
