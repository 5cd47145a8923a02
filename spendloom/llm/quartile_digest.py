"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every byte triplet of a text is hashed into one of ``BUCKETS`` buckets.  The counts' quartiles cut
the buckets into four classes of two bits each; the digest is a header (length on a logarithmic
scale, in two hex digits) and the classes in hex.  Two digests are compared by the summed class
differences and the length difference, each bounded, so the likeness lies between 0 and 1.

Only counts of one text are held at a time.  Finding each document's neighbour in descending order
shuffles every text once, into range partitions of the id.

Defined results: a null text is empty; an empty text has the digest of no triplets; two digests of
no triplets are alike to 1, one of none and one of some to 0; equal texts have equal digests; rows
with equal ids are ordered by text, null ids come last; one document is its own neighbour; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

BUCKETS = 512
LENGTH_STEPS = 8  # steps of the length code to a doubling
LENGTH_SPAN = 24  # length difference, in steps, from which likeness is at its lowest
EDITED = [
    ("doc_id", "bigint"),
    ("n_chars", "bigint"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
]
WALKED = [("part", "bigint"), ("role", "string"), ("text", "string"), *EDITED]
KINDS = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}


def batch_of(rows: list[tuple], columns: list[tuple[str, str]]) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True)) or [()] * len(columns)
    arrays = [pa.array(value, KINDS[kind]) for value, (_, kind) in zip(values, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in columns])


def bucket_counts(data: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """How many of the byte triplets fall into each bucket."""
    values = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(values) < 3:
        return np.zeros(buckets, np.int64)
    mixed = (values[:-2] | values[1:-1] << np.uint32(8) | values[2:] << np.uint32(16)) * np.uint32(2654435761)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(2246822519)
    return np.bincount(mixed >> np.uint32(32 - (buckets - 1).bit_length()), minlength=buckets)


def digest(data: bytes, buckets: int = BUCKETS) -> str:
    """Length code and bucket classes in hex; "-" marks a text without triplets."""
    counts = bucket_counts(data, buckets)
    if not counts.any():
        return "-"
    quartiles = np.sort(counts)[[buckets // 4 - 1, buckets // 2 - 1, buckets * 3 // 4 - 1]]
    classes = (counts[:, None] > quartiles).sum(1).astype(np.uint8).reshape(-1, 4)
    packed = classes[:, 0] | classes[:, 1] << 2 | classes[:, 2] << 4 | classes[:, 3] << 6
    length = min(255, int(np.log2(len(data)) * LENGTH_STEPS))
    return f"{length:02x}{packed.tobytes().hex()}"


def classes_of(fingerprint: str) -> tuple[int, np.ndarray]:
    packed = np.frombuffer(bytes.fromhex(fingerprint[2:]), np.uint8)
    return int(fingerprint[:2], 16), (packed[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).astype(np.int16)


def likeness(one: str, other: str) -> float:
    """1 for equal digests, 0 for the largest bounded difference."""
    if one == other:
        return 1.0
    if "-" in (one, other):
        return 0.0
    (length, a), (other_length, b) = classes_of(one), classes_of(other)
    body = float(np.abs(a - b).sum()) / (3 * a.size)
    span = min(1.0, abs(length - other_length) / LENGTH_SPAN)
    return 1.0 - 0.9 * body - 0.1 * span


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of each row's whole text, where it is read."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [digest(value or b"") for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], names=[key, "fingerprint"])

    rows = docs.select(key, F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next document."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compared(row: tuple, next_text: str, next_digest: str) -> tuple:
    """The result columns of a row (doc_id, text, digest) and the document after it."""
    doc_id, text, own = row
    edited = edited_text(text, next_text).encode()
    changed = digest(edited)
    sha = hashlib.sha256(edited).hexdigest()
    return doc_id, len(text), sha, own, changed, likeness(own, changed), likeness(own, next_digest)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's digest, that of its edited text and of the next document, and their likeness.

    Texts are sorted by range partitions.  A task finishes all its rows but the last, whose next
    document opens the following partition; those few rows are joined to it afterwards.
    """
    spark = docs.sparkSession
    small_batches(spark)
    order = [F.desc_nulls_last("doc_id"), F.asc("text")]
    texts_of = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = texts_of.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                row = (doc_id, text, digest(text.encode()))
                if held is None:
                    out.append((part, "first", text, doc_id, None, None, row[2], None, None, None))
                else:
                    out.append((part, "row", None, *compared(held, row[1], row[2])))
                held = row
            yield batch_of(out, WALKED)
        if held is not None:
            doc_id, text, own = held
            yield batch_of([(part, "last", text, doc_id, None, None, own, None, None, None)], WALKED)

    rows = written(ordered.mapInArrow(walk, ", ".join(f"{name} {kind}" for name, kind in WALKED)))
    parts = sorted(row.part for row in rows.where("role = 'last'").select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part bigint, after bigint")
    last = rows.where("role = 'last'").select("part", "doc_id", "text", "fingerprint")
    first = rows.where("role = 'first'").select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    ends = last.join(following, "part").join(first, "after").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            yield batch_of([compared(row[:3], row[3], row[4]) for row in zip(*columns, strict=True)], EDITED)

    finished = ends.mapInArrow(finish, ", ".join(f"{name} {kind}" for name, kind in EDITED))
    return rows.where("role = 'row'").select(*[name for name, _ in EDITED]).unionByName(finished)
