"""Packing documents into fixed windows by minimum bin slack.

A document's tokens, with an end token, fill whole windows first; what remains is shorter than a
window.  The remainders of a group (consecutive documents of one partition, up to ``GROUP_TOKENS``
tokens) form a multiset of lengths.  Each window starts with the longest remainder; a bitset
subset-sum dynamic programme over the counted lengths picks what fills it closest to capacity, the
counts are traced back, and the same pattern is used as often as the counts allow.  Windows that
cannot be filled are joined, cut at the capacity, and the last one is cut into powers of two.

Documents are packed where they are read: no shuffle, no driver, memory bounded by the group.
A lost task repeats the same scan and gives the same pieces.

Defined results: a null or empty text is the end token alone; equal rows are packed separately;
further columns are ignored; an empty table gives no rows; a text longer than a group is one group.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_units import byte_bpe
from .common import small_batches, texts

WINDOW = 1024
GROUP_TOKENS = 4_000_000
END = array("I", [0]).tobytes()
PIECES = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def best_fill(target: int, counts: list[tuple[int, int]]) -> Counter[int]:
    """The counted lengths whose sum comes closest to the target from below.

    >>> sorted(best_fill(10, [(7, 1), (4, 2), (3, 1)]).elements())
    [3, 7]
    """
    reach, mask, trail = 1, (1 << (target + 1)) - 1, []
    for length, n in counts:
        if length > target:
            continue
        left, step = min(n, target // length), 1
        trail.append((length, left, reach))
        while left:
            step = min(step, left)
            reach |= (reach << (step * length)) & mask
            left -= step
            step *= 2
        if reach >> target & 1:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, n, before in reversed(trail):
        used = next(k for k in range(n + 1) if k * length <= at and before >> (at - k * length) & 1)
        if used:
            chosen[length] = used
            at -= used * length
    return chosen


def patterns(lengths: Counter[int], window: int = WINDOW) -> Iterator[tuple[Counter[int], int]]:
    """(multiset of lengths, how many windows hold it) until no length is left."""
    left = Counter({length: n for length, n in lengths.items() if n})
    while left:
        seed = max(left)
        left[seed] -= 1
        chosen = best_fill(window - seed, [(x, left[x]) for x in sorted(left, reverse=True) if left[x]])
        left[seed] += 1
        chosen[seed] += 1
        times = min(left[length] // n for length, n in chosen.items())
        yield chosen, times
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]


def packed(sizes: list[int], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); all but powers of two are full."""
    remainders: dict[int, list[int]] = {}
    for document, size in enumerate(sizes):
        for start in range(0, size - size % window, window):
            yield [(document, start, window)]
        if size % window:
            remainders.setdefault(size % window, []).append(document)
    loose: list[tuple[int, int, int]] = []
    for pattern, times in patterns(Counter({length: len(x) for length, x in remainders.items()}), window):
        for _ in range(times):
            sequence = []
            for length, n in pattern.items():
                for _ in range(n):
                    document = remainders[length].pop()
                    sequence.append((document, sizes[document] - length, length))
            if sum(length for _, _, length in sequence) == window:
                yield sequence
            else:
                loose += sequence
    loose.reverse()
    total = sum(length for _, _, length in loose)
    while total:
        room = window if total >= window else 1 << (total.bit_length() - 1)
        total -= room
        sequence = []
        while room:
            document, start, length = loose.pop()
            taken = min(room, length)
            sequence.append((document, start, taken))
            room -= taken
            if taken < length:
                loose.append((document, start + taken, length - taken))
        yield sequence


def pack(docs: DataFrame, ranks: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: its document, place and ids there, and its sequence and offset.

    ``ids`` are little-endian unsigned 32-bit integers.  ``sequence_id`` holds the partition in its
    upper bits, so it is unique without counting across tasks.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(key, F.col(text).alias("text"))
    schema = f"`{key}` {rows.schema[0].dataType.simpleString()}, {PIECES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sequence_id = byte_bpe(ranks), TaskContext.get().partitionId() << 33
        kind = None
        keys: list = []
        coded: list[bytes] = []

        def told() -> Iterator[pa.RecordBatch]:
            nonlocal sequence_id
            out: list[tuple] = []
            for sequence in packed([len(ids) // 4 for ids in coded], window):
                offset = 0
                for document, start, length in sequence:
                    ids = coded[document]
                    out.append((keys[document], start, length, ids[4 * start : 4 * (start + length)], len(ids) // 4, sequence_id, offset))
                    offset += length
                sequence_id += 1
                if len(out) >= 4096:
                    yield rows_of(out)
                    out = []
            if out:
                yield rows_of(out)
            keys.clear()
            coded.clear()

        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        held = 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for name, value in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                keys.append(name)
                coded.append(coder.encode(value) + END)
                held += len(coded[-1]) // 4
                if held >= GROUP_TOKENS:
                    yield from told()
                    held = 0
        if coded:
            yield from told()

    return rows.mapInArrow(run, schema)
