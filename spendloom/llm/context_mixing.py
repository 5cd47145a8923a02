"""Language-model scoring by logistic context mixing.

The model predicts the bits of a token sequence: the bytes of each word, then a separator; a
separator at the start of a word ends the document, so the probabilities of all sequences add up to
one at most.  ``CONTEXTS`` bit predictors look up exact counts of zeros and ones by (context, bits of
the byte so far); contexts are the last 1, 2, 3, 4 and 6 bytes of the word, and all its bytes so far.
Their stretched probabilities are combined with weights that a gate picks (place in the word, how
many contexts are known, bit), learnt online, and an adaptive probability map refines the result.

These contexts begin with the word, so their part is done once for each distinct word of the corpus:

1. texts are read once and rewritten as word codes in blocks of ``BLOCK_BYTES``, each with a word
   list of its own and the words' counts in training documents; a list is cut into slices by a hash;
2. the lists are summed, slice by slice, to the corpus word table (base counts; it grows with the
   corpus);
3. the table is dealt to portions, ``ASKED_TOGETHER`` of them to a holder; a holder sends its
   (context, next byte) pairs with their counts to slices by key, whose number follows the size of
   the table; a slice sums equal pairs and answers every holder with the exact counts on its bytes'
   paths, each node that some paths share once.  Nothing has a fixed size: contexts are told apart
   by 56 bits of a hash;
4. each task learns mixing weights online over its words, every word seen without one of its own
   occurrences; weights are averaged over tasks, and a second pass counts the refining map under the
   averaged weights;
5. the word table is scored, its slices answer the blocks' lists, and documents are added up.

Keys and counts travel packed (sorted keys by their steps, counts by bytes), and a written table goes
when its successor is written.

The previous word is a context as well: a word's probability is
(times it followed + ``PRIOR`` x the above) / (times the previous word was seen + ``PRIOR``); pairs of
words are counted exactly, by 64 bits of a hash, in slices that answer the blocks.

A text also adapts the model: training documents fall into ``GROUPS`` groups by their most frequent
word, a word is likelier in some groups than in others, and the groups' weights follow the words
read so far (a Bayesian mixture, whose product over a text is a sum over groups).

Counts, weights and map use all training words.  A lost task repeats only its part.

Defined results: a null or empty text is the end token alone; without training documents every
count is zero; equal texts have equal scores; repeated rows stay; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.session import scratch_folder

from .common import discard, runs, small_batches, written, written_to

BLOCK_BYTES = 6_000_000
ORDERS = (1, 2, 3, 4, 6)  # and the whole word so far
CONTEXTS = len(ORDERS) + 1
PORTION_BYTES = 40_000  # bytes of words that meet their counts at once
ASKED_TOGETHER = 10  # portions that ask for their counts together
SLICE_KEYS = 4_000_000  # (context, next byte) pairs in a slice, at most about
PAIR_SLICES = 512  # slices of the pairs of words
WORD_BITS = 9  # bits of a word's hash that tell its slice
PRIOR = 10.0  # words that the model without the previous word counts for besides the words that followed it
TOKENS_AT_ONCE = 100_000
RATE = 0.05
MAP_STEPS = 33  # places of the refining map between -8 and 8
SEPARATOR = 0x20
GROUPS = 16  # groups of training documents, by a hash of their most frequent word
GROUP_PRIOR = 3.0  # words that a word's group shares count for besides its own
LIFT_STEPS = 32  # steps of a stored lift to a power of ten
PLACES, TRUSTED = 3, 10  # groups of places in a word; levels of trust in the longest context
LEVELS = TRUSTED + CONTEXTS - 1
GATES = PLACES * LEVELS * 8
MIX = np.uint64(0x9E3779B97F4A7C15)
UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOG_COUNT = np.log(np.arange(65536) + 0.03).astype(np.float32)
COMPRESS, EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
TRUST = np.minimum(np.log2(np.maximum(np.arange(1 << TRUSTED), 1)).astype(np.int64), TRUSTED - 1)
Portions = Iterator[tuple]  # words, their counts and, if they were asked for already, what is seen of them
Tables = tuple[np.ndarray, np.ndarray]  # sorted keys of (context, next byte) and their counts


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -11, 11)))


class Positions:
    """All bytes of some words, one after another, each word with its separator, and their contexts."""

    def __init__(self, words: list[bytes]):
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.bytes = np.frombuffer(bytes([SEPARATOR]).join([*words, b""]), np.uint8).astype(np.int64)
        total = len(self.bytes)
        self.place = np.arange(total) - np.repeat(self.starts, lengths)
        self.word = np.repeat(np.arange(len(words)), lengths)
        values = self.bytes.astype(np.uint64) + np.uint64(1)
        hashes = []
        state = np.zeros(total, np.uint64)
        for k in range(1, max(ORDERS) + 1):
            before = np.zeros(total, np.uint64)
            before[k:] = values[:-k]
            state = np.where(self.place >= k, (state + before) * MIX + np.uint64(k), state)
            if k in ORDERS:
                hashes.append(state ^ (state >> np.uint64(29)))
        # All bytes so far: a sum of bytes times powers, brought back to the word's start.
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total - 1, MIX)])) if total else values
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total - 1, UNMIX)])) if total else values
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers)])[:-1]
        first = self.starts[self.word]
        whole = (sums - sums[first]) * back[first] + self.place.astype(np.uint64)
        hashes.append(whole ^ (whole >> np.uint64(31)))
        self.hashes = [h * np.uint64(2 * i + 3) + np.uint64(i) for i, h in enumerate(hashes)]

    def keys(self) -> np.ndarray:
        """(context, next byte) as a number: context after context, every position."""
        mixed = [(h ^ (h >> np.uint64(32))) * MIX for h in self.hashes]
        return np.concatenate([(h & ~np.uint64(255)) | self.bytes.astype(np.uint64) for h in mixed])

    def bits(self) -> Iterator[tuple[int, np.ndarray]]:
        """(index, bit) for each of the eight bits."""
        for index in range(8):
            yield index, self.bytes >> (7 - index) & 1


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> Tables:
    """Equal keys once, in order, with the sum of their counts."""
    unique, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True)
    return unique, np.bincount(place, np.concatenate([np.zeros(0), *counts]), len(unique)).astype(np.int64)


def path_totals(tables: Tables, asked: np.ndarray) -> np.ndarray:
    """(9, asked): how often each context was seen with the first 0 to 8 bits of the byte."""
    keys, counts = tables
    before = np.concatenate([[0], np.cumsum(counts)])
    totals = np.empty((9, len(asked)), np.int64)
    for depth in range(9):
        open_bits = np.uint64((1 << (8 - depth)) - 1)
        first, last = asked & ~open_bits, asked | open_bits
        totals[depth] = before[np.searchsorted(keys, last, "right")] - before[np.searchsorted(keys, first, "left")]
    return totals


def new_nodes(keys: np.ndarray) -> np.ndarray:
    """(9, keys): whether a key is the first, in their order, with its context and first 0 to 8 bits."""
    new = np.ones((9, len(keys)), bool)
    step = keys[1:] ^ keys[:-1]
    for depth in range(9):
        new[depth, 1:] = step >= np.uint64(1 << (8 - depth))
    return new


def own_totals(tables: Tables) -> np.ndarray:
    """(9, keys): ``path_totals`` of all keys of the tables themselves."""
    keys, counts = tables
    totals = np.empty((9, len(keys)), np.int64)
    for depth, new in enumerate(new_nodes(keys)):
        node = np.cumsum(new) - 1
        totals[depth] = np.bincount(node, counts)[node]
    return totals


def path_steps(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The totals of sorted keys without repetition: of each new node its total's distance from the one above, key after key."""
    return np.concatenate([totals[:1], totals[:-1] - totals[1:]]).T[new_nodes(keys).T]


def from_steps(keys: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The totals that ``path_steps`` has packed."""
    new = new_nodes(keys)
    each = np.zeros((len(keys), 9), np.int64)
    each[np.ascontiguousarray(new.T)] = steps
    totals = np.empty((9, len(keys)), np.int64)
    for depth in range(9):
        first = np.flatnonzero(new[depth])
        step = np.repeat(each[first, depth], np.diff(first, append=len(keys)))
        totals[depth] = totals[depth - 1] - step if depth else step
    return totals


def log_count(n: np.ndarray) -> np.ndarray:
    found = LOG_COUNT.take(n, mode="clip")
    large = n >= len(LOG_COUNT)
    if large.any():
        found[large] = np.log(n[large] + 0.03)
    return found


class Seen:
    """The positions of some words, their (context, next byte) pairs in order and, once they are told, the totals on the pairs' paths."""

    def __init__(self, words: list[bytes]):
        self.at = Positions(words)
        self.keys, place = np.unique(self.at.keys(), return_inverse=True)
        self.place = place.reshape(CONTEXTS, -1)
        self.rows = np.ascontiguousarray(self.place.T)
        self.first_gate = np.where(self.at.place == 0, 0, np.where(self.at.place < 3, 1, 2)) * LEVELS
        self.totals: np.ndarray | None = None


class Model:
    """Exact counts, mixing weights (gates, contexts + 1) and the refining map."""

    def __init__(self, tables: Tables | None, weights: np.ndarray | None = None, refined: np.ndarray | None = None):
        self.tables, self.weights, self.refined = tables, weights, refined

    def seen(self, words: list[bytes]) -> Seen:
        """What is seen of some words in the model's own tables."""
        seen = Seen(words)
        seen.totals = path_totals(self.tables, seen.keys)
        return seen

    def totals(self, at: Positions, told: np.ndarray | None) -> np.ndarray:
        """(contexts, 9, positions): the totals on each byte's path; ``told`` holds them by key in order."""
        unique, place = np.unique(at.keys(), return_inverse=True)
        found = path_totals(self.tables, unique) if told is None else told
        return found[:, place].reshape(9, CONTEXTS, -1).transpose(1, 0, 2)

    def inputs(self, seen: Seen, index: int, without: bool) -> tuple[np.ndarray, np.ndarray]:
        """(stretched predictions and a bias, gate) of a bit; ``without`` takes one off the count of the bit itself."""
        own, other = seen.totals[index + 1], seen.totals[index] - seen.totals[index + 1]
        if without:
            own = own - (own > 0)
        known = own + other
        # Positions that share a key share all but their gate.
        bit = (seen.keys >> np.uint64(7 - index) & np.uint64(1)).astype(np.float32)
        stretched = np.clip((log_count(own) - log_count(other)) * (2 * bit - 1), -10, 10)
        x = np.empty((len(seen.rows), CONTEXTS + 1), np.float32)
        x[:, :CONTEXTS] = stretched.take(seen.rows)
        x[:, CONTEXTS] = 0.3
        level = np.zeros(len(seen.rows), np.int8)
        met = (known > 0).view(np.int8)
        for k in range(1, CONTEXTS - 1):
            np.maximum(level, met.take(seen.place[k]) * np.int8(k), out=level)
        whole = known.take(seen.place[CONTEXTS - 1])
        level = np.where(whole > 0, CONTEXTS - 1 + TRUST.take(whole, mode="clip"), level)
        return x, (seen.first_gate + level) * 8 + index

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.einsum("nk,nk->n", x, self.weights.astype(np.float32).take(gate, axis=0))

    def map_places(self, gate: np.ndarray, linear: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower place in the map, share of the upper one)."""
        scaled = (np.clip(linear, -7.999, 7.999) + 8) * ((MAP_STEPS - 1) / 16)
        low = scaled.astype(np.int64)
        return gate * MAP_STEPS + low, scaled - low

    def log10(self, words: list[bytes], seen: Seen | None = None) -> np.ndarray:
        """log10 probability of each word with its separator."""
        seen = seen or self.seen(words)
        total = np.zeros(len(seen.at.bytes))
        for index, bit in seen.at.bits():
            x, gate = self.inputs(seen, index, False)
            linear = self.mixed(x, gate)
            low, upper = self.map_places(gate, linear)
            refined = self.refined.take(low) * (1 - upper) + self.refined.take(low + 1) * upper
            p = np.clip((squash(linear) + refined) / 2, 1e-5, 1 - 1e-5)
            total += np.log10(np.where(bit == 1, p, 1 - p))
        return np.add.reduceat(total, seen.at.starts)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(word, digest_size=8).digest() for word in words), np.uint64)


def word_slices(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """The slice of each word; the end's is the first."""
    return np.where(np.fromiter(map(len, words), np.int64, len(words)) == 0, 0, (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))


def pair_keys(hashes: np.ndarray, documents: list[np.ndarray]) -> np.ndarray:
    """A number for each word of the documents and its end with the word before it (the end before the first)."""
    every = np.concatenate([np.append(codes, np.uint32(0)) for codes in documents])
    lengths = np.array([len(codes) + 1 for codes in documents])
    before = np.concatenate([[np.uint32(0)], every[:-1]])
    before[np.cumsum(lengths)[:-1]] = 0
    mixed = (hashes[before] * MIX + np.uint64(1)) ^ (hashes[before] >> np.uint64(31))
    mixed = (mixed + hashes[every]) * MIX
    return (mixed ^ (mixed >> np.uint64(29))) * MIX


def slice_edges(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """(slices that have keys, edges of their runs) of sorted keys; a slice is a range of keys."""
    number = ((keys >> np.uint64(48)) * np.uint64(slices)) >> np.uint64(16)
    own, first = np.unique(number, return_index=True)
    return own.astype(np.int64), np.append(first, len(keys))


def squeezed(data: bytes) -> bytes:
    return COMPRESS.compress(data)


def expanded(data: bytes) -> bytes:
    return EXPAND.decompress(data)


def pressed(values: np.ndarray) -> bytes:
    """Numbers by bytes: all first bytes, all second ones, and so on."""
    return squeezed(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def unpressed(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(expanded(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def packed(values: np.ndarray) -> bytes:
    """Counts, mostly small: a byte each, and the large ones whole behind them."""
    values = np.ascontiguousarray(values, np.int64).reshape(-1)
    small = squeezed(np.minimum(values, 255).astype(np.uint8).tobytes())
    return len(small).to_bytes(4, "little") + small + pressed(values[values >= 255])


def unpacked(data: bytes) -> np.ndarray:
    upto = 4 + int.from_bytes(data[:4], "little")
    values = np.frombuffer(expanded(data[4:upto]), np.uint8).astype(np.int64)
    values[values == 255] = unpressed(data[upto:], np.int64)
    return values


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their steps."""
    return pressed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpressed(data, np.uint64), dtype=np.uint64)


def packed_words(words: list[bytes]) -> bytes:
    """Words hold no space."""
    return squeezed(b" ".join(words))


def unpacked_words(data: bytes) -> list[bytes]:
    return expanded(data).split(b" ")


def group_of(codes: np.ndarray, words: list[bytes]) -> int:
    """The group of a training document: a hash of its most frequent word, ties to the smaller word."""
    found, times = np.unique(codes, return_counts=True)
    return crc32(min((words[c] for c in found[times == times.max(initial=0)]), default=b"")) % GROUPS


def tokenised(docs: DataFrame, trains: Column, key: str, text: str) -> DataFrame:
    """Blocks: rows of documents as word codes (kind 1), of each block's word list (kind 0) and of its pairs of words (kind 2).

    ``code`` is a slice: of words, whose codes ascend with it, or of pairs.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(trains, F.lit(False)).alias("trains"), F.col(text).cast("binary").alias("text"))
    key_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        keys: list = []
        codes: list[array] = []
        learns: list[bool] = []
        kind = None
        vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)

        def told() -> Iterator[pa.RecordBatch]:
            hashes = word_hashes(list(vocabulary))
            slices = word_slices(list(vocabulary), hashes)
            order = np.argsort(slices, kind="stable")  # the end stays first
            number = np.empty(len(order), np.uint32)
            number[order] = np.arange(len(order), dtype=np.uint32)
            listed = list(vocabulary)
            words = [listed[i] for i in order.tolist()]
            documents = [number[np.frombuffer(c, np.uint32)] for c in codes]
            members: list[list[np.ndarray]] = [[] for _ in range(GROUPS)]
            for own in (d for d, t in zip(documents, learns, strict=True) if t):
                members[group_of(own, words)].append(np.append(own, np.uint32(0)))
            times = np.array([np.bincount(np.concatenate(x) if x else np.zeros(0, np.int64), minlength=len(words)) for x in members])
            own, first = np.unique(slices[order], return_index=True)
            cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(words)], strict=True))
            yield batch_of(0, code=own, codes=[packed(times[:, a:b]) for a, b in cuts], word=[packed_words(words[a:b]) for a, b in cuts])
            pairs_of, place = np.unique(pair_keys(hashes[order], documents), return_inverse=True)
            times_of = np.bincount(place, np.repeat(np.array(learns, np.float64), [len(c) + 1 for c in documents]), len(pairs_of))
            own, edge = slice_edges(pairs_of, PAIR_SLICES)
            cuts = list(zip(edge[:-1], edge[1:], strict=True))
            yield batch_of(2, code=own, codes=[packed_keys(pairs_of[a:b]) for a, b in cuts], word=[packed(times_of[a:b]) for a, b in cuts])
            yield batch_of(1, key=pa.array(keys, kind), codes=[squeezed(c.tobytes()) for c in documents])

        def batch_of(which: int, codes: list[bytes], **columns: object) -> pa.RecordBatch:
            kinds = {"key": kind, "codes": pa.binary(), "word": pa.binary(), "code": pa.int32()}
            columns["codes"] = codes
            arrays = [pa.array(columns[name], k) if name in columns else pa.nulls(len(codes), k) for name, k in kinds.items()]
            head = [pa.array([which] * len(codes), pa.int32()), pa.array([block] * len(codes), pa.int64())]
            return pa.RecordBatch.from_arrays([*head, *arrays], names=["kind", "block", *kinds])

        held = 0
        vocabulary[b""]
        for batch in batches:
            kind = batch.schema.field(0).type
            for name, learn, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys.append(name)
                learns.append(learn)
                codes.append(array("I", map(vocabulary.__getitem__, (data or b"").lower().split())))
                held += len(data or b"")
                if held >= BLOCK_BYTES:
                    yield from told()
                    block, held = block + 1, 0
                    keys, codes, learns = [], [], []
                    vocabulary = defaultdict(count().__next__)
                    vocabulary[b""]
        if keys:
            yield from told()

    return rows.mapInArrow(run, f"kind int, block bigint, key {key_type}, codes binary, word binary, code int")


def word_table(lists: DataFrame) -> DataFrame:
    """(word, n, counts by group) of the blocks' word lists (code, codes, word); words that no training document holds count zero."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, "code"):
            place: defaultdict[bytes, int] = defaultdict(count().__next__)
            parts = []
            for words, times in zip(rows.column("word").to_pylist(), rows.column("codes").to_pylist(), strict=True):
                at = np.fromiter(map(place.__getitem__, unpacked_words(words)), np.int64)
                parts.append((at, unpacked(times).reshape(GROUPS, -1)))
            sums = np.zeros((len(place), GROUPS), np.int64)
            for at, times in parts:
                sums[at] += times.T
            word_at, group = np.nonzero(sums)
            starts = np.searchsorted(word_at, np.arange(len(place) + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(group, pa.int32()), pa.array(sums[word_at, group], pa.int64())], names=["g", "n"])
            columns = [pa.array(list(place), pa.binary()), pa.array(sums.sum(1), pa.int64()), pa.ListArray.from_arrays(pa.array(starts), pairs)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "counts"])

    dealt = lists.select("code", "codes", "word").repartition("code").sortWithinPartitions("code")
    return dealt.mapInArrow(add, "word binary, n bigint, counts array<struct<g:int,n:bigint>>")


def tally_bits(portions: Portions) -> Tables:
    """Counts by (context, next byte) of some words."""
    keys, counts = [], []
    for words, times in portions:
        at = Positions(words)
        keys.append(at.keys())
        counts.append(np.tile(times[at.word].astype(np.float64), CONTEXTS))
    return summed(keys, counts)


def learn_online(portions: Portions, model: Model, learns: bool = True, maps: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Change a model's weights online; returns the tokens each gate has seen, and (ones, all bits) by place of the map.

    The map is counted on predictions before they are learnt from, or not at all without ``maps``;
    without ``learns`` the weights stay.
    """
    squares = np.full((GATES, CONTEXTS + 1), 1e-6)
    seen_all, ones, mass = np.zeros(GATES), np.zeros(GATES * MAP_STEPS), np.zeros(GATES * MAP_STEPS)
    for words, counts, *told in portions:
        known = told[0] if told else model.seen(words)
        weight = counts[known.at.word].astype(np.float64)
        for index, bit in known.at.bits():
            x, gate = model.inputs(known, index, True)
            linear = model.mixed(x, gate)
            if maps:
                low, upper = model.map_places(gate, linear)
                for place, share in ((low, weight * (1 - upper)), (low + 1, weight * upper)):
                    mass += np.bincount(place, share, len(mass))
                    ones += np.bincount(place, share * bit, len(mass))
            if not learns:
                continue
            error = weight * (bit - squash(linear))
            seen = np.bincount(gate, weight, GATES)
            seen_all += seen
            own = seen > 0
            for k in range(CONTEXTS + 1):
                step = np.bincount(gate, error * x[:, k], GATES)[own] / seen[own]
                squares[own, k] += step * step
                model.weights[own, k] += RATE * step / np.sqrt(squares[own, k])
    return seen_all, ones, mass


def first_weights() -> np.ndarray:
    return np.full((GATES, CONTEXTS + 1), 0.3)


def map_from(ones: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """How often the bit was one, from the mixed probability itself where little was seen."""
    middle = np.tile(squash(np.linspace(-8, 8, MAP_STEPS)), GATES)
    return (ones + 20 * middle) / (mass + 20)


def sixteen_bits(tables: Tables) -> Tables:
    """The counts as the model takes them: exact; they were cut to sixteen bits once."""
    return tables


def holders(words: DataFrame, shares: np.ndarray) -> DataFrame:
    """The word table (word, n, counts by group) dealt to holders: (holder, words, n, lift, ends), ends of their portions."""
    portion, together = PORTION_BYTES, ASKED_TOGETHER

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holder = TaskContext.get().partitionId() << 33
        held, times, lifts, ends, length = [], [], [], [], 0

        def told() -> pa.RecordBatch:
            blobs = packed_words(held), packed(np.array(times)), squeezed(b"".join(lifts))
            columns = [pa.array([holder], pa.int64()), *(pa.array([blob], pa.binary()) for blob in blobs), pa.array([ends], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, names=["holder", "words", "n", "lift", "ends"])

        for batch in batches:
            counts = batch.column("counts")
            each = np.zeros((batch.num_rows, GROUPS))
            flat = counts.flatten()
            each[counts.value_parent_indices().to_numpy(), flat.field("g").to_numpy()] = flat.field("n").to_numpy()
            lift = (each + GROUP_PRIOR * shares) / (each.sum(1, keepdims=True) + GROUP_PRIOR) / shares
            steps = np.clip(np.rint(np.log10(lift) * LIFT_STEPS), -127, 127).astype(np.int8)
            for word, n, row in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), steps, strict=True):
                held.append(word)
                times.append(n)
                lifts.append(row.tobytes())
                length += len(word) + 1
                if length >= portion:
                    ends.append(len(held))
                    length = 0
                    if len(ends) >= together:
                        yield told()
                        holder += 1
                        held, times, lifts, ends = [], [], [], []
        if held:
            if length:
                ends.append(len(held))
            yield told()

    return words.select("word", "n", "counts").mapInArrow(deal, "holder bigint, words binary, n binary, lift binary, ends array<int>")


def asked(words: DataFrame, shares: np.ndarray) -> tuple[DataFrame, str]:
    """Holders of the word table (words, n, lift, ends, told) with the totals on their bytes' paths over the whole table; the folder they are in."""
    spark = words.sparkSession
    size = words.agg(F.sum(F.octet_length("word") + 1)).first()[0] or 0
    slices = min(65536, -(-size * CONTEXTS // SLICE_KEYS) or 1)
    dealt_path, path = scratch_folder(spark), scratch_folder(spark)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = tally_bits((at, n) for at, n in portions_of(row))
                own, edge = slice_edges(keys, slices)
                cuts = list(zip(edge[:-1], edge[1:], strict=True))
                blobs = [packed_keys(keys[a:b]) for a, b in cuts], [packed(counts[a:b]) for a, b in cuts]
                columns = [pa.array([row["holder"]] * len(own), pa.int64()), pa.array(own, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)]
                yield pa.RecordBatch.from_arrays(columns, names=["holder", "slice", "keys", "counts"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, "holder"):
            told = packed(np.concatenate([unpacked(part) for part in rows.column("counts").to_pylist()[1:]]))
            head = rows.slice(0, 1).combine_chunks().to_batches()[0]
            columns = [head.column(name) for name in ("words", "n", "lift", "ends")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([told], pa.binary())], names=["words", "n", "lift", "ends", "told"])

    dealt = written_to(dealt_path, holders(words, shares))
    asking = dealt.select("holder", "words", "n", "ends").mapInArrow(ask, "holder bigint, slice int, keys binary, counts binary")
    answers = answered(asking, slices, True)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("words", "binary"), ("n", "binary"), ("lift", "binary"), ("ends", "array<int>"))]
    heads = dealt.select("holder", F.lit(-1).alias("slice"), F.lit(None).cast("binary").alias("counts"), "words", "n", "lift", "ends")
    met = heads.unionByName(answers.select("holder", "slice", "counts", *empty)).repartition("holder").sortWithinPartitions("holder", "slice")
    told = written_to(path, met.mapInArrow(join, "words binary, n binary, lift binary, ends array<int>, told binary"))
    discard(spark, dealt_path)
    return told, path


def evidence(words: DataFrame, shares: np.ndarray) -> DataFrame:
    """Portions of the word table (words, n, lift, told) with the totals on their bytes' paths over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, n, seen, lift in told_portions(batches):
            kinds = [pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            columns = [own, n.tolist(), lift.tobytes(), zstandard.compress(seen.totals.tobytes(), 1)]
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)], names=["words", "n", "lift", "told"])

    return asked(words, shares)[0].mapInArrow(run, "words array<binary>, n array<bigint>, lift binary, told binary")


def answered(asking: DataFrame, slices: int, paths: bool) -> DataFrame:
    """(holder, slice, counts): for the keys of each row (holder, slice, keys, counts) the sums over all rows, or the steps of the totals on their paths."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in runs(batches, "slice"):
            keys = [unpacked_keys(k) for k in rows.column("keys").to_pylist()]
            unique, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(place, np.concatenate([unpacked(c) for c in rows.column("counts").to_pylist()]), len(unique)).astype(np.int64)
            if paths:
                totals = own_totals((unique, sums))
            start = 0
            for holder, own in zip(rows.column("holder").to_pylist(), keys, strict=True):
                at = place[start : start + len(own)]
                start += len(own)
                found = path_steps(own, totals[:, at]) if paths else sums[at]
                columns = [pa.array([holder], pa.int64()), pa.array([number], pa.int32()), pa.array([packed(found)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["holder", "slice", "counts"])

    dealt = (asking.repartition(slices, "slice") if paths else asking.repartition("slice")).sortWithinPartitions("slice")
    return dealt.mapInArrow(answer, "holder bigint, slice int, counts binary")


def portions_of(holder: dict) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, counts) of the portions of a holder."""
    words, n, start = unpacked_words(holder["words"]), unpacked(holder["n"]), 0
    for end in holder["ends"]:
        yield words[start:end], n[start:end]
        start = end


def told_portions(batches: Iterator[pa.RecordBatch]) -> Portions:
    """(words, counts, what is seen of them, lift if it was read) of the portions."""
    for batch in batches:
        for row in batch.to_pylist():
            portions = [(words, n, Seen(words)) for words, n in portions_of(row)]
            keys = np.unique(np.concatenate([seen.keys for _, _, seen in portions]))
            totals = from_steps(keys, unpacked(row["told"]))
            lift = np.frombuffer(expanded(row["lift"]), np.int8).reshape(-1, GROUPS) if "lift" in row else None
            start = 0
            for words, n, seen in portions:
                seen.totals = totals.take(np.searchsorted(keys, seen.keys), axis=1)
                yield words, n, seen, None if lift is None else lift[start : start + len(words)]
                start += len(words)
                seen.totals = None


def summed_cells(parts: DataFrame) -> dict[tuple[int, int], tuple[float, float]]:
    """Sums of (value, mass) by (row, column); as many as the model has cells."""
    sums = parts.groupBy("row", "col").agg(F.sum("value").alias("value"), F.sum("mass").alias("mass"))
    return {(r.row, r.col): (r.value, r.mass) for r in sums.collect()}


CELLS = "row int, col int, value double, mass double"


def cells(row: np.ndarray, col: np.ndarray, value: np.ndarray, mass: np.ndarray) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((row, col, value, mass), kinds, strict=True)], names=["row", "col", "value", "mass"])


def learnt(portions: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(weights, refining map): weights are averaged by the tokens each gate has seen in a task; the map is counted under the averaged ones."""
    known = portions.select("words", "n", "ends", "told")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(None, first_weights())
        seen, _, _ = learn_online(told_portions(batches), model, maps=False)
        gate, k = np.nonzero((seen > 0)[:, None] & np.ones(CONTEXTS + 1, bool))
        if len(gate):
            yield cells(gate, k, model.weights[gate, k] * seen[gate], seen[gate])

    weights = first_weights()
    for (row, col), (value, seen) in summed_cells(known.mapInArrow(learn, CELLS)).items():
        weights[row, col] = value / seen

    def count_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, ones, mass = learn_online(told_portions(batches), Model(None, weights), learns=False)
        place = np.nonzero(mass)[0]
        if len(place):
            yield cells(place // MAP_STEPS, place % MAP_STEPS, ones[place], mass[place])

    ones, mass = np.zeros((GATES, MAP_STEPS)), np.zeros((GATES, MAP_STEPS))
    for (row, col), (value, seen) in summed_cells(known.mapInArrow(count_map, CELLS)).items():
        ones[row, col], mass[row, col] = value, seen
    return weights, map_from(ones.ravel(), mass.ravel())


def scored_words(portions: DataFrame, weights: np.ndarray, refined: np.ndarray) -> DataFrame:
    """(slice, word, n, score, lift) of every word of the corpus; lift holds, for each group, how much likelier the word is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(None, weights, refined)
        for words, n, seen, lift in told_portions(batches):
            own = word_slices(words, word_hashes(words))
            kinds = [pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.binary()]
            columns = [own, words, n, model.log10(words, seen), [row.tobytes() for row in lift]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["slice", "word", "n", "score", "lift"])

    return written(portions.mapInArrow(run, "slice int, word binary, n bigint, score double, lift binary"))


def told_words(lists: DataFrame, scored: DataFrame) -> DataFrame:
    """(block, code, codes, score, lift): for each slice of the blocks' word lists (block, code, word) the words' counts, scores and lifts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in runs(batches, "code"):
            size = int(pc.sum(pc.less(rows.column("block"), 0)).as_py())
            head, asking = rows.slice(0, size), rows.slice(size)
            place = dict(zip(head.column("word").to_pylist(), range(size), strict=True))
            n, score = head.column("n").to_numpy(), head.column("score").to_numpy()
            lift = np.frombuffer(b"".join(head.column("lift").to_pylist()), np.int8).reshape(-1, GROUPS)
            for block, words in zip(asking.column("block").to_pylist(), asking.column("word").to_pylist(), strict=True):
                at = np.fromiter(map(place.__getitem__, unpacked_words(words)), np.int64)
                blobs = packed(n[at]), pressed(score[at]), squeezed(np.ascontiguousarray(lift[at].T).tobytes())
                columns = [pa.array([block], pa.int64()), pa.array([number], pa.int32()), *(pa.array([blob], pa.binary()) for blob in blobs)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "code", "codes", "score", "lift"])

    table = scored.select(F.lit(-1).cast("bigint").alias("block"), F.col("slice").alias("code"), "word", "n", "score", "lift")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("n", "bigint"), ("score", "double"), ("lift", "binary"))]
    met = table.unionByName(lists.select("block", "code", "word", *none)).repartition("code").sortWithinPartitions("code", "block")
    return met.mapInArrow(run, "block bigint, code int, codes binary, score binary, lift binary")


def group_totals(scored: DataFrame) -> np.ndarray:
    """For each group, log10 of what its lifted probabilities add up to, so that they can be brought to one."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extra = np.zeros(GROUPS)
        for batch in batches:
            lift = np.frombuffer(b"".join(batch.column("lift").to_pylist()), np.int8).reshape(-1, GROUPS)
            extra += (10 ** batch.column("score").to_numpy()) @ (10 ** (lift / LIFT_STEPS) - 1)
        zeros = np.zeros(GROUPS)
        yield cells(zeros, np.arange(GROUPS), extra, zeros)

    sums = summed_cells(scored.select("score", "lift").mapInArrow(add, CELLS))
    return np.log10(1 + np.array([sums.get((0, g), (0.0, 0.0))[0] for g in range(GROUPS)]))


def score(docs: DataFrame, trains: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every whole text, learnt from the rows that train."""
    spark = docs.sparkSession
    path, words_path = scratch_folder(spark), scratch_folder(spark)
    blocks = written_to(path, tokenised(docs, trains, key, text), "kind")
    asking = blocks.where("kind = 2").select(F.col("block").alias("holder"), F.col("code").alias("slice"), F.col("codes").alias("keys"), F.col("word").alias("counts"))
    followed = written(answered(asking, PAIR_SLICES, False))
    discard(spark, f"{path}/kind=2")
    lists = blocks.where("kind = 0")
    words = written_to(words_path, word_table(lists).repartition("word").sortWithinPartitions(F.xxhash64("word")))  # learning online wants a mixed order
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("distinct")).first()
    tokens, distinct = totals.tokens, totals.distinct
    sizes = {r.g: r.n for r in words.select(F.explode("counts").alias("c")).groupBy("c.g").agg(F.sum("c.n").alias("n")).collect()}
    shares = np.array([sizes.get(g, 0) + 1.0 for g in range(GROUPS)])
    shares /= shares.sum()
    portions, portions_path = asked(words, shares)
    discard(spark, words_path)
    scored = scored_words(portions, *learnt(portions))
    discard(spark, portions_path)
    whole = group_totals(scored)
    key_type = blocks.schema["key"].dataType.simpleString()
    kinds = {"code": "int", "key": key_type, "codes": "binary", "word": "binary", "score": "binary", "lift": "binary"}

    def rows_of(kind: int, rows: DataFrame) -> DataFrame:
        return rows.select("block", F.lit(kind).alias("kind"), *[F.col(c) if c in rows.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])

    met = rows_of(0, told_words(lists, scored))
    met = met.unionByName(rows_of(1, blocks.where("kind = 1").select("block", "key", "codes")))
    met = met.unionByName(rows_of(2, followed.select(F.col("holder").alias("block"), F.col("slice").alias("code"), F.col("counts").alias("codes"))))
    met = met.unionByName(rows_of(3, lists.select("block", "code", "word")))
    met = met.repartition("block").sortWithinPartitions("block", "kind", "code")

    def mixed_groups(tokens_of: np.ndarray, lengths: np.ndarray, alone: np.ndarray, last: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """log10 of the probability of some texts when each group's weight follows the words read so far."""
        met = np.log10((pairs[:, None] + PRIOR * alone.take(tokens_of, axis=0)) / (last[:, None] + PRIOR))
        each = np.log10(shares) + np.add.reduceat(met, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
        top = each.max(1, keepdims=True)
        return (top + np.log10((10 ** (each - top)).sum(1, keepdims=True)))[:, 0]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, "block"):
            kinds = rows.column("kind").to_numpy()
            told, rest, followers, lists = (rows.filter(pa.array(kinds == kind)) for kind in range(4))
            times = np.concatenate([unpacked(c) for c in told.column("codes").to_pylist()])
            chance = np.concatenate([unpressed(c, np.float64) for c in told.column("score").to_pylist()])
            lifts = np.concatenate([np.frombuffer(expanded(c), np.int8).reshape(GROUPS, -1) for c in told.column("lift").to_pylist()], 1).T
            words = [word for data in lists.column("word").to_pylist() for word in unpacked_words(data)]
            base = np.log10((times + 0.1) / (tokens + 0.1 * (distinct + 1)))
            seen = times > 0
            alone = 10 ** (chance[:, None] + lifts / LIFT_STEPS - whole)
            documents = [np.frombuffer(expanded(c), np.uint32) for c in rest.column("codes").to_pylist()]
            sums = np.concatenate([unpacked(c) for c in followers.column("codes").to_pylist()])
            pairs = sums[np.unique(pair_keys(word_hashes(words), documents), return_inverse=True)[1]]
            every = np.concatenate([np.append(codes, np.uint32(0)) for codes in documents])
            ends = np.cumsum([len(codes) + 1 for codes in documents])
            before = np.concatenate([[np.uint32(0)], every[:-1]])
            before[ends[:-1]] = 0
            last = times[before]
            scores, done = [], 0
            while done < len(documents):
                start = ends[done - 1] if done else 0
                upto = max(done + 1, int(np.searchsorted(ends, start + TOKENS_AT_ONCE, "right")))
                part = slice(start, ends[upto - 1])
                lengths = np.diff(np.concatenate([[start], ends[done:upto]]))
                scores.append(mixed_groups(every[part], lengths, alone, last[part], pairs[part]))
                done = upto
            out = []
            for codes, score_of in zip(documents, np.concatenate(scores), strict=True):
                codes = np.append(codes, np.uint32(0))
                out.append((len(codes), int(seen[codes].sum()), tokens, float(base[codes].sum()), float(score_of)))
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64()] * 3 + [pa.float64()] * 2, strict=True)]
                keys = rest.column("key").combine_chunks()
                yield pa.RecordBatch.from_arrays([keys, *columns], names=[key, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return met.mapInArrow(add_up, f"`{key}` {key_type}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
