"""Alignment of two tokenizers over the same texts, and how often their tokens end together.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentencepiece BPE with byte fallback)
reads the text and adds that space itself.  Byte offsets at which both end a token cut a text into groups;
the two tokens that end there are linked.

1. Spans.  The libraries' own spans give the ends: character offsets of A, spans of B's proto, turned into
   byte offsets.  They are coarse: tokens inside a multibyte character or made of white space (A), and pieces
   of byte fallback (B), have none of their own, so their ends are counted from the last sure end by the bytes
   they decode to.  The decoded bytes, joined, must equal the text's.
2. Units.  No pre-token of A and no piece of B spans the border between other characters and white space
   (``\\r`` apart, checked on B's vocabulary when it is loaded), so both tokenizers work on a unit of white
   space and what follows it as they do on the whole text.  A worker aligns a batch's new units
   as one text and remembers a bounded number of them; a text's groups are its units' groups.
3. Counts.  Each text's links are counted by pair of ids before anything leaves its task, then summed over
   the corpus.  Texts join the pair counts by pair: a pair is one row for each text that holds it, whatever
   their number in it, and sums are combined by text in the task that made the rows.  The counts are
   broadcast if they are no more than ``BROADCAST_PAIRS``, else both sides are shuffled.

Defined results: null and empty texts, and texts whose joined bytes differ from a space and the text, have no
tokens: zeros and an empty hash; special tokens' strings are plain text; repeated rows count repeatedly;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import small_batches, written
from .transducer_bpe import byte_letters

MEMO_ENTRIES = 400_000  # units a worker remembers, and as many from before
UNIT_CHARS = 64  # longer units are aligned each time
BROADCAST_PAIRS = 2_000_000  # rows of 24 bytes
HALF = 1 << 32  # a pair is A's id times this, plus B's
SPACE = "▁"
WHITE = "[^\\S\x1c-\x1f]"  # white space, as A's pattern has it
OTHER = "[\\S\x1c-\x1f]"
# White space and what follows it; \r after other characters doesn't begin a unit.
UNIT = re.compile(f"(?:{WHITE}+|^){OTHER}*(?:\r{WHITE}*{OTHER}*)*")
WHITE_CHARACTER = re.compile(WHITE)
LEAD = " ."  # a unit that others can follow
ACROSS = re.compile(f"{OTHER}(?!\r){WHITE}")
FALLBACK = re.compile(r"<0x([0-9A-F]{2})>")
KIND = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<struct<pair: bigint, n: bigint>>"


class Aligned(NamedTuple):
    """One unit or text: its groups as text, its number of tokens, and the pair of each link."""

    groups: str
    n_a: int
    n_b: int
    pairs: tuple[int, ...]


def byte_offsets(text: str) -> np.ndarray:
    """The byte offset of each character, and the text's length in bytes."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])


def refined(coarse: np.ndarray, sure: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Token ends: the coarse end where it is sure, else the last sure end and the bytes decoded since then."""
    if sure.all():
        return coarse
    counted = np.cumsum(lengths)
    at = np.maximum.accumulate(np.where(sure, np.arange(len(sure)), -1))
    since = np.where(at >= 0, coarse[at] - counted[at], 0)
    return np.where(sure, coarse, since + counted)


class Aligner:
    """Both tokenizers, with their tokens' bytes and a memory of units."""

    def __init__(self, byte_bpe: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        values = {letter: byte for byte, letter in enumerate(byte_letters())}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [bytes(values[c] for c in self.a.id_to_token(i) or "" if c in values) for i in range(size)]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        fallback = [bool(FALLBACK.fullmatch(name)) for name in names]
        self.bytes_b = [bytes([int(name[3:5], 16)]) if byte else name.replace(SPACE, " ").encode() for name, byte in zip(names, fallback, strict=True)]
        self.length_a, self.length_b = np.array(list(map(len, self.bytes_a))), np.array(list(map(len, self.bytes_b)))
        # A span of A is sure for whole characters that aren't all white space, which the library trims.
        self.sure_a = np.array([bool(b.strip()) and b.decode(errors="ignore").encode() == b for b in self.bytes_a])
        self.sure_b = ~np.array(fallback)
        self.most = max(size, len(names))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(self.most)]  # ids as they stand in the groups
        self.by_units = not any(ACROSS.search(name.replace(SPACE, " ")) for name in names)
        self.memo: dict[str, Aligned | None] = {}
        self.old: dict[str, Aligned | None] = {}

    def proto(self, text: str):
        """B's tokens with their spans, under either name the library has for them."""
        try:
            return self.b.encode(text, return_type="proto")
        except TypeError:
            return self.b.encode(text, out_type="immutable_proto")

    def aligned(self, units: list[str]) -> list[Aligned] | None:
        """The alignment of each of some units that follow each other in a text; None if bytes differ.

        The text begins with a space, which B adds itself.
        """
        text = "".join(units)
        a, pieces = self.a.encode(text, add_special_tokens=False), list(self.proto(text[1:]).pieces)
        ids_a, ids_b = a.ids, [piece.id for piece in pieces]
        data = text.encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != data or b"".join(map(self.bytes_b.__getitem__, ids_b)) != data:
            return None
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a = np.array([end for _, end in a.offsets], np.int64)
        ends_b = np.array([piece.end for piece in pieces], np.int64) + 1
        if len(data) != len(text):
            offsets = byte_offsets(text)
            ends_a = offsets[ends_a]
            if ends_b[-1] == len(text):  # spans in characters; some releases have bytes
                ends_b = offsets[ends_b]
        ends_a = refined(ends_a, self.sure_a[ids_a], self.length_a[ids_a])
        ends_b = refined(ends_b, self.sure_b[ids_b], self.length_b[ids_b])
        cuts, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        # A group is its A ids, then its B ids; the mark behind an id tells what follows.
        of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        before = np.concatenate([[0], last_b + 1])
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + before[of_a]] = ids_a + self.most * (ends_a == cuts[of_a])
        codes[np.arange(len(ids_b)) + last_a[of_b] + 1] = ids_b + 2 * self.most * (ends_b == cuts[of_b])
        marked = list(map(self.written.__getitem__, codes.tolist()))
        pairs = (ids_a[last_a] * HALF + ids_b[last_b]).tolist()
        closing = np.searchsorted(cuts, np.cumsum([len(unit.encode()) for unit in units]))
        done, start = [], (0, 0, 0)
        for stop in zip((last_a[closing] + 1).tolist(), (last_b[closing] + 1).tolist(), (closing + 1).tolist(), strict=True):
            groups = "".join(marked[start[0] + start[1] : stop[0] + stop[1]])[:-1]
            done.append(Aligned(groups, stop[0] - start[0], stop[1] - start[1], tuple(pairs[start[2] : stop[2]])))
            start = stop
        return done

    def units_of(self, text: str) -> list[str]:
        """The units of a space and the text, or these as one."""
        return list(filter(None, UNIT.findall(f" {text}"))) if self.by_units else [f" {text}"]

    def all_aligned(self, units: list[str]) -> list[Aligned | None]:
        """Alignments of units.  They are read as one text, in which a unit that ends in white space can only be the last."""
        inner = [unit for unit in units if not WHITE_CHARACTER.match(unit[-1])]
        found = dict(zip(inner, (self.aligned([LEAD, *inner]) or [])[1:], strict=False))
        return [found[unit] if unit in found else (self.aligned([LEAD, unit]) or [None, None])[1] for unit in units]

    def learn(self, units: Iterable[str]) -> None:
        """Align the units that are new.  A full memory is kept as the old one until the next is full."""
        if len(self.memo) > MEMO_ENTRIES:
            self.old, self.memo = self.memo, {}
        new = []
        for unit in set(units):
            if unit in self.memo:
                continue
            if unit in self.old:
                self.memo[unit] = self.old[unit]
            elif len(unit) <= UNIT_CHARS:
                new.append(unit)
        self.memo.update(zip(new, self.all_aligned(new), strict=True))

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, list[int], list[int]]]:
        """Of each text: (tokens of A, tokens of B, groups, hash of the groups, pairs of the links, how often each)."""
        split = [self.units_of(text) if text else [] for text in texts]
        self.learn(chain.from_iterable(split))
        return list(map(self.text, texts, split))

    def text(self, text: str, units: list[str]) -> tuple[int, int, int, str, list[int], list[int]]:
        """One text of ``texts``, from its units."""
        memo = self.memo
        parts = [memo[unit] if unit in memo else self.all_aligned([unit])[0] for unit in units]
        if None in parts:  # what a unit alone can't tell, the whole text can
            parts = self.aligned([f" {text}"]) or []
        if not parts:
            return 0, 0, 0, "", [], []
        groups, n_a, n_b, pairs = zip(*parts, strict=True)
        links = Counter(chain.from_iterable(pairs))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        return sum(n_a), sum(n_b), links.total(), digest, list(links), list(links.values())


@lru_cache(maxsize=2)
def aligner(byte_bpe: str, pieces: str) -> Aligner:
    """One aligner, with its memory, per worker."""
    return Aligner(byte_bpe, pieces)


def linked_texts(docs: DataFrame, byte_bpe: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, links) of every text: its links counted by pair of ids."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_bpe, pieces)
        kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
        for batch in batches:
            found = own.texts([value or "" for value in batch.column(1).to_pylist()])
            counts = [pa.array([row[i] for row in found], pa.int64()) for i in range(3)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(row[4]) for row in found])]), pa.int32())
            flat = [pa.array(list(chain.from_iterable(row[i] for row in found)), pa.int64()) for i in (4, 5)]
            items = pa.StructArray.from_arrays(flat, names=["pair", "n"])
            listed = pa.ListArray.from_arrays(ends, items).cast(kind)
            hashes = pa.array([row[3] for row in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, hashes, listed], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return docs.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(run, KIND)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, count, best): each pair's links over all texts, and whether it has the most of its B id."""
    counts = linked.select(F.inline("links")).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("id_b", F.col("pair").bitwiseAND(HALF - 1))
    most = counts.groupBy("id_b").agg(F.max("count").alias("most"))
    return counts.join(most, "id_b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_bpe: str, pieces: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    linked = written(linked_texts(docs, byte_bpe, pieces, key, text)).withColumn("row", F.monotonically_increasing_id())
    counts = written(pair_counts(linked))
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    each = linked.where("n_groups > 0").select("row", F.inline("links")).join(counts, "pair")
    best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0))
    sums = each.groupBy("row").agg(best.alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return linked.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
