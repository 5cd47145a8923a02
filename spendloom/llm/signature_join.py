"""N-gram Jaccard self-join by signature trees, and the groups its links form.

Two documents link when the Jaccard similarity of their shingle sets reaches a threshold of
``percent``; results are exact.

1. Each text becomes its set of hashed word shingles (64 bits), and a digest of the set: documents
   with equal sets are one from here on, whatever their number.  Sets are dealt to size classes; each
   takes part in its own class and the next one, so linked sets share a class.
2. Candidates.  All sets are put into one order of shingles, so linked sets share one of their first
   ``n - ceil(p n) + 1`` shingles (otherwise too few would be left to agree on).  Any one order gives
   all links.  Here a share of the hash range comes first (``low_bound``, two and a half times the
   share of a set that is asked for), and in it the rarest shingles: passages that many documents
   share stay at the end, where they make no candidates.  Rarity is the exact number of sets, counted
   in blocks of the hash range that grow in number with the corpus and stay on executors; portions of
   documents send their distinct shingles packed, and get levels back.  A shingle of one set alone is
   no key.  Only texts that have too few shingles in that share use others, uncounted, by hash.
   Each (key, class) links its sets to the smallest one, never in pairs; sets that meet in one buffer
   of a task are linked there, and only the first goes on, so a hot key is a row per buffer.
3. The components of a class's candidate links are blocks; no true link leaves its block.  Texts of
   blocks are read again and sent compressed, which takes a third of the room of their sets; tiles
   make the sets anew.  A block that weighs no more than ``TILE`` is a tile, and each of its sets is
   sent once.  A heavier one is dealt to tiles; each pair of tiles is a unit of its own, so no block,
   however large, meets in one task.  Two sets that are both from the class before are left to that
   class's block.
4. A tile's sets form a signature tree: nodes hold the OR of their sets' hashed bitmaps and the range
   of sizes.  Two trees are traversed together; a pair of nodes is left when the overlap it can reach
   at most is too small for the threshold.  What is left is verified on the whole sets; a pair
   already connected is skipped, so a tile pair returns a spanning forest of its links.
5. The components of these links are the groups, found by joins on written tables.

Defined results: words are runs of bytes other than ASCII white space, A-Z in lower case; a text of
fewer words than a shingle is one shingle; a null or blank text has an empty set and links with
nothing; rows of equal id count as one document each and share a group; rows with a null id are
returned as documents without links; ties go to the smaller id; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, small_batches, written

TILE = 8 << 20  # weight of the sets that one task compares: their shingles and SET_WEIGHT for each
SET_WEIGHT = 256
FANOUT = 16
BITMAP_BITS = 2048  # at least; larger sets get four bits an element, so that bitmaps don't fill up
BITMAPS_AT_ONCE = 1 << 25  # bytes of bitmaps compared at once
AT_ONCE = 1 << 20  # shingles of a portion of documents, whose keys are linked before they are sent
BLOCK_SHINGLES = 1 << 21  # shingles that one block of the hash range counts, about
SETS = "doc_id bigint, n bigint, tag bigint, digest binary, low_name bigint, high_name bigint"
PORTIONS = "portion string, lows bigint, bases binary, tags binary, firsts binary, lengths binary, elements binary"


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text."""
    words = data.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    hashes = word_hashes(data)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        total = (total ^ hashes[i : len(hashes) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return np.unique(total * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(size))


def size_class(size: int, percent: int) -> tuple[int, int]:
    """(number of the class, largest size in it): classes in which the smallest still links to the largest, at least."""
    number, largest = 0, 1
    while largest < size:
        number, largest = number + 1, max(largest + 1, largest * 100 // percent)
    return number, largest


def low_bound(percent: int) -> np.uint64:
    """The hash under which shingles come first in the order: two and a half times as many as keys are needed."""
    return np.uint64(min((1 << 64) - 1, (1 << 64) * (100 - percent) // 40))


def key_count(size: int, percent: int) -> int:
    """How many of a set's first shingles hold one of any linked set's first ones."""
    return size - -(-percent * size // 100) + 1


def in_class(values: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Names of sets, or keys, in a size class.  Two of one name would only share a block."""
    return ((values ^ classes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def set_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row of each document's set, without a portion: its size, size class, digest and names in two classes; and
    rows of portions: of each different set of some documents, the shingles that may become keys."""
    bound = low_bound(percent)
    fields = [part.split()[0] for part in f"{SETS}, {PORTIONS}".split(", ")]
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in f"{SETS}, {PORTIONS}".split(", ")]

    def rows(columns: dict[str, list]) -> pa.RecordBatch:
        length = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f], t) if f in columns else pa.nulls(length, t) for f, t in zip(fields, types, strict=True)], names=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[int, int, int, np.ndarray]] = {}
        size = 0

        def portion() -> pa.RecordBatch:
            bases, tags, firsts, kept = zip(*held.values(), strict=True)
            elements = np.concatenate(kept)
            packed = [np.array(x, t).tobytes() for x, t in ((bases, np.uint64), (tags, np.int64), (firsts, np.int64), (list(map(len, kept)), np.int64))]
            whole = [uuid.uuid4().hex, int((elements < bound).sum()), *packed, elements.tobytes()]
            return rows({f: [value] for f, value in zip(fields[6:], whole, strict=True)})

        for batch in batches:
            ids = batch.column(0).to_pylist()
            sets = [shingle_set(data or b"", words) for data in batch.column(1).to_pylist()]
            digests = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            bases = np.array([int.from_bytes(d[:8], "little") if d else 0 for d in digests], np.uint64)
            tags = np.array([size_class(len(s), percent)[0] for s in sets], np.int64)
            names = {"low_name": in_class(bases, tags).tolist(), "high_name": in_class(bases, tags + 1).tolist()}
            yield rows({"doc_id": ids, "n": list(map(len, sets)), "tag": tags.tolist(), "digest": digests, **names})
            for doc_id, elements, digest, base, tag in zip(ids, sets, digests, bases.tolist(), tags.tolist(), strict=True):
                if doc_id is None or digest is None or digest in held:
                    continue
                first = key_count(len(elements), percent)
                kept = elements[: max(first, int(np.searchsorted(elements, bound)))]
                held[digest] = base, tag, first, kept
                size += len(kept)
                if size >= AT_ONCE:
                    yield portion()
                    held, size = {}, 0
        if held:
            yield portion()

    return docs.mapInArrow(run, f"{SETS}, {PORTIONS}")


def shingle_levels(portions: DataFrame, percent: int) -> DataFrame:
    """(portion, parts): for each portion the levels (eighths of logarithms of the number of sets) of its distinct low
    shingles, ascending, in parts by block of the hash range.  Copies of a set count once in a portion."""
    bound = low_bound(percent)
    total = portions.agg(F.sum("lows")).first()[0] or 0
    blocks = total // BLOCK_SHINGLES + 1
    edges = np.array([int(bound) * i // blocks for i in range(1, blocks)], np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion, data in zip(batch.column(0), batch.column(1), strict=True):
                elements = np.frombuffer(data.as_buffer(), np.uint64)
                found, counts = np.unique(elements[elements < bound], return_counts=True)
                cuts = np.searchsorted(found, edges)
                parts = [(i, e, c) for i, (e, c) in enumerate(zip(np.split(found, cuts), np.split(counts, cuts), strict=True)) if len(e)]
                columns = [
                    pa.array([portion.as_py()] * len(parts), pa.string()),
                    pa.array([i for i, _, _ in parts], pa.int64()),
                    pa.array([e.tobytes() for _, e, _ in parts], pa.binary()),
                    pa.array([zstandard.compress(c.astype(np.uint32).tobytes()) for _, _, c in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["portion", "block", "elements", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in runs(batches, "block"):
            parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("elements")]
            counts = np.concatenate([np.frombuffer(zstandard.decompress(x.as_buffer()), np.uint32) for x in rows.column("counts")])
            _, place = np.unique(np.concatenate(parts), return_inverse=True)
            levels = np.minimum(8 * np.log2(np.bincount(place, counts)), 255).astype(np.uint8)[place]
            packed = [zstandard.compress(x.tobytes()) for x in np.split(levels, np.cumsum([len(x) for x in parts])[:-1])]
            names = ["portion", "block", "levels"]
            yield pa.RecordBatch.from_arrays([rows.column("portion").combine_chunks(), pa.array([block] * len(parts), pa.int64()), pa.array(packed, pa.binary())], names=names)

    sent = portions.select("portion", "elements").mapInArrow(send, "portion string, block bigint, elements binary, counts binary")
    told = sent.repartition("block").sortWithinPartitions("block").mapInArrow(add, "portion string, block bigint, levels binary")
    return told.groupBy("portion").agg(F.array_sort(F.collect_list(F.struct("block", "levels"))).alias("parts"))


def linked_in_buffer(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of fewer keys that connect the same documents.

    The smallest document of a key stands for it; the others are linked to that document under a key
    made of its id, once, whatever the number of keys they share with it.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    starts = np.concatenate([[True], keys[1:] != keys[:-1]])
    heads = ids[np.maximum.accumulate(np.where(starts, np.arange(len(keys)), 0))]
    others = heads != ids
    pairs = np.unique(np.stack([heads[others], ids[others]]), axis=1)
    hubs = np.unique(pairs[0])
    named = np.concatenate([hubs, pairs[0]]).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(0x94D049BB133111EB)
    return np.concatenate([keys[starts], named]), np.concatenate([ids[starts], hubs, pairs[1]])


def candidate_links(portions: DataFrame, percent: int) -> DataFrame:
    """(one, other), names of sets in a class: each set of a key and class with the smallest one there."""
    bound = low_bound(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bases, elements = np.frombuffer(row["bases"], np.uint64), np.frombuffer(row["elements"], np.uint64)
                tags, firsts, lengths = (np.frombuffer(row[x], np.int64) for x in ("tags", "firsts", "lengths"))
                low = elements < bound
                levels = np.full(len(elements), 1, np.int64)  # others come later in the order, and may have partners
                if low.any():
                    told = np.frombuffer(b"".join(zstandard.decompress(part["levels"]) for part in row["parts"]), np.uint8)
                    _, place = np.unique(elements[low], return_inverse=True)
                    levels[low] = told[place]
                owner = np.repeat(np.arange(len(bases)), lengths)
                order = np.lexsort((elements, levels, ~low, owner))
                rank = np.arange(len(order)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                used = order[(rank < np.repeat(firsts, lengths)) & (levels[order] > 0)]
                if not len(used):
                    continue
                owner, elements = owner[used], elements[used]
                classes = np.concatenate([tags[owner], tags[owner] + 1])
                keys, names = in_class(np.tile(elements, 2), classes), in_class(np.tile(bases[owner], 2), classes)
                keys, names = linked_in_buffer(keys.view(np.uint64), names)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(names)], names=["key", "doc_id"])

    levels = shingle_levels(portions, percent).hint("merge")
    columns = "bases", "tags", "firsts", "lengths", "elements"
    keyed = portions.join(levels, "portion", "left").select(*columns, "parts").mapInArrow(run, "key bigint, doc_id bigint")
    # Rows of a key are sorted with the smallest id first, so one pass over a partition links them.
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key", "doc_id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, None
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
            if len(keys) and key is not None and keys[0] == key:
                starts[0] = False
            at = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), -1)) if len(keys) else np.zeros(0, np.int64)
            heads = np.where(at >= 0, ids[at], first if first is not None else 0)
            if len(keys):
                key, first = keys[-1], heads[-1]
            apart = heads != ids
            pairs = np.unique(np.stack([heads[apart], ids[apart]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["one", "other"])

    return sorted_keys.mapInArrow(link, "one bigint, other bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (one, other), by alternating large and small stars.

    Each round is a written table; the number of rounds grows with the logarithm of the longest path.
    """
    edges = written(links.where("one <> other").select(F.greatest("one", "other").alias("big"), F.least("one", "other").alias("small")).distinct())
    while True:
        both = edges.union(edges.select(F.col("small").alias("big"), F.col("big").alias("small")))
        least = both.groupBy("big").agg(F.least(F.min("small"), F.col("big")).alias("least"))
        joined = both.join(least, "big")
        large = joined.where("small > big").select(F.col("small").alias("big"), F.col("least").alias("small")).distinct()
        down = large.groupBy("big").agg(F.min("small").alias("least"))
        again = large.join(down, "big")
        small = again.select(F.when(F.col("small") == F.col("least"), F.col("big")).otherwise(F.col("small")).alias("big"), F.col("least").alias("small"))
        following = written(small.where("big <> small").distinct())
        if same_edges(edges, following):
            return following.select(F.col("big").alias("node"), F.col("small").alias("component"))
        edges = following


def same_edges(one: DataFrame, other: DataFrame) -> bool:
    """Whether two edge tables hold the same rows, by count and sums of two hashes."""
    measures = [F.count("*"), *(F.sum(F.xxhash64("big", "small", F.lit(salt)).cast("decimal(38,0)")) for salt in (1, 2))]
    return one.agg(*measures).first() == other.agg(*measures).first()


def bitmap_bits(sets: list[np.ndarray]) -> int:
    """Bits of each set's bitmap: all bitmaps together take a sixteenth to an eighth of the sets' room, or the least width."""
    return max(BITMAP_BITS, 1 << (4 * sum(map(len, sets)) // len(sets)).bit_length())


class Tree:
    """A signature tree over sets: levels of OR-combined bitmaps, size ranges and largest excess of elements over bits."""

    def __init__(self, sets: list[np.ndarray], width: int):
        maps = np.empty((len(sets), width // 64), np.uint64)
        for i, elements in enumerate(sets):
            bits = np.zeros(width, np.uint8)
            bits[(elements >> np.uint64(13)) % np.uint64(width)] = 1
            maps[i] = np.packbits(bits).view(np.uint64)
        sizes = np.array([len(s) for s in sets])
        self.order = np.lexsort((np.array([s[0] for s in sets], np.uint64), sizes))
        maps, sizes = maps[self.order], sizes[self.order]
        self.levels = [(maps, sizes, sizes, sizes - np.bitwise_count(maps).sum(1, dtype=np.int64))]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, excess = self.levels[-1]
            starts = np.arange(0, len(maps), FANOUT)
            self.levels.append(
                (np.bitwise_or.reduceat(maps, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(excess, starts))
            )


def may_link(one: tuple, i: np.ndarray, other: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether node pairs can hold a linked pair: the overlap they reach at most against what the threshold asks."""
    common = np.bitwise_count(one[0][i] & other[0][j]).sum(1, dtype=np.int64)
    most = np.minimum(np.minimum(one[2][i], other[2][j]), common + np.minimum(one[3][i], other[3][j]))
    # |x & y| >= p / (100 + p) (|x| + |y|), and no smaller set than p % of the larger.
    least = one[1][i] + other[1][j]
    sizes = (100 * one[2][i] >= percent * other[1][j]) & (100 * other[2][j] >= percent * one[1][i])
    return sizes & ((100 + percent) * most >= percent * least)


def children(nodes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the parent in the list, child) of all children."""
    found = nodes[:, None] * FANOUT + np.arange(FANOUT)
    parent, _ = np.nonzero(found < width)
    return parent, found[found < width]


def leaf_pairs(one: Tree, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaves that may link, found by going down both trees at once, some node pairs at a time."""
    height = max(len(one.levels), len(other.levels)) - 1
    most = max(64, min(1 << 14, BITMAPS_AT_ONCE // one.levels[0][0][0].nbytes))
    held = [(height, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while held:
        level, i, j = held.pop()
        first, second = min(level, len(one.levels) - 1), min(level, len(other.levels) - 1)
        fit = may_link(one.levels[first], i, other.levels[second], j, percent)
        if one is other:
            fit &= i <= j
        i, j = i[fit], j[fit]
        if not len(i):
            continue
        if not level:
            yield i, j
            continue
        if first == level:
            parent, i = children(i, len(one.levels[level - 1][0]))
            j = j[parent]
        if second == level:
            parent, j = children(j, len(other.levels[level - 1][0]))
            i = i[parent]
        for start in range(0, len(i), most):
            held.append((level - 1, i[start : start + most], j[start : start + most]))


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """The exact test on two sorted sets."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(other) - common)


def tile_links(ids: list[int], sets: list[np.ndarray], second: np.ndarray, owned: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked in one tile (none is of the second) or across two; one of a pair is of the class itself."""
    own = np.nonzero(~second)[0]
    opposite = np.nonzero(second)[0]
    width = bitmap_bits(sets)
    one = Tree([sets[i] for i in own], width)
    other = Tree([sets[i] for i in opposite], width) if len(opposite) else one
    left, right = own[one.order], (opposite if len(opposite) else own)[other.order]
    parent = np.arange(len(ids))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    found = []
    for i, j in leaf_pairs(one, other, percent):
        a, b = left[i], right[j]
        some_own = owned[a] | owned[b]
        for a, b in zip(a[some_own].tolist(), b[some_own].tolist(), strict=True):
            if a != b and (x := root(a)) != (y := root(b)) and linked(sets[a], sets[b], percent):
                parent[max(x, y)] = min(x, y)
                found.append((ids[a], ids[b]))
    return found


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text compressed: a third of the size of its set of hashes."""
    for batch in batches:
        packed = [zstandard.compress(data or b"") for data in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def true_links(docs: DataFrame, blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """(one, other): verified links that connect each block's linked documents."""
    weight = F.sum(F.col("n") + SET_WEIGHT)
    sizes = blocks.groupBy("component").agg(F.count("*").alias("sets"), F.ceil(weight / TILE).alias("tiles"), F.max("own").alias("some_own"))
    # One set alone needs no task; sets of the class before meet there.
    tiled = sizes.where("sets > 1 AND some_own").select("component", "tiles")
    placed = blocks.join(tiled, "component").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    places = placed.groupBy("node").agg(F.collect_set(F.struct("component", "own", "tile", "tiles")).alias("places"))  # at most two for each set
    # The same plan at every size: texts are dealt by id, blocks are not broadcast.
    packed = docs.mapInArrow(packed_texts, "doc_id bigint, packed binary").hint("merge")
    each = packed.join(places, packed["doc_id"] == places["node"]).select("doc_id", "packed", F.explode("places").alias("place")).select("doc_id", "packed", "place.*")
    # A set goes to each pair of tiles that its own is part of.
    mates = each.withColumn("mate", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
    low, high = F.least("tile", "mate").alias("low"), F.greatest("tile", "mate").alias("high")
    pair = F.xxhash64("component", low, high).alias("pair")
    paired = mates.select(pair, "component", "own", low, high, (F.col("tile") > F.col("mate")).alias("second"), "doc_id", "packed")
    dealt = paired.repartition("pair").sortWithinPartitions("pair", "component", "low", "high")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(with_tile_pair(batches), "tile_pair"):
            second = rows.column("second").to_numpy()
            if second.any() and second.all():
                continue
            across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
            if across and not second.any():
                continue
            sets = [shingle_set(zstandard.decompress(x.as_buffer()), words) for x in rows.column("packed")]
            found = tile_links(rows.column("doc_id").to_pylist(), sets, second, rows.column("own").to_numpy(), percent)
            if found:
                one, other = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], names=["one", "other"])

    return dealt.mapInArrow(join, "one bigint, other bigint")


def with_tile_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the component and its two tiles as one column."""
    for batch in batches:
        names = [":".join(map(str, row)) for row in zip(*(batch.column(n).to_pylist() for n in ("component", "low", "high")), strict=True)]
        yield batch.append_column("tile_pair", pa.array(names, pa.string()))


def groups(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the set's size and the smallest id its links reach."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = written(set_rows(rows, words, percent))
    sets = found.where("portion IS NULL").select("doc_id", "n", "digest", "low_name", "high_name")
    # Equal sets are one node, named by the smallest id.
    named_sets = sets.where("n > 0 AND doc_id IS NOT NULL")
    same = written(named_sets.groupBy("digest", "n", "low_name", "high_name").agg(F.min("doc_id").alias("node")))
    nodes = written(named_sets.select("doc_id", "digest").join(same.select("digest", "node"), "digest").select("doc_id", "node").distinct())
    near = candidate_links(found.where("portion IS NOT NULL").select("portion", "lows", "bases", "tags", "firsts", "lengths", "elements"), percent)
    candidates = components(near)
    reached = candidates.select(F.col("node").alias("name"), "component")
    heads = candidates.select(F.col("component").alias("name"), "component").distinct()
    classes = F.array(F.struct(F.lit(True).alias("own"), F.col("low_name").alias("name")), F.struct(F.lit(False).alias("own"), F.col("high_name").alias("name")))
    classed = same.select("node", "n", F.explode(classes).alias("c")).select("node", "n", "c.*")
    blocks = written(classed.join(reached.union(heads), "name").select("node", "n", "own", "component"))
    links = true_links(rows, blocks, words, percent)
    linked_nodes = components(links)
    named = nodes.join(linked_nodes, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    ids = named.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sets.join(ids, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), F.col("doc_id")).alias("component_id")
    )
