"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

Three steps.  All pre-tokens of the corpus are counted (combined in each task before the shuffle).
The most frequent ones, ``LEXICON_WORDS`` of them, are compiled into a minimal acyclic automaton:
equal suffixes share states, each transition carries an additive output, and the outputs along a
word's path add up to its rank, which points to its token ids.  The automaton is flat arrays in one
file of bounded size that workers map into memory.  Words outside it are merged exactly by rank.
A worker walks each distinct word once and remembers a bounded number of results.

Defined results: a null or empty text has no tokens and decodes to the empty text; equal texts have
equal ids; special tokens in a text are found before normalisation; rows are returned as they come,
repeated ones repeatedly; further columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import shared_file, small_batches, texts, written

LEXICON_WORDS = 65_536
COUNTER_ENTRIES = 400_000  # distinct words a task counts before it hands them on
MEMO_ENTRIES = 300_000  # units a worker remembers, and as many from before; and as many words
SHORT_WORD = 48  # bytes up to which the best pair is looked for in a list, which is quicker than a heap
# Fixed values of the vocabulary's file format.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
SPECIAL = re.compile(r"(<\|startoftext\|>|<\|endoftext\|>)")
RANGE = re.compile(r"(\\U[0-9a-f]{8})-(\\U[0-9a-f]{8})")  # as ``odd_characters`` writes them
NOT_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split alone


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {byte: chr(byte) for byte in plain}
    for shift, byte in enumerate(b for b in range(256) if b not in letters):
        letters[byte] = chr(256 + shift)
    return [letters[byte] for byte in range(256)]


LETTERS = byte_letters()


def lowered(text: str) -> str:
    """NFC, then the lower case of each character by itself (so no final sigma)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(unit: str) -> list[str]:
    """The pre-tokens of a text or of a part between white space."""
    return WORD.findall(lowered(unit))


def units(text: str) -> list[str]:
    """Parts between white space."""
    return [x for x in regex.split(r"\s+", text) if x] if NOT_SPACE.search(text) else text.split()


class Merges:
    """The vocabulary's merges, applied in order of rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = {token["content"]: token["id"] for token in model["added_tokens"]}
        self.ids: dict[str, int] = model["model"]["vocab"]
        self.names = {number: token for token, number in (self.ids | self.special).items()}
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"])
        # Numbers of two tokens, joined, tell the rank of their merge and the number of what comes out, joined as well.
        self.bits = max(self.ids.values()).bit_length()
        ids, bits = self.ids, self.bits
        self.pairs = {ids[one] << bits | ids[other]: rank << bits | ids[one + other] for rank, (one, other) in enumerate(pairs)}
        self.letters = [ids[letter] for letter in LETTERS]
        self.ends = [ids[letter + WORD_END] for letter in LETTERS]

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        data = word.encode()
        parts = [self.letters[byte] for byte in data[:-1]]
        parts.append(self.ends[data[-1]])
        return self.merged_short(parts) if len(parts) <= SHORT_WORD else self.merged_long(parts)

    def merged_short(self, parts: list[int]) -> list[int]:
        """The least rank, leftmost, is merged until no pair has one."""
        get, bits = self.pairs.get, self.bits
        none = 1 << 63
        mask = (1 << bits) - 1
        found = [get(one << bits | other, none) for one, other in zip(parts, parts[1:], strict=False)]
        while found and (least := min(found)) != none:
            i = found.index(least)
            new = parts[i] = least & mask
            del parts[i + 1], found[i]
            if i:
                found[i - 1] = get(parts[i - 1] << bits | new, none)
            if i < len(found):
                found[i] = get(new << bits | parts[i + 1], none)
        return parts

    def merged_long(self, letters: list[int]) -> list[int]:
        """The same by a heap, which keeps long words from quadratic work."""
        get, bits = self.pairs.get, self.bits
        mask = (1 << bits) - 1
        parts: list[int | None] = list(letters)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(pair, i) for i in range(len(letters) - 1) if (pair := get(letters[i] << bits | letters[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            pair, i = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= len(parts) or get(parts[i] << bits | parts[j]) != pair:
                continue
            parts[i] = pair & mask
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(parts):
                    new = get(parts[k] << bits | parts[after[k]])
                    if new is not None:
                        heapq.heappush(heap, (new, k))
        return [part for part in parts if part is not None]


def minimal_states(words: Iterable[bytes]) -> list[tuple[bool, tuple[tuple[int, int], ...]]]:
    """States of the minimal automaton of sorted words: (final, ((byte, state), ...)); the last one is the start."""
    frozen: dict[tuple, int] = {}
    states: list[tuple] = []

    def freeze(node: list) -> int:
        state = (node[0], tuple(node[1]))
        if state not in frozen:
            frozen[state] = len(states)
            states.append(state)
        return frozen[state]

    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))

    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        last = word
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    return states


def compile_lexicon(outputs: dict[str, list[int]]) -> bytes:
    """The transducer of words and their ids, as flat arrays one after another."""
    ordered = sorted((word.encode(), ids) for word, ids in outputs.items())
    states = minimal_states(word for word, _ in ordered)
    below: list[int] = []
    first, finals, labels, targets, sums = array("I", [0]), array("I"), array("I"), array("I"), array("I")
    for final, edges in states:
        total = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            sums.append(total)
            total += below[target]
        below.append(total)
        finals.append(final)
        first.append(len(labels))
    starts, ids = array("I", [0]), array("I")
    for _, output in ordered:
        ids.extend(output)
        starts.append(len(ids))
    parts = [first, finals, labels, targets, sums, starts, ids]
    return b"".join(part.tobytes() for part in [array("I", [len(part) for part in parts]), *parts])


class Transducer:
    """Reads a compiled lexicon in place, from bytes or a memory map."""

    def __init__(self, content):
        view = memoryview(content).cast("I")
        at, arrays = 7, []
        for length in view[:7]:
            arrays.append(view[at : at + length])
            at += length
        self.first, self.finals, self.labels, self.targets, self.sums, self.starts, self.ids = arrays

    def find(self, word: bytes) -> memoryview | None:
        """The ids of a word, None if the lexicon lacks it."""
        state, rank = len(self.finals) - 1, 0
        first, labels = self.first, self.labels
        for byte in word:
            end = first[state + 1]
            edge = bisect_left(labels, byte, first[state], end)
            if edge == end or labels[edge] != byte:
                return None
            rank += self.sums[edge]
            state = self.targets[edge]
        return self.ids[self.starts[rank] : self.starts[rank + 1]] if self.finals[state] else None


class Coder:
    """Encodes and decodes with a transducer first and exact merges for the rest."""

    def __init__(self, transducer: Transducer, merges: Merges, odd: str = "", published: Tokenizer | None = None):
        self.transducer, self.merges, self.published = transducer, merges, published
        self.odd = re.compile(odd) if odd else None
        # Most texts stay below U+10000, where a pattern without higher ranges needs one look for each character.
        low = "".join([f"{one}-{other}" for one, other in RANGE.findall(odd) if int(one[2:], 16) < 0x10000])
        self.low_odd = re.compile(f"[{low}]") if low else None
        names = merges.names
        self.names = [names.get(number, "") for number in range(max(names) + 1)]
        # Ids of units and words: plain values are nothing to collect.
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of one pre-token."""
        known = self.word_ids.get(word)
        if known is not None:
            return known
        if word.isascii() and (known := self.ids.get(word)) is not None:  # a unit by itself
            return known
        if len(self.word_ids) >= MEMO_ENTRIES:
            self.word_ids.clear()
        known = self.word_ids[word] = self.coded(word)
        return known

    def coded(self, word: str) -> bytes:
        """The same, found anew."""
        ids = self.transducer.find(word.encode())
        return array("I", self.merges.merge(word)).tobytes() if ids is None else ids.tobytes()

    def is_odd(self, part: str) -> bool:
        """Whether the library's tables may differ on one of its characters."""
        if self.odd is None or part.isascii():
            return False
        pattern = self.low_odd if max(part) < "\U00010000" else self.odd
        return pattern is not None and pattern.search(part) is not None

    def unit(self, part: str) -> bytes:
        """Ids of a part between white space."""
        found = self.old.get(part)
        if found is not None:
            return found
        if self.is_odd(part):
            return array("I", self.published.encode(part, add_special_tokens=False).ids).tobytes()
        words = pieces(part)
        if len(words) == 1:  # a word is not remembered twice
            return self.coded(part) if words[0] == part and part not in self.word_ids else self.word(words[0])
        return b"".join([self.word(word) for word in words])

    def decode(self, ids: Iterable[int]) -> str:
        """Token texts joined by spaces, special tokens kept."""
        return " ".join(map(self.names.__getitem__, ids))

    def code(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and their decoded text."""
        if len(self.ids) >= MEMO_ENTRIES:
            self.old, self.ids = self.ids, {}
        known = self.ids
        found: list[bytes] = []
        for i, segment in enumerate(SPECIAL.split(text) if "<|" in text else [text]):
            if i % 2:
                found.append(array("I", [self.merges.special[segment]]).tobytes())
            else:
                parts = units(segment)
                for part in set(parts).difference(known):
                    known[part] = self.unit(part)
                found += map(known.__getitem__, parts)
        ids = b"".join(found)
        return ids, self.decode(memoryview(ids).cast("I"))


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each pre-token occurs in the whole corpus."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def told() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for part, n in held.items():
                for word in pieces(part):
                    words[word] += n
            held.clear()
            return pa.RecordBatch.from_pydict({"word": list(words), "n": pa.array(words.values(), pa.int64())})

        for batch in batches:
            for value in texts(batch):
                held.update(units(value))
                if len(held) > COUNTER_ENTRIES:
                    yield told()
        if held:
            yield told()

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, words: int) -> list[str]:
    """The most frequent words of (word, n), ties to the smaller word.

    The least number of occurrences is found first, from histograms, so that tasks send these words alone.
    """
    octaves = counts.groupBy(F.length(F.bin("n")).alias("octave")).count().collect()  # 64 rows at most
    left, octave = words, 0
    for octave, rows in sorted(octaves, reverse=True):
        if rows > left:
            break
        left -= rows
    else:
        return [row.word for row in counts.collect()]
    least = 0
    inside = counts.where(F.length(F.bin("n")) == octave).groupBy("n").count()
    for least, rows in sorted(inside.collect(), reverse=True):  # no more rows than words in the octave
        if rows > left:
            break
        left -= rows
    tied = counts.where(F.col("n") == least).orderBy("word").limit(left).select("word")
    return [row.word for row in counts.where(F.col("n") > least).select("word").union(tied).collect()]


def build_lexicon(docs: DataFrame, tokenizer: str, words: int = LEXICON_WORDS, text: str = "text") -> str:
    """Compile the most frequent words (ties to the smaller word) and hand the file to the executors; returns its name."""
    frequent = frequent_words(written(word_counts(docs, text)), words)
    merges = Merges(tokenizer)
    content = compile_lexicon({word: merges.merge(word) for word in frequent})
    return shared_file(docs.sparkSession, content, "lexicon.bin")


def published_tokenizer(path: str) -> Tokenizer:
    """The library's tokenizer, without truncation and padding."""
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def odd_characters(path: str) -> str:
    """A pattern of the characters on which the library's tables of Unicode differ from those used here.

    Every character is tried between letters, and every mark around other marks, some thousands in a call.
    Code points without a character, in this release of Python, are among them without a trial.
    """
    published = published_tokenizer(path)
    kinds = {i: unicodedata.category(chr(i)) for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000}
    points = [chr(i) for i, kind in kinds.items() if kind not in ("Cn", "Co")]
    marks = ["\u0301", "\u0327", "\u0345", "\u05b0", "\u093c", "\u302a", "\u1dfa"]
    tried = [f"a{c}b" for c in points]
    loose = [c for c in points if kinds[ord(c)][0] == "M"]
    tried += [f"a{x}{y}" for mark in marks for c in loose for x, y in ((c, mark), (mark, c))]
    owners = points + [c for _ in marks for c in loose for _ in range(2)]
    odd = {chr(i) for i, kind in kinds.items() if kind in ("Cn", "Co")}
    step = 1 << 16
    for at in range(0, len(tried), step):
        parts, names = tried[at : at + step], owners[at : at + step]
        text = "\n".join(parts)
        told = published.normalizer.normalize_str(text.replace("\n", "xqxqx")).split("xqxqx")
        for name, part, normal in zip(names, parts, told, strict=True):
            if name not in odd and (normal != lowered(part) or " ".join(units(part)) != part.strip()):
                odd.add(name)
    # What the pre-tokenizer cuts, and where; a character of white space is no part of a piece.
    for at in range(0, len(points), step):
        names = points[at : at + step]
        text = " ".join(lowered(f"a{c}b") for c in names)
        cuts = published.pre_tokenizer.pre_tokenize_str(text)
        own = [match.span() for match in WORD.finditer(text)]
        apart = {place for span in {span for _, span in cuts} ^ set(own) for place in range(*span)}
        place = 0
        for name in names:
            length = len(lowered(f"a{name}b"))
            if any(i in apart for i in range(place, place + length)):
                odd.add(name)
            place += length + 1
    ranges: list[list[int]] = []
    for point in sorted(map(ord, odd)):
        if ranges and point == ranges[-1][1] + 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join([f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges]) + "]"


@lru_cache(maxsize=2)
def coder(lexicon: str, tokenizer: str, odd: str) -> Coder:
    """One coder per worker, over the mapped file."""
    with open(SparkFiles.get(lexicon), "rb") as file:
        content = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return Coder(Transducer(content), Merges(tokenizer), odd, published_tokenizer(tokenizer))


def encode_decode(docs: DataFrame, lexicon: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text they decode to."""
    small_batches(docs.sparkSession)

    odd = odd_characters(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(lexicon, tokenizer, odd)
        for batch in batches:
            coded = [own.code(value) for value in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([ids for ids, _ in coded], pa.binary()), pa.array([t for _, t in coded], pa.string())],
                names=[key, "ids", "decoded"],
            )

    rows = docs.select(key, F.col(text).alias("text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids binary, decoded string")


def encode_digests(docs: DataFrame, lexicon: str, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of ``encode_decode``'s rows, hashed where they are coded."""
    small_batches(docs.sparkSession)
    odd = odd_characters(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(lexicon, tokenizer, odd)
        for batch in batches:
            coded = [own.code(value) for value in texts(batch)]
            columns = [
                pa.array([len(ids) // 4 for ids, _ in coded], pa.int64()),
                pa.array([sha256(ids).hexdigest() for ids, _ in coded], pa.string()),
                pa.array([sha256(decoded.encode()).hexdigest() for _, decoded in coded], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(key, F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
