"""Fast exact byte-level BPE: texts are cut where the vocabulary's pattern always cuts, and each unit is encoded once."""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken

MEMO_ENTRIES = 400_000  # units a worker remembers; when full it starts anew
# Here a run of white space depends on what stands on both sides, so the text is encoded whole.
DEPENDENT = re.compile(r"\s[ \n](?:\s|\Z)")
SPECIAL = "<|endoftext|>"
# The pattern's matcher can't look past so long a run of white space, which is cut off by hand.
LONG_RUN = re.compile(r"[^\S\x1c-\x1f]{2048,}")


class ByteBpe:
    """Equals the published tokenizer with ``add_special_tokens=False``."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={SPECIAL: len(ranks)},
        )
        self.memo: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """A text's ids.  A run of white space is one pre-token, but for its last character if more text follows."""
        if len(text) < 2048:
            return self.short(text)
        done, at = [], 0
        for run in LONG_RUN.finditer(text):
            start, end = run.span()
            cut = end if end == len(text) or text.startswith(SPECIAL, end) else end - 1
            done.append(self.short(text[at:start]))
            done.append(array("I", self.encoding._encode_single_piece(text[start:cut].encode())).tobytes())
            at = cut
        return b"".join([*done, self.short(text[at:])])

    def short(self, text: str) -> bytes:
        ids = self.encoding.encode(text, allowed_special="all") if SPECIAL in text else self.encoding.encode_ordinary(text)
        return array("I", ids).tobytes()

    def unit(self, word: str) -> bytes:
        found = self.whole(word if word.startswith("\n") else " " + word)
        if len(self.memo) >= MEMO_ENTRIES:
            self.memo.clear()
        self.memo[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if SPECIAL in text or DEPENDENT.search(text):
            return self.whole(text)
        first, *words = text.replace("\n", " \n").split(" ")
        memo, unit = self.memo, self.unit
        return self.whole(first) + b"".join([memo.get(word) or unit(word) for word in words])


@lru_cache(maxsize=2)
def byte_bpe(ranks_path: str) -> ByteBpe:
    """One coder, with its memory of units, per worker."""
    return ByteBpe(ranks_path)
