"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits,
schemes and identifier cues.  Local parsers then expand each anchor to both sides and validate what
they find, so text without anchors costs no more than that pass:

- an at-sign expands to an e-mail address;
- a digit expands to a dotted address of four parts and to a card number (Luhn);
- a plus sign expands to a telephone number;
- a scheme expands to a web address that carries personal data: user information before its host;
- a cue (``iban``, ``account``, ...) expands to an account number: an IBAN that passes its check
  digits, or after an account cue a plain number of 8 to 17 digits.

The parsers of the first four kinds give exactly the leftmost, non-overlapping matches of the base
patterns; a match that fails its validation is dropped and not tried again from another place.

Rows are handled where they are read: no shuffle, nothing on the driver, one text at a time.

Defined results: a null or empty text has no spans; spans count code points, end exclusive; equal
rows give equal results; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account")
KINDS = BASE + ADDED
# Fixed values of the formats.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
DIGITS = frozenset("0123456789")
PHONE = frozenset(" ().0123456789-")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte")
AFTER_CUE = re.compile(r"[A-Za-z]{0,2}\.?[\x20:#=\"]{0,4}(?:(?:no|number|nr)\.?[\x20:#=\"]{0,4})?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){7,16}(?![0-9])")
USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=:-]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\"'<>]*)?")

Span = tuple[str, int, int]


def run_end(text: str, at: int, allowed: frozenset[str]) -> int:
    """End of the run of allowed characters that starts at a place."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def luhn(digits: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str, signs: list[int]) -> Iterator[Span]:
    """Expand each at-sign: the local part to the left, two labels or more to the right."""
    done = 0
    for sign in signs:
        start = sign
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start == sign:
            continue
        end = run_end(text, sign + 1, LABEL)
        labels = int(end > sign + 1)
        while labels and text[end : end + 1] == "." and (after := run_end(text, end + 1, LABEL)) > end + 1:
            end, labels = after, labels + 1
        if labels > 1:
            yield "email", start, end
            done = end


def digit_runs(digits: list[int]) -> list[tuple[int, int]]:
    """Places of neighbouring digits as (start, end)."""
    found: list[tuple[int, int]] = []
    for at in digits:
        if found and found[-1][1] == at:
            found[-1] = (found[-1][0], at + 1)
        else:
            found.append((at, at + 1))
    return found


def chains(text: str, runs: list[tuple[int, int]], between: str) -> Iterator[list[tuple[int, int]]]:
    """Digit runs that are one character of a set apart."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[run[0] - 1] in between):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def addresses(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    """Four parts at a time of each dotted chain; a part is at most 255."""
    for chain in chains(text, runs, "."):
        for i in range(0, len(chain) - 3, 4):
            parts = chain[i : i + 4]
            if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b][-3:]) <= 255 for a, b in parts):
                yield "ip", parts[0][0], parts[-1][1]


def cards(text: str, runs: list[tuple[int, int]]) -> Iterator[Span]:
    """Each chain of digits with single spaces or hyphens, if it holds 13 to 19 digits that pass the check."""
    for chain in chains(text, runs, " -"):
        digits = "".join([text[a:b] for a, b in chain])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", chain[0][0], chain[-1][1]


def phones(text: str, signs: list[int]) -> Iterator[Span]:
    """A plus sign, a digit, and the run after it up to its last digit."""
    for sign in signs:
        if text[sign + 1 : sign + 2] not in DIGITS:
            continue
        end = run_end(text, sign + 2, PHONE)
        while end > sign + 3 and text[end - 1] not in DIGITS:
            end -= 1
        if end <= sign + 3 or text[end - 1] not in DIGITS:
            continue
        if 9 <= sum(character in DIGITS for character in text[sign:end]) <= 15:
            yield "phone", sign, end


def iban_valid(text: str) -> bool:
    """The check digits of an account number, modulo 97."""
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join([str(int(c, 36)) for c in plain[4:] + plain[:4]])) % 97 == 1


def accounts(text: str, cues: list[tuple[int, str]]) -> Iterator[Span]:
    """What follows a cue that stands alone, if it is an account number."""
    done = 0
    for end, cue in cues:
        start = end - len(cue)
        if start < done or (start and text[start - 1].isalnum()):
            continue
        at = AFTER_CUE.match(text, end).end()
        if (found := IBAN.match(text, at)) and iban_valid(found[0]) or cue != "iban" and (found := ACCOUNT.match(text, at)):
            yield "account", found.start(), found.end()
            done = found.end()


def urls(text: str, schemes: list[tuple[int, str]]) -> Iterator[Span]:
    """Web addresses with user information."""
    for end, scheme in schemes:
        start = end - len(scheme)
        if not (start and text[start - 1].isalnum()) and (found := USERINFO.match(text, end)):
            yield "url", start, found.end()


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors; cues and schemes in lower and upper case and capitalised."""
    automaton = ahocorasick.Automaton()
    for sign in "@+0123456789":
        automaton.add_word(sign, ("@" if sign == "@" else "+" if sign == "+" else "digit", sign))
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                automaton.add_word(form, (kind, word))
    automaton.make_automaton()
    return automaton


def find_spans(text: str) -> list[Span]:
    """All spans of a text by kind as listed, then by start."""
    found: dict[str, list] = {"@": [], "+": [], "digit": [], "scheme": [], "cue": []}
    for last, (kind, word) in anchors().iter(text):
        found[kind].append((last + 1, word) if kind in ("scheme", "cue") else last)
    runs = digit_runs(found["digit"])
    spans = [*emails(text, found["@"]), *addresses(text, runs), *cards(text, runs), *phones(text, found["+"])]
    if found["scheme"]:
        spans += urls(text, found["scheme"])
    if found["cue"]:
        spans += accounts(text, found["cue"])
    return spans


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or each group of overlapping spans, replaced by the name of its kind."""
    out, done = [], 0
    for start, end, kind in sorted(((start, end, kind) for kind, start, end in spans), key=lambda s: (s[0], -s[1])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans, redacted): an array of (kind, start, end), and the text without them."""
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = texts(batch)
            spans = [find_spans(value) for value in values]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in each] for each in spans]
            clean = [redacted(value, each) if each else value for value, each in zip(values, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind), pa.array(clean, pa.string())], names=[key, "spans", "redacted"]
            )

    rows = docs.select(key, F.col(text).alias("text"))
    schema = f"`{key}` {rows.schema[0].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>, redacted string"
    return rows.mapInArrow(run, schema)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows as they are, their texts without personal data; a null text stays null."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [value and redacted(value, find_spans(value)) for value in batch.column(place).to_pylist()]
            yield batch.set_column(place, text, pa.array(clean, pa.string()))

    return docs.mapInArrow(run, docs.schema)
