"""The operators against brute force, the published tokenizers and held-out labels, on small tables."""

import hashlib
import math
import random
import re
import struct
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendloom.llm import (
    anchor_pii,
    byte_units,
    common,
    compression_quality,
    context_mixing,
    hnsw,
    license_scan,
    quartile_digest,
    queries,
    signature_join,
    slack_packing,
    token_counts,
    transducer_bpe,
)
from spendloom.session import scratch_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
HARD = [
    None,
    "",
    " ",
    "\n",
    "a",
    "Σας ΣΑΣ İstanbul ǅ é ﬁ",
    "two  spaces   three \n\n lines\t\ttab \r\n end  ",
    "<|endoftext|>mid<|startoftext|> <|endoftext|",
    "a\x1cb\x1d c\x85d e f​g",
    "don't we'll I'M 12 345 x²½ _under_ ---",
    "日本語テキスト 한국어 emoji 😀😀 \U0001f468‍\U0001f469",
    "z" * 3000,
    "mail a.b+c@x-y.co.uk, 10.0.0.256 1.2.3.4.5 4111 1111 1111 1111 +1 (555) 123-4567",
    "same same",
    "same same",
]


@pytest.fixture
def hard(spark):
    rows = [(i, text, "x", "left", 7) for i, text in enumerate(HARD)] + [(None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, decoded string, spans string, score int")


@pytest.fixture
def nothing(hard):
    return hard.where("false")


def by_id(df):
    return {row.doc_id: row for row in df.collect()}


def le_ids(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def sample_texts(n, seed=3):
    rng = random.Random(seed)
    alphabet = ["a", "B", "é", "ß", "Σ", "1", "²", " ", "  ", "\n", "\t", "'", "'s", "'ll", ".", "!?", "_", "\x1c", " ", " ", "漢", "é", "😀", "the", " and", "<|endoftext|>", "<|"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# BPE


def test_word_bpe_equals_published_tokenizer(spark, hard, nothing):
    published = Tokenizer.from_file(WORD_BPE)
    lexicon = transducer_bpe.build_lexicon(hard, WORD_BPE, 20)
    got = by_id(transducer_bpe.encode_decode(hard, lexicon, WORD_BPE))
    for i, text in [*enumerate(HARD), (None, None)]:
        ids = published.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids == le_ids(ids), text
        assert got[i].decoded == published.decode(ids, skip_special_tokens=False)
    assert transducer_bpe.encode_decode(nothing, transducer_bpe.build_lexicon(nothing, WORD_BPE), WORD_BPE).count() == 0


def test_word_bpe_on_random_texts():
    published, merges = Tokenizer.from_file(WORD_BPE), transducer_bpe.Merges(WORD_BPE)
    words = Counter(w for text in sample_texts(200, 1) for w in transducer_bpe.pieces(text))
    lexicon = transducer_bpe.compile_lexicon({w: merges.merge(w) for w in list(words)[::2]})
    coder = transducer_bpe.Coder(transducer_bpe.Transducer(lexicon), merges)
    for text in sample_texts(3000):
        ids = published.encode(text, add_special_tokens=False).ids
        assert coder.code(text) == (le_ids(ids), published.decode(ids, skip_special_tokens=False)), repr(text)


def test_short_and_long_merges_agree():
    merges = transducer_bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(7)
    for _ in range(2000):
        word = "".join(rng.choices("aeinrstéß的0!", k=rng.randint(1, 90)))
        data = word.encode()
        letters = [*(merges.letters[byte] for byte in data[:-1]), merges.ends[data[-1]]]
        assert merges.merged_short(list(letters)) == merges.merged_long(letters) == merges.merge(word)


def test_transducer_shares_suffixes_and_finds_exactly():
    words = {f"{a}{b}ing": [len(a), len(b)] for a in ("", "walk", "talk", "é") for b in ("", "s", "er")}
    found = transducer_bpe.Transducer(transducer_bpe.compile_lexicon(words))
    assert all(list(found.find(w.encode())) == ids for w, ids in words.items())
    assert found.find(b"walki") is None and found.find(b"walkingx") is None and found.find(b"") is None
    assert len(found.finals) < sum(map(len, words))


def test_byte_bpe_equals_published_tokenizer():
    published, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_units.ByteBpe(RANKS)
    for text in [*(t or "" for t in HARD), *sample_texts(4000)]:
        assert own.encode(text) == le_ids(published.encode(text, add_special_tokens=False).ids), repr(text)


# Packing


def check_packing(rows, ids_of):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert bytes(r.ids) == le_ids(ids_of[r.doc_id][r.start : r.start + r.length]) and r.length > 0
        assert r.doc_tokens == len(ids_of[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, ids in ids_of.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024


def test_packing(spark, hard, nothing):
    published = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids_of = {i: [*published.encode(t or "", add_special_tokens=False).ids, 0] for i, t in [*enumerate(HARD), (None, None)]}
    check_packing(slack_packing.pack(hard, RANKS).collect(), ids_of)
    assert slack_packing.pack(nothing, RANKS).count() == 0


def test_fill_is_the_closest_to_the_target():
    rng = random.Random(5)
    for _ in range(300):
        counts = [(x, rng.randint(1, 3)) for x in sorted(rng.sample(range(1, 30), rng.randint(0, 5)), reverse=True)]
        target = rng.randint(0, 60)
        chosen = slack_packing.best_fill(target, counts)
        assert all(chosen[x] <= dict(counts)[x] for x in chosen)
        sums = {0}
        for x, n in counts:
            sums = {s + k * x for s in sums for k in range(n + 1) if s + k * x <= target}
        assert sum(x * n for x, n in chosen.items()) == max(sums)


def test_patterns_use_every_length_once():
    lengths = Counter(random.Random(2).choices(range(1, 1024), k=500))
    used = Counter()
    for pattern, times in slack_packing.patterns(lengths):
        assert sum(x * n for x, n in pattern.items()) <= 1024
        used.update({x: n * times for x, n in pattern.items()})
    assert used == lengths


# Quality


def test_quality_on_held_out_rows(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    good = [" ".join(rng.choices(words, k=rng.randint(5, 300))) for _ in range(300)]
    bad = [" ".join(w.upper() + "!!" for w in rng.choices(words, k=rng.randint(5, 300))) for _ in range(100)]
    rows = [(i, t, int(i < 300)) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2], "doc_id bigint, quality int")
    scores = by_id(compression_quality.score(docs, compression_quality.fit(docs, labels)))
    held = [(scores[i].score >= 0.5, bool(q)) for i, _, q in rows if i % 2 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.97


def test_quality_of_odd_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 1), (6, 0), (9, 1), (10, 0), (9, None), (None, 1), (99, 7)], "doc_id bigint, quality int")
    model = compression_quality.fit(hard, labels)
    rows = compression_quality.score(hard, model).collect()
    assert len(rows) == len(HARD) + 1 and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.score for r in rows}
    assert got[0] == got[1] == got[None] and got[13] == got[14]
    assert compression_quality.score(nothing, model).count() == 0
    alone = compression_quality.fit(hard, labels.where("quality = 1"))
    assert compression_quality.score(hard, alone).where("score < 0.99").count() == 0
    even = compression_quality.fit(hard, labels.where("false"))
    assert {round(r.score, 6) for r in compression_quality.score(hard, even).collect()} == {0.5}
    kept = compression_quality.scored(hard, model)
    assert kept.columns == [*hard.columns] and kept.count() == hard.count()


# Digests


def test_edited_fingerprints(spark, hard, nothing):
    rows = quartile_digest.edited_fingerprints(hard.where("doc_id is not null")).collect()
    texts = {i: t or "" for i, t in enumerate(HARD)}
    ids = sorted(texts, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    assert len(rows) == len(texts)
    for r in rows:
        own, after = texts[r.doc_id], texts[following[r.doc_id]]
        third = len(own) // 3
        edited = own[: len(own) - third] + after[:third]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == quartile_digest.digest(own.encode()) and r.edited_fingerprint == quartile_digest.digest(edited.encode())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert quartile_digest.edited_fingerprints(nothing).count() == 0
    assert quartile_digest.edited_fingerprints(hard).count() == len(HARD) + 1
    one = quartile_digest.edited_fingerprints(hard.where("doc_id = 9")).collect()
    assert [r.near_next for r in one] == [1.0]


def test_likeness_falls_with_edits():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(200)]
    text = " ".join(rng.choices(words, k=400))
    other = " ".join("".join(rng.choices("qrstuvwxyz", k=5)) for _ in range(400))
    digests = [quartile_digest.digest((text[: len(text) - n] + other[:n]).encode()) for n in (0, 100, 600, 2000)]
    near = [quartile_digest.likeness(digests[0], d) for d in digests]
    assert near[0] == 1 and near == sorted(near, reverse=True)


def test_bucket_counts_against_a_loop():
    data = "Zürich und Bern".encode()
    triplets = Counter(data[i : i + 3] for i in range(len(data) - 2))
    counts = quartile_digest.bucket_counts(data)
    assert counts.sum() == sum(triplets.values())
    assert sorted(counts[counts > 0]) == sorted(triplets.values())


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
            luhn = sum(sum(map(int, str(x))) for x in doubled) % 10 == 0
            if kind == "ip" and any(int(part) > 255 for part in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            yield kind, m.start(), m.end()


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    parts = ["a", "@", ".", "+", "1", "25", " ", "-", "(", ")", "b.c", "4111111111111111", "555 555", "300", "00", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 24)))
        assert [s for s in anchor_pii.find_spans(text) if s[0] in anchor_pii.BASE] == list(base_spans(text)), text


def test_added_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678 and ftp://joe:pw@host/x"
    found = {kind: text[a:b] for kind, a, b in anchor_pii.find_spans(text) if kind in anchor_pii.ADDED}
    assert found["url"] == "ftp://joe:pw@host/x"
    spans = [text[a:b] for kind, a, b in anchor_pii.find_spans(text) if kind == "account"]
    assert spans == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert anchor_pii.find_spans("IBAN DE88 3704 0044 0532 0130 00x on account of http://example.com") == []


def test_personal_data_rows(spark, hard, nothing):
    got = by_id(anchor_pii.scan(hard))
    for i, text in [*enumerate(HARD), (None, None)]:
        assert [tuple(s) for s in got[i].spans if s.kind in anchor_pii.BASE] == list(base_spans(text or ""))
    # The "5" before the card number is one chain with it, of 17 digits, and is dropped as the pattern says.
    assert got[12].redacted == "mail [EMAIL], 10.0.0.256 [IP].5 4111 1111 1111 1111 [PHONE]"
    assert anchor_pii.redacted("card 4111 1111 1111 1111.", anchor_pii.find_spans("card 4111 1111 1111 1111.")) == "card [CARD]."
    assert anchor_pii.scan(nothing).count() == 0
    clean = anchor_pii.redact(hard)
    assert clean.columns == hard.columns and by_id(clean)[12].text == got[12].redacted and by_id(clean)[12].score == 7


# Nearest neighbours


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 700)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 16))
    vectors[500:900] = vectors[7]  # a hot vector
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    odd = [(3000, None, ""), (3050, [0.0] * 16, ""), (3100, [math.nan] * 16, ""), (3150, [None] * 16, ""), (None, [1.0] * 16, ""), (3200, [1.0], ""), (3250, [], "")]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, score string")
    got = defaultdict(dict)
    for r in hnsw.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    norms = np.linalg.norm(vectors, axis=1)
    hits = 0
    assert set(got) == set(range(0, 2000, 50))
    for q, found in got.items():
        scores = vectors @ vectors[q] / (norms * norms[q])
        scores[q] = -9
        best = np.lexsort((np.arange(2000), -np.round(scores, 12)))[:5]
        hits += len({v for v, _ in found.values()} & set(best))
        assert sorted(found) == [1, 2, 3, 4, 5] and all(abs(s - scores[v]) < 1e-9 for v, s in found.values())
    assert hits / (5 * len(got)) >= 0.9
    assert [v for v, _ in (got[500][r] for r in range(1, 6))] == [7, 501, 502, 503, 504]


def test_few_neighbours(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    rows = hnsw.nearest(df, df.where("vec_id % 50 = 0")).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in rows] == [(1, 2), (2, 1)]
    assert hnsw.nearest(df.where("false"), df.where("false")).count() == 0
    assert hnsw.nearest(df.where("vec_id = 50"), df.where("vec_id = 50")).count() == 0


# Language model


def test_language_model_base_scores(spark, hard, nothing):
    rows = context_mixing.score(hard, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))).collect()
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t in [*enumerate(HARD), (None, None)]}
    counts = Counter(w for i in tokens if i is not None and i % 3 for w in tokens[i])
    total = sum(counts.values())
    assert len(rows) == len(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in own)
        assert r.base_score == pytest.approx(base) and r.n_tokens == len(own) and r.train_tokens == total
        assert r.n_known == sum(counts[w] > 0 for w in own) and r.score < 0
    assert context_mixing.score(nothing, F.lit(True)).count() == 0
    assert context_mixing.score(hard, F.lit(False)).where("train_tokens = 0 AND n_known = 0").count() == len(tokens)


def test_language_model_is_a_distribution_that_learns():
    words = [b"the", b"then", b"other", b"mother", b"", b"zz"] * 5
    portions = lambda: iter([(words[:6], np.array([50, 20, 9, 5, 20, 1]))])
    model = context_mixing.Model(context_mixing.sixteen_bits(context_mixing.tally_bits(portions())), context_mixing.first_weights())
    _, ones, mass = context_mixing.learn_online(portions(), model)
    model.refined = context_mixing.map_from(ones, mass)
    # The next byte after "the": all 256 probabilities, as one-byte endings differ only there.
    first = model.log10([bytes([b]) for b in range(256) if b != 0x20])
    ends = model.log10([b""])
    assert (10**first).sum() + (10**ends).sum() <= 1 + 1e-9
    assert model.log10([b"the"])[0] > model.log10([b"thq"])[0] + 1


def test_prefix_hash_does_not_depend_on_the_place_in_a_batch():
    alone = context_mixing.Positions([b"abcdefghij"])
    among = context_mixing.Positions([b"xyz", b"", b"abcdefghij"])
    for a, b in zip(alone.hashes, among.hashes, strict=True):
        assert (a == b[-11:]).all()


def test_counts_are_exact_at_any_number_of_slices_and_portions(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "PORTION_BYTES", 300)
    monkeypatch.setattr(context_mixing, "SLICE_KEYS", 500)
    rng = random.Random(4)
    words = sorted({bytes(rng.choices(b"abcdexyz", k=rng.randint(0, 9))) for _ in range(400)})
    table = spark.createDataFrame([(w, i % 7, [(i % 3, i % 7)]) for i, w in enumerate(words)], "word binary, n bigint, counts array<struct<g:int,n:bigint>>")
    shares = np.full(context_mixing.GROUPS, 1 / context_mixing.GROUPS)
    rows = context_mixing.evidence(table.repartition(3), shares).collect()
    assert len(rows) > 3 and sorted(bytes(w) for r in rows for w in r.words) == words
    seen = Counter()  # (order, context, first bits of the byte): occurrences
    def paths(word):
        whole = word + b" "
        for at, byte in enumerate(whole):
            for order in (*context_mixing.ORDERS, None):
                context = (at, whole[:at]) if order is None else whole[max(0, at - order) : at]
                yield [(order, context, depth, byte >> (8 - depth)) for depth in range(9)]
    for i, word in enumerate(words):
        for path in paths(word):
            seen.update({step: i % 7 for step in path})
    import zstandard
    for r in rows:
        own = [bytes(w) for w in r.words]
        told = np.frombuffer(zstandard.decompress(r.told), np.int64).reshape(9, -1)
        got = context_mixing.Model(None).totals(context_mixing.Positions(own), told)
        want = np.array([[seen[step] for step in path] for word in own for path in paths(word)]).reshape(-1, context_mixing.CONTEXTS, 9)
        assert (got == want.transpose(1, 2, 0)).all()


def test_packed_numbers_and_paths_come_back_whole():
    rng = np.random.default_rng(5)
    for values in (np.zeros(0, np.int64), np.array([0, 254, 255, 256, 1 << 40]), rng.integers(0, 1000, 5000)):
        assert (context_mixing.unpacked(context_mixing.packed(values)) == values).all()
    keys = np.unique(rng.integers(0, 1 << 63, 300, np.uint64) << np.uint64(8) | rng.integers(0, 256, (9, 300), np.uint64))
    keys = np.unique(np.concatenate([keys, np.array([0, 255, (1 << 64) - 1], np.uint64)]))
    counts = rng.integers(0, 400, len(keys))
    assert (context_mixing.unpacked_keys(context_mixing.packed_keys(keys)) == keys).all()
    totals = context_mixing.path_totals((keys, counts), keys)
    assert (context_mixing.own_totals((keys, counts)) == totals).all()
    asked = np.sort(rng.permutation(len(keys))[:700])
    steps = context_mixing.path_steps(keys[asked], totals[:, asked])
    assert len(steps) < totals[:, asked].size and (context_mixing.from_steps(keys[asked], steps) == totals[:, asked]).all()
    words = [b"", b"a", b"\x00\xff", b"zz"]
    assert context_mixing.unpacked_words(context_mixing.packed_words(words)) == words and context_mixing.unpacked_words(context_mixing.packed_words([b""])) == [b""]


def test_the_language_model_writes_little_more_than_its_result_reads(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(200)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    numbers = iter(range(100))
    for module in (common, context_mixing):
        monkeypatch.setattr(module, "scratch_folder", lambda _: str(tmp_path / f"table-{next(numbers)}"), raising=False)
    rows = context_mixing.score(df, F.col("doc_id") % 10 != 0)
    left = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert 0 < left < 8 * sum(map(len, texts))
    assert rows.count() == rows.count() == 150  # from what is left


def test_the_previous_word_counts_and_pairs_add_up_to_one(spark):
    texts = ["red fox", "red fox", "red fox", "blue dog", "blue dog", "blue dog", "fox", "dog"]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(["red fox", "red dog", "blue dog", "blue fox", "", "red"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, trains boolean")
    got = {r.doc_id: r.score for r in context_mixing.score(df, F.col("trains")).collect()}
    assert got[100] > got[101] + 0.2 and got[102] > got[103] + 0.2 and got[0] == got[100]
    assert sum(10**score for key, score in got.items() if key >= 100) < 1
    assert context_mixing.ORDERS[0] == 1


# Near duplicates


def brute_groups(texts, size, percent):
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
    parent = {i: i for i in texts}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


@pytest.mark.parametrize(("size", "percent", "tile"), [(3, 90, 8 << 20), (5, 80, 2000), (1, 50, 1000)])
def test_groups_equal_brute_force(spark, monkeypatch, size, percent, tile):
    monkeypatch.setattr(signature_join, "TILE", tile)
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(260):
        if i % 3 and i > 5:
            words = texts[rng.randrange(i)].split()
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 15, 40, 120]))
        texts[i] = " ".join(words)
    texts |= {300 + i: t for i, t in enumerate(["", None, "  ", "One", "one\n", "ONE two", "one TWO"])}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id bigint, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.groups(df, size, percent).collect()}
    assert got == brute_groups(texts, size, percent)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_a_passage_in_every_document_makes_no_block_of_them_all(spark, monkeypatch, size, percent):
    monkeypatch.setattr(signature_join, "AT_ONCE", 500)  # many portions and blocks of the hash range
    monkeypatch.setattr(signature_join, "BLOCK_SHINGLES", 2000)
    rng = random.Random(percent)
    passage = [f"p{i}" for i in range(50)]
    texts: dict[int, str] = {}
    for i in range(300):
        words = texts[i - 1].split() if i % 3 == 1 else [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 61, 80, 120]))] + passage
        if i % 3 == 1:
            words[rng.randrange(len(words))] = f"w{i}"
        texts[i] = " ".join(words)
    heaviest = []
    true_links = signature_join.true_links

    def watched(docs, blocks, *rest):
        heaviest.extend(r["count"] for r in blocks.groupBy("component").count().collect())
        return true_links(docs, blocks, *rest)

    monkeypatch.setattr(signature_join, "true_links", watched)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.groups(df, size, percent).collect()}
    assert got == brute_groups(texts, size, percent)
    assert max(heaviest) <= 10


def test_groups_of_odd_rows(spark, hard, nothing):
    rows = signature_join.groups(hard).collect()
    assert len(rows) == len(HARD) + 1
    assert {r.doc_id: r.component_id for r in rows}[14] == 13
    assert signature_join.groups(nothing).count() == 0
    repeated = signature_join.groups(hard.where("doc_id = 9").union(hard.where("doc_id = 9"))).collect()
    assert [r.component_id for r in repeated] == [9, 9]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "one bigint, other bigint")
    got = {r.node: r.component for r in signature_join.components(links).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100: 90}


# Licences


def test_license_scan_against_exact_windows(spark, hard, nothing):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(50)]
    texts = {0: "", 1: None, 2: "Released under the MIT License."}
    for i in range(3, 60):
        parts = rng.choices(words, k=rng.randint(0, 400))
        for notice in rng.sample(list(license_scan.NOTICES.values()), rng.randint(0, 2)):
            at = rng.randint(0, len(parts))
            kept = notice.split() if rng.random() < 0.6 else notice.split()[: -rng.randint(1, 4)]
            parts[at:at] = kept
        texts[i] = " ".join(parts)

    def shingles(text):
        found = re.findall(r"[^\W_]+", (text or "").lower())
        return [tuple(found[j : j + 3]) for j in range(max(1, len(found) - 2))] if found else []

    want = {}
    for i, text in texts.items():
        own = shingles(text)
        for name, notice in license_scan.NOTICES.items():
            wanted = set(shingles(notice))
            for w in range(max(1, math.ceil(len(own) / 64) - 1)):
                share = len(wanted & set(own[64 * w : 64 * w + 128])) / len(wanted)
                if share >= license_scan.LEAST and share > want.get((i, name), (0, 0))[0]:
                    want[i, name] = (share, w)
    templates = spark.createDataFrame(list(license_scan.NOTICES.items()), "license string, text string")
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, license string")
    got = {(r.doc_id, r.license): (r.containment, r.window) for r in license_scan.scan(df, templates).collect()}
    assert got == want
    assert license_scan.scan(hard, templates).count() == 0 and license_scan.scan(nothing, templates).count() == 0
    assert license_scan.scan(df, templates.where("false")).count() == 0


def test_whole_licence_texts_are_found_at_any_place(spark):
    whole = license_scan.whole_texts() | {"long": " ".join(f"t{i}" for i in range(500)), "spent": " ".join(f"u{i}" for i in range(122))}
    sizes = {name: len(re.findall(r"[^\W_]+", text)) for name, text in whole.items()}
    assert sizes["mit-text"] > 160 and sizes["gpl-3.0-text"] > 5000
    names = list(whole)
    before = [0, 1, 31, 63, 64, 100, 150, 700]
    rows = [(i * 100 + at, " ".join([*(f"w{j}" for j in range(n)), whole[name], "after it"])) for i, name in enumerate(names) for at, n in enumerate(before)]
    templates = spark.createDataFrame(list(whole.items()), "license string, text string")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.license): r.containment for r in license_scan.scan(docs, templates).collect()}
    for key, _ in rows:
        assert got[key, names[key // 100]] == 1
    assert {names[key // 100] for key, name in got if name == "long"} == {"long"}


def test_all_notices_beside_each_other_are_found(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        notices = list(license_scan.NOTICES.values())
        rng.shuffle(notices)
        rows.append((i, " ".join([*(f"w{rng.randrange(99)}" for _ in range(rng.randrange(30))), *notices])))
    # Thirty templates of three shingles, side by side in one window.
    lines = {f"line{i}": " ".join(f"n{i}x{j}" for j in range(5)) for i in range(30)}
    rows.append((300, " ".join(lines.values())))
    templates = spark.createDataFrame(list((license_scan.NOTICES | lines).items()), "license string, text string")
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), templates).where("containment = 1")
    got = {(r.doc_id, r.license) for r in found.collect()}
    assert got == {(i, name) for i in range(300) for name in license_scan.NOTICES} | {(300, name) for name in lines}


def test_hnsw_vectors_of_two_lengths_and_of_any_magnitude(spark):
    """Queries of a length that candidates rarely have take no part; scores of huge and tiny vectors are cosines."""
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * scale for _ in range(3)]) for i, scale in enumerate(rng.choice([1e-200, 1.0, 1e200]) for _ in range(39))]
    vectors = spark.createDataFrame(rows + [(50, [1.0, 2.0]), (100, [2.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert hnsw.nearest(vectors, vectors.where("vec_id % 50 = 0 AND vec_id > 0"), 5).count() == 0
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in hnsw.nearest(vectors, vectors.where("vec_id < 3"), 5).collect()}
    units = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    for query in range(3):
        best = sorted(((-float(units[query] @ v), i) for i, v in units.items() if i != query))[:5]
        for rank, (score, i) in enumerate(best, 1):
            assert got[query, rank][0] == i and abs(got[query, rank][1] + score) < 1e-12


# Token rollups


def test_rollup(spark, hard, nothing):
    docs = hard.select("doc_id", "text", F.col("decoded").alias("source"), F.col("spans").alias("lang"))
    counts = token_counts.of_version(token_counts.token_numbers(docs, RANKS, WORD_BPE), "byte_tokens", "v1")
    rollup = token_counts.TokenRollup(spark, scratch_folder(spark))
    assert rollup.totals().count() == 0
    assert rollup.apply("load", token_counts.signed(counts, 1)) and not rollup.apply("load", token_counts.signed(counts, 1))
    published = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(published.encode(t or "", add_special_tokens=False).ids) for t in HARD)

    def totals(store):
        return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in store.totals().collect()}

    assert totals(rollup) == {("x", "left", "v1"): (len(HARD), total), (None, None, "v1"): (1, 0)}
    rollup.apply("drop", token_counts.signed(counts.where("doc_id is null"), -1))
    rollup.compact()
    rollup.apply("again", token_counts.revised(counts.where("doc_id = 9"), token_counts.of_version(token_counts.token_numbers(docs.where("doc_id = 9"), RANKS, WORD_BPE), "word_tokens", "v2")))
    again = token_counts.TokenRollup(spark, rollup.folder)
    assert not again.apply("drop", token_counts.signed(counts, -1)) and not again.apply("again", token_counts.signed(counts, -1))
    nine = len(published.encode(HARD[9], add_special_tokens=False).ids)
    assert totals(again) == {("x", "left", "v1"): (len(HARD) - 1, total - nine), (None, None, "v1"): (0, 0), ("x", "left", "v2"): (1, len(Tokenizer.from_file(WORD_BPE).encode(HARD[9], add_special_tokens=False).ids))}
    assert again.apply("empty", token_counts.signed(counts.where("false"), 1))
    again.compact()
    assert totals(token_counts.TokenRollup(spark, rollup.folder)) == totals(again)


def test_word_crc(spark):
    """The fold of the queries is that of zlib."""
    from spendloom.llm.common import fold

    rows = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_word_tokens_equal_the_published_tokenizer():
    published = Tokenizer.from_file(WORD_BPE)
    values = [text or "" for text in HARD] + sample_texts(500, 8)
    assert token_counts.WordTokens(WORD_BPE).counts(values) == [len(published.encode(v, add_special_tokens=False).ids) for v in values]


def test_rollup_query_shuffles_no_texts(spark, monkeypatch):
    """Totals of the registered query, and no text below any exchange of its batches."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plans = []
    apply = token_counts.TokenRollup.apply
    monkeypatch.setattr(token_counts.TokenRollup, "apply", lambda self, name, rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or apply(self, name, rows))
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in queries.QUERIES["op1_token_rollup"](spark, "/root/testdata/sf0.001").collect()}
    assert len(plans) == 4 and not any("text" in plan.replace("text_", "") for plan in plans)
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    poor = {r.doc_id for r in labels.where("quality = 0").collect()} - toxic
    byte_bpe, word_bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Tokenizer.from_file(WORD_BPE)
    want = defaultdict(lambda: [0, 0])
    for r in docs.collect():
        for name, model in (("byte_bpe_50k", byte_bpe), ("word_bpe_49k", word_bpe)):
            kept = r.doc_id not in toxic and (r.doc_id in poor) == (name == "word_bpe_49k")
            n = len(model.encode(r.text or "", add_special_tokens=False).ids) if kept else 0
            if kept or name == "byte_bpe_50k" or r.doc_id in poor:
                want[r.source, r.lang, name][0] += kept
                want[r.source, r.lang, name][1] += n
    assert got == {key: tuple(value) for key, value in want.items()}


def test_white_space_of_any_length(spark):
    """Runs on which the pattern's matcher gives up, at every place of a text, as the published tokenizer codes them."""
    published, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), byte_units.ByteBpe(RANKS)
    for run in (" " * 5000, "\n" * 3000, " \t\n" * 1500, "\u3000" * 3000):
        for text in (run, f"a{run}", f"{run}b", f"a{run}b c{run}<|endoftext|>{run}\x1cd", f"x {run}\n y"):
            assert own.encode(text) == le_ids(published.encode(text, add_special_tokens=False).ids), repr(text[:5])
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "a" + "\n" * 300_000 + "b")], "doc_id bigint, text string")
    pieces = slack_packing.pack(docs, RANKS)
    assert {r.doc_id: r.n for r in pieces.groupBy("doc_id").agg(F.max("doc_tokens").alias("n")).collect()} == {i: len(own.encode(t)) // 4 + 1 for i, t in docs.collect()}


def test_word_bpe_on_every_character():
    """Each code point up to the emoji between letters, and marks in any order."""
    published, merges = Tokenizer.from_file(WORD_BPE), transducer_bpe.Merges(WORD_BPE)
    coder = transducer_bpe.Coder(transducer_bpe.Transducer(transducer_bpe.compile_lexicon({"the": merges.merge("the")})), merges, transducer_bpe.odd_characters(WORD_BPE), published)
    points = [chr(i) for i in range(0x33480) if not 0xD800 <= i < 0xE000]
    marks = [c for c in points if unicodedata.category(c)[0] == "M"]
    rng = random.Random(1)
    mixed = ["".join(rng.choice([rng.choice(points), rng.choice(marks), "a", "e "]) for _ in range(12)) for _ in range(4000)]
    for text, told in ((t, e) for part in (mixed, [f"a{c}b" for c in points]) for t, e in zip(part, published.encode_batch(part, add_special_tokens=False), strict=True)):
        assert coder.code(text)[0] == le_ids(told.ids), ascii(text)


def test_frequent_words_are_the_most_frequent(spark):
    rng = random.Random(9)
    counts = {f"w{i}": rng.choice([1, 1, 1, 2, 3, 5, 9, 40, 1000 + i]) for i in range(300)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    for limit in (0, 1, 7, 60, 150, 299, 300, 500):
        want = sorted(counts, key=lambda w: (-counts[w], w))[:limit]
        assert sorted(transducer_bpe.frequent_words(df, limit)) == sorted(want), limit


def test_neighbours_among_parallel_and_nearly_equal_vectors(spark, monkeypatch):
    """The graph finds them in knots of parallel, nearly parallel and tightly clustered vectors, too."""
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 800)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(3, 32))
    sets = [
        np.concatenate([rng.normal(size=(600, 32)), centres[0] * rng.uniform(0.1, 9, size=(600, 1))]),
        centres[rng.integers(0, 3, 1200)] + 1e-4 * rng.normal(size=(1200, 32)),
        centres[rng.integers(0, 3, 1200)] + 1e-7 * rng.normal(size=(1200, 32)),
        np.eye(32)[rng.integers(0, 32, 1200)] * rng.integers(1, 50, (1200, 1)),
    ]
    for vectors in sets:
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        hits = []
        for r in hnsw.nearest(df, df.where("vec_id % 50 = 0")).collect():
            scores = np.delete(units @ units[r.query_id], r.query_id)
            hits.append(r.score >= np.sort(scores)[-5] - 1e-15 and r.vec_id != r.query_id)
        assert len(hits) == 5 * 24 and np.mean(hits) >= 0.95


def test_every_node_of_a_graph_can_be_reached():
    vectors = np.eye(64)
    graph = hnsw.Graph(vectors, [64], [np.full((64, 2), -1, np.int64)])
    graph.connect()
    assert graph.reached().all() and graph.beam_for(vectors) <= hnsw.SEARCH_BEAM


def test_bpe_decodes_a_text_once_and_knows_odd_characters():
    """Token names are joined for a whole text; characters below U+10000 are told by the shorter pattern as by the whole one."""
    merges, odd = transducer_bpe.Merges(WORD_BPE), transducer_bpe.odd_characters(WORD_BPE)
    published = transducer_bpe.published_tokenizer(WORD_BPE)
    coder = transducer_bpe.Coder(transducer_bpe.Transducer(transducer_bpe.compile_lexicon({"the": merges.merge("the")})), merges, odd, published)
    decoded, decode = [], coder.decode
    coder.decode = lambda ids: decoded.append(1) or decode(ids)
    text = "the cat, the <|endoftext|> unseen-words \U0001f600 caf\xe9 ͸ the"
    told = published.encode(text, add_special_tokens=False).ids
    assert coder.code(text) == (le_ids(told), published.decode(told, skip_special_tokens=False)) and len(decoded) == 1
    assert coder.code("") == (b"", "")
    whole = re.compile(odd)
    for point in [*range(0x80, 0xD800, 7), *range(0xE000, 0x33480, 11)]:
        assert coder.is_odd("a" + chr(point)) == bool(whole.search(chr(point)))
