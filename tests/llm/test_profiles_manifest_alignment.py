"""Language profiles, the Merkle manifest and tokenizer alignment against plain versions of themselves."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendloom.llm import merkle_manifest, rank_profiles, token_alignment
from spendloom.llm.common import fold
from spendloom.llm.queries import QUERIES

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
ODD = "doc_id bigint, source string, lang string, n_chars bigint, text string, siblings string, pair string, rank int"


# Language


def plain_grams(text):
    words = "".join(c if c.isalpha() or rank_profiles.kinds()[0][ord(c)] else " " for c in text.lower()).split()
    counts = Counter()
    for word in words:
        padded = f" {word} "
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def code(gram):
    return sum(ord(c) << 21 * (len(gram) - 1 - i) for i, c in enumerate(gram))


def ranked(counts):
    return [gram for gram, _ in sorted(counts.items(), key=lambda item: (-item[1], code(item[0])))[: rank_profiles.PROFILE]]


def plain_language(text, profiles):
    if not any(c.isalpha() for c in text or "") or not profiles:
        return "und", 0.0
    own, most = ranked(plain_grams(text)), rank_profiles.PROFILE
    best = min((sum(abs(i - ranks[g]) if g in ranks else most for i, g in enumerate(own)), lang) for lang, ranks in profiles.items())
    return best[1], 1 - best[0] / (most * len(own))


SAMPLES = {"en": "the cat and the dog went to the other house ", "de": "der Hund und die Katze über dem großen Haus ", "el": "ο σκύλος και η γάτα στο σπίτι "}


def language_rows():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        lang = rng.choice(list(SAMPLES))
        words = SAMPLES[lang].split()
        rows.append((i, "s", lang, 1, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), None, None, None))
    odd = [None, "", " \n ", "123 !?", "a", "İŞ ǅ ﬁ ΣΑΣ", "日本語 テキスト", "x" * 5000, "the the", "the the"]
    rows += [(100 + i, None, "en" if i % 2 else None, None, text, "x", "y", 3) for i, text in enumerate(odd)]
    return rows + [(None, None, None, None, None, None, None, None), (None, None, "en", None, "the cat", None, None, None)]


def test_profiles_equal_a_plain_version(spark, monkeypatch):
    rows = language_rows()
    docs = spark.createDataFrame(rows, ODD)
    learnt = defaultdict(Counter)
    for doc_id, _, lang, _, text, *_ in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 and lang and text:
            learnt[lang].update(plain_grams(text))
    plain = {lang: {gram: i for i, gram in enumerate(ranked(counts))} for lang, counts in learnt.items()}
    found = rank_profiles.predict(docs.repartition(3), rank_profiles.learn(docs, fold("doc_id", 5) != 0))
    got = sorted((repr(r.doc_id), r.lang_pred, round(r.score, 9)) for r in found.collect())
    want = [(repr(r[0]), *plain_language(r[4], plain)) for r in rows]
    assert got == sorted((doc_id, lang, round(score, 9)) for doc_id, lang, score in want)


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Ein  langer, Text\n\nmit Wörtern 12 und á — "
    whole = sorted(x for part in rank_profiles.grams(text) for x in part.tolist())
    assert whole == sorted(code(g) for g, n in plain_grams(text).items() for _ in range(n))
    for size in (1, 2, 3, 7, len(text)):
        monkeypatch.setattr(rank_profiles, "SLICE", size)
        assert sorted(x for part in rank_profiles.grams(text) for x in part.tolist()) == whole


def test_profiles_of_nothing(spark):
    docs = spark.createDataFrame([(1, None, None, None, "some text", None, None, None)], ODD)
    nothing = rank_profiles.learn(docs, F.lit(True))
    assert [(r.lang_pred, r.score) for r in rank_profiles.predict(docs, nothing).collect()] == [("und", 0.0)]
    assert rank_profiles.predict(docs.where("false"), nothing).count() == 0


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op11_rank_profiles"](spark, FOLDER)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    right = found.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


# Manifest


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    nodes, steps, places = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for k, place in enumerate(places):
            start = place - place % 3
            steps[k].append((nodes[start:place], nodes[place + 1 : start + 3]))
            places[k] = place // 3
        nodes = [hashed(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], steps


def plain_manifest(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text, *_ in rows:
        tampered = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            tampered = text.replace("\n", "")
        leaf, other = (hashed(*map(field, (doc_id, source, lang, n_chars, t))) for t in (text, tampered))
        groups[source].append(((doc_id is not None, doc_id), leaf, other))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda row: (row[0][0], row[0][1] or 0, row[1]))
        trees[source] = plain_tree([leaf for _, leaf, _ in groups[source]])
    root, upper = plain_tree([trees[source][0] for source in sources])
    out = []
    for source, above in zip(sources, upper, strict=True):
        for ((_, doc_id), leaf, folded), own in zip(groups[source], trees[source][1], strict=True):
            for before, after in own + above:
                folded = hashed(*before, folded, *after)
            proof = hashed(*[x for before, after in own + above for x in before + after])
            out.append((doc_id, leaf, trees[source][0], root, proof, folded, folded == root))
    return Counter(out)


def manifest_rows(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "a\nb", "é\n\n漢", "same", "x" * 300 + "\n"])
            rows.append((rng.randint(-50, 500), source, rng.choice(["en", None]), rng.choice([1, None]), text, "clash", "clash", 1))
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"hot": 260, None: 5, "": 1, "b": 27, "ä": 28, "z": 3, "y": 81, "x": 82},
        {"only": 1},
        {"only": 30},
        {f"s{i}": 1 + i % 4 for i in range(40)},
    ],
)
def test_manifest_equals_plain_trees(spark, sizes):
    rows = manifest_rows(sizes)
    rows += rows[:2]  # repeated rows are leaves of their own
    rows += [(None, rows[0][1], None, None, "no\nid", None, None, None)] * 3
    docs = spark.createDataFrame(rows, ODD).repartition(5)
    assert Counter(tuple(row) for row in merkle_manifest.verified(docs).collect()) == plain_manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle_manifest.verified(spark.createDataFrame([], ODD)).count() == 0


def test_manifest_query_on_a_table(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select(*merkle_manifest.COLUMNS).collect()]
    found = QUERIES["op12_merkle_climb"](spark, FOLDER)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(row) for row in found.collect()) == plain_manifest(rows)


def test_manifest_leaves_meet_no_source(spark):
    """Leaves are placed without a window or a shuffle over whole sources."""
    docs = spark.createDataFrame(manifest_rows({"hot": 50, "b": 3}), ODD)
    plan = merkle_manifest.ordered_leaves(docs)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source#" not in plan.split("Window")[0]


# Alignment


class Plain:
    """Whole texts, one token after another."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_BPE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.letters = {letter: byte for byte, letter in enumerate(token_alignment.byte_letters())}

    def bytes_b(self, token):
        piece = self.b.id_to_piece(token)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(token) else piece.replace("▁", " ").encode()

    def groups(self, text):
        """[(A ids, B ids)], or None without tokens."""
        if not text:
            return None
        tokens = []
        for ids, data in (
            (a := self.a.encode(" " + text, add_special_tokens=False).ids, [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]),
            (b := self.b.encode(text), [self.bytes_b(i) for i in b]),
        ):
            if b"".join(data) != (" " + text).encode():
                return None
            ends, end = [], 0
            for x in data:
                end += len(x)
                ends.append(end)
            tokens.append((ids, ends))
        cuts = sorted(set(tokens[0][1]) & set(tokens[1][1]))
        found, at = [], [0, 0]
        for cut in cuts:
            stop = [ends.index(cut) + 1 for _, ends in tokens]
            found.append(tuple(ids[i:j] for (ids, _), i, j in zip(tokens, at, stop, strict=True)))
            at = stop
        return found


def written_out(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain_alignment(rows):
    plain = Plain()
    found = [(row[0], plain.groups(row[4])) for row in rows]
    counts = Counter((a[-1], b[-1]) for _, groups in found for a, b in groups or [])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, groups in found:
        if groups is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a[-1], b[-1]) for a, b in groups]
        best = sum(counts[link] == most[link[1]] for link in links)
        sizes = sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links)
        out.append((doc_id, *sizes, best, sum(counts[link] for link in links), hashlib.sha256(written_out(groups).encode()).hexdigest()))
    return Counter(out)


PARTS = ["a", "B", "é", "ß", "1", "²", " ", "  ", "   ", "\n", "\t", "\r", "\r\n", "'s", ".", "!?", ");\r", "_", "\x1c", "\x85", "　", " ", "​", "漢", "世", "😀"]
PARTS += ["\U0001f9ff", "the", " and", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "▁", "\x00", "́", "ﬁ", " {\r"]


def alignment_texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_units_align_as_whole_texts():
    own, plain = token_alignment.Aligner(BYTE_BPE, PIECES), Plain()
    assert own.by_units
    texts = alignment_texts(4000) + ["word " * 500, "x" * 3000, " " * 2000 + "a", "é" * 200 + "漢" * 200]
    for text, got in zip(texts, own.texts(texts[:2000]) + own.texts(texts[2000:]), strict=True):
        groups = plain.groups(text)
        if groups is None:
            assert got == (0, 0, 0, "", [], []), repr(text)
        else:
            want = Counter(a[-1] * token_alignment.HALF + b[-1] for a, b in groups)
            assert got[3] == hashlib.sha256(written_out(groups).encode()).hexdigest(), repr(text)
            assert got[:3] == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups))
            assert dict(zip(got[4], got[5], strict=True)) == want


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_alignment_equals_a_plain_version(spark, monkeypatch, broadcast):
    monkeypatch.setattr(token_alignment, "BROADCAST_PAIRS", broadcast)
    texts = [None, "", *alignment_texts(150), "the cat sat on the mat", "the cat sat on the mat"]
    rows = [(i, "s", None, 1, text, "clash", "clash", 1) for i, text in enumerate(texts)]
    rows += [rows[-1], (None, None, None, None, "the cat", None, None, None), (None, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, ODD).repartition(4)
    found = token_alignment.align(docs, BYTE_BPE, PIECES)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(row) for row in found.collect()) == plain_alignment(rows)
    assert token_alignment.align(docs.where("false"), BYTE_BPE, PIECES).count() == 0


def test_long_texts_align(spark):
    """A million spaces, a word of a hundred thousand letters."""
    own = token_alignment.Aligner(BYTE_BPE, PIECES)
    for text in (" " * 1_000_000, "ab" * 50_000, "\n" * 100_000 + "x"):
        ((n_a, n_b, groups, digest, _, counts),) = own.texts([text])
        assert n_a and n_b and groups == sum(counts) and digest


def test_alignment_query_on_a_table(spark):
    rows = [(row.doc_id, None, None, None, row.text) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert Counter(tuple(row) for row in QUERIES["op13_tokenizer_spans"](spark, FOLDER).collect()) == plain_alignment(rows)
