"""The pipeline against a plain version of its decisions, with repeated rows and rows without an id."""

import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spendloom.llm import anchor_pii, compression_quality

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GOOD = "the harbour council met on monday to review plans for a longer sea wall and heard that costs had risen since spring".split()
BAD = "win win click here free prize $$$ buy now cheap cheap limited offer act fast !!! bonus xx yy zz".split()


def tables(spark, folder):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(60):
        words = [rng.choice(GOOD if i % 3 else BAD) for _ in range(120)]
        rows.append((i, " ".join(words), "en", f"s{i % 2}", 9))
        labels.append((i, int(i % 3 > 0), 0))
    text = rows[1][1]
    rows += [(100, text, "en", "s0", 9), (101, text + " mail a.b@example.org today", "de", "s1", 9)]  # copies of 1
    rows += [(1, text, "en", "s1", 9), (1, text, "en", "s1", 9), (2, rows[4][1], "en", "s0", 9)]  # repeated ids, one with another text
    rows += [(None, " ".join(rng.choice(GOOD) for _ in range(120)), "en", None, None)] * 2 + [(None, None, None, None, None)]
    rows += [(102, "call +1 555 123 4567 about the harbour council and the longer sea wall", "en", "s0", 9)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_pipeline(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = compression_quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"))
    scores = {(r.doc_id, r.text): r.score for r in compression_quality.scored(docs, model).select("doc_id", "text", "score").collect()}
    rows = [row for row in rows if scores[row[0], row[1]] >= 0.3]
    with_id = [row for row in rows if row[0] is not None]
    parent = {row[0]: row[0] for row in with_id}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in with_id:
        for b in with_id:
            x, y = shingles(a[1]), shingles(b[1])
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                one, other = sorted((root(a[0]), root(b[0])))
                parent[other] = one
    return [row for row in with_id if root(row[0]) == row[0]], [row for row in rows if row[0] is None]


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    folder = str(tmp_path)
    rows = tables(spark, folder)
    kept, without_id = plain_pipeline(spark, folder, rows)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got if r.doc_id is not None} == {row[0] for row in kept}
    assert any(row[0] % 3 == 0 for row in rows[:60] if row[0] not in {r.doc_id for r in got})  # some were rejected
    assert not {100, 101} & {r.doc_id for r in got}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def coded(text):
        return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]

    redacted = spark.createDataFrame([(i, row[1]) for i, row in enumerate(kept + without_id)], "i int, text string")
    clean = {r.i: r.text for r in anchor_pii.redact(redacted).collect()}
    texts = {}
    for i, row in enumerate(kept + without_id):
        texts.setdefault(row[0] if row[0] is not None else ("none", row[1]), set()).add(clean[i])
    lengths = {}
    for r in got:
        lengths.setdefault(r.doc_id, []).append(r)
    for doc_id, pieces in lengths.items():
        if doc_id is None:
            continue
        pieces.sort(key=lambda r: r.start)
        ids = next(c for c in map(coded, sorted(texts[doc_id], key=str)) if len(c) == pieces[0].doc_tokens)
        assert sum(r.length for r in pieces) == len(ids)  # one row of the document, whole
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
    # Of the texts without an id one is given twice and stays once.
    wanted = sorted(len(coded(next(iter(texts[key])))) for key in texts if isinstance(key, tuple))
    assert wanted
    assert sorted(r.doc_tokens for r in lengths.get(None, []) if r.start == 0) == wanted


@pytest.mark.parametrize("times", [1, 3])
def test_near_duplicates_keep_one_row(spark, times):
    rows = [(1, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (3, "", "en", "s", 0), (None, "x", None, None, None), (None, "y", None, None, None)]
    docs = spark.createDataFrame(rows * times, KIND).withColumn("_key", F.lit("clash"))
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == [(-1, "x"), (-1, "y"), (1, "a b c d e f"), (3, "")]


def test_pipeline_of_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
