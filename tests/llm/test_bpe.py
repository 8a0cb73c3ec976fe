"""Encoding and decoding against the library that the vocabulary file is made for."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import bpe
from starloom.llm.bpe import Encoder, PairTree, decoded, encoded, id_list, vocabulary
from starloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SF_DIR = "/root/testdata/sf0.01"
NASTY = [
    None, "", " ", "\n\t", "a", "The the THE", "it's WE'LL 'tis don'T", "x<|endoftext|>y <|startoftext|>",
    "<|endoftext|><|endoftext|>", "<|EndOfText|> <|endoftext |>", "ΑΣ ΣΑΣ Σ", "İstanbul ẞ ǅ", "é é ﬁ Ａ",
    "́x", "a\x1cb\x1d c\x85d\xa0e f​g", "日本語 テキスト 한국어", "😀😀 a😀b", "١٢٣ ½ x2 3d 1000", "\x00 a\x00b",
    "!!!???...---", "'s't're've'm'll'd", "aaaaaaaaaaaaaaaa", "ab" * 3000, "q" * 20_000, "é" * 999, "�﻿",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return Encoder(file.read())


def numbers(raw):
    return [int.from_bytes(raw[k:k + 4], "little") for k in range(0, len(raw), 4)]


def test_texts_match_the_library(library, encoder):
    rng = random.Random(5)
    letters = "abcdeeettthrs  '.,!\n\téßΣ日😀1́"
    texts = NASTY + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text, raw in zip(texts, encoder.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        got = numbers(raw)
        assert got == want, text
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False), text


def test_tree_names_the_leftmost_lowest():
    rng = random.Random(2)
    for size in (1, 2, 3, 7, 8, 33):
        ranks = [rng.randrange(9) for _ in range(size)]
        tree = PairTree(list(ranks))
        for _ in range(60):
            assert tree.first() == (min(ranks), ranks.index(min(ranks)))
            at = rng.randrange(size)
            ranks[at] = rng.randrange(9)
            tree.put(at, ranks[at])


def test_merges_match_a_plain_search(encoder):
    rng = random.Random(3)
    words = [[encoder.inner[rng.choice(b"aehinorst")] for _ in range(rng.randrange(1, 40))] for _ in range(400)]
    together = encoder.merge_beside(words)
    for word, beside in zip(words, together):
        want = list(word)
        while True:
            ranked = [(encoder.ranks[p], k) for k, p in enumerate(zip(want, want[1:])) if p in encoder.ranks]
            if not ranked:
                break
            rank, k = min(ranked)
            want[k:k + 2] = [encoder.merged[rank]]
        assert encoder.merge(list(word)) == beside == want


def test_what_is_remembered_changes_nothing(encoder, monkeypatch):
    texts = [t for t in NASTY if t] * 2
    want = [encoder.encode([t])[0] for t in texts]
    for name, value in (("CACHE", 3), ("BESIDE", 2), ("LONGEST", 1)):
        monkeypatch.setattr(bpe, name, value)
        encoder.known, encoder.words = dict(encoder.marks), {}
        assert [encoder.encode([t])[0] for t in texts] == want == encoder.encode(texts)


def test_columns(spark, library):
    rows = [(k, t, "kept") for k, t in enumerate(NASTY)] + [(3, "a", "kept"), (None, "the end", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    words = vocabulary(spark, PATH)
    out = docs.withColumn("raw", encoded(F.col("text"), words))
    out = out.withColumn("numbers", id_list("raw")).withColumn("back", decoded(F.col("raw"), words)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.numbers == numbers(r.raw) == want
        assert r.back == library.decode(want, skip_special_tokens=False)
    empty = docs.limit(0).withColumn("raw", encoded(F.col("text"), words))
    assert empty.withColumn("back", decoded(F.col("raw"), words)).collect() == []
    assert spark.range(1).select(decoded(F.lit(None).cast("binary"), words).alias("t")).first().t == ""


def test_other_kinds_of_files_are_refused(spark, tmp_path):
    with open(PATH) as file:
        spec = json.load(file)
    spec["normalizer"]["normalizers"].pop()
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        vocabulary(spark, str(tmp_path / "v.json"))


def test_query_matches_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    out = QUERIES["op13_bpe_segment_tree"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in want)
        text = library.decode(want, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
