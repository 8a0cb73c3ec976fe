"""The window network: scores against a plain loop, learning, and the mean of tasks."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import masked_lm, shingles
from starloom.llm.masked_lm import (
    CLUSTERS, PLACES, RARE, SIZE, Model, Weights, contexts, count_words, fit, learn, log_probabilities,
    numbers, scored, start_weights,
)
from starloom.llm.shingles import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def random_model(texts, seed=3):
    hashes = np.unique(np.concatenate([h for _, _, h in words(pa.array(texts))]))[:20]
    rng = np.random.default_rng(seed)
    weights = start_weights(rng.random(SIZE))
    weights.bias += rng.normal(size=weights.bias.shape).astype(np.float32)
    return Model(hashes, np.arange(len(hashes)) * 7 % (SIZE - RARE), weights)


def plain_score(text, m):
    """Sum over words of the logarithm of a full softmax over all numbers."""
    ids = [int(numbers(h[:1], m.vocabulary, m.ids)[0])
           for w in WORD.findall(text or "") for _, _, h in words(pa.array([w]))]
    total = 0.0
    for k, target in enumerate(ids):
        z = m.weights.bias.astype(float)
        for place, table in zip(PLACES, m.weights.tables):
            near = ids[k + place] if 0 <= k + place < len(ids) else SIZE
            z = z + table[near]
        h = np.append(np.tanh(z), 1.0)
        top = np.exp(h @ m.weights.top)
        joint = []
        for c in range(CLUSTERS):
            inner = np.exp(h @ m.weights.inner[c])
            joint.append(top[c] / top.sum() * inner / inner.sum())
        joint = np.concatenate(joint)
        assert abs(joint.sum() - 1) < 1e-6
        total += math.log(joint[target])
    return len(ids), total


TEXTS = ["one two three two one", "One", "", None, "a\tb\nc d  e f a b c", "x " * 300]


def test_scores_match_a_plain_loop(spark, monkeypatch):
    m = random_model(TEXTS[:1] + TEXTS[4:])
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(None, "one"), (0, TEXTS[0])], "doc_id bigint, text string")
    got = {}
    for r in scored(docs, m).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, text in enumerate(TEXTS):
        n, total = plain_score(text, m)
        for r in got[k]:
            assert r.n_tokens == n and abs(r.log_likelihood - total) < 1e-3 * max(n, 1)
            assert r.mean_log_likelihood is None if n == 0 else abs(r.mean_log_likelihood - total / n) < 1e-3
    assert len(got[0]) == 2 and len(got[None]) == 1
    assert scored(docs.limit(0), m).collect() == []
    monkeypatch.setattr(masked_lm, "SCORED", 3)
    monkeypatch.setattr(shingles, "BLOCK", 50)
    for _, offsets, hashes in words(pa.array(["x " * 300])):
        ids = numbers(hashes, m.vocabulary, m.ids)
        again = log_probabilities(m.weights, ids, contexts(ids, offsets)).sum()
    assert abs(again - plain_score("x " * 300, m)[1]) < 0.1


def test_gradient_points_downhill():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 40, 300)
    around = contexts(ids, np.array([0, 100, 300]))
    w = start_weights(np.ones(SIZE))
    squares = [np.full_like(x, 1e-4) for x in w.parts()]
    before = log_probabilities(w, ids, around).mean()
    for _ in range(60):
        learn(w, squares, ids, around)
    assert log_probabilities(w, ids, around).mean() > before + 1
    assert (Weights.of(w.flat()).flat() == w.flat()).all()


def test_learns_order_from_both_sides(spark):
    rng = random.Random(6)
    lines = [" ".join(rng.choice(["red fox runs home", "blue bird sings songs", "old man reads books"]) for _ in range(30))
             for _ in range(120)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(lines)], "doc_id bigint, text string, n_tokens string")
    m = fit(docs.repartition(3))

    def mean(texts):
        rows = scored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), m).collect()
        return sum(r.log_likelihood for r in rows) / sum(r.n_tokens for r in rows)

    def shuffled(t):
        parts = t.split()
        rng.shuffle(parts)
        return " ".join(parts)

    assert mean(lines[:20]) > mean([shuffled(t) for t in lines[:20]]) + 1


def test_vocabulary_counts_all_documents(spark):
    texts = ["a b c a", None, "", "A b"] * 50
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    hashes, ids, counts = count_words(docs)
    assert len(hashes) == 3 and (np.diff(hashes.astype(float)) > 0).all()
    assert sorted(counts[:3]) == [50, 100, 150] and counts[3:].sum() == 0
    empty = fit(docs.limit(0))
    assert len(empty.vocabulary) == 0
    assert scored(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), empty).first().n_tokens == 2


def test_query_scores_every_document(spark):
    from starloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = QUERIES["op4_masked_pseudo_likelihood"](spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.n_tokens == len(WORD.findall(docs[r.doc_id]))
        assert r.log_likelihood <= 0 and (r.n_tokens == 0 or -12 < r.mean_log_likelihood < 0)


@pytest.mark.parametrize("begins", [[0, 0, 3, 5], [0, 5], [0, 1, 2, 3, 4, 5]])
def test_contexts_stop_at_texts(begins):
    ids = np.arange(5)
    got = contexts(ids, np.array(begins))
    text = [max(k for k, b in enumerate(begins) if b <= i) for i in range(5)]
    for row, place in zip(got, PLACES):
        for i in range(5):
            inside = 0 <= i + place < 5 and text[i] == text[i + place]
            assert row[i] == (ids[i + place] if inside else SIZE)


def test_rare_words_are_scored_as_themselves(spark):
    rng = random.Random(8)
    common = [f"c{k}" for k in range(masked_lm.SIZE - RARE)] * 9
    rare = [f"r{k}" for k in range(3000) for _ in range(1 + k % 4)]
    tokens = common + rare
    rng.shuffle(tokens)
    lines = [" ".join(tokens[k:k + 100]) for k in range(0, len(tokens), 100)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").repartition(3)
    m = fit(docs)
    bucket = {}
    for w, n in {w: rare.count(w) for w in set(rare)}.items():
        h = next(words(pa.array([w])))[2]
        bucket.setdefault(int(numbers(h, m.vocabulary, m.ids)[0]), {})[w] = n
    assert min(bucket) >= SIZE - RARE
    asked = ["r3", "r0", "r7 c1 never", "never", "c5 c6"]
    rows = [(k, t) for k, t in enumerate(asked)] + [(0, "r3"), (None, "r3"), (9, None)]
    rows = scored(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2), m).collect()
    assert len(rows) == 8 and [r.mean_log_likelihood for r in rows if r.doc_id == 9] == [None]
    got = {r.doc_id: r.log_likelihood for r in rows}
    for k, text in enumerate(asked):
        want = plain_score(text, m)[1]
        for w in text.split():
            here = bucket.get(int(numbers(next(words(pa.array([w])))[2], m.vocabulary, m.ids)[0]))
            if here:
                whole = sum(here.values()) + masked_lm.UNSEEN * (len(here) + 1)
                want += math.log((here.get(w, 0) + masked_lm.UNSEEN) / whole)
        assert abs(got[k] - want) < 1e-3
    assert got[None] == got[0] > got[1] > got[3]


def test_numbers_grow_with_the_distinct_words():
    sizes = [np.prod(masked_lm.shape(n)) for n in (0, 1000, 400_000, 4_000_000, 50_000_000)]
    assert sizes == [1024, 1024, 2048, 4096, 16384]
    assert [masked_lm.buckets(int(n)) for n in sizes[2:]] == [64, 128, 512]
    w = start_weights(np.ones(2048))
    assert w.shape == masked_lm.shape(400_000) and w.size == 2048
    assert (Weights.of(w.flat(), w.shape).flat() == w.flat()).all()
    ids = np.arange(2000)
    around = contexts(ids, np.array([0, 2000]), 2048)
    squares = [np.full_like(x, 1e-4) for x in w.parts()]
    before = log_probabilities(w, ids, around).mean()
    for _ in range(30):
        learn(w, squares, ids, around)
    assert log_probabilities(w, ids, around).mean() > before


def test_sparse_steps_equal_dense_gradients():
    """One batch against plain sums over its words, for every table."""
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 90, 70)
    around = contexts(ids, np.array([0, 3, 3, 40, 70]))
    w = start_weights(rng.random(SIZE))
    before = Weights.of(w.flat())
    grads = [np.zeros(x.shape) for x in w.parts()]
    members = SIZE // CLUSTERS
    for k, target in enumerate(ids):
        near = around[:, k]
        h = np.tanh(sum(t[n] for t, n in zip(before.tables, near)) + before.bias)
        wide = np.append(h, 1.0)
        p = np.exp(wide @ before.top)
        p /= p.sum()
        p[target // members] -= 1
        q = np.exp(wide @ before.inner[target // members])
        q /= q.sum()
        q[target % members] -= 1
        back = (before.top[:-1] @ p + before.inner[target // members][:-1] @ q) * (1 - h * h) / len(ids)
        grads[1] += back
        grads[2] += np.outer(wide, p) / len(ids)
        grads[3][target // members] += np.outer(wide, q) / len(ids)
        for place, n in enumerate(near):
            grads[0][place, n] += back
    squares = [np.full_like(x, 1e-4) for x in w.parts()]
    learn(w, squares, ids, around)
    for old, new, g in zip(before.parts(), w.parts(), grads):
        want = old - masked_lm.RATE * g / (np.sqrt(1e-4 + g * g) + 1e-6)
        assert np.abs(want - new).max() < 1e-3


def test_batches_grow_with_the_words_seen(monkeypatch):
    sizes = []
    monkeypatch.setattr(masked_lm, "learn", lambda w, s, ids, around: sizes.append(len(ids)))
    ids, seen = np.zeros(40_000, np.int64), 0
    for _ in range(10):
        seen = masked_lm.teach_words(None, None, ids, np.zeros((4, len(ids)), np.int64), seen)
    assert seen == sum(sizes) == 400_000
    assert sizes[0] == masked_lm.FIRST and max(sizes) == masked_lm.BATCH


def test_every_text_is_learned_once(spark, monkeypatch):
    """All rows of all tasks, copies and a text of a third of all words among them."""
    seen = []
    plain = masked_lm._round

    def kept(texts, model):
        seen.append([r.text for r in texts.collect()])
        return plain(texts, model)

    monkeypatch.setattr(masked_lm, "_round", kept)
    texts = [f"t{k} a b" for k in range(50)] + ["copy of one"] * 40 + [None, "", "long " * 2000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    fit(docs)
    key = lambda t: (t is None, t or "")
    assert len(seen) == masked_lm.ROUNDS
    assert sorted((t for part in seen for t in part), key=key) == sorted(texts, key=key)
    assert all(0 < part.count("copy of one") < 40 for part in seen)


def test_a_batch_takes_exponentials_once_per_level(monkeypatch):
    """However many clusters it has; with large weights, maxima keep them finite."""
    rng = np.random.default_rng(5)
    ids = rng.integers(0, SIZE, 4000)
    around = contexts(ids, np.array([0, 1000, 4000]))
    calls = []
    plain = np.exp
    with monkeypatch.context() as m:
        m.setattr(np, "exp", lambda *a, **k: calls.append(1) or plain(*a, **k))
        w = start_weights(rng.random(SIZE))
        learn(w, [np.full_like(x, 1e-4) for x in w.parts()], ids, around)
        assert len(calls) == 2
        log_probabilities(w, ids, around)
        assert len(calls) == 4
    by_maximum = start_weights(np.ones(SIZE))
    by_bound = Weights.of(by_maximum.flat())
    for w, limit in ((by_maximum, 0.0), (by_bound, masked_lm.EXPONENT)):
        monkeypatch.setattr(masked_lm, "EXPONENT", limit)
        squares = [np.full_like(x, 1e-4) for x in w.parts()]
        for _ in range(5):
            learn(w, squares, ids, around)
    assert np.abs(by_maximum.flat() - by_bound.flat()).max() < 1e-3
    for x in (by_bound.top, by_bound.inner):
        x *= 1e4
    found = log_probabilities(by_bound, ids, around)
    assert np.isfinite(found).all() and found.min() < -100 and found.max() <= 0
    learn(by_bound, [np.full_like(x, 1e-4) for x in by_bound.parts()], ids, around)
    assert np.isfinite(by_bound.flat()).all()
