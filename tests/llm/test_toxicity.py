"""Ordinal regression: labels learned and held out, the fit against one on a list, scores against a plain sum."""

import re

import numpy as np
import pyarrow as pa

from starloom.llm import shingles, toxicity
from starloom.llm.toxicity import at_least, fit, fit_ordinal, sample, scored, train


def test_ordinal_fit_recovers_an_order():
    rng = np.random.default_rng(2)
    n = 800
    x = rng.random((n, 3)) < 0.4
    s = x @ np.array([3.0, 1.5, 0.0]) + rng.logistic(size=n) * 0.3
    grades = np.digitize(s, [1.0, 2.5, 4.0])
    rows, cols = np.nonzero(x)
    w, t = fit_ordinal(rows, cols, 3, grades)
    assert (np.diff(t) > 0).all() and w[0] > w[1] > w[2] >= 0
    model = toxicity.Model(np.arange(3), w, t)
    expected = at_least(x @ w, model).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.85


def labelled():
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(5000)]
    texts, toxic = [], []
    for k in range(400):
        body = list(rng.choice(words, 30))
        bad = k % 4 == 0
        if bad:
            body += [f"{stem}{end}" for stem, end in zip(
                rng.choice(["vermin", "grotty"], 1 + k % 3), rng.choice(["", "ly", "ish", "est"], 3))]
        rng.shuffle(body)
        texts.append(" ".join(body))
        toxic.append(float(bad))
    return texts, np.array(toxic)


def test_unseen_inflections_and_grades():
    texts, toxic = labelled()
    model = train(texts, toxic)
    new = ["w1 w2 VERMINOUS!! w3", "w1 w2 w3 clean", "verminly grottyest vermin grotty w1"]
    p = []
    for text in new:
        column = {b: k for k, b in enumerate(model.buckets)}
        found = {column[b] for _, _, _, bs in toxicity.features(pa.array([text])) for b in bs.tolist() if b in column}
        p.append(at_least(np.array([sum(model.weights[k] for k in found)]), model)[0])
    assert p[0][0] > 0.5 > p[1][0] and p[2].sum() > p[0].sum() > p[1].sum()
    assert (np.diff(p, axis=1) <= 0).all()


def test_pieces_of_long_texts_read_alike(monkeypatch):
    texts = pa.array(["vermin " * 50 + "x1,5 " * 40, None, "É" * 30 + " end"])

    def read():
        return sorted({(f + r, b) for f, _, rows, bs in toxicity.features(texts) for r, b in zip(rows.tolist(), bs.tolist())})

    whole = read()
    for module in (shingles, toxicity):
        monkeypatch.setattr(module, "BLOCK", 100)
    assert read() == whole


def test_odd_rows(spark):
    texts, toxic = labelled()
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame(
        [(k, 0, int(x)) for k, x in enumerate(toxic)] + [(None, 0, 1), (5, 0, None), (99_999, 0, 1)],
        "doc_id bigint, quality bigint, toxic bigint")
    model = fit(docs, labels)
    odd = spark.createDataFrame(
        [(1, None, ""), (2, "", ""), (3, "vermin grotty", ""), (3, "vermin grotty", ""), (None, "vermin vermin", ""),
         (4, "w1 " * 700_000 + "verminly", "")], docs.schema)
    out = scored(odd, model)
    assert out.columns == ["doc_id", "expected_severity", "grade", "p_toxic", "toxic"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.toxic, round(r.expected_severity, 9)))
    assert got[1] == got[2] and got[1][0][0] is False
    assert len(got[3]) == 2 and got[3][0] == got[3][1] and got[3][0][0] and got[None][0][0] and got[4][0][0]
    nothing = fit(docs, labels.where("toxic = 0"))
    assert {(r.toxic, r.expected_severity) for r in scored(odd, nothing).collect()} == {(False, 0.0)}
    assert {r.toxic for r in scored(odd, fit(docs, labels.limit(0))).collect()} == {False}
    assert scored(odd.limit(0), model).collect() == []


def tables(spark, texts, toxic):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return docs, spark.createDataFrame([(k, int(x)) for k, x in enumerate(toxic)], "doc_id bigint, toxic bigint")


def test_fit_in_tasks_is_the_fit_on_a_list(spark):
    texts, toxic = labelled()
    got, want = fit(*tables(spark, texts, toxic)), train(texts, toxic, toxic.sum() / (1 - toxic).sum())
    assert got.buckets.tolist() == want.buckets.tolist() and len(want.buckets)
    assert np.allclose(got.weights, want.weights) and np.allclose(got.thresholds, want.thresholds)


def test_sample_has_one_row_of_an_id(spark):
    texts, toxic = labelled()
    docs, labels = tables(spark, texts, toxic)
    copies = spark.range(20_000).selectExpr("0L AS doc_id", "if(id % 2 = 0, 'vermin again', 'x ' || id) AS text")
    known = labels.selectExpr("doc_id", "toxic > 0 AS toxic")
    counts = {True: int(toxic.sum()), False: int((1 - toxic).sum())}
    rows = sample(docs.unionByName(copies), known, counts, "s").collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    few = {k: 10**9 for k in counts}
    assert sample(docs, known, few, "s").count() < 10


def test_scores_are_plain_sums_on_held_out_texts(spark):
    texts, toxic = labelled()
    docs, labels = tables(spark, texts, toxic)
    model = fit(docs.where("doc_id % 8 < 4"), labels)
    held = docs.where("doc_id % 8 >= 4")
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    rows = {r.doc_id: r for r in scored(held, model).collect()}
    for k, r in rows.items():
        seen = {b for _, _, _, bs in toxicity.features(pa.array([texts[k]])) for b in bs.tolist()}
        p = [1 / (1 + np.exp(t - sum(weight.get(b, 0.0) for b in seen))) for t in model.thresholds]
        assert np.isclose(r.expected_severity, sum(p)) and np.isclose(r.p_toxic, p[0])
        assert r.grade == sum(x >= 0.5 for x in p)
    assert np.mean([rows[k].toxic == bool(toxic[k]) for k in rows]) > 0.95


def test_query_finds_toxic_documents(spark):
    from starloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op8_toxicity_severity"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    toxic = [r for r in labels if r.toxic]
    clean = [r for r in labels if not r.toxic]
    assert np.mean([got[r.doc_id].toxic for r in toxic]) > 0.9
    assert np.mean([got[r.doc_id].toxic for r in clean]) < 0.01
    insults = re.compile(r"\b(idiot|moron|scum|trash|loser)\b", re.I)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    heavy = [got[i].expected_severity for i, t in texts.items() if len(set(map(str.lower, insults.findall(t)))) >= 4]
    light = [got[i].expected_severity for i, t in texts.items() if not insults.search(t)]
    assert np.mean(heavy) > 1 > np.mean(light)
