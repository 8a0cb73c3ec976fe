"""The byte network: held-out accuracy, and windows against a plain convolution."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starloom.llm import language
from starloom.llm.language import (
    WIDTHS, WINDOW, Model, fit, keep_known, predicted, probabilities, train,
)


def tiny_model(seed=1):
    rng = np.random.default_rng(seed)
    tables = [rng.normal(size=(w, 256, language.FILTERS)).astype(np.float32) for w in WIDTHS]
    n = language.FILTERS * len(WIDTHS)
    return Model(["a", "b", "c"], tables, rng.normal(size=n).astype(np.float32),
                 rng.normal(size=(n + 1, 3)).astype(np.float32))


def plain(text, model):
    raw = (text or "").encode()
    parts = [raw[k:k + WINDOW].ljust(WINDOW, b"\0") for k in range(0, len(raw), WINDOW)]
    total = np.zeros(3)
    for part in parts:
        found = [
            max(sum(t[k][part[at + k]][f] for k in range(w)) for at in range(WINDOW - w + 1))
            for w, t in zip(WIDTHS, model.tables) for f in range(language.FILTERS)
        ]
        z = np.maximum(np.array(found) + model.bias, 0) @ model.out[:-1] + model.out[-1]
        e = np.exp(z - z.max())
        total += e / e.sum()
    return total / max(len(parts), 1)


def test_windows_match_a_plain_convolution():
    model, texts = tiny_model(), ["kurz", None, "", "é" * 200, "x y z " * 60]
    got = probabilities(pa.array(texts), model, model.paired())
    for row, text in zip(got, texts):
        assert np.allclose(row, plain(text, model), atol=1e-4)


def test_training_separates_alphabets():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(97, 105, (60, WINDOW)), rng.integers(103, 112, (60, WINDOW))])
    y = np.repeat([0, 1], 60)
    model = train(x.astype(np.uint8), y, ["lo", "hi"])
    texts = pa.array([bytes(r.astype(np.uint8).tolist()).decode() for r in x])
    assert (probabilities(texts, model, model.paired()).argmax(axis=1) == y).mean() > 0.97


def test_query_on_held_out_documents(spark):
    from starloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op9_language_byte_cnn"](spark, sf_dir)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 0.1 < len(held) / len(rows) < 0.3
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(k, "the and of with " * 9, "en", "s") for k in range(30)]
    rows += [(k, "der und die mit zu " * 9, "de", "s") for k in range(30, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = fit(docs)
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame(
        [(1, None, None, ""), (2, "", None, ""), (3, "12 34 !!", "en", ""), (None, "and of the with " * 50_000, None, ""),
         (5, "und der", "", ""), (5, "und der", "", "")], docs.schema)
    got = predicted(odd, model, ["doc_id"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by[1] == by[2] == by[3] == [("und", 0.0)]
    assert by[None][0][0] == "en" and len(by[5]) == 2 and by[5][0] == by[5][1]
    kept = keep_known(odd, model)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [5, 5, None]
    none = fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in predicted(docs, none, ["doc_id"]).collect()} == {"und"}
    assert predicted(odd.limit(0), model, ["doc_id"]).collect() == []
    assert fit(docs.limit(0)).languages == []


def test_copies_are_one_text_of_the_sample(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(language, "PER_LANGUAGE", 5)
    monkeypatch.setattr(language, "LANGUAGES", 3)
    monkeypatch.setattr(language, "SAMPLE", 15)
    monkeypatch.setattr(language, "train", lambda x, y, names: seen.update(x=x, y=y, names=names))
    rows = [("copied text " * 20, "en")] * 400 + [(f"english {k} " * 20, "en") for k in range(9)]
    rows += [(f"deutsch {k} " * 20, "de") for k in range(3)] + [("x" * 200, f"l{k}") for k in range(2)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    fit(docs)
    # four languages share 15 texts, three each
    assert seen["names"] == ["de", "en", "l0", "l1"]
    texts = {}
    for x, y in zip(seen["x"], seen["y"]):
        texts.setdefault(seen["names"][y], []).append(bytes(x))
    assert {k: len(v) for k, v in texts.items()} == {"de": 12, "en": 12, "l0": 4, "l1": 4}
    assert sum(b"copied" in x for x in texts["en"]) <= 4
