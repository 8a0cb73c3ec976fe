"""The pipeline, stage by stage, against what each stage must keep of its own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.session import written
from tests.llm.test_ngram_join import brute_force

SF_DIR = "/root/testdata/sf0.01"
TOKEN, WORD = re.compile(r"[^\W_]+"), re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
        out.append((name, docs))
    return out


def before_and_after(results, name):
    k = [n for n, _ in results].index(name)
    return results[k - 1][1], results[k][1]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(results):
    assert [n for n, _ in results] == ["documents", "language", "copies", "benchmark", "personal", "mix"]
    for _, df in results[:-1]:
        assert df.columns == results[0][1].columns and df.count() == df.select("doc_id").distinct().count() > 500


def test_language_keeps_texts_with_letters(results):
    old, new = (rows(d) for d in before_and_after(results, "language"))
    letters = {i for i, r in old.items() if re.search(r"[^\W\d_]", r.text or "")}
    assert set(new) <= letters and len(new) >= 0.99 * len(letters)
    assert all(new[i] == old[i] for i in new)


def test_one_of_each_component_stays(results):
    old, new = (rows(d) for d in before_and_after(results, "copies"))
    component = {i: c for i, _, c in brute_force([(i, r.text) for i, r in old.items()])}
    assert set(new) == {i for i, c in component.items() if i == c}
    assert all(new[i] == old[i] for i in new)


def test_documents_with_benchmark_items_go(spark, results):
    def plain(text):
        return " " + " ".join(w.lower() for w in TOKEN.findall(text)) + " "

    old, new = (rows(d) for d in before_and_after(results, "benchmark"))
    items = [plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {i for i, r in old.items() if any(x in plain(r.text) for x in items)}
    assert leaked and set(new) == set(old) - leaked
    assert all(new[i] == old[i] for i in new)


def test_personal_data_are_replaced(results):
    found = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![0-9A-Za-z])[0-9a-fA-F]{40}")
    old, new = (rows(d) for d in before_and_after(results, "personal"))
    assert set(old) == set(new)
    for i, r in old.items():
        secrets = found.findall(r.text)
        assert not any(s in new[i].text for s in secrets)
        assert new[i].n_chars == len(new[i].text)
        if not re.search(r"\d{2}|@", r.text):
            assert new[i] == r


def test_mix_meets_targets(results):
    old, new = before_and_after(results, "mix")
    sizes = {r.doc_id: (r.source, len(WORD.findall(r.text)), r.text) for r in old.collect()}
    taken, places = {}, {}
    for r in new.withColumn("file", F.input_file_name()).collect():
        assert r.text == sizes[r.doc_id][2] and 0 < r.words <= sizes[r.doc_id][1] and r["pass"] in (0, 1)
        taken[r.source] = taken.get(r.source, 0) + r.words
        places.setdefault(r.file.rsplit("/", 1)[1], []).append(r.position)
    by_source = {}
    for source, size, _ in sizes.values():
        by_source[source] = by_source.get(source, 0) + size
    total, weights = sum(by_source.values()), {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(by_source))}
    target, held = {}, set()
    while True:
        level = (1.5 * total - sum(2 * by_source[s] for s in held)) / sum(w for s, w in weights.items() if s not in held)
        more = {s for s in weights if s not in held and level * weights[s] > 2 * by_source[s]}
        if not more:
            break
        held |= more
    for s, w in weights.items():
        target[s] = 2 * by_source[s] if s in held else level * w
        assert abs(taken.get(s, 0) - target[s]) <= 1
    order = [p for _, part in sorted(places.items()) for p in part]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), "empty")
        assert docs.count() == 0
