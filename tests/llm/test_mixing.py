"""The mix against a plain loop over documents, and the inverse of the demand."""

import hashlib
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing
from starloom.llm.mixing import SCHEDULES, moment, placed, training_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def demand(knots, t):
    """Share of the whole area under the schedule up to t."""
    def area(end):
        total = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            if end > t0:
                stop = min(end, t1)
                total += (stop - t0) * (w0 + w0 + (w1 - w0) * (stop - t0) / (t1 - t0)) / 2
        return total
    return area(t) / area(1.0)


def test_moment_inverts_the_demand(spark):
    rows = [(k, q / 200) for k in range(6) for q in range(201)]
    got = spark.createDataFrame(rows, "rank bigint, q double").select(
        "rank", "q", moment(F.col("q"), F.col("rank")).alias("t")).collect()
    for r in got:
        assert abs(demand(SCHEDULES[r.rank % 3], r.t) - r.q) < 1e-9


def brute_force(rows, weights=(3, 1, 2)):
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    whole = {s: sum(n for n, r in zip(sizes, rows) if r[2] == s) for s in sources}
    weight = {s: weights[k % 3] for k, s in enumerate(sources)}
    held, budget = set(), Fraction(3, 2) * sum(whole.values())
    while True:
        open_ = [s for s in sources if s not in held]
        level = (budget - sum(2 * whole[s] for s in held)) / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if level * weight[s] > 2 * whole[s]}
        if not more:
            break
        held |= more
    target = {s: 2 * whole[s] if s in held else level * weight[s] for s in sources}
    out = []
    for s in sources:
        mine = sorted((hashlib.md5(f"mix:{'-' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, n)
                      for (i, _, x), n in zip(rows, sizes) if x == s)
        start, quota = 0, int(target[s] + Fraction(1, 2))
        for _, i, n in mine:
            taken = sum(max(0, min(n, quota - start - p * whole[s])) for p in (0, 1))
            out.append((i, n, whole[s], taken))
            start += n
    return sorted(out), {s: float(t) for s, t in target.items()}


@pytest.mark.parametrize("shape", ["even", "one small", "one source", "odd"])
def test_placed_matches_a_plain_loop(spark, shape):
    rows = {
        "even": [(k, "w " * (k % 7), f"s{k % 5}") for k in range(200)],
        "one small": [(k, "w " * 20, "big" if k else "a tiny") for k in range(90)],
        "one source": [(k, "w\tw\nw", None) for k in range(30)],
        "odd": [(1, None, None), (2, "", "x"), (None, "a b", "x"), (4, "c d e", "é"), (4, "c d e", "é"), (4, "f", "é"),
                (5, "w " * 50_000, "Z"), (6, " x ", "")],
    }[shape]
    docs = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id bigint, text string, source string, target double")
    got = placed(docs).collect()
    want, target = brute_force(rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.source_size, r.taken) for r in got) == want
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6
        assert sum(p.words for p in r.passes) == r.taken <= 2 * r["size"]
        assert all(0 <= p.position <= 1 for p in r.passes)
    sample = training_set(docs).collect()
    assert training_set(docs).columns[:3] == ["doc_id", "text", "source"]
    assert {r.position for r in sample} == set() or [r.position for r in sample] == sorted(r.position for r in sample)
    assert placed(docs.limit(0)).collect() == [] and training_set(docs.limit(0)).collect() == []


def test_every_row_is_a_document(spark):
    """Rows without an id, rows of one id and text, and rows that are alike in all columns."""
    rows = [(None, "x y", "s", "a"), (None, "x y", "t", "a"), (1, "p q r", "s", "b"), (1, "p q r", "s", "b"),
            (1, "p q r", "t", "c"), *[(2, "w w", "u", "d")] * 40, (3, "", "s", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row string")
    sample = training_set(docs)
    assert sample.columns == ["doc_id", "text", "source", "_row", "pass", "words", "position"]
    _, target = brute_force([r[:3] for r in rows])
    taken, times = {}, {}
    for r in sample.collect():
        taken[r.source] = taken.get(r.source, 0) + r.words
        times[tuple(r)[:4] + (r["pass"],)] = times.get(tuple(r)[:4] + (r["pass"],), 0) + 1
    assert all(abs(taken.get(s, 0) - t) <= 1 for s, t in target.items())
    # as often as it is there, in the first pass of a source that is read whole
    whole = {s: sum(len(WORD.findall(r[1])) for r in rows if r[2] == s) for s in target}
    for row in set(rows):
        if target[row[2]] >= whole[row[2]] and row[1]:
            assert times[(*row, 0)] == rows.count(row)
    assert {row[3] for row in times} == {"a", "b", "c", "d"}


def test_query_repeats_and_meets_targets(spark):
    from starloom.llm.queries import QUERIES

    run = QUERIES["op3_mix_curriculum"]
    first, second = (sorted(map(tuple, run(spark, "/root/testdata/sf0.001").drop("position").collect())) for _ in range(2))
    assert first == second and len(first) == 200


def test_parts_follow_the_bytes_of_the_texts(spark, monkeypatch):
    rows = [(k, "word " * 50, "s") for k in range(200)] + [(None, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert training_set(docs).rdd.getNumPartitions() == least
    monkeypatch.setattr(mixing, "PART_BYTES", 1000)
    sample = training_set(docs)
    read = sum(len(r.text) for r in sample.collect())
    assert sample.rdd.getNumPartitions() == -(-read // 1000) > least
    position = [r.position for r in sample.collect()]
    assert position == sorted(position)
