"""Components of the n-gram join against all pairs."""

import random
import re

import pytest

from starloom.llm.components import components
from starloom.llm.ngram_join import linked, one_per_component

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(5))))


def brute_force(rows):
    """{index: (n, component)} by comparing all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for pair in {(a, b) for ks in holders.values() for i, a in enumerate(ks) for b in ks[i + 1:]}:
        a, b = (sets[k] for k in pair)
        if root(pair[0]) != root(pair[1]) and 100 * len(a & b) >= 80 * len(a | b):
            parent[root(pair[0])] = root(pair[1])
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(k)
    out = []
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        out += [(rows[k][0], len(sets[k]), min(ids, default=None)) for k in members]
    return sorted(out, key=str)


def near_copies(seed, groups=12, copies=25):
    """Groups of copies at all distances from their base, and texts that share a passage."""
    rng = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 5, 12, 60, 200]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 20))):
                at = rng.randrange(len(words) + 1)
                words[at:at + rng.randrange(2)] = [f"x{rng.randrange(50)}"] * rng.randrange(1, 4)
            rows.append(" ".join(words))
        words = [f"u{g}_{i}" for i in range(40)]
        rows.append(" ".join(words[:20] + passage + words[20:]))
    rng.shuffle(rows)
    return list(enumerate(rows))


def answer(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize("limit", [100_000, 7])
def test_components_match_all_pairs(spark, limit):
    rows = near_copies(3)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert answer(linked(docs, limit=limit)) == brute_force(rows)


def test_long_lists_match_all_pairs(spark):
    rows = near_copies(5, groups=2, copies=260)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert answer(linked(docs)) == brute_force(rows)


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "a b c d e"),
        (7, "a b c d e"), (None, "a b"), (None, "alone here"), (8, "é " * 30_000 + "end"),
        (9, "é " * 30_000 + "end"), (10, "x" * 3_000_000 + " y"), (-1, "a b c d e f"),
    ]
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in rows], "doc_id bigint, text string, component_id string")
    want = {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6),
            (None, 1, 4), (None, 1, None), (8, 2, 8), (9, 2, 8), (10, 1, 10), (-1, 2, -1)}
    got = answer(linked(docs))
    assert set(got) == want and len(got) == len(rows)
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 6, 8, 10, -1, None], key=str)
    assert linked(docs.limit(0)).collect() == []
    assert one_per_component(docs.limit(0)).collect() == []


def test_one_row_of_each_component_stays(spark):
    """Repeated ids, missing ids and repeated rows lose no text and leave one row of each group."""
    a = " ".join(f"a{k}" for k in range(40))
    b = " ".join(f"b{k}" for k in range(40))
    c = " ".join(f"c{k}" for k in range(40))
    rows = [(5, a, "s2", "x"), (5, b, "s1", "x"), (3, b + " more", "s1", "x"), (9, a + " one", "s1", "x"),
            (None, c, "s", "x"), (None, c, "t", "x"), (None, c + " end", "r", "x"), (None, "", "s", "x"), (None, "", "s", "x"),
            (7, "alone", "s2", "x"), (7, "alone", "s1", "z"), (7, "alone", "s1", "y"), (7, "alone", "s1", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, key string")
    kept = one_per_component(docs).collect()
    by = {}
    for r in kept:
        by.setdefault((r.text or "")[:2], []).append(tuple(r))
    assert by["a0"] == [rows[0]] and by["b0"] == [rows[2]] and by["al"] == [rows[11]]
    assert len(by["c0"]) == 1 and by["c0"][0][1] in (c, c + " end") and len(by[""]) == 2
    assert len(kept) == 6


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[k] for k in range(41)}) == 1
    assert len({got[k] for k in range(100, 160)}) == 1
    assert len(set(got.values())) == 3 and got[299] == got[300] == 299


def test_query_matches_brute_force(spark):
    from starloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_ngram_jaccard_join"](spark, sf_dir)
    assert answer(got) == brute_force([tuple(r) for r in docs])
