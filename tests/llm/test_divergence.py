"""Sources against each other, by plain counting."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from starloom.llm import divergence
from starloom.llm.divergence import audited, collapsed, term_counts

SCHEMA = "doc_id bigint, text string, lang string, source string, digest string, rows int, term string"


def brute_force(rows, least, top):
    docs = [((r[2] or ""), (r[3] or ""), r[1] or "") for r in rows]
    frequency, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        frequency[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in frequency[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            parts = {
                "pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s],
                "term": [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]],
            }
            for part, found in parts.items():
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)
                        if part == "pair" or k < top]
    return sorted(out)


def corpus(rng, n):
    words = [f"{a}{b}" for a in "aBcdé日" for b in "xyZöÜ"] + ["the", "The", "a1b", "it's"]
    rows = []
    for k in range(n):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "S2", "é", None, ""])
        text = rng.choice([None, "", " 1 2 ", " ".join(rng.choices(words, k=rng.randrange(30)))])
        rows.append((k, text, lang, source, "x", 1, "y"))
    copies = [(9000 + k, "the copy of The copy", "en", rng.choice(["s1", "s2"]), None, 2, "z") for k in range(300)]
    alone = [(9900, "nothing kept here", "fr", "s1", "", 0, ""), (9901, None, "fr", "s2", "", 0, "")]
    return rows + copies + alone + rows[:5] * 3 + [(None, "long " * 50_000, "de", "s1", "", 0, "")]


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_matches_plain_counting(spark):
    rows = corpus(random.Random(6), 600)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least, top in ((30, 50), (4, 3), (1, 50)):
        assert collected(audited(docs, least, top)) == brute_force(rows, least, top)


def test_copies_are_read_once(spark):
    rows = corpus(random.Random(7), 50)
    texts = collapsed(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert len(texts) == len({(r[2] or "", r[1] or "") for r in rows})
    assert sum(n.n for t in texts for n in t.rows) == len(rows)


def test_parts_add_up(spark, monkeypatch):
    """Handing on after few entries changes no sum."""
    rows = corpus(random.Random(8), 80)
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(divergence, "HELD", 3)
    monkeypatch.setattr(divergence, "COMPARED", 4)
    batches = [b for b in collapsed(docs).toArrow().to_batches()]
    parts = [r for b in divergence._count(iter(batches)) for r in b.to_pylist()]
    sums = defaultdict(lambda: [0, 0])
    for r in parts:
        sums[r["lang"], r["source"], r["term"]][0] += r["occurrences"]
        sums[r["lang"], r["source"], r["term"]][1] += r["documents"]
    whole = defaultdict(lambda: [0, 0])
    for r in term_counts(collapsed(docs)).collect():
        whole[r.lang, r.source, bytes(r.term)][0] += r.occurrences
        whole[r.lang, r.source, bytes(r.term)][1] += r.documents
    assert dict(sums) == dict(whole)


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 0), (0, 0, 7), (9 * 10**17, 9 * 10**17 + 1, 3), (123456789012345678, 987654321098765432, 1000), (5, 90, 2)]
    rows = spark.createDataFrame(cases, "c bigint, n bigint, v bigint").select(
        "*", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    for r in rows:
        assert r.p == (1 + 10**9 * (r.c + 5) // (r.n + 5 * r.v) if r.n + 5 * r.v else None)


def test_empty(spark):
    assert audited(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pairs_add_up(monkeypatch):
    rng = random.Random(9)
    rows = [{"lang": rng.choice("ab"), "uses": [
        {"source": s, "share": rng.randrange(10**9), "base": rng.randrange(10**6)} for s in rng.sample("uvwxyz", rng.randrange(7))]}
        for _ in range(200)]
    kind = pa.struct([("source", pa.string()), ("share", pa.int64()), ("base", pa.int64())])
    batches = pa.table({"lang": [r["lang"] for r in rows], "uses": pa.array([r["uses"] for r in rows], pa.list_(kind))}
                       ).to_batches(max_chunksize=30)
    want = Counter()
    for r in rows:
        for a in r["uses"]:
            for b in r["uses"]:
                if a["source"] < b["source"]:
                    p, q, x, y = a["share"], b["share"], a["base"], b["base"]
                    want[r["lang"], a["source"], b["source"]] += abs(p - q) - abs(p - y) - abs(x - q) + abs(x - y)
    for compared in (1 << 20, 3):
        monkeypatch.setattr(divergence, "COMPARED", compared)
        got = Counter()
        for r in (r for b in divergence._both(iter(batches)) for r in b.to_pylist()):
            got[r["lang"], r["source"], r["item"]] += r["value"]
        assert dict(got) == dict(want)
