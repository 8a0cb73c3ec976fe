"""The prefix trie against one that is built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from starloom.llm import prefix_trie
from starloom.llm.prefix_trie import BLOCK, ends_of, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, digest int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for node, found in members.items():
        under = [k for k in members if k[:len(node)] == node]
        children = [k for k in under if len(k) == len(node) + 1]
        ends = ",".join(str(c) for c in sorted(found) if len(paths[c]) == len(node))
        out.append((
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children),
            sum(not any(len(j) == len(k) + 1 and j[:len(k)] == k for j in under) for k in under),
            sum((len(members[k]) - 1) * len(k[-1][1]) for k in under if k),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def corpus(rng, n, longest):
    """Conversations that share beginnings, end inside others, and are copies of others."""
    rows, made = [], [[]]
    for c in rng.sample(range(-250, 700), n):
        path = list(rng.choice(made))[:rng.randrange(longest)]
        while len(path) < longest and rng.random() < 0.7:
            path.append((rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "ab", "", None, "é" * 9])))
        made.append(path)
        rows += [(c, k, *t, "x", 1) for k, t in enumerate(path or [("user", "only")])]
    return rows


@pytest.mark.parametrize("seed, n, longest", [(1, 60, 3), (2, 150, 9), (3, 80, 30)])
def test_matches_a_plain_trie(spark, seed, n, longest):
    rows = corpus(random.Random(seed), n, longest)
    assert collected(trie(spark.createDataFrame(rows, SCHEMA).repartition(6))) == brute_force(rows)


def test_defined_cases(spark):
    rows = [(1, None, None, None, "x", 1), (1, 3, "user", "t", None, None), (1, 3, "user", "t", None, None),
            (1, 3, "assistant", "t", "", 0), (None, 0, "user", "lost", "", 0), (100, 0, "user", "A" * 300_000, "", 0),
            (-5, 0, "1:", "a", "", 0), (-7, 0, "", ":a", "", 0)]
    rows += [(c, k, "user", f"t{k}", "", 0) for c in range(200, 230) for k in range(8)]
    assert collected(trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_conversations_without_turns_belong_to_the_root(spark):
    # 101 takes turns of a head that does not exist, and has fewer turns than it gives up
    gone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(gone, 0, "user", "a", "", 0)]
    assert brute_force(rows) == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]
    assert collected(trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_empty(spark):
    assert trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation_and_large_group_of_copies(spark):
    head = [(0, k, "user", f"h{k}", "", 0) for k in range(60)]
    copies = [(c, k, "user", f"h{k}", "", 0) for c in range(1, 40) for k in range(60)]
    rows = head + copies + [(1000, k, "user", f"h{k}" if k < 57 else "z", "", 0) for k in range(70)]
    assert collected(trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_ids_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    ids = random.Random(1).sample(range(-500, 500), 300)
    rows = spark.createDataFrame([("a" if i % 3 else "b", i) for i in ids], "node string, conv_id bigint").repartition(9)
    got = {r.node: r.ends_sha256 for r in ends_of(rows).collect()}
    for name, fits in (("a", lambda i: i % 3), ("b", lambda i: not i % 3)):
        assert got[name] == hashlib.sha256(",".join(str(i) for i in sorted(ids) if fits(i)).encode()).hexdigest()


def test_boundaries_are_looked_for_among_siblings_only(spark):
    """Conversations that follow each other's blocks whole need no search inside them."""
    rows = [(c, k, "user", f"t{k}", "", 0) for c in range(600, 700) for k in range(3 * BLOCK)]
    chains = spark.createDataFrame(rows, SCHEMA)
    blocks = prefix_trie.block_rows(prefix_trie.turns_of(chains))
    assert blocks.select("before", "after").distinct().count() == 3
    assert blocks.count() == 300
