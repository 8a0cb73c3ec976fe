"""Reply trees against a plain walk, and the template's round trip."""

import random

from pyspark.sql import functions as F

from starloom.llm.chat import best_paths, escaped, formatted, parsed, tree_of_turns, unescaped

SCHEMA = "node bigint, parent bigint, role string, text string, score double"
NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<<SYS>> <</SYS>>", "\\", "<|", "[INST]",
         "<s", "a<\\s>b", "[\\/INST]", "", "plain\ntext", "é<|é|>", "<<s>", "[[INST]]", "\\<|"]


def brute_force(rows, per_root):
    """{(root, leaf): [(role, text)]} of the best paths by mean score, then smallest leaf."""
    by = {r[0]: r for r in rows}
    has_child = {r[1] for r in rows if r[1] != r[0]}
    paths = {}
    for node in by:
        if node in has_child:
            continue
        path, at, seen = [], node, set()
        while True:
            if at in seen:
                path = None
                break
            seen.add(at)
            path.append(by[at])
            up = by[at][1]
            if up is None or up == at or up not in by:
                break
            at = up
        if path:
            paths.setdefault(at, []).append(
                (-sum(p[4] or 0.0 for p in path) / len(path), node, [(p[2] or "", p[3] or "") for p in path[::-1]]))
    return {(root, leaf): turns for root, found in paths.items() for _, leaf, turns in sorted(found)[:per_root]}


def collected(paths):
    out = {}
    for r in paths.collect():
        out.setdefault((r.root, r.leaf), []).append((r.depth, r.role, r.text))
    return {k: [x[1:] for x in sorted(v)] for k, v in out.items()}


def test_paths_match_a_plain_walk(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        parent = rng.choice([None, *range(max(0, k - 30), k)]) if k % 40 else None
        rows.append((k, parent, rng.choice(["user", "assistant"]), f"t{k}", float(rng.randrange(8))))
    rows += [(1000 + k, 999 + k if k else None, "user", "deep", 1.0) for k in range(300)]
    rows += [(2000, 2001, "user", "cycle", 9.0), (2001, 2000, "user", "cycle", 9.0), (2002, 2001, "user", "tail", 1.0),
             (3000, 3000, "user", "own parent", 1.0), (3001, 77777, "user", "no such parent", None)]
    tree = spark.createDataFrame(rows, SCHEMA)
    for per_root in (1, 3):
        assert collected(best_paths(tree, per_root)) == brute_force(rows, per_root)


def test_escaping_is_reversible(spark):
    rng = random.Random(1)
    texts = NASTY + ["".join(rng.choice(["<", "[", "\\", "|", "s>", "/s>", "INST]", "SYS>>", "x"]) for _ in range(12))
                     for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(x in r.e for x in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_formatted_conversations_come_back(spark):
    turns = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)]
    turns += [(2, 0, None, None), (2, 1, "assistant", None), (None, 0, "user", "x"), (3, 5, "<|im_sep|>", "r")]
    turns += [(4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a"), (5, 0, "assistant", "A" * 400_000)]
    docs = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id bigint, turn bigint, role string, text string, root string")
    chats = formatted(best_paths(tree_of_turns(docs)))
    rows = chats.withColumn("turns", parsed(F.col("formatted"))).collect()
    assert len(rows) == 6
    for r in rows:
        conv = r.root.conv_id
        want = sorted(((t[1], t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert [tuple(t) for t in r.turns] == [t[1:] for t in want]
        masked = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        assert len(masked) == sum(t[1] == "assistant" for t in want)
    assert formatted(best_paths(tree_of_turns(docs.limit(0)))).collect() == []
