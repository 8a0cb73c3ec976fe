"""Reply trees as conversations.

A node replies to its parent. Ancestor tables are built by self-joins that double the distance
each time, so a tree of depth d takes about log2(d) joins, each only of the nodes that have so many
ancestors; a node thereby learns its root, its depth and the sum of the scores above it. The leaves of a root are ranked by the mean score of
their path, and walking the ancestor tables down again marks the nodes of the chosen paths.

The template is `<|im_start|>role<|im_sep|>text<|im_end|>`. Inside texts and roles every string
that starts like a control string gets one backslash more behind its first character, which
`unescaped` takes out again, so any text comes back as it was.

Defined cases: a null text, role or score is empty or 0. A node whose parent does not exist, and
a node that names itself as its parent, is a root. Nodes in a cycle belong to no root and are
left out. Equal scores: the smallest leaf id wins. Repeated node ids: the smallest row by
(parent, role, text) stays. Turns with one number are ordered by role, then text. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import written

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# What begins a control string, of this template and of other common ones: `<|`, `<s>`, `</s>`,
# `[INST]`, `[/INST]`, `<<SYS>>`, `<</SYS>>`. Any number of backslashes may stand inside.
_TAIL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
_PLAIN, _MARKED = rf"([<\[])(\\*){_TAIL}", rf"([<\[])\\(\\*){_TAIL}"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, "$1$2")


def tree_of_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as a tree: each turn replies to the one before it."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("at") > 1, F.struct("conv_id", (F.col("at") - 1).alias("at")))
    return rows.select(
        F.struct("conv_id", "at").alias("node"), parent.alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def best_paths(tree: DataFrame, per_root: int = 1) -> DataFrame:
    """(root, leaf, rank, depth, role, text) of the nodes on the `per_root` best paths.

    `tree` has node, parent, role, text and score; node and parent are of any one type.
    """
    nodes = tree.groupBy("node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("n"))
    nodes = nodes.select(
        "node", "n.parent", F.coalesce("n.role", F.lit("")).alias("role"),
        F.coalesce("n.text", F.lit("")).alias("text"), F.coalesce("n.score", F.lit(0.0)).alias("score"),
    )
    nodes = written(nodes, "nodes")
    links = nodes.where("parent IS NOT NULL AND parent <> node").select("node", "parent", "score")
    links = links.join(nodes.select(F.col("node").alias("parent")), "parent", "left_semi")
    # level k has the nodes with 2^k ancestors or more: `jump` is that ancestor, `total` the score
    # of the node and those below `jump`. `done` has the nodes whose root is known.
    level = written(links.select("node", F.col("parent").alias("jump"), F.col("score").alias("total")), "jumps")
    done = written(nodes.join(links, "node", "left_anti").select(
        "node", F.col("node").alias("root"), F.lit(1).cast("bigint").alias("depth"),
        F.col("score").alias("total")), "done")
    levels, steps, limit = [level], 1, nodes.count()
    while level.limit(1).count() and steps <= limit:
        a, b, end = level.alias("a"), level.alias("b"), done.alias("b")
        total = (F.col("a.total") + F.col("b.total")).alias("total")
        met = F.col("a.jump") == F.col("b.node")
        found = a.join(end, met).select(
            "a.node", "b.root", (F.col("b.depth") + F.lit(steps)).alias("depth"), total)
        level = written(a.join(b, met).select("a.node", F.col("b.jump").alias("jump"), total), "jumps")
        done = done.unionByName(written(found, "done"))
        levels.append(level)
        steps *= 2
    inner = links.select(F.col("parent").alias("node")).distinct()
    leaves = done.join(inner, "node", "left_anti")
    # Only the best few of a root are kept on the way: ranked by a bounded aggregate, not a sort.
    mean = F.col("total") / F.col("depth")
    ranked = _best(leaves.select("root", F.col("node").alias("leaf"), "depth", mean.alias("mean")), per_root)
    ranked = written(ranked, "chosen")
    marked = ranked.select("root", "leaf", "rank", "depth", F.col("leaf").alias("node"),
                           F.col("depth").alias("place"))
    for k in reversed(range(len(levels) - 1)):
        up = marked.join(levels[k].select("node", "jump"), "node").select(
            "root", "leaf", "rank", "depth", F.col("jump").alias("node"),
            (F.col("place") - F.lit(1 << k)).alias("place"))
        marked = written(marked.unionByName(up), "marked")
    texts = nodes.select("node", "role", "text")
    return marked.join(texts, "node").select(
        "root", "leaf", "rank", F.col("place").alias("depth"), "role", "text")


def _best(leaves: DataFrame, per_root: int) -> DataFrame:
    """The best leaves of each root, taken one rank after the other with a max aggregate."""
    out, left = None, leaves
    for rank in range(1, per_root + 1):
        top = left.groupBy("root").agg(F.min(F.struct(-F.col("mean"), "leaf", "depth")).alias("b"))
        top = top.select("root", "b.leaf", "b.depth", F.lit(rank).alias("rank"))
        out = top if out is None else out.unionByName(top)
        if rank < per_root:
            left = left.join(top.select("root", "leaf"), ["root", "leaf"], "left_anti")
    return out


def formatted(paths: DataFrame) -> DataFrame:
    """(root, leaf, rank, formatted, loss_spans): one conversation for each path.

    `loss_spans` has (start, length) in code points for the text of each assistant turn.
    """
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP))
    body = escaped(F.col("text"))
    pieces = paths.select("root", "leaf", "rank", "depth", "role", head.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    before = (
        Window.partitionBy("root", "leaf", "rank").orderBy("depth")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = pieces.withColumn("begin", F.coalesce(F.sum(size.cast("bigint")).over(before), F.lit(0)))
    span = F.when(
        F.col("role") == "assistant",
        F.struct((F.col("begin") + F.length("head")).alias("start"),
                 F.length("body").cast("bigint").alias("length")),
    )
    turn = F.struct("depth", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span"))
    whole = pieces.groupBy("root", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return whole.select(
        "root", "leaf", "rank",
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parsed(text: Column) -> Column:
    """A formatted conversation as an array of (role, text)."""
    parts = F.filter(F.split(text, r"<\|im_end\|>"), lambda p: p != "")
    sep = r"<\|im_sep\|>"
    return F.transform(parts, lambda p: F.struct(
        unescaped(F.substring(F.split(p, sep, 2)[0], len(START) + 1, 1 << 30)).alias("role"),
        unescaped(F.split(p, sep, 2)[1]).alias("text"),
    ))
