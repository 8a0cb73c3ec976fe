"""The prefix trie of conversations: which turns they begin with in common.

A node of depth d is a distinct sequence of the first d turns (role and text); its members are
the conversations that begin with it. Turns go by digest. BLOCK successive turns form a block,
and the chain of block digests names all turns up to a block's end. Conversations are grouped by
those chains first, so that copies and common beginnings are one row per block. Only where
several blocks follow the same chain (siblings) are turn boundaries looked for inside them; a
block without siblings gives its nodes as they are.

Sums over subtrees follow from owners. The smallest member of a node owns it; what a conversation
owns is the end of its path. So the sum over a subtree is the sum, over its members, of what they
own there: inside the block over at most BLOCK places, below it by one running total per owner.
No node meets all its ancestors, and no level of the trie costs a job of its own.

The digest of the members that end at a node is taken over pieces: the ids of one range of IDS are
joined first, and a task reads the pieces of a node in order, holding one at a time.

Defined cases: rows without conv_id belong to no conversation and are left out. Turns are in
order of `turn` (null first), then role, then digest of role and text; a null role or text is
empty; repeated rows are repeated turns. The remainder of a negative id is negative, as in SQL. A
conversation without turns is a member of the root alone. Extra columns are ignored. An empty
table has no members, hence no root: the result is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import written

BLOCK = 4
FAMILY, HEADS = 100, 6
IDS = 4096
ROOT = ""
EMPTY = hashlib.sha256(b"").hexdigest()

TURN_SCHEMA = "conv_id bigint, pos bigint, digest binary, chars bigint"
BLOCK_SCHEMA = (
    "conv_id bigint, block bigint, before string, after string, "
    "turns array<struct<prefix: string, chars: bigint>>, last boolean")


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): every turn, numbered from 1 in its conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(whole, 256).alias("hex"), F.length(text).cast("bigint").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "hex")
    return rows.select(
        "conv_id", F.row_number().over(order).cast("bigint").alias("pos"), F.unhex("hex").alias("digest"), "chars")


def heads_taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each conversation's first turns are those of its family's head.

    The h first turns of conversation c - c % FAMILY come before c's own after its first h.
    """
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumns({
        "h": heads_taken(F.col("conv_id")), "head": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).withColumnRenamed("conv_id", "head")
    sizes = heads.groupBy("head").agg(F.max("pos").alias("size"))
    convs = convs.join(sizes, "head", "left").withColumn(
        "taken", F.least("h", F.coalesce("size", F.lit(0).cast("bigint"))))
    given = heads.join(convs.select("conv_id", "head", "taken"), "head").where("pos <= taken")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").withColumn(
        "pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "digest", "chars"]
    depth = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("bigint"))
    return convs.select("conv_id", depth.alias("depth")), given.select(*columns).unionByName(own.select(*columns))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the turns of conversations that come one after another, each in order."""
    conv, block, before, state, turns = None, 0, ROOT, None, []
    out: list[tuple] = []

    def close(last: bool) -> None:
        nonlocal block, before, state, turns
        after = turns[-1]["prefix"]
        out.append((conv, block, before, after, turns, last))
        block, before, state, turns = block + 1, after, None, []

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(),
                 pa.list_(pa.struct([("prefix", pa.string()), ("chars", pa.int64())])), pa.bool_()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "block", "before", "after", "turns", "last"])

    for batch in batches:
        for c, digest, chars in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "digest", "chars")]):
            if c != conv:
                if turns:
                    close(True)
                conv, block, before, state, turns = c, 0, ROOT, None, []
            elif len(turns) == BLOCK:
                close(False)
            if len(out) >= 4096:
                yield flush()
            if state is None:
                state = hashlib.sha256(before.encode())
            state.update(digest)
            turns.append({"prefix": state.hexdigest(), "chars": chars})
    if turns:
        close(True)
    if out:
        yield flush()


def block_rows(turns: DataFrame) -> DataFrame:
    """Every conversation's blocks: the chain before, the chain after, and each turn's prefix.

    The prefix of a turn is the digest of the chain before its block and of the block's turns up
    to it; that of a full block's last turn is the chain after the block.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return ordered.select("conv_id", "digest", "chars").mapInArrow(_chain, BLOCK_SCHEMA)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of pieces that come node by node, each in order."""
    node, state, out = None, None, []

    def flush() -> pa.RecordBatch:
        arrays = [pa.array(c, pa.string()) for c in zip(*out)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, ["node", "ends_sha256"])

    for batch in batches:
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if name != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                if len(out) >= 4096:
                    yield flush()
                node, state = name, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state is not None:
        out.append((node, state.hexdigest()))
    if out:
        yield flush()


def ends_of(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of rows (node, conv_id): the ids in order, joined by commas.

    A piece has the ids of one range of IDS, so its size is bounded however many end at a node.
    """
    piece = F.floor((F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(IDS))) / F.lit(IDS))
    ordered = F.array_sort(F.collect_list("conv_id"))
    pieces = ends.groupBy("node", piece.alias("piece")).agg(
        F.array_join(ordered.cast("array<string>"), ",").alias("ids"))
    return (
        pieces.repartition("node").sortWithinPartitions("node", "piece").select("node", "ids")
        .mapInArrow(_digests, "node string, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256). conv_id is the node's smallest member; saved_tokens counts the
    code points that members share with a smaller member, in the node's turn and beneath it."""
    convs, turns = rebuilt(written(turns_of(conversations), "turns"))
    convs = written(convs, "conversations")
    blocks = written(block_rows(turns), "blocks")

    # Blocks as such: one row for each chain, whoever follows it.
    groups = blocks.groupBy("before", "after").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("block").alias("block"),
        F.first("turns").alias("turns"))
    places = F.transform("turns", lambda t, i: F.struct(
        (i + 1).cast("bigint").alias("place"), t["prefix"].alias("node"), t["chars"].alias("chars"),
        F.when(i > 0, F.get(F.col("turns"), i - 1)["prefix"]).otherwise(F.col("before")).alias("parent"),
        F.transform(F.slice("turns", F.lit(1), i + 1), lambda u: u["prefix"]).alias("path")))
    groups = written(groups, "block-groups")
    # Joined by the chain after the block, which has one row, and not by the one before it, which
    # a third of all blocks may share.
    single = groups.groupBy("before").agg(F.count("*").alias("n"), F.first("after").alias("after"))
    single = single.where("n = 1").select("after", F.lit(True).alias("single"))
    met = groups.join(single, "after", "left").withColumn("at", F.explode(places)).select(
        "block", "conv_id", "n_convs", F.col("single").isNotNull().alias("single"), "at.*")
    # Turn boundaries are looked for among siblings only.
    apart = met.where("not single").groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("block", "place", "chars", "parent", "path")],
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    columns = ["node", "block", "place", "chars", "parent", "path", "conv_id", "n_convs"]
    nodes = met.where("single").select(*columns).unionByName(apart.select(*columns))
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, "node", "left").na.fill(0, ["n_children"]).withColumn(
        "leaf", (F.col("n_children") == 0).cast("bigint")), "nodes-with-children")

    # What an owner has in its later blocks goes to each of its blocks.
    owned = nodes.groupBy("conv_id", "block").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    owners = owned.groupBy("conv_id").agg(F.max("block").alias("deepest"))
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = (
        blocks.select("conv_id", "block", "turns").join(owners, "conv_id").where("deepest > 0")
        .join(owned, ["conv_id", "block"], "left")
        .select("turns", F.sum("saved").over(later).alias("saved"), F.sum("leaves").over(later).alias("leaves"))
        .where("saved > 0 or leaves > 0")
        .select(F.explode(F.transform("turns", lambda t: t["prefix"])).alias("node"), "saved", "leaves"))
    inside = nodes.select(F.explode("path").alias("node"), "saved", F.col("leaf").alias("leaves"))
    sums = inside.unionByName(below).groupBy("node").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    ends = blocks.where("last").select(F.col("after").alias("node"), "conv_id")
    ends = ends.unionByName(convs.where("depth = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    ended = ends_of(ends)

    # The root is the parent of all first turns: its values come from sums, not from a join.
    members = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    whole = nodes.agg(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(members.least).cast("bigint").alias("conv_id"), F.lit(members.n).cast("bigint").alias("n_convs"),
        F.count(F.when(F.col("parent") == ROOT, 1)).alias("n_children"),
        F.greatest(F.coalesce(F.sum("leaf"), F.lit(0)), F.lit(1)).cast("bigint").alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).cast("bigint").alias("saved_tokens")).where("n_convs > 0")
    others = nodes.join(sums, "node").select(
        "node", "parent", (F.col("block") * BLOCK + F.col("place")).alias("depth"),
        "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    first = F.when(F.col("parent") == ROOT, F.lit(members.least).cast("bigint"))
    first_turns = others.where(F.col("parent") == ROOT).unionByName(whole).withColumn("parent_conv_id", first)
    later_turns = others.where(F.col("parent") != ROOT).join(parents, "parent")
    return first_turns.unionByName(later_turns).join(ended, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
