"""Join of documents whose sets of word shingles have a Jaccard similarity of 4/5 or more.

1. The shingles of all documents are counted in a table of 2^COUNT_BITS buckets. It gives one
   order of all shingles, rare ones first. Two linked sets share a shingle among the first
   n - ceil(4n/5) + 1 of each, so only these are indexed.
2. Equal sets become one class, by digest; the index holds classes.
3. The index list of a shingle is read in order of centrality: the mean logarithm of the counts
   of a set's shingles, highest for the set that its near copies were made from. Each entry
   proposes the head of the list, if sizes and positions allow a link. The proposals are checked
   on the sets themselves and give first components: a head's answer already decides all sets
   that it links, and pairs inside a component are never looked at again.
4. What is left are pairs of different components. The lists are read by size, in blocks that
   know how far the positions in them allow a partner; blocks that cannot hold one are skipped.
   Long runs of one component are skipped as a whole. The pairs are checked, minus those already
   checked, and the components closed.

Every pair that could be linked is either checked or inside one component, so the components are
exact (up to 64-bit hashes). A list of more than LIST entries is dealt over pairs of blocks.

Defined cases: null text and text without words have an empty set, link with nothing and are
their own component. Fewer than five words: the whole sequence is the one shingle. Rows that
repeat a doc_id or a text are rows of their own. A null doc_id takes part but names no
component: if a component has no other, its id is null. Extra columns, whatever their names, are
ignored by `linked` and kept by `one_per_component`. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.components import components
from starloom.llm.filters import bucket_counts, key_filter, split_by_filter
from starloom.llm.registry import arrow_rows
from starloom.llm.shingles import WIDTH, shingle_hashes, shingle_sets, words
from starloom.session import written

COUNT_BITS = 20
LIST = 100_000  # entries of an index list that one task holds at once
SKIP = 256  # entries of a block in a list
SHORT = 64  # lists up to here are paired without blocks
LIGHT_ROWS = 20_000  # rows of an Arrow batch where a row is a few numbers
NUM, DEN = 4, 5


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def shingle_counts(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    def buckets(batch):
        for _, offsets, hashes in words(batch.column(0)):
            sets = [
                np.unique(shingle_hashes(hashes[a:b], width)) for a, b in zip(offsets, offsets[1:])
            ]
            yield _bucket(np.concatenate(sets))

    return bucket_counts(docs.select("text"), buckets, COUNT_BITS)


def indexed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_key, class, n, centrality, prefix) of every document."""
    counts = shingle_counts(docs, width)
    shared = docs.sparkSession.sparkContext.broadcast(np.log2(np.maximum(counts, 1)).astype(np.float32))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("class", pa.int64()), ("n", pa.int32()),
        ("centrality", pa.float32()), ("prefix", pa.list_(pa.int64())),
    ])

    def describe(batches):
        for batch in batches:
            classes, sizes, central, prefixes = [], [], [], []
            for _, h in shingle_sets(batch.column(2), width):
                n = len(h)
                weight = shared.value[_bucket(h)]
                # h is sorted, so a stable sort by weight orders ties by hash
                first = np.argsort(weight, kind="stable")[: n + 1 + (-NUM * n // DEN) if n else 0]
                name = hashlib.blake2b(h.tobytes(), digest_size=8).digest()
                classes.append(int.from_bytes(name, "little", signed=True))
                sizes.append(n)
                central.append(float(weight.mean()) if n else 0.0)
                prefixes.append(h[first].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes]))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(classes, pa.int64()),
                 pa.array(sizes, pa.int32()), pa.array(central, pa.float32()), lists],
                schema=schema,
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text"
    )
    return rows.mapInArrow(
        describe,
        "doc_id bigint, text_key bigint, class bigint, n int, centrality float, prefix array<bigint>",
    )


def reach(n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The largest set that an entry at this position can link to, if the lists first meet here.

    n - at shingles are left, and a link takes (n + m) * NUM / (NUM + DEN) common ones.
    """
    return ((NUM + DEN) * (n - at) - NUM * n) // NUM


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def propose(batches):
    """Entries of lists with two or more, each with the head of its list or null.

    Input sorted by (token, centrality descending); a row is held back until the next is seen.
    """
    schema = pa.schema([("token", pa.int64()), ("class", pa.int64()), ("n", pa.int64()),
                        ("at", pa.int64()), ("head", pa.int64())])
    kept, top, joined = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        now = np.stack([c.astype(np.int64) for c in _columns(batch)])
        rows = now if kept is None else np.concatenate([kept, now], axis=1)
        token, same = rows[0], np.zeros(rows.shape[1], bool)
        same[1:] = rows[0][1:] == rows[0][:-1]
        same[0] = joined
        begin = np.where(same, -1, np.arange(len(token)))
        begin = np.maximum.accumulate(begin)
        heads = rows[1:4, np.maximum(begin, 0)].copy()
        if top is not None:
            heads[:, begin < 0] = top[:, None]
        shared = same.copy()
        shared[:-1] |= same[1:]
        yield from _proposals(rows[:, :-1], heads[:, :-1], shared[:-1], schema)
        kept, top, joined = rows[:, -1:], heads[:, -1], bool(same[-1])
    if kept is not None:
        yield from _proposals(kept, top[:, None], np.array([joined]), schema)


def _proposals(rows, heads, shared, schema):
    rows, heads = rows[:, shared], heads[:, shared]
    if rows.shape[1]:
        n, at, m, there = rows[2], rows[3], heads[1], heads[2]
        fits = (m <= reach(n, at)) & (n <= reach(m, there)) & (heads[0] != rows[1])
        head = pa.array(heads[0], mask=~fits)
        yield pa.RecordBatch.from_arrays([*map(pa.array, rows[:4]), head], schema=schema)


def pair_up(batches):
    """Pairs of different components that sizes and positions allow, from lists sorted by size.

    Input: (token, part, n, class, at, component, block), sorted by (token, part, n).
    """
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.astype(np.int64) for c in _columns(batch)])
        rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
        change = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
        last = change[-1] if len(change) else 0
        kept = rows[:, last:]
        yield from _pairs(rows[:, :last])
    if kept is not None:
        yield from _pairs(kept)


def _pairs(rows: np.ndarray):
    """Pairs (a, b) of complete lists."""
    if rows.shape[1] < 2:
        return
    _, part, n, cls, at, comp, block = rows
    far = reach(n, at)
    cut = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
    begins, ends = np.r_[0, cut], np.r_[cut, rows.shape[1]]
    first = np.repeat(comp[begins], ends - begins)
    mixed_list = np.add.reduceat((comp != first).astype(np.int64), begins) > 0
    sizes = ends - begins
    found = []
    # Short lists, all at once: each entry with the next one, the one after that, and so on.
    short = np.repeat(mixed_list & (sizes <= SHORT), sizes)
    end_of = np.repeat(ends, sizes)
    i, d = np.flatnonzero(short), 0
    while len(i):
        d += 1
        i = i[i + d < end_of[i]]
        i = i[n[i + d] <= far[i]]
        ok = (comp[i] != comp[i + d]) & (n[i] <= far[i + d])
        found.append(np.stack([i[ok], i[ok] + d]))
    for b, e in zip(begins[mixed_list & (sizes > SHORT)], ends[mixed_list & (sizes > SHORT)]):
        names, inverse, members = np.unique(comp[b:e], return_inverse=True, return_counts=True)
        # The largest component is paired with the others only; a pair of others is found once,
        # from its smaller index.
        main = inverse == members.argmax()
        edges = np.arange(b, e, SKIP)
        top = np.maximum.reduceat(far[b:e], edges - b)
        for x in b + np.flatnonzero(~main):
            low = b + np.searchsorted(n[b:e], -(-NUM * n[x] // DEN), "left")
            high = b + np.searchsorted(n[b:e], far[x], "right")
            for k in range((low - b) // SKIP, -(-(high - b) // SKIP)):
                if top[k] < n[x]:
                    continue
                y = np.arange(max(low, edges[k]), min(high, edges[k] + SKIP, e))
                y = y[(comp[y] != comp[x]) & (main[y - b] | (y > x)) & (far[y] >= n[x])]
                # of two sizes, the smaller entry must reach the larger
                y = y[n[y] <= far[x]]
                found.append(np.stack([np.full(len(y), x), y]))
    i, j = np.concatenate(found, axis=1) if found else (np.zeros(0, np.int64),) * 2
    apart = (part[i] < 0) | (block[i] != block[j])  # blocks of one list meet once
    i, j = i[apart], j[apart]
    both = np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])])
    both = np.unique(both, axis=1)
    if both.shape[1]:
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])


def checked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a, b, linked) of pairs of classes, from the whole texts."""
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = written(wanted.join(classes.select("class", "text_key"), "class"), "wanted")
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    maybe, _ = split_by_filter(keyed, "text_key", key_filter(wanted.select("text_key")))
    once = maybe.groupBy("text_key").agg(F.first("text").alias("text"))
    texts = written(once.join(wanted, "text_key").select("class", "text"), "texts")

    def compare(batches):
        for batch in batches:
            a, b = (c.to_pylist() for c in batch.columns[:2])
            sets: dict[int, np.ndarray] = {}
            for names, column in ((a, batch.column(2)), (b, batch.column(3))):
                new = [k for k, name in enumerate(names) if name not in sets]
                new = list({names[k]: k for k in new}.values())
                for k, h in shingle_sets(column.take(pa.array(new, pa.int64())), width):
                    sets[names[new[k]]] = h
            linked = []
            for x, y in zip(a, b):
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                union = len(sets[x]) + len(sets[y]) - common
                linked.append(DEN * common >= NUM * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)],
                                             ["a", "b", "linked"])

    one = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    return written(
        both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint, linked boolean"),
        "checked",
    )


def dealt(lists: DataFrame, limit: int = LIST) -> DataFrame:
    """Lists of more than `limit` entries, once for each pair of their blocks; others as they are.

    `part` is negative where all pairs count, else only those of different blocks.
    """
    long = lists.groupBy("token").count().where(F.col("count") > limit)
    long = long.select("token", F.ceil(F.col("count") / limit).cast("int").alias("blocks"))
    long = written(long, "long")
    if not long.limit(1).count():
        return lists.withColumns({"block": F.lit(0), "part": F.lit(-1)})
    rows = lists.join(long, "token", "left")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.coalesce("blocks", F.lit(1))).cast("int"))
    low = F.least(F.col("block"), F.col("other")) * F.col("blocks") + F.greatest("block", "other")
    rows = rows.withColumn("other", F.explode(F.when(
        F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    part = F.when(F.col("blocks").isNull(), F.lit(-1)).when(
        F.col("block") == F.col("other"), -1 - low).otherwise(low)
    return rows.withColumn("part", part)


def linked(docs: DataFrame, width: int = WIDTH, limit: int = LIST) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return _linked(docs, width, limit).select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), own.alias("component_id"))


def _linked(docs: DataFrame, width: int, limit: int) -> DataFrame:
    """(doc_id, text_key, n, component_id, head) of every document; the head is the first
    (without id or not, doc_id, text_key) of its component, and null where n is 0."""
    docs = docs.select("doc_id", "text")
    index = written(indexed(docs, width), "index")
    classes = written(
        index.where("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("smallest"), F.min("text_key").alias("text_key"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("head")),
        "classes",
    )
    once = index.where("n > 0").groupBy("class").agg(
        F.first(F.struct("n", "centrality", "prefix")).alias("x"))
    entries = once.select("class", "x.n", "x.centrality", F.posexplode("x.prefix").alias("at", "token"))
    entries = entries.repartition("token").sortWithinPartitions("token", F.desc("centrality"), "class")
    with arrow_rows(docs.sparkSession, LIGHT_ROWS):
        lists = written(
            entries.select("token", "class", "n", "at").mapInArrow(
                propose, "token bigint, class bigint, n bigint, at bigint, head bigint"),
            "lists",
        )
    heads = lists.where("head IS NOT NULL").select(
        F.least("class", "head").alias("a"), F.greatest("class", "head").alias("b")).distinct()
    first = checked(docs, classes, written(heads, "heads"), width)
    roots = components(first.where("linked"))
    named = lists.drop("head").join(
        roots.select(F.col("node").alias("class"), "root"), "class", "left"
    ).withColumn("component", F.coalesce("root", "class"))
    groups = dealt(named, limit).select("token", "part", "n", "class", "at", "component", "block")
    groups = groups.repartition("token", "part").sortWithinPartitions("token", "part", "n", "class")
    with arrow_rows(docs.sparkSession, LIGHT_ROWS):
        met = groups.mapInArrow(pair_up, "a bigint, b bigint").distinct()
        pairs = written(met.join(first.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    second = checked(docs, classes, pairs, width)
    # The second links join components of the first.
    left = second.where("linked").select("a", "b")
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), "root")
        left = left.join(known, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
    joined = components(left)
    roots = roots.unionByName(
        joined.select("node", F.col("node").alias("root"))
        .join(roots.select("node"), "node", "left_anti"))
    roots = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    roots = roots.select("node", F.coalesce("to", "root").alias("root"))
    whole = classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    whole = written(whole.withColumn("root", F.coalesce("root", "class")), "whole")
    names = whole.groupBy("root").agg(F.min("smallest").alias("component_id"), F.min("head").alias("head"))
    names = written(whole.drop("head").join(names, "root").select("class", "component_id", "head"), "names")
    return index.select("doc_id", "text_key", "n", "class").join(names, "class", "left").drop("class")


def one_per_component(docs: DataFrame, width: int = WIDTH, limit: int = LIST) -> DataFrame:
    """Exactly one document of each component: the one with the smallest doc_id, then text key.

    Documents without an id come last. Of rows that repeat both, the one with the smallest source
    and other columns stays. Documents without words are linked to nothing and all stay.
    """
    links = written(_linked(docs, width, limit).where("n > 0"), "links")
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))
    pairs = links.select("doc_id", "text_key", first.alias("first")).groupBy("doc_id", "text_key", "first").agg(
        F.count("*").alias("n"))
    # All rows of other pairs go; of a first pair that repeats, one row stays.
    key = F.xxhash64("doc_id", "text_key")
    changed = written(
        pairs.where("not first or n > 1").select(
            key.alias("key"), F.col("doc_id").alias("of"), F.col("text_key").alias("of_text"), "first"),
        "changed")
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")).withColumn("key", key)
    maybe, clear = split_by_filter(rows, "key", key_filter(changed.select("key")))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_text"))
    met = maybe.join(changed.withColumnRenamed("key", "of_key"), (F.col("key") == F.col("of_key")) & same, "left")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = sorted(rest, key=lambda c: c != "source")
    place = F.to_json(F.struct(*[F.col(f"doc.`{c}`") for c in rest])) if rest else F.lit("")
    again = met.where("first").groupBy("doc_id", "text_key").agg(F.min_by("doc", place).alias("doc"))
    kept = clear.select("doc").unionByName(met.where("of_key IS NULL").select("doc")).unionByName(again.select("doc"))
    return kept.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
