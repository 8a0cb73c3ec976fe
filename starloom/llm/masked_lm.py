"""Pseudo-likelihood of texts by a bidirectional window network.

Every word is masked in turn and predicted from the two words before and the two after it. Each
place of the window has its own embedding table; their sum goes through tanh and a softmax in
two levels, over clusters of the vocabulary and over the words of a cluster. The logarithms of
the probabilities, summed over a text, are its score.

The vocabulary is counted over all words of all documents; the most frequent ones have a number,
the others share buckets by hash. The numbers and buckets grow with the square root of the
distinct words, from SIZE and RARE on. A word in a bucket has the probability of its bucket times
its share of the bucket, (count + UNSEEN) of all counts there plus UNSEEN for each distinct word
and for one that was never seen; the counts of all words are joined for this, so every word is
predicted as itself. The network is trained on all texts, each once and whole, in ROUNDS: the rows
of a task are dealt to the rounds in turn, so that copies of one text do not fill a round. In a
round every task starts from the same weights, learns from its own texts in batches (numpy,
Adagrad) and sends its weights and number of words; the weighted mean begins the next round. Only
the vocabulary and the weights come to the driver. Means are taken in order of the tasks, so that
a rerun over the same splits gives the same weights.

Defined cases: a null text, or one without words, has 0 words, score 0 and a null mean. Beyond
the ends of a text the window holds a boundary mark. Without any training text the network
knows nothing but the boundary and gives all words nearly the same probability. Repeated rows
are scored each. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starloom.llm.registry import arrow_rows
from starloom.llm.shingles import mixed, words
from starloom.session import written

CLUSTERS, MEMBERS, RARE, DIM = 32, 32, 32, 16
SIZE = CLUSTERS * MEMBERS
PLACES = (-2, -1, 1, 2)
ROUNDS, RATE = 3, 0.3
FIRST, SHARE, BATCH = 256, 32, 8192  # words of a batch: the first ones, of those seen, and the most
COUNTED = 1 << 21  # words that a task counts at once
SCORED = 8192  # words scored at once
EXPONENT = 40.0  # below this, exponentials and their sums, times weights, stay far inside float32
COUNT_ROWS = 50_000  # rows of an Arrow batch of word counts
GROUPS = 16  # groups of tasks whose weights are averaged first
UNSEEN = 0.5  # added to the count of every word of a bucket, and the count of an unseen one
FIXED = 1 << 30  # logarithms are summed in whole parts of this, so that no sum depends on an order


def shape(distinct: int) -> tuple[int, int]:
    """(clusters, members) for so many distinct words."""
    clusters, members = CLUSTERS, MEMBERS
    while clusters * members < 2 * math.sqrt(distinct):
        clusters, members = (2 * clusters, members) if clusters == members else (clusters, 2 * members)
    return clusters, members


def buckets(size: int) -> int:
    return RARE * size // SIZE


@dataclass
class Weights:
    tables: np.ndarray  # (places, size + 1, DIM); the last row is the boundary
    bias: np.ndarray  # (DIM,)
    top: np.ndarray  # (DIM + 1, clusters)
    inner: np.ndarray  # (clusters, DIM + 1, members)

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.inner), self.inner.shape[2]

    @property
    def size(self) -> int:
        return self.tables.shape[1] - 1

    def parts(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.top, self.inner]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @staticmethod
    def of(flat: np.ndarray, shape: tuple[int, int] = (CLUSTERS, MEMBERS)) -> Weights:
        clusters, members = shape
        shapes = [(len(PLACES), clusters * members + 1, DIM), (DIM,), (DIM + 1, clusters),
                  (clusters, DIM + 1, members)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return Weights(*[x.reshape(s).astype(np.float32).copy() for x, s in zip(np.split(flat, ends[:-1]), shapes)])


def start_weights(counts: np.ndarray, seed: int = 9) -> Weights:
    """Small random embeddings; the output begins at the words' frequencies."""
    rng = np.random.default_rng(seed)
    clusters = CLUSTERS
    while clusters * clusters < len(counts):
        clusters *= 2
    share = (counts + 1.0).reshape(clusters, -1)
    top = rng.normal(0, 0.05, (DIM + 1, clusters))
    inner = rng.normal(0, 0.05, (clusters, DIM + 1, share.shape[1]))
    top[-1] = np.log(share.sum(axis=1) / share.sum())
    inner[:, -1] = np.log(share / share.sum(axis=1, keepdims=True))
    tables = rng.normal(0, 0.1, (len(PLACES), len(counts) + 1, DIM))
    return Weights(*(x.astype(np.float32) for x in (tables, np.zeros(DIM), top, inner)))


def numbers(hashes: np.ndarray, vocabulary: np.ndarray, ids: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Word numbers; `vocabulary` is sorted, `ids` are its numbers. The last ones are buckets."""
    count = buckets(size)
    rare = size - count + (mixed(hashes ^ np.uint64(5)) % np.uint64(count)).astype(np.int64)
    if not len(vocabulary):
        return rare
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, ids[at], rare)


def contexts(ids: np.ndarray, begins: np.ndarray, size: int = SIZE) -> np.ndarray:
    """(places, words): the numbers around each word, `size` beyond the ends of its text.

    `begins` are the offsets of the texts and the end of the last.
    """
    out = np.full((len(PLACES), len(ids)), size, np.int64)
    text = np.searchsorted(begins, np.arange(len(ids)), "right")
    for row, k in zip(out, PLACES):
        here, there = (slice(-k, None), slice(None, k)) if k < 0 else (slice(None, -k), slice(k, None))
        if len(ids) > abs(k):
            same = text[here] == text[there]
            row[here][same] = ids[there][same]
    return out


def _hidden(w: Weights, around: np.ndarray) -> np.ndarray:
    total = np.take(w.tables[0], around[0], axis=0)
    for table, ids in zip(w.tables[1:], around[1:]):
        total += np.take(table, ids, axis=0)
    total += w.bias
    return np.tanh(total, out=total)


def _wide(h: np.ndarray) -> np.ndarray:
    """With a column of ones, which meets the last row of the output tables."""
    return np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)


def _bound(x: np.ndarray, weights: np.ndarray) -> None:
    """Take its maximum from each row, in place, if an exponential could overflow. Hidden values are
    at most 1, so the sums of the weights that made the rows bound them without a look at each."""
    if np.abs(weights).sum(axis=-2).max() > EXPONENT:
        x -= x.max(axis=1, keepdims=True)


def _exps(x: np.ndarray) -> np.ndarray:
    """Exponentials, in place; the sums of the rows."""
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _log_of(x: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row at one column; `x` is used up."""
    _bound(x, weights)
    here = x[np.arange(len(x)), at]
    return here - np.log(_exps(x))


def _slope(x: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The softmax of each row, less 1 at one column, in place and times its sum; one over the sums."""
    _bound(x, weights)
    total = _exps(x)
    x[np.arange(len(x)), at] -= total
    return (1 / total)[:, None]


def _inner(w: Weights, wide: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """What the members of its cluster get, for each word; the words are in runs by cluster."""
    out = np.empty((len(wide), w.shape[1]), np.float32)
    for c, first, end in runs:
        np.matmul(wide[first:end], w.inner[c], out=out[first:end])
    return out


def _by_cluster(cluster: np.ndarray, clusters: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order of the words by cluster, and (cluster, first, end) of each one that occurs."""
    order = np.argsort(cluster.astype(np.int16), kind="stable")
    edges = np.searchsorted(cluster[order], np.arange(clusters + 1)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def log_probabilities(w: Weights, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Of each word, given the words around it."""
    out = np.empty(len(ids))
    clusters, members = w.shape
    for a in range(0, len(ids), SCORED):
        part = ids[a:a + SCORED]
        order, runs = _by_cluster(part // members, clusters)
        part = part[order]
        cluster, member = part // members, part % members
        wide = _wide(_hidden(w, around[:, a:a + SCORED][:, order]))
        found = _log_of(wide @ w.top, cluster, w.top).astype(np.float64)
        found += _log_of(_inner(w, wide, runs), member, w.inner)
        out[a + order] = found
    return out


def _step(x: np.ndarray, squares: np.ndarray, grad: np.ndarray, at=...) -> None:
    """Adagrad, in place, on the rows `at`."""
    total = squares[at] + grad * grad
    squares[at] = total
    x[at] -= RATE * grad / (np.sqrt(total) + 1e-6)


def learn(w: Weights, squares: list[np.ndarray], ids: np.ndarray, around: np.ndarray) -> None:
    """One step on a batch, in place. `squares`: sums of squared gradients.

    Only the clusters and the rows of the tables that occur in the batch are touched.
    """
    n = len(ids)
    clusters, members = w.shape
    order, runs = _by_cluster(ids // members, clusters)
    ids, around = ids[order], around[:, order]
    cluster, member = ids // members, ids % members
    h = _hidden(w, around)
    wide = _wide(h)
    p = wide @ w.top
    scale = _slope(p, cluster, w.top)
    back = (p @ w.top[:-1].T) * scale
    top = (wide * scale).T @ p / n
    q = _inner(w, wide, runs)
    scale = _slope(q, member, w.inner)
    scaled = wide * scale
    more, inner = np.empty_like(back), np.empty((len(runs), DIM + 1, members), np.float32)
    for k, (c, first, end) in enumerate(runs):
        np.matmul(q[first:end], w.inner[c, :-1].T, out=more[first:end])
        np.matmul(scaled[first:end].T, q[first:end], out=inner[k])
    back += more * scale
    _step(w.top, squares[2], top)
    _step(w.inner, squares[3], inner / n, [c for c, _, _ in runs])
    back *= (1 - h * h) / np.float32(n)
    _step(w.bias, squares[1], back.sum(axis=0))
    for table, square, near in zip(w.tables, squares[0], around):
        order = np.argsort(near.astype(np.int16 if w.size < 1 << 15 else np.int32), kind="stable")
        near = near[order]
        firsts = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
        # two sums at once, as the parts of a complex number
        pairs = np.take(back, order, axis=0).view(np.complex64)
        _step(table, square, np.add.reduceat(pairs, firsts, axis=0).view(np.float32), near[firsts])


def teach_words(w: Weights, squares: list[np.ndarray], ids: np.ndarray, around: np.ndarray, seen: int) -> int:
    """Steps over these words, after `seen` others; how many have been seen then.

    Batches grow with what has been seen, so that few words are enough for some steps.
    """
    a = 0
    while a < len(ids):
        size = min(max(FIRST, (seen + a) // SHARE), BATCH)
        learn(w, squares, ids[a:a + size], around[:, a:a + size])
        a += size
    return seen + len(ids)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) of all words of all documents."""
    def emit(held):
        if held:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())], ["word", "count"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, hashes in words(batch.column(0)):
                held.append(hashes)
                size += len(hashes)
                if size >= COUNTED:
                    yield from emit(held)
                    held, size = [], 0
        yield from emit(held)

    counts = docs.select("text").mapInArrow(count, "word bigint, count bigint")
    counts = counts.groupBy("word").agg(F.sum("count").alias("count"))
    return written(counts, "words")


def count_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted hashes, their numbers, counts by number) of the vocabulary of all documents."""
    return vocabulary(word_counts(docs))[:3]


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same from (word, count), and the logarithm of the share that an unseen word has of
    each bucket."""
    distinct = counts.count()
    clusters, members = shape(distinct)
    size = clusters * members
    count = buckets(size)
    best = counts.orderBy(F.desc("count"), "word").limit(size - count).collect()
    hashes = np.array([r["word"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, order = hashes[order], order.astype(np.int64)
    by_number = np.zeros(size)
    by_number[:len(best)] = [r["count"] for r in best]

    def add(batches):
        held = np.zeros((2, size), np.int64)
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            ids = numbers(words, hashes, order, size)
            held[0] += np.bincount(ids, minlength=size)
            # whole numbers up to 2^53 stay exact
            held[1] += np.bincount(ids, weights=batch.column(1).to_numpy(), minlength=size).astype(np.int64)
        at = np.flatnonzero(held[0, size - count:]) + size - count
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[0, at]), pa.array(held[1, at])],
                                         ["number", "words", "count"])

    words = np.zeros(count)
    with arrow_rows(counts.sparkSession, COUNT_ROWS):
        sums = counts.mapInArrow(add, "number bigint, words bigint, count bigint").groupBy("number").agg(
            F.sum("words").alias("words"), F.sum("count").alias("count")).collect()
    for r in sums:
        words[r["number"] - size + count], by_number[r["number"]] = r["words"], r["count"]
    unseen = np.log(UNSEEN / (by_number[size - count:] + UNSEEN * (words + 1)))
    return hashes, order, by_number, unseen


@dataclass
class Model:
    vocabulary: np.ndarray
    ids: np.ndarray
    weights: Weights
    unseen: np.ndarray | None = None  # by bucket: logarithm of an unseen word's share
    counts: DataFrame | None = None  # (word, count); without it, buckets are scored as one word


def _round(texts: DataFrame, model: Model) -> Weights:
    """Every task learns from its texts; the mean of their weights by number of words."""
    shared = texts.sparkSession.sparkContext.broadcast(replace(model, counts=None))

    def teach(batches):
        m = shared.value
        w = Weights.of(m.weights.flat(), m.weights.shape)
        squares = [np.full_like(x, 1e-4) for x in w.parts()]
        seen = 0
        for batch in batches:
            for _, offsets, hashes in words(batch.column(0)):
                ids = numbers(hashes, m.vocabulary, m.ids, w.size)
                around = contexts(ids, offsets, w.size)
                seen = teach_words(w, squares, ids, around, seen)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seen], pa.int64()),
                 pa.array([w.flat().tobytes()], pa.binary())], ["task", "seen", "weights"])

    def add(batches):
        total, weight = None, 0
        for batch in batches:
            for seen, flat in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                part = np.frombuffer(flat, np.float32).astype(np.float64) * seen
                total, weight = part if total is None else total + part, weight + seen
        if weight:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([weight], pa.int64()),
                 pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())],
                ["task", "seen", "weights"])

    schema = "task int, seen bigint, weights binary"
    parts = texts.mapInArrow(teach, schema)
    # The means of groups of tasks, and the mean of these on the driver: at most GROUPS rows.
    grouped = written(parts.withColumn("group", F.pmod("task", F.lit(GROUPS))), "weights")
    with arrow_rows(texts.sparkSession, 16):
        sums = grouped.repartition("group").sortWithinPartitions("group", "task")
        rows = sums.select("task", "seen", "weights").mapInArrow(add, schema).collect()
    if not rows:
        return model.weights
    flat = sum(np.frombuffer(r.weights, np.float32).astype(np.float64) * r.seen for r in sorted(
        rows, key=lambda r: (r.seen, bytes(r.weights))))
    return Weights.of(flat / sum(r.seen for r in rows), model.weights.shape)


def fit(docs: DataFrame) -> Model:
    words = word_counts(docs)
    hashes, ids, counts, unseen = vocabulary(words)
    model = Model(hashes, ids, start_weights(counts), unseen, words)
    dealt = docs.select("text").withColumn("turn", F.pmod(F.monotonically_increasing_id(), F.lit(ROUNDS)))
    for turn in range(ROUNDS):
        texts = dealt.where(F.col("turn") == turn).select("text")
        model = replace(model, weights=_round(texts, model))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every whole text.

    The network's part is written with a row number and the words outside the vocabulary, first
    taken as unseen ones. No such word is frequent, so the join with the counts of all words is
    dealt evenly; it gives what their counts add.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, counts=None))

    def score(batches):
        m = shared.value
        size, row = m.weights.size, TaskContext.get().partitionId() << 33
        bucket = size - buckets(size)
        for batch in batches:
            for first, offsets, hashes in words(batch.column(1)):
                ids = numbers(hashes, m.vocabulary, m.ids, size)
                log = log_probabilities(m.weights, ids, contexts(ids, offsets, size))
                rare = np.flatnonzero(ids >= bucket) if m.unseen is not None else np.zeros(0, np.int64)
                if len(rare):
                    log[rare] += m.unseen[ids[rare] - bucket]
                count = np.diff(offsets)
                rows = np.repeat(np.arange(len(count)), count)
                total = np.bincount(rows, weights=log, minlength=len(count))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(rare, offsets), pa.int32()), pa.array(hashes[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(count))), batch.column(0).slice(first, len(count)),
                     pa.array(count, pa.int64()), pa.array(total, pa.float64()), lists],
                    ["row", "doc_id", "n_tokens", "log", "rare"])
                row += len(count)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        score, "row bigint, doc_id bigint, n_tokens bigint, log double, rare array<bigint>")
    total = F.col("log")
    if model.counts is not None:
        rows = written(rows, "scores")
        more = F.round(F.log1p(F.col("count") / F.lit(UNSEEN)) * F.lit(FIXED)).cast("bigint")
        seen = rows.select("row", F.explode("rare").alias("word")).join(model.counts, "word")
        seen = seen.groupBy("row").agg(F.sum(more).alias("more"))
        rows = rows.drop("rare").join(seen, "row", "left")
        total = total + F.coalesce(F.col("more"), F.lit(0)) / F.lit(FIXED)
    rows = rows.select("doc_id", "n_tokens", total.alias("log_likelihood"))
    return rows.withColumn("mean_log_likelihood", F.when(
        F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))
