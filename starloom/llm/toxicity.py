"""Severity of toxic texts by cumulative-link ordinal regression.

Grades are ordered: 0 clean, then GRADES - 1 grades of toxicity. P(grade >= k) is the logistic
function of s - threshold k, where s is one weighted sum over the text's words: the weights are
shared by all thresholds, which are ordered. The result is the expected grade.

Labels say only toxic or not. The grade of a toxic training text is its quantile, among the
toxic ones, by the number of features that tell toxic from clean texts.

Learning takes a bounded sample: the SAMPLE labelled documents with the lowest keyed hash of each
label, one text of up to MAX_CHARS each. Features are counted in tasks; to the driver come their
counts, where a SHARE of the toxic texts has them, and the few that tell of each text. Features are words (letters and digits, in lower case) and their
first 3 to 8 bytes, which inflected forms share, hashed to 2^BITS buckets, as present or not;
those enter that speak for toxicity (z of Z or more), that SUPPORT toxic texts and a SHARE of
them have, and that are in toxic texts in PURITY of their cases. Weights are 0 or more: no word makes a text less toxic. Of near copies in the
sample, which would make all their words telling, one counts. The sample holds as many toxic as clean texts, which is made up for in the thresholds. Everything
else is on whole texts of all documents.

Defined cases: a null text, or one without known words, has the score 0 and so the prior's
expected severity. Labels without a document, or null, are ignored; of several labels for one id
the highest counts; of several texts of one id the one with the lowest hash is learned. Without labels of both kinds nothing is toxic: all severities are 0.
Repeated rows are scored each; a null doc_id is scored like any other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.shingles import BLOCK, _pieces, blocks, shingle_sets
from starloom.llm.tokens import tokens
from starloom.session import written

GRADES, BITS = 4, 22
PREFIXES = (3, 4, 5, 6, 7, 8)  # bytes
SAMPLE, MAX_CHARS = 3000, 200_000
Z, SUPPORT, SHARE, PURITY = 4.0, 5, 0.005, 0.8


@dataclass
class Model:
    buckets: np.ndarray  # of the words used, in order
    weights: np.ndarray
    thresholds: np.ndarray  # GRADES - 1, rising


def _features(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word and of its beginnings."""
    t = tokens(raw, begins)
    starts, hashes = [t.starts], [t.hashes]
    for size in PREFIXES:
        at, h = t.prefixes(size)
        starts.append(t.starts[at])
        hashes.append(h)
    return np.concatenate(starts), np.concatenate(hashes)


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, row and bucket of each feature) of blocks of rows."""
    for first, last, offsets, raw in blocks(texts):
        if last == first + 1 and len(raw) > BLOCK:
            for piece in _pieces(raw):
                starts, hashes = _features(piece, np.zeros(1, np.int64))
                yield first, last, np.zeros(len(starts), np.int64), _bucket(hashes)
        else:
            starts, hashes = _features(raw, offsets[:-1])
            yield first, last, np.searchsorted(offsets, starts, "right") - 1, _bucket(hashes)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of the distinct features of each text, block by block."""
    for first, _, rows, buckets in features(pa.array(texts, pa.string())):
        pairs = np.unique((first + rows) << BITS | buckets)
        yield pairs >> BITS, pairs & ((1 << BITS) - 1)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(x / 2))


def at_least(scores: np.ndarray, model: Model) -> np.ndarray:
    """P(grade >= k) for k = 1 and up, one column each."""
    return _sigmoid(scores[:, None] - model.thresholds[None, :])


def fit_ordinal(rows, cols, n_cols: int, grades: np.ndarray, steps: int = 1500, ridge: float = 1e-4):
    """Weights and thresholds of least loss on a sparse 0/1 matrix given by (rows, cols)."""
    n, k = len(grades), GRADES - 1
    share = [(grades >= g).mean() for g in range(1, GRADES)]
    share = np.clip(share, 1 / (4 * n), 1 - 1 / (4 * n))
    first = -np.log(share / (1 - share))
    # thresholds are the first one and the logarithms of the steps, so they stay in order
    gaps = np.log(np.maximum(np.diff(first), 1e-3))
    params = np.concatenate([np.zeros(n_cols), [first[0]], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, t = params[:n_cols], params[n_cols] + np.concatenate([[0], np.cumsum(np.exp(params[n_cols + 1:]))])
        s = np.bincount(rows, weights=w[cols], minlength=n)
        upper = np.concatenate([np.ones((n, 1)), _sigmoid(s[:, None] - t), np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[at, grades] - upper[at, grades + 1], 1e-12)
        slope = upper * (1 - upper)
        # derivative of the log-likelihood by the score and by each threshold
        by_score = (slope[at, grades] - slope[at, grades + 1]) / p
        by_t = np.zeros((n, k + 2))
        by_t[at, grades] -= slope[at, grades] / p
        by_t[at, grades + 1] += slope[at, grades + 1] / p
        by_t = by_t[:, 1:-1].mean(axis=0)
        grad = np.zeros_like(params)
        grad[:n_cols] = np.bincount(cols, weights=by_score[rows], minlength=n_cols) / n - ridge * w
        grad[n_cols] = by_t.sum()
        after = np.cumsum(by_t[::-1])[::-1]
        grad[n_cols + 1:] = after[1:] * np.exp(params[n_cols + 1:])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        params[:n_cols] = np.maximum(params[:n_cols], 0)
    t = params[n_cols] + np.concatenate([[0], np.cumsum(np.exp(params[n_cols + 1:]))])
    return params[:n_cols], t


def _telling(have: np.ndarray, hits: np.ndarray, n: int, positives: int) -> np.ndarray:
    """Which features enter, that `have` texts of n and `hits` toxic ones of `positives` contain."""
    rate = positives / n
    z = (hits - have * rate) / np.sqrt(np.maximum(have * rate * (1 - rate), 1e-9))
    return (z >= Z) & (hits >= max(SUPPORT, SHARE * positives)) & (hits >= PURITY * have)


def _graded(used: np.ndarray, rows: np.ndarray, buckets: np.ndarray, toxic: np.ndarray, odds: float | None) -> Model:
    """The model of these features, from the (row, bucket) pairs of them that the texts have."""
    n, positives = len(toxic), int(toxic.sum())
    signs = np.bincount(rows, minlength=n)
    cuts = np.quantile(signs[toxic > 0], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(toxic > 0, 1 + np.searchsorted(cuts, signs, "left"), 0)
    weights, thresholds = fit_ordinal(rows, np.searchsorted(used, buckets), len(used), grades)
    if odds:
        thresholds = thresholds + np.log(positives / (n - positives) / odds)
    return Model(used, weights, thresholds)


def _nothing() -> Model:
    return Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES - 1, np.inf))


def train(texts: list[str], toxic: np.ndarray, odds: float | None = None) -> Model:
    """Choose the features, grade the toxic texts, fit: `fit` on a list. `odds`: of toxic to clean
    outside the sample."""
    n, positives = len(texts), int(toxic.sum())
    if not 0 < positives < n:
        return _nothing()
    # Near copies most likely share their smallest shingle hash; one of them counts.
    smallest = np.zeros(n, np.uint64)
    for k, h in shingle_sets(pa.array(texts, pa.string())):
        smallest[k] = h[0] if len(h) else 0
    _, kept = np.unique(np.stack([smallest, toxic.astype(np.uint64)]), axis=1, return_index=True)
    texts, toxic, n = [texts[k] for k in kept], toxic[kept], len(kept)
    positives = int(toxic.sum())
    # Counted block by block: the features of the whole sample never meet in memory.
    have, hits = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for rows, buckets in _distinct(texts):
        np.add.at(have, buckets, 1)
        np.add.at(hits, buckets[toxic[rows] > 0], 1)
    telling = _telling(have, hits, n, positives)
    found = [(rows[telling[b]], b[telling[b]]) for rows, b in _distinct(texts)]
    p_rows, p_buckets = (np.concatenate(x) for x in zip(*found))
    return _graded(np.flatnonzero(telling), p_rows, p_buckets, toxic, odds)


def _described(texts: DataFrame) -> DataFrame:
    """(doc_id, toxic, smallest shingle hash, distinct features) of each text of the sample."""

    def describe(batches):
        for batch in batches:
            smallest, lists = np.zeros(batch.num_rows, np.int64), []
            for k, h in shingle_sets(batch.column(2)):
                smallest[k] = h[:1].view(np.int64)[0] if len(h) else 0
            for k in range(batch.num_rows):
                found = [np.unique(b) for _, _, _, b in features(batch.column(2).slice(k, 1))]
                lists.append(np.unique(np.concatenate([np.zeros(0, np.int64), *found])))
            ends = np.cumsum([0, *map(len, lists)])
            column = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(smallest), column],
                ["doc_id", "toxic", "smallest", "buckets"])

    return texts.select("doc_id", "toxic", "text").mapInArrow(
        describe, "doc_id bigint, toxic boolean, smallest bigint, buckets array<bigint>")


def sample(docs: DataFrame, known: DataFrame, counts: dict[bool, int], seed: str) -> DataFrame:
    """(doc_id, toxic, text) of at most SAMPLE documents of each label, one row an id."""
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = None
    for toxic, count in counts.items():
        share = min(1.0, 1.3 * SAMPLE / count)
        part = known.where((F.col("toxic") == toxic) & (F.pmod(h, F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)))
        part = part.orderBy(h, "doc_id").limit(SAMPLE)
        picked = part if picked is None else picked.unionByName(part)
    # At most SAMPLE ids of each label, so they go to every task; rows of one id meet as one
    # text before they are shuffled.
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").where(F.length("text") <= MAX_CHARS)
    return rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))


def fit(docs: DataFrame, labels: DataFrame, seed: str = "toxicity") -> Model:
    """Train on a bounded sample of documents with a label."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint")).agg(
        (F.max("toxic") > 0).alias("toxic")).toDF("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return _nothing()
    all_texts = written(_described(sample(docs, known, counts, seed)), "sample")
    # Near copies most likely share their smallest shingle hash; one of them counts.
    one = all_texts.groupBy("smallest", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    texts = all_texts.join(F.broadcast(one), "doc_id")
    rows = sorted((r.doc_id, r.toxic) for r in texts.select("doc_id", "toxic").collect())
    toxic = np.array([float(x) for _, x in rows])
    n, positives = len(rows), int(toxic.sum())
    if not 0 < positives < n:
        return _nothing()
    each = texts.select("toxic", F.explode("buckets").alias("bucket"))
    found = each.groupBy("bucket").agg(F.count("*").alias("have"), F.count_if("toxic").alias("hits"))
    found = found.where(F.col("hits") >= max(SUPPORT, SHARE * positives)).orderBy("bucket").collect()
    table = np.array([tuple(r) for r in found], np.int64).reshape(-1, 3)
    used = table[_telling(table[:, 1], table[:, 2], n, positives), 0]
    wanted = docs.sparkSession.createDataFrame([(int(b),) for b in used], "bucket bigint")
    pairs = texts.select("doc_id", F.explode("buckets").alias("bucket")).join(F.broadcast(wanted), "bucket")
    place = {doc_id: k for k, (doc_id, _) in enumerate(rows)}
    pairs = sorted((place[r.doc_id], r.bucket) for r in pairs.select("doc_id", "bucket").collect())
    at = np.array(pairs, np.int64).reshape(-1, 2)
    return _graded(used, at[:, 0], at[:, 1], toxic, counts[True] / max(counts[False], 1))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_severity, grade, p_toxic, toxic); grade is the median one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        column = np.full(1 << BITS, -1, np.int32)
        column[model.buckets] = np.arange(len(model.buckets))
        for batch in batches:
            size, found = np.int64(len(model.buckets) + 1), [np.zeros(0, np.int64)]
            for first, _, rows, buckets in features(batch.column(1)):
                cols = column[buckets].astype(np.int64)
                hit = cols >= 0
                found.append(np.unique((first + rows[hit]) * size + cols[hit]))
            pairs = np.unique(np.concatenate(found))
            total = np.bincount(pairs // size, weights=model.weights[pairs % size], minlength=batch.num_rows)
            p = at_least(total, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1), pa.int64()),
                 pa.array(p[:, 0]), pa.array(p[:, 0] >= 0.5)],
                ["doc_id", "expected_severity", "grade", "p_toxic", "toxic"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        score, "doc_id bigint, expected_severity double, grade bigint, p_toxic double, toxic boolean")
