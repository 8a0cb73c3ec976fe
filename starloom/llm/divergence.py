"""How much the sources of a language differ in the words they use.

Identical texts of a language are collapsed first: each is read into terms once, with the number
of its rows in every source. Its terms count once for each row in the document frequencies and
as often as they occur, times the rows, in the counts. Copies therefore cost no work beyond
their digests, however many there are.

A language keeps the terms of at least LEAST of its documents. A source's share of a kept term
is 1 + floor(SCALE * (count + PRIOR) / (all counts + PRIOR * kept terms)), in integers. Two
sources differ by the sum over all kept terms of the difference of their shares. The sum is
sparse: a term that neither has adds the same small difference for each such term; a term that
only one has is met in the histogram of that source's shares; only terms that both have are
compared with each other. Those comparisons are added up inside the tasks, so that a pair of
sources leaves a task as one row and not once per term.

Defined cases: a null text, language or source is ''. A text without terms counts as a row of its
source and nothing else. A source without kept terms has the least share of each, a language
without kept terms gives its pairs the value 0. Ties in value are in order of the item's UTF-8
bytes. Repeated rows are counted as often as they are there; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import written

LEAST, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
# Entries that a task adds up before it hands them on, and pairs compared at once.
HELD, COMPARED = 400_000, 1 << 20

# Runs of letters: ASCII ones and all bytes of longer characters.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, rows): every distinct text of a language, with its rows in each source.

    Sources are counted by digest alone; of the texts, one of each digest leaves a task.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    counts = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    counts = counts.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("rows"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(counts, ["lang", "digest"]).select("lang", "text", "rows")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    size = 0

    def out() -> pa.RecordBatch:
        flat = [(lang, source, term, *pair) for (lang, source), terms in held.items() for term, pair in terms.items()]
        columns = list(zip(*flat))
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "term", "occurrences", "documents"])

    for batch in batches:
        for lang, text, rows in zip(*[batch.column(c) for c in ("lang", "text", "rows")]):
            # On bytes, lower() changes A to Z only.
            terms = Counter(TERM.findall(text.as_py().encode().lower()))
            for row in rows.as_py():
                known, n = held[lang.as_py(), row["source"]], row["n"]
                size -= len(known)
                for term, times in terms.items():
                    pair = known.get(term)
                    if pair is None:
                        known[term] = [times * n, n]
                    else:
                        pair[0] += times * n
                        pair[1] += n
                size += len(known)
            if size >= HELD:
                yield out()
                held.clear()
                size = 0
    if size:
        yield out()


def term_counts(texts: DataFrame) -> DataFrame:
    """(lang, source, term, occurrences, documents) of collapsed texts, in parts that add up."""
    return texts.mapInArrow(
        _count, "lang string, source string, term binary, occurrences bigint, documents bigint")


def kept_terms(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, uses): the terms of at least `least` documents, with the counts of each source.

    Terms are shuffled once; all three sums follow from that.
    """
    each = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("occurrences").alias("occurrences"), F.sum("documents").alias("documents"))
    terms = each.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"),
        F.collect_list(F.struct("source", "occurrences")).alias("uses"))
    return terms.where(F.col("documents") >= least).select(
        "lang", F.col("term").cast("string").alias("term"), "uses")


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kinds)); null where nothing is kept."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")
    below = F.nullif(total + F.lit(PRIOR) * kinds, F.lit(0)).cast("decimal(20,0)")
    # Exact: the remainder leaves the whole number of times.
    whole = (above - F.pmod(above, below)) / below
    return whole.cast("decimal(38,0)").cast("bigint") + F.lit(1)


def _added(codes: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their values."""
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.zeros(len(code), np.int64)
    np.add.at(sums, place, np.concatenate(values))
    return code, sums


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], int] = {}
    codes, values, size = [], [], 0

    def out(code: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        names = list(groups)
        pairs = [(names[a], names[b]) for a, b in zip((code >> 32).tolist(), (code & 0xFFFFFFFF).tolist())]
        columns = [[a[0] for a, _ in pairs], *zip(*[sorted((a[1], b[1])) for a, b in pairs])]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.string()) for c in columns], pa.array(sums)], ["lang", "source", "item", "value"])

    for batch in batches:
        uses = batch.column("uses")
        flat, ends = uses.flatten(), np.cumsum([len(u) for u in uses])
        share, base = (flat.field(c).to_numpy() for c in ("share", "base"))
        sources = flat.field("source").to_pylist()
        for lang, begin, end in zip(batch.column("lang").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            p, b = share[begin:end], base[begin:end]
            group = np.array([groups.setdefault((lang, s), len(groups)) for s in sources[begin:end]])
            step = max(1, COMPARED // max(end - begin, 1))
            for start in range(0, end - begin, step):
                i, j = np.triu_indices(min(step, end - begin - start), 1 + start, end - begin)
                i = i + start
                more = np.abs(p[i] - p[j]) - np.abs(p[i] - b[j]) - np.abs(p[j] - b[i]) + np.abs(b[i] - b[j])
                codes.append(np.minimum(group[i], group[j]) << 32 | np.maximum(group[i], group[j]))
                values.append(more)
                size += len(i)
                if size >= 2 * COMPARED:
                    code, sums = _added(codes, values)
                    if len(code) >= COMPARED:
                        yield out(code, sums)
                        code, sums = code[:0], sums[:0]
                    codes, values, size = [code], [sums], len(code)
    if size:
        yield out(*_added(codes, values))


def _pairs(uses: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the difference of all two sources of a language."""
    base = F.coalesce("base", F.lit(0))
    one = groups.select("lang", "source", base.alias("base"), "kinds")
    other = groups.select("lang", F.col("source").alias("item"), base.alias("other"))
    unlike, apart = F.col("source") != F.col("item"), F.abs(F.col("base") - F.col("other"))
    neither = one.join(other, "lang").where(unlike).select("lang", "source", "item", (F.col("kinds") * apart).alias("value"))
    shares = uses.groupBy("lang", "source", "base", "share").agg(F.count("*").alias("n"))
    beyond = F.col("n") * (F.abs(F.col("share") - F.col("other")) - apart)
    alone = shares.join(other, "lang").where(unlike).groupBy("lang", "source", "item").agg(F.sum(beyond).alias("value"))
    together = uses.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "share", "base")).alias("uses"))
    both = together.select("lang", "uses").mapInArrow(_both, "lang string, source string, item string, value bigint")
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def swapped(rows: DataFrame) -> DataFrame:
        return rows.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    parts = neither.unionByName(alone).unionByName(swapped(alone)).unionByName(both).unionByName(swapped(both))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part `pair` ranks the other sources of the language by their difference. Part `term` ranks
    the terms that the source uses more than its language does, the first `top` of them.
    """
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    kept = written(kept_terms(term_counts(collapsed(docs)), least), "kept-terms")
    each = kept.select("lang", "term", F.inline("uses"))
    kinds = kept.groupBy("lang").agg(F.count("*").alias("kinds"))
    totals = each.groupBy("lang", "source").agg(F.sum("occurrences").alias("total"))
    groups = groups.join(kinds, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["kinds", "total"])
    groups = groups.withColumn("base", share(F.lit(0), F.col("total"), F.col("kinds")))
    groups = written(groups, "groups")

    uses = written(
        each.join(groups, ["lang", "source"]).withColumn(
            "share", share(F.col("occurrences"), F.col("total"), F.col("kinds"))),
        "uses")
    pairs = _pairs(uses, groups)

    whole = kept.select("lang", "term", F.aggregate("uses", F.lit(0).cast("bigint"), lambda n, u: n + u["occurrences"]).alias("count"))
    all_of = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.first("kinds").alias("kinds"))
    whole = whole.join(all_of, "lang").select("lang", "term", share(F.col("count"), F.col("all"), F.col("kinds")).alias("usual"))
    terms = uses.where("occurrences > 0").join(whole, ["lang", "term"]).where("share > usual").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    best = terms.select("*", rank).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.select("*", rank).withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(best.withColumn("part", F.lit("term")).select(*columns)))
