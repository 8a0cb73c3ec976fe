"""Mixing sources to target weights along a time-varying curriculum.

Each source has a budget of words and a schedule that says how strongly it is wanted at each
moment t of training, 0 to 1. The integral of the schedule, scaled to the budget, is the
source's cumulative demand; a document stands where the demand reaches its words. The documents
of a source follow each other in a keyed random order, and begin again when the budget exceeds
what there is. The last document of a budget is taken in part, so that budgets are met to the
word.

Running totals are taken in slices of the random order (at most SLICES per source), so a source
that holds a third of all rows is dealt over many tasks. Only sums per slice meet in one window.

Defined cases: a null text or one without words has size 0, takes nothing and has no position.
Null is a source of its own, the last. Rows that repeat a doc_id are separate documents and are
placed in order of size. An empty table gives an empty result. Extra columns are ignored by
`placed` and kept by `training_set`, which also tells rows apart that are alike in all columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.keys import dense_key
from starloom.session import written

WORD = r"[^\x20\x09-\x0D]+"
UNFOLD = 1_000_000  # copies of one row that a task unfolds at once
PART_BYTES = 128 * 1024 * 1024  # text of a part of the training set
SLICE_DIGITS = 3  # hexadecimal digits of the random order: 4,096 slices of a source

# Weights of the sources by code point, repeating, and how each changes from the begin (0) to
# the end (1) of training: knots (moment, strength) joined by straight lines.
WEIGHTS = (3, 1, 2)
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
    ((0.0, 1.0), (0.5, 1.5), (1.0, 0.5)),
)
SHARE, LIMIT = 1.5, 2.0


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _segments(knots) -> list[tuple[float, float, float, float, float]]:
    """(start, strength there, slope, share of the demand before it, share after it)."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        after = before + (t1 - t0) * (w0 + w1) / 2 / area
        out.append((t0, w0 / area, (w1 - w0) / (t1 - t0) / area, before, after))
        before = after
    return out


def moment(demand: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The moment at which a source has met this share (0 to 1) of its demand."""
    out = F.lit(None).cast("double")
    for k, knots in reversed(list(enumerate(schedules))):
        inverse = None
        for t0, w0, slope, before, _ in reversed(_segments(knots)):
            rest = F.greatest(demand - F.lit(before), F.lit(0.0))
            # the root of w0 * x + slope * x * x / 2 = rest, in a form that allows slope 0
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            at = F.lit(t0) + F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(0.0)
            inverse = at if inverse is None else F.when(demand < F.lit(before_next), at).otherwise(inverse)
            before_next = before
        out = F.when(rank % len(schedules) == k, inverse).otherwise(out)
    return out


def targets(
    sized: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """(source, source_size, rank, target): words per source, none above `limit` of its size.

    Sources that would exceed their limit are held there and the excess goes to the others by
    weight, again until none is above. Each round reads one row per source and brings two sums
    to the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_key(sums, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.lit(limit) * F.col("source_size"), 0.0
    while True:
        held = cap < F.lit(level) * F.col("weight")
        at_cap, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(held, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0)),
        ).first()
        if not open_weight:
            level = math.inf
            break
        raised = (share * total - limit * at_cap) / open_weight
        if raised <= level:
            break
        level = raised
    wanted = F.lit(level) * F.col("weight")
    target = cap if level == math.inf else F.when(cap < wanted, cap).otherwise(wanted)
    return sources.select("source", "source_size", "rank", target.alias("target"))


def placed(
    docs: DataFrame,
    weights=WEIGHTS,
    schedules=SCHEDULES,
    share: float = SHARE,
    limit: float = LIMIT,
    seed: str = "mix",
    carry: list[str] | None = None,
) -> DataFrame:
    """Per document: size, its source's size and target, words taken, and its passes.

    `passes` is an array of (pass, words, position), one for each time the document is read.
    `carry` names columns to take along.
    """
    carry = carry or []
    return _placed(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry), carry,
        weights, schedules, share, limit, seed)


def _placed(
    sized: DataFrame, carry: list[str], weights=WEIGHTS, schedules=SCHEDULES, share: float = SHARE,
    limit: float = LIMIT, seed: str = "mix",
) -> DataFrame:
    """`placed`, from (doc_id, source, size) and the columns in `carry`; `_name` stands for the
    id in the random order, if it is there."""
    name = F.col("_name") if "_name" in sized.columns else F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    key = F.md5(F.concat_ws(":", F.lit(seed), name))
    keyed = sized.withColumn("key", key).withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    sized = written(keyed, "sized")
    goal = targets(sized, weights, share, limit)
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    slices = slices.alias("a").join(
        goal.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))
    ).select("a.source", "slice", "before", "source_size", "rank", "target")
    inside = (
        Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size", *carry)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("a")
    rows = rows.join(
        slices.alias("b"),
        F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.slice") == F.col("b.slice")),
    ).select("doc_id", "a.source", "size", "source_size", "target", "rank", *carry,
             (F.col("before") + F.col("inside")).alias("start"))
    quota = F.floor(F.col("target") + 0.5).cast("bigint")

    def one(n: int) -> Column:
        at = F.col("start") + F.lit(n) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), quota - at))
        middle = (at + words / F.lit(2.0)) / F.greatest(quota, F.lit(1))
        return F.struct(
            F.lit(n).alias("pass"), words.alias("words"),
            moment(middle, F.col("rank"), schedules).alias("position"),
        )

    passes = F.array(*[one(n) for n in range(math.ceil(limit))])
    rows = rows.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda a, p: a + p["words"])
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes", *carry
    )


def by_position(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-sort: part files follow each other in training order, rows without a position last."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)


def training_set(docs: DataFrame, **options) -> DataFrame:
    """Each document once for every pass, with `pass`, `words` (of its text, from the front)
    and `position`, range-sorted by position. Documents that the mix leaves out are gone.

    Every row is a document. Rows that are alike in all columns are counted, so that they travel
    as one, and numbered, so that each has its own place; the number and, without an id, the row's
    digest stand in the random order, which spreads large groups of them. Columns of the names
    `pass`, `words` and `position` are replaced, others of any name are kept.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    others = F.to_json(F.struct(*rest)) if rest else F.lit("")
    rows = docs.select(
        F.xxhash64("doc_id", "text", others).alias("_row"), F.struct(*docs.columns).alias("_doc"),
        word_count(F.col("text")).alias("_size"), F.octet_length("text").cast("bigint").alias("_bytes"))
    # The plan is made from the sizes alone and written, as the range-sort reads it twice; the
    # texts are shuffled to meet it, and once more into training order.
    once = rows.groupBy("_row").agg(F.first("_doc").alias("_doc"))
    counted = rows.select("_row", F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.source").alias("source"),
                          F.col("_size").alias("size"), F.coalesce("_bytes", F.lit(0)).alias("_bytes"))
    counted = counted.groupBy("_row", "doc_id", "source", "size", "_bytes").agg(F.count("*").alias("_copies"))
    zero, step = F.lit(0).cast("bigint"), F.lit(UNFOLD).cast("bigint")
    chunks = counted.withColumn("_from", F.explode(F.sequence(zero, F.col("_copies") - 1, step))).hint("rebalance")
    upto = F.least(F.col("_from") + step, F.col("_copies")) - 1
    sized = chunks.withColumn("_copy", F.explode(F.sequence(F.col("_from"), upto)))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("_row").cast("string")))
    name = F.when(F.col("_copy") > 0, F.concat_ws(":", name, F.col("_copy").cast("string"))).otherwise(name)
    sized = sized.select("_row", "_copy", "doc_id", "source", "size", name.alias("_name"), "_bytes")
    plan = _placed(sized, ["_row", "_copy", "_bytes"], **options)
    plan = plan.select("_row", "_bytes", F.explode("passes").alias("_p"))
    plan = written(plan.select("_row", "_p.pass", "_p.words", "_p.position", "_bytes"), "plan")
    total = plan.agg(F.sum("_bytes")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    kept = [F.col(f"_doc.`{c}`") for c in docs.columns if c not in ("pass", "words", "position")]
    return by_position(once.join(plan, "_row").select(*kept, "pass", "words", "position"), parts)
