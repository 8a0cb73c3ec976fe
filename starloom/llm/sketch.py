"""Threshold-scaled sketches of documents.

The sketch of a text is every hash of a five-word shingle below a fixed fraction of all hashes.
Half of all hashes are below, so that short texts have some, too. If none is below, it is the
smallest one. So a text of any length has a sketch in proportion to
it, and texts of very unequal lengths can be compared: of the shingles of a text, its sketch is
a sample that another text's sketch either holds or not.

The sketch of two texts together follows from their sketches alone (`merged`): the hashes of
both below the threshold or, if there are none, the smallest.

Words are separated by blanks and the control characters 9 to 13, in lower case. Fewer than five
words are one shingle. Defined cases: null is the empty text; a text without words has an empty
sketch, which is like another empty one (1) and like no other (0). The containment of a text
without a hash below the threshold is unknown (null): a longer text drops the one that it keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.keys import dense_key
from starloom.session import written

SCALE, WIDTH = 2, 5
THRESHOLD = -(1 << 63) + (1 << 64) // SCALE


def words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+")
    return F.filter(parts, lambda w: w != "")


def _scaled(hashes: Column) -> Column:
    """Distinct hashes below the threshold, or the smallest one, in order."""
    low = F.filter(hashes, lambda h: h < F.lit(THRESHOLD))
    least = F.array_min(hashes)
    none = F.when(least.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(least))
    return F.when(least < F.lit(THRESHOLD), F.array_sort(F.array_distinct(low))).otherwise(none)


def with_sketch(rows: DataFrame, text: str = "text", name: str = "sketch", scale: int = SCALE) -> DataFrame:
    """Add the sketch of a text column. Words and hashes are columns of their own on the way, so
    that they are computed once for each row and not once for each shingle."""
    width = F.lit(WIDTH)
    rows = rows.withColumn("_words", words(F.col(text)))
    count = F.size("_words")
    run = [F.get(F.col("_words"), F.lit(k)) for k in range(WIDTH)]
    runs = F.transform(
        F.sequence(F.lit(0), count - width),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WIDTH)]),
    )
    hashes = F.when(count >= width, runs).when(count > 0, F.array(F.xxhash64(*run))).otherwise(
        F.array().cast("array<bigint>"))
    rows = rows.withColumn("_hashes", hashes).drop("_words")
    return rows.withColumn(name, _scaled(F.col("_hashes"))).drop("_hashes")


def merged(a: Column, b: Column) -> Column:
    return _scaled(F.array_union(a, b))


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of the shingles of `part` that `whole` has; null if `part` has no sample."""
    common = F.size(F.array_intersect(part, whole))
    return F.when(F.size(part) == 0, (F.size(whole) == 0).cast("double")).when(
        F.array_min(part) < F.lit(THRESHOLD), common / F.size(part))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def shortened(sketch: Column) -> Column:
    """The lower halves of the hashes, enough to tell those of two texts apart."""
    return F.transform(sketch, lambda h: (h % F.lit(1 << 31)).cast("int"))


def fingerprint(sketch: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def next_rows(docs: DataFrame) -> DataFrame:
    """(key, n, copies, next_key, next_of, next_of_n): the order by descending doc_id.

    `key` names a (doc_id, text). Rows that repeat both follow each other; null ids are last, equal
    ids are in order of key. After the last row comes the first. `next_of` is the key of the row
    before, and `next_of_n` its length. Only keys and lengths are moved.
    """
    light = docs.select("key", "doc_id", F.length("text").cast("bigint").alias("n"))
    light = light.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies"))
    ranked = written(dense_key(light, [F.col("doc_id").desc_nulls_last(), F.col("key")], "rank"), "ranked")
    total = ranked.count()
    last = F.lit(max(total - 1, 0))
    after = ranked.select(
        F.when(F.col("rank") == 0, last).otherwise(F.col("rank") - 1).alias("rank"),
        F.col("key").alias("next_key"))
    before = ranked.select(
        F.when(F.col("rank") == last, F.lit(0)).otherwise(F.col("rank") + 1).cast("bigint").alias("rank"),
        F.col("key").alias("next_of"), F.col("n").alias("next_of_n"))
    return ranked.join(after, "rank").join(before, "rank").select(
        "key", "copies", "n", "next_key", "next_of", "next_of_n")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Sketches of every text and of its edited text.

    In the edited text, the last half of the code points (rounded down) is replaced by the first
    as many (or all) of the next document in order of descending doc_id.

    The texts are shuffled once. Each then sends the front of itself and its sketch (by the lower
    32 bits of its hashes), which the document before it needs, to that document.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    order = written(next_rows(rows), "order")
    # One struct, so that both uses need the same columns and share one shuffle. Sketches are made
    # after it, as they are about as large as the texts.
    once = rows.groupBy("key").agg(F.first(F.struct("doc_id", "text")).alias("row"))
    own = with_sketch(once.join(order, "key").select("*", "row.*").drop("row"))
    half = F.floor(F.col("next_of_n") / 2).cast("int")
    sent = own.select(
        F.col("next_of").alias("key"), F.substr(F.col("text"), F.lit(1), half).alias("front"),
        shortened(F.col("sketch")).alias("next_sketch"))
    # Of several copies of a row, all but the last are followed by a copy.
    half = F.floor(F.col("n") / 2).cast("int")
    copy = F.substr(F.col("text"), F.lit(1), half)
    steps = F.array(F.struct(F.lit(1).cast("bigint").alias("times"), F.col("front").alias("front"),
                             F.col("next_sketch").alias("other")),
                    F.struct((F.col("copies") - 1).alias("times"), copy.alias("front"),
                             shortened(F.col("sketch")).alias("other")))
    both = own.join(sent, "key").withColumn("step", F.explode(F.filter(steps, lambda s: s["times"] > 0)))
    kept = F.substr(F.col("text"), F.lit(1), (F.col("n") - half).cast("int"))
    both = both.select("doc_id", "n", "sketch", "step.times", "step.other",
                       F.concat(kept, F.col("step.front")).alias("edited"))
    both = with_sketch(both, "edited", "edited_sketch")
    out = both.select(
        "doc_id", F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(shortened(F.col("sketch")), F.col("other")).alias("near_next"), "times",
    )
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).drop("times")
