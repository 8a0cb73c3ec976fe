"""Documents that repeat benchmark items, also with other numbers, names or units.

A text becomes a template: words in lower case, and typed placeholders for its slots.

- number: a token with a digit, or a number word;
- unit: a unit word that follows a number;
- name: a capitalised word. Neighbouring names are one slot. What begins a sentence may be a name
  or not, so each text has two readings: in the first it is a word, in the second a name. Windows
  of one reading meet those of the same reading. (What a word is must not depend on the rest of
  the text, or a passage would read differently inside a document.)

Windows of five template tokens are evidence. Those with fewer than three words count with the
values of their slots, so they are met by exact copies only (their hashes are odd, the others
even). The windows of the items
set bits in a table of fixed size, which lets the tasks that read the documents pass on only
windows that may match; these are joined on their hash. Matches of a document and an item that
keep the same distance lie on one diagonal, and a diagonal counts if its slots are consistent:
equal values in the item have equal values in the document, on the diagonal and on the longest
one of the two texts. A document repeats an item if the diagonals that count cover COVER of the
item's windows, or of its windows with three words, in one reading or in both together.

Defined cases: null texts and texts without tokens have no windows. Fewer than five tokens: the
whole text is the one window, exact unless it has as many words as tokens up to three; such an
item is found as a whole text, not inside a longer one. Rows that repeat an item_id are alternatives of it; the
best covered counts. Rows with equal doc_id and text give one result; a null doc_id is kept as
null. Extra columns are ignored by `repeats` and kept by `clean`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.filters import in_filter, key_filter, without
from starloom.llm.registry import fresh
from starloom.llm.shingles import _STEP, BLOCK, _pieces, blocks, mixed
from starloom.llm.tokens import FIRST, INSIDE, NUMBER, tokens
from starloom.session import written

WIDTH, WORDS, COVER = 5, 3, 0.8
FILTER_BITS = 22

# Words that stand for numbers and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion half dozen twice thrice"
).split()
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards yd mile miles mi g kg mg gram grams "
    "kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne tonnes ml l liter "
    "liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years percent degree degrees dollar dollars cent "
    "cents euro euros eur usd kph mph kmh hz khz mhz ghz w kw kwh v kv a j kj cal kcal pa kpa bar"
).split()
READINGS = WORD_FIRST, NAME_FIRST = 0, 1

NUM, UNIT, NAME = (mixed(np.array([k], np.uint64))[0] for k in (1, 2, 3))


def _hash_list(words) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return np.sort(tokens(raw, np.zeros(1, np.int64)).hashes)


_NUMBERS, _UNITS = map(_hash_list, (NUMBER_WORDS, UNITS))


def template(text: np.ndarray, hashes: np.ndarray, kind: np.ndarray, reading: int):
    """Template tokens: first own token, text number, hash, slot value (0 for a word). `text` rises."""
    number = (kind == NUMBER) | np.isin(hashes, _NUMBERS)
    unit = np.zeros(len(hashes), bool)
    unit[1:] = number[:-1] & (text[1:] == text[:-1]) & np.isin(hashes[1:], _UNITS)
    name = ((kind == INSIDE) | ((kind == FIRST) & (reading == NAME_FIRST))) & ~number & ~unit
    again = np.zeros(len(hashes), bool)
    again[1:] = name[1:] & name[:-1] & (text[1:] == text[:-1])
    keep = np.flatnonzero(~again)
    value = np.where(number | unit | name, hashes | np.uint64(1), np.uint64(0))
    value = np.add.reduceat(value, keep) if len(keep) else value
    token = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, hashes)))[keep]
    return keep, text[keep], token, value


def windows(texts: pa.Array, reading: int = WORD_FIRST):
    """(row, place, hash, slot values by place in the window) of the evidence of each text.

    Exact windows have odd hashes and no slots.
    """
    for _, row, place, _, window, slots in _read(texts, (reading,)):
        yield row, place, window, slots


def _read(texts: pa.Array, readings=READINGS):
    """(reading, row, place, spot, hash, slot values); places count template tokens, and spots the
    tokens before the window, whatever the reading."""
    for first, last, offsets, raw in blocks(texts):
        if last == first + 1 and len(raw) > BLOCK:
            parts, fresh = [], True
            for piece in _pieces(raw):
                t = tokens(piece, np.zeros(1, np.int64), fresh)
                fresh = t.ended
                parts.append((t.hashes, t.kinds))
            hashes, kind = (np.concatenate(x) for x in zip(*parts))
            text = np.zeros(len(hashes), np.int64)
        else:
            t = tokens(raw, offsets[:-1])
            hashes, kind = t.hashes, t.kinds
            text = np.searchsorted(offsets, t.starts, "right") - 1
        own_begin = np.searchsorted(text, np.arange(last - first + 1))
        for reading in readings:
            at, of, token, value = template(text, hashes, kind, reading)
            for row, place, window, slots in _evident(of, token, value, last - first, reading):
                begin = np.searchsorted(of, row)
                yield reading, first + row, place, at[begin + place] - own_begin[row], window, slots


def _evident(text: np.ndarray, token: np.ndarray, value: np.ndarray, count: int, reading: int):
    """(text number, place, hash, slot values) of the windows of `count` texts."""
    one, salt = np.uint64(1), np.uint64(reading << 8)
    own = np.where(value == 0, token, mixed(token ^ value))
    begin = np.searchsorted(text, np.arange(count + 1))
    size = np.diff(begin)
    if len(token) >= WIDTH:
        h = np.zeros(len(token) - WIDTH + 1, np.uint64)
        as_is, words = np.zeros_like(h), np.zeros(len(h), np.int64)
        for k in range(WIDTH):
            h += token[k:len(h) + k] * _STEP[k]
            as_is += own[k:len(h) + k] * _STEP[k]
            words += value[k:len(h) + k] == 0
        at = np.flatnonzero(text[: len(h)] == text[WIDTH - 1:])
        if len(at):
            exact = words[at] < WORDS
            slots = np.stack([value[at + k] for k in range(WIDTH)], axis=1)
            slots[exact] = 0
            found = mixed(np.where(exact, as_is[at], h[at]) + np.uint64(WIDTH) + salt)
            yield text[at], at - begin[text[at]], np.where(exact, found | one, found & ~one), slots
    for row in np.flatnonzero((size > 0) & (size < WIDTH)):
        t, v = token[begin[row]:begin[row + 1]], value[begin[row]:begin[row + 1]]
        exact = (v == 0).sum() < min(WORDS, len(v))
        t = own[begin[row]:begin[row + 1]] if exact else t
        h = np.uint64(len(t)) + (t * _STEP[:len(t)]).sum(dtype=np.uint64)
        slots = np.zeros((1, WIDTH), np.uint64)
        if not exact:
            slots[0, :len(v)] = v
        found = mixed(np.array([h + salt]))
        yield np.array([row]), np.zeros(1, np.int64), found | one if exact else found & ~one, slots


SCHEMA = "row bigint, key bigint, reading int, place int, spot int, window bigint, slots array<bigint>"


def _evidence(rows: DataFrame, held: np.ndarray | None = None) -> DataFrame:
    """Windows of (row, key, text) in both readings; only those that the filter may hold."""
    shared = None if held is None else rows.sparkSession.sparkContext.broadcast(held)

    def find(batches):
        for batch in batches:
            for reading, row, place, spot, window, slots in _read(batch.column(2)):
                if shared is not None:
                    hit = in_filter(shared.value, window.view(np.int64), FILTER_BITS)
                    row, place, spot, window, slots = (x[hit] for x in (row, place, spot, window, slots))
                if len(row):
                    at = pa.array(row)
                    lists = pa.FixedSizeListArray.from_arrays(
                        pa.array(slots.ravel().view(np.int64)), WIDTH).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at),
                         pa.array(np.full(len(row), reading), pa.int32()), pa.array(place, pa.int32()),
                         pa.array(spot, pa.int32()), pa.array(window.view(np.int64)), lists],
                        ["row", "key", "reading", "place", "spot", "window", "slots"],
                    )

    return rows.mapInArrow(find, SCHEMA)


def _counts(places: DataFrame, keys: list[str], *more) -> DataFrame:
    """`counts` by keys: of all spots and of those with three words, in either reading, and in
    each. `places` has keys, spot, reading and exact."""
    exact = [F.min("exact"), *[F.min(F.when(F.col("reading") == r, F.col("exact"))) for r in READINGS]]
    spots = places.groupBy(*keys, "spot").agg(*[e.alias(f"e{k}") for k, e in enumerate(exact)], *more)
    each = [F.count_if(x) for k in range(len(exact)) for x in (F.col(f"e{k}").isNotNull(), F.col(f"e{k}") == 0)]
    return spots.groupBy(*keys).agg(F.array(*each).alias("counts"), *more)


def repeats(docs: DataFrame, items: DataFrame, cover: float = COVER) -> DataFrame:
    """(doc_id, text_key, item_id, windows, covered, coverage, changed_slots) of what repeats.

    `docs` has doc_id and text, `items` has item_id and text; ids are longs.
    """
    key = F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")
    bench = _evidence(items.select(F.col("item_id").cast("bigint").alias("row"), key, "text"))
    bench = bench.distinct().withColumn("exact", F.col("window").bitwiseAND(F.lit(1)))
    bench = written(bench.withColumnsRenamed({"row": "item_id", "key": "item_key"}), "evidence")
    held = key_filter(bench.select("window"), FILTER_BITS)
    hits = _evidence(docs.select(F.col("doc_id").cast("bigint").alias("row"), key, "text"), held)
    hits = hits.select(
        F.col("row").alias("doc_id"), F.col("key").alias("text_key"), "place", "window", "slots")
    ours = bench.select("item_id", "item_key", "reading", F.col("place").alias("at"), "spot", "window",
                        F.col("slots").alias("was"), "exact")
    slot = F.filter(F.arrays_zip("was", "slots"), lambda s: s["was"] != 0)
    met = hits.join(ours, "window").select(
        "doc_id", "text_key", "item_id", "item_key", "reading", (F.col("place") - F.col("at")).alias("diagonal"),
        "spot", "exact", slot.alias("slot"),
    )
    keys = ["doc_id", "text_key", "item_id", "item_key"]
    # At most the windows of one item meet in a group.
    lines = met.groupBy(*keys, "reading", "diagonal").agg(
        F.collect_set(F.struct("spot", "exact")).alias("at"),
        F.array_distinct(F.flatten(F.collect_set("slot"))).alias("slot"))
    changed = F.size(F.filter("slot", lambda s: s["was"] != s["slots"]))
    lines = written(lines.where(_one_value("slot")).withColumn("changed", changed), "lines")
    # The longest line of a document and an item says what their slots are. A document that holds
    # the item twice, in two forms, has two lines of its own length, and the first one counts.
    longest = lines.groupBy(*keys).agg(
        F.max(F.struct(F.size("at"), -F.col("reading"), -F.col("diagonal"), "slot"))["slot"].alias("said"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    lines = lines.alias("l").join(longest.alias("m"), same).select("l.*", F.array_union("slot", "said").alias("said"))
    places = lines.where(_one_value("said")).select(*keys, "reading", F.explode("at").alias("at"), "changed")
    places = places.select(*keys, "reading", "at.*", "changed")
    found = _counts(places, keys, F.max("changed").alias("changed"))
    sizes = _counts(bench.select("item_id", "item_key", "reading", "spot", "exact"), ["item_id", "item_key"])
    both = found.alias("f").join(sizes.alias("s"), [
        F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ("item_id", "item_key")])
    way = F.explode(F.arrays_zip(F.col("s.counts").alias("windows"), F.col("f.counts").alias("covered")))
    both = both.select(*[f"f.{k}" for k in keys], F.col("changed").cast("bigint").alias("changed_slots"), way.alias("way"))
    both = both.select(*keys, "changed_slots", F.col("way.windows"), F.col("way.covered")).where("windows > 0")
    both = both.withColumn(
        "coverage", F.col("covered") / F.col("windows")).where(F.col("coverage") >= F.lit(cover))
    best = F.max(F.struct("coverage", "windows", "covered", -F.col("changed_slots"))).alias("b")
    return both.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id", "text_key", "item_id", "b.windows", "b.covered", "b.coverage",
        (-F.col("b.col4")).alias("changed_slots"))


def _one_value(slots: str) -> Column:
    """Whether each value of the item has one value in the document."""
    return F.size(F.array_distinct(F.transform(slots, lambda s: s["was"]))) == F.size(slots)


def clean(docs: DataFrame, items: DataFrame, cover: float = COVER) -> DataFrame:
    """The documents that repeat no item."""
    key = fresh("text_key", docs.columns)
    found = written(repeats(docs, items, cover).select(F.col("text_key").alias(key)).distinct(), "repeats")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    return without(keyed, key, found).select(*docs.columns)
