"""Template decontamination: planted items in changed forms, against a plain reading."""

import re

import pyarrow as pa

from starloom.llm.decontaminate import clean, repeats, windows
from starloom.llm import decontaminate, shingles

ITEM = ("Yesterday Alice bought 12 apples for 3 dollars each at the market near the river. "
        "How much did Alice pay for all 12 apples if the seller gave back 5 dollars?")
CHANGED = (ITEM.replace("Alice", "Bob").replace("12", "45").replace("dollars", "euros"))
BROKEN = ITEM.replace("Alice", "Bob", 1).replace("Alice", "Carl").replace("12", "45", 1)
FILL = "some other words that stand in front of what was copied from elsewhere and go on. "


def docs_of(spark, texts):
    rows = [(k, t, "en", "extra") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, item_id string")


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def test_changed_slots_are_caught(spark):
    texts = [FILL + ITEM, FILL + CHANGED + " " + FILL, FILL + BROKEN, FILL * 3, ITEM.upper(),
             ITEM.replace(" ", " \n\t"), " ".join(ITEM.split()[:12]), None, "", "12 12 12 12 12 12"]
    found = repeats(docs_of(spark, texts), items_of(spark, [ITEM, "1 2 3 4 5 6", None, "", "what is it"]))
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert {(0, 0), (1, 0)} <= set(got)
    assert (2, 0) not in got and (3, 0) not in got and (6, 0) not in got
    assert got[0, 0].changed_slots == 0 and got[1, 0].changed_slots > 0
    assert {k for k, _ in got} <= {0, 1, 5}
    kept = clean(docs_of(spark, texts), items_of(spark, [ITEM]))
    assert kept.columns == ["doc_id", "text", "lang", "item_id"]
    assert {2, 3, 6, 7, 8, 9} <= {r.doc_id for r in kept.collect()}
    assert not {0, 1} & {r.doc_id for r in kept.collect()}


def test_copies_ties_and_empty_tables(spark):
    docs = docs_of(spark, [FILL + ITEM] * 3 + [FILL])
    docs = docs.union(docs)
    items = items_of(spark, [ITEM, ITEM]).union(items_of(spark, [ITEM]))
    got = sorted((r.doc_id, r.item_id) for r in repeats(docs, items).collect())
    assert got == [(d, i) for d in range(3) for i in range(2)]
    assert [r.doc_id for r in clean(docs, items).collect()] == [3, 3]
    assert repeats(docs.limit(0), items).collect() == []
    assert repeats(docs, items.limit(0)).collect() == []
    assert clean(docs, items.limit(0)).count() == 8
    null_id = docs.selectExpr("cast(null as bigint) AS doc_id", "text")
    assert {(r.doc_id, r.item_id) for r in repeats(null_id, items).collect()} == {(None, 0), (None, 1)}


def test_short_items_match_whole_texts_only(spark):
    found = repeats(docs_of(spark, ["Who wrote it?", FILL + "Who wrote it?"]), items_of(spark, ["who wrote it"]))
    assert [r.doc_id for r in found.collect()] == [0]


def test_items_of_slots_are_found_as_exact_copies(spark):
    items = ["Compute 12, 7, 3 and 45 plus 9", "3 1 4 1 5 9 2 6", "7 8"]
    texts = [FILL + items[0] + ". " + FILL, FILL + items[1] + " " + FILL, "7 8", FILL,
             FILL + items[0].replace("12", "13").replace("45", "44"), FILL + "3 1 4 2 5 9 2 7", "7 9"]
    found = repeats(docs_of(spark, texts), items_of(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 0), (1, 1), (2, 2)]
    assert all(r.coverage == 1 and r.changed_slots == 0 for r in found)


def test_first_word_of_an_item_inside_a_sentence(spark):
    item = "What is the capital of that"
    texts = [f"some 12) {item}", f'and he said, "{item}"', FILL + item, FILL, "others ask the capital of that"]
    found = repeats(docs_of(spark, texts), items_of(spark, [item])).collect()
    assert sorted(r.doc_id for r in found) == [0, 1, 2]
    assert all(r.covered == r.windows == 2 for r in found)


def test_names_that_no_list_has(spark):
    item = "Zoran bakes 12 loaves every morning. How many loaves does Zoran bake in 3 weeks of such work?"
    other = item.replace("Zoran", "Priya").replace("12", "36").replace("3 weeks", "9 weeks")
    mixed = item.replace("Zoran", "Priya", 1)
    two_words = item.replace("Zoran", "Mary Ann")
    texts = [FILL + other + " " + FILL, FILL + mixed, FILL + two_words, "They say: " + other, FILL, item.replace("Zoran", "He")]
    found = {r.doc_id: r for r in repeats(docs_of(spark, texts), items_of(spark, [item])).collect()}
    assert {0, 2, 3} <= set(found) and 4 not in found
    assert found[0].changed_slots == 3 and found[0].coverage == 1
    assert found[1].coverage < 1  # two values of one name: only as a copy with another first word


def test_slots_agree_over_all_lines(spark):
    one = "When {} sends a parcel of old books to {} by the slow train in spring"
    two = "{} waits a whole month before the answer of {} comes back over hill and sea"
    item = one.format("Anna", "Bob") + ", and then " + two.format("Anna", "Bob")
    same = one.format("Tom", "Ben") + ", and so then " + two.format("Tom", "Ben")
    other = one.format("Tom", "Ben") + ", and so then " + two.format("Kate", "Rose")
    found = repeats(docs_of(spark, [same, other, FILL]), items_of(spark, [item]), cover=0.7)
    assert [r.doc_id for r in found.collect()] == [0]


def test_null_ids_of_items(spark):
    items = spark.createDataFrame([(None, ITEM)], "item_id bigint, text string")
    found = repeats(docs_of(spark, [CHANGED, FILL]), items).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(0, None)]


def test_pieces_of_long_texts_read_alike(monkeypatch):
    text = (FILL + CHANGED + "\n" + "É" * 9 + " Ünd Ört. ") * 40

    def read():
        out = []
        for row, place, h, slots in windows(pa.array(["a b", text, None])):
            out += list(zip(row.tolist(), place.tolist(), h.tolist(), slots.tolist()))
        return sorted(out)

    whole = read()
    for module in (shingles, decontaminate):
        monkeypatch.setattr(module, "BLOCK", 500)
    assert read() == whole


def test_query_finds_every_whole_item(spark):
    from starloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    word = re.compile(r"[^\W_]+")

    def plain(text):
        return " " + " ".join(w.lower() for w in word.findall(text or "")) + " "

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if plain(i.text) in plain(d.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op1_decontaminate_templates"](spark, sf_dir).collect()}
    assert got == want and want


def test_clean_keeps_columns_of_any_name(spark):
    item = "How many loaves does the old baker sell on a long summer morning in town"
    docs = spark.createDataFrame([(1, "a quite different text", "mine"), (2, item, "mine")],
                                 "doc_id bigint, text string, text_key string")
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert [tuple(r) for r in clean(docs, items).collect()] == [(1, "a quite different text", "mine")]
