import re

import pytest

from hourgrid.llm import decontaminate
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty

ITEM = "A train leaves Boston at 40 mph and travels for 3 hours before John Smith boards. How far did John Smith ride on it?"
SAME = "Intro words. A train leaves Denver at 65 kmh and travels for 7 hours before Mary boards. How far did Mary ride on it? The end."
MIXED = "A train leaves Denver at 65 mph and travels for 7 hours before Mary boards. How far did Peter ride on it?"


def leaks(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(docs, bench).collect()}


def test_other_numbers_names_and_units_are_found(spark):
    found = leaks(spark, [ITEM, SAME, "Nothing to see here at all, only a clean text about trains and hours and boards."])
    assert set(found) == {(0, 0), (1, 0)}
    assert not found[0, 0]["reparameterised"] and found[1, 0]["reparameterised"]
    assert found[0, 0]["coverage"] == 1.0


def test_inconsistent_slots_are_no_leak(spark):
    assert leaks(spark, [MIXED]) == {}


APPLES = "Sam has 5 apples. Sam buys 3 more apples. Sam eats 2 apples. How many apples does Sam have?"


@pytest.mark.parametrize("name", ["Mary", "Mary Ann"])
def test_names_at_sentence_starts_are_slots(spark, name):
    found = leaks(spark, [APPLES.replace("Sam", name), APPLES], [APPLES, APPLES.replace("Sam", "Sam Smith")])
    assert set(found) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert found[0, 0]["reparameterised"] and found[1, 0]["coverage"] == 1.0


def test_starts_with_two_values_are_words(spark):
    item = "The red fox ran over the old wooden bridge at night. The dog slept in a warm house near the river, "
    item += "where many small boats were tied up for the winter months and nobody came to look after them."
    found = leaks(spark, [item.replace("The dog", "A dog"), item.replace("night. The", "night, the")], [item])
    assert set(found) == {(0, 0), (1, 0)}


SUM = "What is 12 + 7 - 4 + 9 - 30 + 18 - 5 + 11?"


def test_items_without_literal_windows_match_as_they_are(spark):
    items = [SUM, "Who painted the Mona Lisa?", "Anna has 3 red hats. Why?"]
    texts = [f"Some text. {i} More text." for i in items] + [SUM.replace("30", "31").replace("12", "13"), "Ben has 4 red hats. Why?"]
    found = leaks(spark, texts, items)
    assert set(found) == {(0, 0), (1, 1), (2, 2), (4, 2)}
    assert found[0, 0]["coverage"] == 1.0 and not found[0, 0]["reparameterised"] and found[4, 2]["reparameterised"]


def test_long_excerpts_of_long_items_are_leaks(spark):
    words = [f"{a}{b}" for a in ("bar", "cor", "dul", "fen", "gim", "hol", "jas", "kel") for b in map(lambda i: "x" * i + "y" * (50 - i), range(50))]
    passage = " ".join(words)
    found = leaks(spark, [f"Some text. {' '.join(words[100:250])} ends.", " ".join(words[100:140])], [passage])
    assert set(found) == {(0, 0)} and found[0, 0]["coverage"] < 0.5


def test_short_items_and_shared_starts_are_no_leak(spark):
    assert leaks(spark, ["two words", ITEM[:45]], ["two words", ITEM]) == {}


def test_given_documents_equal_substring_search(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark")
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [(r["item_id"], plain(r["text"])) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in plain(r["text"] or "")}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == want
    clean = decontaminate.drop_leaks(docs, bench)
    assert clean.count() == docs.count() - len({d for d, _ in want})


@pytest.mark.parametrize("text", ["", "word", "1 2 3", "A. B. C.", "John Smith Mary Ann Jones went"])
def test_windows_of_any_text(text):
    starts, hashes, slot, values, prefixes = decontaminate.windows(text)
    assert len(starts) == len(hashes) == len(prefixes) and len(slot) == len(values)


def plain_windows(text):
    """All readings of the windows of eight words, one word after the other."""
    t = decontaminate.template(text)
    found = set()

    def read(at, left, words, values, slots):
        if slots > decontaminate.WINDOW - decontaminate.LITERALS:
            return
        if not left:
            found.add((begin, tuple(words), tuple(values)))
            return
        if at >= len(t.hashed):
            return
        read(at + 1, left - 1, [*words, int(t.hashed[at])], [*values, int(t.values[at])], slots + bool(t.slot[at]))
        if t.soft[at]:
            value, end = int(t.values[at]), at + 1
            if end < len(t.hashed) and t.joined[end]:
                value, end = (value + int(t.values[end]) * int(decontaminate._GOLDEN)) % 2**64, end + 1
            name = int(decontaminate._PLACEHOLDER[decontaminate._CAPITAL])
            read(end, left - 1, [*words, name], [*values, value], slots + 1)

    for begin in range(len(t.hashed)):
        read(begin, decontaminate.WINDOW, [], [], 0)
    return found


@pytest.mark.parametrize("text", [APPLES, SAME, MIXED, APPLES.replace("Sam", "Sam Smith Jones"), "A b. C d. E f. G h. I j. K l. M n."])
def test_windows_are_all_readings(text):
    starts, _, _, values, _ = decontaminate.windows(text)
    want = plain_windows(text)
    kept = [(s[1], tuple(v)) for s, v in zip(starts.tolist(), values.tolist(), strict=True)]
    few = len(kept) - len(want)
    assert sorted((b, v) for b, _, v in want) == sorted(kept[few:])


def test_the_filter_drops_no_match():
    """With the filter of an item, exactly the windows that the item has are left."""
    from hourgrid.llm import bloom

    for item in (ITEM, APPLES, SUM):
        words = decontaminate.template(item)
        _, hashes, _, _, prefixes = decontaminate.windows(item)
        bits = bloom.of_keys([*hashes.tolist(), *prefixes.ravel().tolist(), *words.hashed[~words.slot].view("int64").tolist()])
        for text in (item, SAME, MIXED, APPLES.replace("Sam", "Mary Ann"), f"Then. {item} And more of it."):
            every = decontaminate.windows(text)
            some = decontaminate.windows(text, bits=bits)
            want = sorted((*s, h) for s, h in zip(every[0][:, 1:3].tolist(), every[1].tolist(), strict=True) if h in set(hashes.tolist()))
            assert sorted((*s, h) for s, h in zip(some[0][:, 1:3].tolist(), some[1].tolist(), strict=True)) == want


def test_a_name_inside_a_sentence_matches_one_at_its_start(spark):
    item = "Every Monday Lena Smith sells 12 jars of honey and 7 loaves of dark bread at the market by the old mill."
    text = "Peter sells 30 jars of honey and 9 loaves of dark bread at the market by the old mill."
    found = leaks(spark, [text], [item])
    assert set(found) == {(0, 0)} and found[0, 0]["reparameterised"]


def test_ids_of_any_type_and_shared_ids(spark):
    docs = spark.createDataFrame([("a", ITEM), ("a", "clean text"), ("b", MIXED), (None, SAME), ("c", None)], "doc_id string, text string")
    bench = spark.createDataFrame([("x", ITEM), (None, APPLES)], "item_id string, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == {("a", "x"), (None, "x")}


def test_long_items_repeated_many_times(spark):
    found = leaks(spark, [" ".join([SAME] * 300)], [ITEM, APPLES])
    assert set(found) == {(0, 0)}


def test_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (None, ITEM)], "item_id long, text string")
    docs = awkward(spark)
    assert decontaminate.find_leaks(docs, bench).count() == 0
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert decontaminate.find_leaks(empty(spark), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0
