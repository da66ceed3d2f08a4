import re
from collections import defaultdict

import pytest

from hourgrid.llm import source_mix
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The rule as a plain loop: deal, stop at the limit, deal the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    got, left = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    open_ = set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        step = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            got[s] += step[s]
            if got[s] >= most * sizes[s] - 1e-9:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_words_taken(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    rows = {r["doc_id"]: r for r in docs.collect()}
    sizes = defaultdict(int)
    for r in rows.values():
        sizes[r["source"]] += words(r["text"])
    want = targets(sizes)
    mixed = source_mix.mix_sources(docs).collect()
    assert len(mixed) == len(rows)
    taken = defaultdict(int)
    for r in mixed:
        source = rows[r["doc_id"]]["source"]
        assert r["size"] == words(rows[r["doc_id"]]["text"])
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source] += r["taken"]
    # Ten documents a source here: whole documents come no nearer than half the largest one.
    largest = {s: max(r["size"] for r in mixed if rows[r["doc_id"]]["source"] == s) for s in want}
    assert all(abs(want[s] - taken[s]) <= largest[s] / 2 for s in want)
    assert abs(sum(want.values()) - sum(taken.values())) <= 0.03 * sum(want.values())
    again = source_mix.mix_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, again))


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    mixed = source_mix.mix_sources(docs).collect()
    assert len(mixed) == docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    assert [r["size"] for r in mixed if r["doc_id"] in (3, 4, 5)] == [0, 0, 0]
    assert 9_007_199_254_740_993 in {r["doc_id"] for r in mixed}
    assert source_mix.mix_sources(empty(spark)).count() == 0


def test_words_outside_ascii_white_space(spark):
    docs = spark.createDataFrame([(1, "a b c\x1cd\te\n")], "doc_id long, text string").withColumn("source", source_mix.F.lit("s"))
    assert source_mix.mix_sources(docs).first()["size"] == 3


def test_unequal_weights_shift_the_chance(spark):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "'w w w' AS text", "CASE WHEN id < 2000 THEN 'a' ELSE 'b' END AS source", "1 + id % 2 * 2 AS weight"
    )
    mixed = source_mix.mix_sources(docs, weights=(1, 3), share=0.4, weight_col="weight").collect()
    light = sum(r["copies"] for r in mixed if r["doc_id"] < 2000 and r["doc_id"] % 2 == 0)
    heavy = sum(r["copies"] for r in mixed if r["doc_id"] < 2000 and r["doc_id"] % 2 == 1)
    assert heavy > 2 * light > 0
    assert abs(light + heavy - 400) <= 1


def test_ids_of_any_type_and_rows_without_one(spark):
    rows = [(f"id{i}", f"word {i} " * (i % 5 + 1), "a") for i in range(60)] + [(None, f"nameless {i} text", "a") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    one, two = (source_mix.mix_sources(d).select("doc_id", "size", "taken").collect() for d in (docs, docs.repartition(5)))
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 100
    # Rows without an id do not share one luck: some are taken once, some twice.
    assert len({r["taken"] for r in one if r["doc_id"] is None}) > 1
