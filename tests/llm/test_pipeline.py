"""The stages together, against brute force on the smallest tables."""

import re

import corpus_pipeline
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty
from tests.llm.test_jaccard_join import brute


def test_pipeline_keeps_what_brute_force_keeps(spark, sf_dir):
    rows = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    items = [r["text"] for r in table(spark, sf_dir, "benchmark").collect()]
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    first = {}
    for i in sorted(rows):
        if re.search(r"[^\W\d_]", rows[i]):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i]), i)
    kept = [(i, rows[i]) for i in first.values()]
    classes = {i: c for i, c, _ in brute(kept)}
    left = {i for i, t in kept if classes[i] == i and not any(plain(b) in plain(t) for b in items)}
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in result} == left
    assert sum(r["taken"] for r in result) == sum(r["copies"] * r["size"] for r in result) > 0


def test_stages_keep_the_columns_and_take_awkward_rows(spark, sf_dir):
    docs = awkward(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, docs, sf_dir)
        assert after.schema.names == docs.schema.names
        docs = after
    assert {r["doc_id"] for r in docs.collect()} >= {1, 6, 8}
    assert corpus_pipeline.mix_to_weights(spark, docs, sf_dir).count() == docs.count()
    nothing = empty(spark)
    for _, function in corpus_pipeline.STAGES:
        nothing = function(spark, nothing, sf_dir)
    assert nothing.count() == 0
