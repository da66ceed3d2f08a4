"""Language, quality and toxicity models: held-out accuracy and awkward rows."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from hourgrid.llm import language_id, linear, quality_pu, toxicity_chain
from hourgrid.llm.frames import table
from hourgrid.llm.queries import queries
from tests.llm.helpers import LONG, awkward, empty


def test_language_of_held_out_rows(spark, sf_dir):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents", "doc_id", "lang").collect()}
    found = queries()["op4_language_id"](spark, sf_dir).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(truth) and len(held) > 20
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    model = language_id.train(docs, per_language=10, epochs=1)
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == docs.count() and 9_007_199_254_740_993 in {r["doc_id"] for r in rows}
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 7)} == {"und"}
    kept = language_id.keep_known(docs, model, 0.0)
    assert kept.schema == docs.schema and kept.count() == docs.count() - 4
    assert language_id.identify(empty(spark), model).count() == 0
    nothing = language_id.train(empty(spark))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


@pytest.mark.parametrize("piece", [3, 64, 1000])
def test_pieces_count_like_the_whole(monkeypatch, piece):
    text = "Ein  langer Text, 12 mal ÄÖÜ…\n\nund weiter " * 30
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", piece)
    assert (language_id.gram_counts(text) == whole).all()


def test_training_vectors_are_made_a_few_texts_at_a_time(spark, monkeypatch):
    """The counts of a text are as wide as the model: a batch of them took half a gigabyte of a worker."""
    frame, made = type(spark.range(0)), {}
    true = frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda df, f, schema: (made.setdefault(f.__name__, f), true(df, f, schema))[1])
    texts = [f"text number {k} about {'abcdefghij'[k % 10] * 3} things" for k in range(300)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    language_id.train(docs, epochs=1)
    batch = pd.DataFrame({"place": range(300), "shard": 0, "y": 0, "text": [*texts[:298], "12", ""], "fit": True})
    tracemalloc.start()
    try:
        out = list(made["features"](iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()
    rows = pd.concat(out)
    assert rows["place"].tolist() == list(range(298))
    for text, idx, val in zip(texts, rows["idx"], rows["val"], strict=False):
        assert idx.tolist() == np.flatnonzero(language_id.gram_counts(text)).tolist()
        assert (val * val).sum() == pytest.approx(1.0, abs=1e-5)


def test_quality_of_held_out_rows(spark, sf_dir):
    label = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels", "doc_id", "quality").collect()}
    rows = [r for r in queries()["op7_quality_pu"](spark, sf_dir).collect() if r["held_out"]]
    good = [r["score"] for r in rows if label.get(r["doc_id"]) == 1]
    bad = [r["score"] for r in rows if label.get(r["doc_id"]) == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_toxicity_query_on_held_out_rows(spark, sf_dir):
    label = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels", "doc_id", "toxic").collect()}
    found = queries()["op8_toxicity_chain"](spark, sf_dir)
    rows = found.collect()
    assert len(rows) == table(spark, sf_dir, "documents").count() and {"doc_id", "held_out", "predicted"} <= set(found.columns)
    held = [r for r in rows if r["held_out"] and label.get(r["doc_id"]) is not None]
    assert held and np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.9


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (8, 1), (3, 0), (None, 1), (6, None)], "doc_id long, quality int")
    rows = quality_pu.score_quality(docs, quality_pu.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    model = quality_pu.train(empty(spark), labels.where("false"))
    assert {r["score"] for r in quality_pu.score_quality(docs, model).collect()} == {0.5}
    assert quality_pu.score_quality(empty(spark), model).count() == 0


def test_prior_is_the_share_of_positives():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(3, 1, 6000), rng.normal(-3, 1, 2000)
    assert quality_pu.estimate_prior(good[:3000], np.concatenate([good[3000:], bad])) == pytest.approx(0.6, abs=0.05)


@pytest.fixture
def insults(spark):
    rng = random.Random(1)
    marks = [w for words in toxicity_chain.CATEGORIES.values() for w in words]
    rows, labels = [], []
    for k in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        toxic = k % 4 == 0
        if toxic:
            words[5:5] = rng.sample(marks[:6], 3)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_chain_finds_toxic_rows_it_did_not_see(insults):
    docs, labels = insults
    chain = toxicity_chain.train(docs.where("doc_id % 5 != 0"), labels.where("doc_id % 5 != 0"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity_chain.score_toxicity(docs, chain).collect() if r["doc_id"] % 5 == 0]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows]) > 0.95
    assert np.mean([r["p_insult"] > 0.5 for r in rows if truth[r["doc_id"]]]) > 0.7


def test_chain_takes_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int")
    rows = toxicity_chain.score_toxicity(docs, toxicity_chain.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    blank = toxicity_chain.train(docs, labels.where("false"))
    assert {r["score"] for r in toxicity_chain.score_toxicity(docs, blank).collect()} == {0.5}
    assert toxicity_chain.score_toxicity(empty(spark), blank).count() == 0
    assert len(toxicity_chain.features(LONG)) < 40


def test_l1_penalty_leaves_unused_coordinates_at_zero():
    model = linear.Ftrl(4, 2, True, l1=0.5)
    for k in range(60):
        model.update(np.array([k % 2]), np.ones(1, np.float32), np.eye(2, dtype=np.float32)[k % 2])
    w = model.dense()
    assert (w[2:4] == 0).all() and w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0
