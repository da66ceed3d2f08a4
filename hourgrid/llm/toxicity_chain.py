"""Toxicity of whole texts by a chain of linear classifiers.

The categories are predicted in a fixed order. Each model is a sparse logistic
regression on the words of the text, the four-letter beginnings of longer words,
and the probabilities of the categories before it. While training, those
probabilities come from models that did not see the row (out-of-fold), so a
later model does not learn to trust an overfitted earlier one.

The labels say only whether a text is toxic. The earlier categories are told
apart inside the toxic rows by seed words (``CATEGORIES``); the last link predicts
the label itself, in any language that the labelled rows hold.

Bounded: the training sample (``SAMPLE`` labelled rows) and the models
(buckets x categories). All texts are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm import linear
from hourgrid.llm.frames import computed, objects, stage, unit_hash
from hourgrid.session import release

# Seed words of the earlier categories.
CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "stupid", "clown", "fool", "dumb", "loser"),
    "contempt": ("pathetic", "worthless", "disgusting", "useless", "hateful"),
    "dehumanising": ("scum", "trash", "vermin", "filth", "garbage", "animal"),
}
LAST = "toxic"
BUCKETS = 1 << 17
SAMPLE = 10_000
FOLDS = 3
EPOCHS = 3
SHARDS = 4
PREFIX = 4
CACHE = 100_000

_WORD = re.compile(r"[^\W_]+")
_cache: dict[str, tuple[int, ...]] = {}


def _buckets(word: str) -> tuple[int, ...]:
    found = _cache.get(word)
    if found is None:
        if len(_cache) >= CACHE:
            _cache.clear()
        found = (zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS,)
        if len(word) > PREFIX:
            found += (zlib.crc32(b"^" + word[:PREFIX].encode("utf-8", "surrogatepass")) % BUCKETS,)
        _cache[word] = found
    return found


def features(text: str | None) -> np.ndarray:
    """The sorted buckets that a text switches on; none for NULL and for texts without a word."""
    on = {b for w in set(_WORD.findall((text or "").lower())) for b in _buckets(w)}
    return np.fromiter(sorted(on), np.int64, len(on))


@dataclass
class Chain:
    names: list[str]
    weights: np.ndarray

    def score(self, text: str | None) -> list[float]:
        idx, p = features(text), []
        sums = self.weights[idx].sum(axis=0) + self.weights[-1]
        for k in range(len(self.names)):
            total = sums[k] + sum(q * self.weights[BUCKETS + j, k] for j, q in enumerate(p))
            p.append(float(linear.probabilities(np.float64(total), False)))
        return p


def train(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "toxic",
    categories: dict[str, tuple[str, ...]] | None = None,
    sample: int = SAMPLE,
) -> Chain:
    """Fit the chain on at most about ``sample`` rows of ``labels`` that have a document.

    A label of NULL is no label; an id labelled twice counts as toxic if any
    label says so. Without a usable label every probability is one half.
    """
    categories = CATEGORIES if categories is None else categories
    names = [*categories, LAST]
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    labels = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_toxic"))
    share = min(1.0, sample / max(1, labels.count()))
    drawn = labels.where(unit_hash(F.lit("toxicity"), F.col("_id")) < share)
    # The sample is bounded by the parameter, so it may be sent to every task.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "_id")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int")
    dealt = linear.dealt_to_shards(rows, "_id", SHARDS).select("place", "shard", fold.alias("fold"), "text", "_toxic")
    seeds = [frozenset(words) for words in categories.values()]

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [set(_WORD.findall((t or "").lower())) for t in batch["text"]]
            ys = [
                [float(bool(toxic and words_ & seed)) for seed in seeds] + [float(bool(toxic))]
                for words_, toxic in zip(words, batch["_toxic"], strict=True)
            ]
            idx = [features(t).astype(np.int32) for t in batch["text"]]
            out = batch[["place", "shard", "fold"]]
            val = [np.ones(len(i), np.float32) for i in idx]
            yield out.assign(ys=objects(ys).values, idx=objects(idx).values, val=objects(val).values)

    layout = "place long, shard int, fold int, ys array<float>, idx array<int>, val array<float>"
    rows = stage(dealt.mapInPandas(prepare, layout))
    # Common words are noise of about the square root of their rows; the penalty follows it.
    penalty = 0.03 * np.sqrt(rows.count())
    weights = np.zeros((BUCKETS + len(names) + 1, len(names)), np.float32)
    for k in range(len(names)):
        model = linear.Ftrl(BUCKETS + len(names), 1, False, alpha=0.5, l1=float(penalty), l2=0.01)
        fitted = linear.fit(rows.withColumn("y", F.col("ys")[k]), model, EPOCHS, SHARDS, folds=FOLDS)
        weights[:, k] = fitted[0][:, 0]
        if k + 1 < len(names):
            old, rows = rows, stage(_with_out_of_fold(rows, [w[:, 0] for w in fitted[1:]], BUCKETS + k, layout))
            release(old)
    release(rows)
    return Chain(names, weights)


def _with_out_of_fold(rows: DataFrame, models: list[np.ndarray], place: int, layout: str) -> DataFrame:
    """Add the probability from the model that did not see the row, as feature ``place``."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            idx, val = [], []
            for i, v, f in zip(batch["idx"], batch["val"], batch["fold"], strict=True):
                w = sent.value[f]
                p = linear.probabilities((np.asarray(v) * w[np.asarray(i)]).sum() + w[-1], False)
                idx.append(np.append(i, place).astype(np.int32))
                val.append(np.append(v, p).astype(np.float32))
            yield batch.assign(idx=objects(idx).values, val=objects(val).values)

    return rows.mapInPandas(run, layout)


def score_toxicity(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``p_<category>`` columns, ``score`` and ``predicted`` in place of the text.

    ``score`` is the last link's probability, ``predicted`` 1 from ``threshold`` on. A
    NULL or empty text has no features and gets the base rates. Equal texts get
    equal scores; clashing names are replaced; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{n}" for n in chain.names[:-1]] + ["score"]

    def run(texts: list[str | None]) -> list[list]:
        rows = [sent.value.score(t) for t in texts]
        return [[r[k] for r in rows] for k in range(len(names))] + [[int(r[-1] >= threshold) for r in rows]]

    fields = [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField("predicted", T.IntegerType())]
    return computed(docs, [text_col], run, fields, [text_col])
