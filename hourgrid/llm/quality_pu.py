"""Text quality by positive-unlabelled learning.

Trusted good texts are the positives; all other texts are a mixture of good and
bad ones without labels. A logistic model is trained on the non-negative
unbiased risk

    p R(positive, +) + max(0, R(unlabelled, -) - p R(positive, -)),

where p is the share of good texts among the unlabelled ones. p is estimated first:
an ordinary classifier of positives against unlabelled ranks held-back rows, and p
is the smallest upper bound of P(unlabelled above t) / P(positive above t).

Features are bins of whole-text statistics (case, symbols, digits, repeated
words and lines, vocabulary) and hashed word shapes. Bounded: the samples
(``POSITIVES``, ``UNLABELLED``) and the model. All texts are scored whole.
"""

from __future__ import annotations

import math
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

SHAPES = 1 << 12
STATISTICS = 1 << 9
DIM = SHAPES + STATISTICS
POSITIVES = 5_000
UNLABELLED = 5_000
ROUNDS = 4
SHARDS = 4
STEPS = 300
CACHE = 100_000
PIECE = 1 << 20

_kinds: np.ndarray | None = None
_shapes: dict[str, int] = {}


def _kind_of_codes(codes: np.ndarray) -> np.ndarray:
    """0 symbol, 1 lower-case or caseless letter, 2 upper-case letter, 3 digit, 4 white space."""
    global _kinds
    if _kinds is None:
        kinds = (
            4 if c.isspace() else 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 0
            for c in map(chr, range(0x110000))
        )
        _kinds = np.fromiter(kinds, np.uint8, 0x110000)
    return _kinds[codes]


def _shape(word: str) -> int:
    found = _shapes.get(word)
    if found is None:
        if len(_shapes) >= CACHE:
            _shapes.clear()
        shape = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a", word)
        shape = re.sub(r"\d+", "9", shape)[:16]
        found = _shapes[word] = zlib.crc32(shape.encode("utf-8", "surrogatepass")) % SHAPES
    return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Active coordinates and values of a text; NULL counts as empty."""
    text = text or ""
    kinds = np.zeros(5, np.int64)
    for begin in range(0, len(text), PIECE):
        codes = np.frombuffer(text[begin : begin + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds += np.bincount(_kind_of_codes(codes), minlength=5)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, marks = len(words), max(1, int(kinds[:4].sum()))
    size = min(15, int(math.log2(n)) + 1) if n else 0
    repeats = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
    tenth = lambda part, whole: min(10, math.ceil(10 * part / whole)) if whole else 0
    bins = [
        size,
        tenth(kinds[2], max(1, int(kinds[1] + kinds[2]))),
        min(20, math.ceil(40 * int(kinds[0]) / marks)),
        tenth(kinds[3], marks),
        tenth(len(set(words)), n),
        tenth(repeats, n),
        tenth(len(lines) - len(set(lines)), len(lines)),
        min(15, int(marks / n)) if n else 0,
        size // 3 * 11 + tenth(len(set(words)), n),
    ]
    idx = [SHAPES + 32 * k + b for k, b in enumerate(bins[:-1])] + [SHAPES + 32 * 8 + bins[-1]]
    shapes, counts = np.unique(np.fromiter((_shape(w) for w in words), np.int64, n), return_counts=True)
    weight = np.sqrt(counts)
    norm = np.sqrt((weight * weight).sum()) if n else 1.0
    return (
        np.concatenate([np.array(idx, np.int64), shapes]),
        np.concatenate([np.full(len(idx), 0.5), 2.0 * weight / norm]).astype(np.float32),
    )


@dataclass
class QualityModel:
    weights: np.ndarray
    prior: float

    def score(self, text: str | None) -> float:
        idx, val = features(text)
        return float(linear.probabilities(np.float64(self.weights[idx] @ val + self.weights[-1]), False))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of held-back rows.

    Above a high threshold nearly all unlabelled rows are positive, so the ratio of
    the two tails bounds the share; the threshold with the lowest upper
    confidence bound is taken.
    """
    if not len(positive) or not len(unlabelled):
        return 0.5
    positive, unlabelled = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    above_p = 1.0 - np.searchsorted(positive, cuts, "left") / len(positive)
    above_u = 1.0 - np.searchsorted(unlabelled, cuts, "left") / len(unlabelled)
    usable = above_p > 0
    slack = sum(math.sqrt(math.log(4 / confidence) / (2 * len(x))) for x in (positive, unlabelled))
    bound = above_u[usable] / above_p[usable] + 1.01 * slack / above_p[usable]
    best = int(np.argmin(bound))
    return float(np.clip(above_u[usable][best] / above_p[usable][best], 0.02, 0.98))


def train(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> QualityModel:
    """Fit on trusted positives (label 1 in ``labels``) and on unlabelled rows of ``docs``.

    Only the positives' labels are used. The ids draw the samples and are no input
    of a score. Without positives every score is one half.
    """
    trusted = labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    luck = unit_hash(F.lit("quality"), F.col("_id"))
    share_p = min(1.0, positives / max(1, trusted.count()))
    share_u = min(1.0, unlabelled / max(1, docs.count()))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    # The positive sample is bounded by the parameter, so it may be sent to every task.
    good = texts.join(F.broadcast(trusted.where(luck < share_p)), "_id").withColumn("y", F.lit(1))
    any_luck = unit_hash(F.lit("unlabelled"), F.col("_id"))
    other = texts.where(any_luck < share_u).withColumn("y", F.lit(0))
    rows = linear.dealt_to_shards(good.unionByName(other), "_id", SHARDS)
    rows = rows.withColumn("fit", F.pmod(F.xxhash64(F.lit("fit"), "text"), F.lit(4)) != 0)

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [features(t) for t in batch["text"]]
            out = batch[["place", "shard", "y", "fit"]]
            yield out.assign(idx=objects([m[0].astype(np.int32) for m in made]).values, val=objects([m[1] for m in made]).values)

    rows = stage(
        rows.select("place", "shard", "y", "fit", "text").mapInPandas(
            prepare, "place long, shard int, y int, fit boolean, idx array<int>, val array<float>"
        )
    )
    fitted = rows.where("fit")
    plain = linear.fit(fitted, linear.Ftrl(DIM, 1, False, alpha=0.3, l1=0.05), 3, SHARDS)[0][:, 0]
    held = _scores(rows.where("NOT fit"), plain)
    prior = estimate_prior(held.loc[held.y == 1, "s"].to_numpy(), held.loc[held.y == 0, "s"].to_numpy())
    weights = _non_negative(fitted, prior)
    release(rows)
    return QualityModel(weights, prior)


def _scores(rows: DataFrame, weights: np.ndarray) -> pd.DataFrame:
    """Scores of the held-back part of the bounded sample."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for batch in batches:
            s = [float(np.asarray(v) @ w[np.asarray(i)] + w[-1]) for i, v in zip(batch["idx"], batch["val"], strict=True)]
            yield pd.DataFrame({"y": batch["y"], "s": s})

    return rows.select("y", "idx", "val").mapInPandas(run, "y int, s double").toPandas()


def _non_negative(rows: DataFrame, prior: float, step: float = 1.0, decay: float = 1e-5) -> np.ndarray:
    """Weights of least non-negative risk: shards descend, their weights are averaged."""
    context = rows.sparkSession.sparkContext
    weights, power = np.zeros(DIM + 1), np.zeros(DIM + 1)
    dealt = rows.select("y", "idx", "val", "shard", "place").repartition(SHARDS, "shard").sortWithinPartitions("shard", "place")
    for _ in range(ROUNDS):
        sent = context.broadcast((weights, power))

        def descend(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            w, g2 = (x.copy() for x in sent.value)
            sides: dict[int, list] = {1: [], 0: []}
            for batch in batches:
                for y, i, v in zip(batch["y"], batch["idx"], batch["val"], strict=True):
                    sides[int(y)].append((np.append(i, DIM), np.append(v, 1.0)))
            seen = len(sides[0]) + len(sides[1])
            if sides[0] and sides[1]:
                flat = [_flat(side) for side in sides.values()]
                for _ in range(STEPS):
                    _step(w, g2, flat, prior, step, decay)
            if seen:
                yield pd.DataFrame({"seen": [seen], "w": [w.tobytes()], "g2": [g2.tobytes()]})

        parts = dealt.mapInPandas(descend, "seen long, w binary, g2 binary").collect()
        total = sum(p["seen"] for p in parts)
        if total:
            weights = sum(np.frombuffer(p["w"]) * (p["seen"] / total) for p in parts)
            power = sum(np.frombuffer(p["g2"]) * (p["seen"] / total) for p in parts)
        sent.unpersist()
    return weights


def _flat(side: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows of one side as three parallel arrays: row number, coordinate, value."""
    lengths = [len(i) for i, _ in side]
    return (
        np.repeat(np.arange(len(side)), lengths),
        np.concatenate([i for i, _ in side]),
        np.concatenate([v for _, v in side]),
        len(side),
    )


def _step(w: np.ndarray, g2: np.ndarray, sides: list[tuple], prior: float, step: float, decay: float) -> None:
    """The usual descent, or ascent on the negative part once that is below zero."""
    scores = [np.bincount(row, val * w[idx], minlength=n) for row, idx, val, n in sides]
    p_good, p_other = (linear.probabilities(s, False) for s in scores)
    negative = np.logaddexp(0, scores[1]).mean() - prior * np.logaddexp(0, scores[0]).mean()
    if negative >= 0:
        slopes = [np.full(len(p_good), -prior / len(p_good)), p_other / len(p_other)]
    else:
        slopes = [prior * p_good / len(p_good), -p_other / len(p_other)]
    gradient = decay * w
    for (row, idx, val, _), slope in zip(sides, slopes, strict=True):
        gradient += np.bincount(idx, val * slope[row], minlength=len(w))
    g2 += gradient * gradient
    w -= step * gradient / np.sqrt(g2 + 1e-10)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` in place of the text column.

    Empty and NULL texts are scored like any other, by their statistics. Equal
    texts get equal scores; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str | None]) -> list[list]:
        scores = [sent.value.score(t) for t in texts]
        return [scores, [int(s >= threshold) for s in scores]]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return computed(docs, [text_col], run, fields, [text_col])
