"""Language of whole texts: multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, each run of other characters than letters becomes one
space, and n-grams of 1 to 3 characters are hashed into a fixed number of
buckets. Weights are (1 + ln tf) * idf with unit length. The model is trained with
follow-the-regularised-leader under elastic-net penalties and its temperature is
fitted on rows held back from training.

What is bounded: the training sample (``per_language`` texts of each language and
a quarter as many for the temperature) and the model (buckets x languages). The document
frequencies are counted over all rows that may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.llm import linear
from hourgrid.llm.frames import computed, objects, stage, unit_hash
from hourgrid.session import release

BUCKETS = 1 << 16
ORDERS = 3
PER_LANGUAGE = 600
EPOCHS = 4
SHARDS = 4
PIECE = 1 << 20
# A text's vector has up to BUCKETS entries: so many texts' vectors are held at once.
ROWS_AT_ONCE = 64
UNDETERMINED = "und"

_LETTER: np.ndarray | None = None


def _letters(codes: np.ndarray) -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER[codes]


def gram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text, or None if it has no letter.

    Works through the text in pieces, so memory does not grow with its length.
    """
    low = text.lower()
    shift, total, seen = np.uint32(32 - (buckets.bit_length() - 1)), None, False
    carry = np.array([32], np.uint32)
    for begin in range(0, len(low), PIECE):
        codes = np.frombuffer(low[begin : begin + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(codes)
        seen = seen or bool(letter.any())
        codes = np.where(letter, codes, np.uint32(32))
        codes = np.concatenate([carry, codes] if begin + PIECE < len(low) else [carry, codes, [np.uint32(32)]]).astype(np.uint32)
        space = codes == 32
        codes = codes[~(space & np.concatenate([[False], space[:-1]]))]
        gram, keep, hashed = codes, min(ORDERS - 1, len(codes)), []
        for order in range(ORDERS):
            if order:
                gram = gram[:-1] * np.uint32(0x01000193) + codes[order:]
            # Grams that end inside the carried part were counted with the piece before.
            fresh = gram[max(0, len(carry) - order) :] if begin else gram
            hashed.append(((fresh + np.uint32(order)) * np.uint32(0x9E3779B1)) >> shift)
        counts = np.bincount(np.concatenate(hashed), minlength=buckets)
        total = counts if total is None else total + counts
        carry = codes[-keep:] if keep else carry
    return total if seen else None


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx = np.flatnonzero(counts)
    val = (1.0 + np.log(counts[idx])) * idf[idx]
    length = np.sqrt((val * val).sum())
    return idx, (val / length if length else val).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def score(self, text: str | None) -> tuple[str, float]:
        counts = None if text is None else gram_counts(text, len(self.idf))
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0
        idx, val = vector(counts, self.idf)
        p = linear.probabilities((val @ self.weights[idx] + self.weights[-1]) / self.temperature, True)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _frequencies(learn: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """idf of every bucket over all texts of ``learn``: at most ``buckets`` sums come back."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, texts = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for text in batch[text_col]:
                counts = gram_counts(text, buckets)
                if counts is not None:
                    found += counts > 0
                    texts += 1
        used = np.flatnonzero(found)
        yield pd.DataFrame({"bucket": np.append(used, -1), "n": np.append(found[used], texts)})

    sums = learn.select(text_col).mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found, texts = np.zeros(buckets), 0
    for bucket, n in sums.collect():
        if bucket < 0:
            texts = n
        else:
            found[bucket] = n
    return np.log((1.0 + texts) / (1.0 + found)).astype(np.float32) + np.float32(1.0)


def train(
    learn: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    buckets: int = BUCKETS,
    epochs: int = EPOCHS,
) -> LanguageModel:
    """Fit on the rows of ``learn`` that have a text and a language.

    The id only draws the sample; it is no input of a prediction.
    """
    learn = learn.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in learn.groupBy(lang_col).count().collect()}
    languages = sorted(counts)
    idf = _frequencies(learn, text_col, buckets)
    if not languages:
        return LanguageModel([], idf, np.zeros((buckets + 1, 0), np.float32), 1.0)
    share = linear.bounded_share(counts, per_language * 5 // 4)
    drawn = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])[F.col(lang_col)]
    number = F.create_map(*[F.lit(x) for pair in ((v, i) for i, v in enumerate(languages)) for x in pair])[F.col(lang_col)]
    luck = unit_hash(F.lit("language"), F.col(id_col))
    sample = linear.dealt_to_shards(learn.where(luck < drawn), id_col, SHARDS).select(
        "place", "shard", number.alias("y"), F.col(text_col).alias("text"), (luck < drawn * 0.8).alias("fit")
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[begin : begin + ROWS_AT_ONCE]
                keep, idx, val = [], [], []
                for i, text in enumerate(part["text"]):
                    # The counts are as wide as the model and go with each text.
                    counts = gram_counts(text, buckets)
                    if counts is not None:
                        found = vector(counts, idf)
                        keep.append(i)
                        idx.append(found[0].astype(np.int32))
                        val.append(found[1])
                out = part.iloc[keep][["place", "shard", "y", "fit"]]
                yield out.assign(idx=objects(idx).values, val=objects(val).values)

    rows = stage(
        sample.mapInPandas(features, "place long, shard int, y int, fit boolean, idx array<int>, val array<float>")
    )
    model = linear.Ftrl(buckets, len(languages), True, alpha=1.0, l1=0.02, l2=0.1)
    weights = linear.fit(rows.where("fit"), model, epochs, SHARDS)[0]
    temperature = _temperature(rows.where("NOT fit"), weights)
    release(rows)
    return LanguageModel(languages, idf, weights, temperature)


def _temperature(rows: DataFrame, weights: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows (a bounded sample).

    The targets are smoothed by one pseudo-row per class, so that rows without a
    single error do not drive the temperature to 0 and every score to 1.
    """
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = sent.value
        for batch in batches:
            scores = [np.asarray(v) @ w[np.asarray(i)] + w[-1] for i, v in zip(batch["idx"], batch["val"], strict=True)]
            yield pd.DataFrame({"y": batch["y"], "scores": [s.astype(np.float64) for s in scores]})

    got = rows.select("y", "idx", "val").mapInPandas(logits, "y int, scores array<double>").toPandas()
    if not len(got):
        return 1.0
    scores, y = np.stack(got["scores"].to_numpy()), got["y"].to_numpy()

    def loss(t: float) -> float:
        p = np.log(np.maximum(linear.probabilities(scores / t, True), 1e-12))
        return float(-(p[np.arange(len(y)), y].sum() + p.mean(axis=0).sum()) / len(y))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of the text column.

    A NULL text or one without a letter gives ``und`` with score 0, as does a
    model without languages. Of equal scores the first language by name wins.
    Equal texts get equal answers; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str | None]) -> list[list]:
        found = [sent.value.score(t) for t in texts]
        return [[f[0] for f in found], [f[1] for f in found]]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return computed(docs, [text_col], run, fields, [text_col])


def keep_known(docs: DataFrame, model: LanguageModel, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least this score; same columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(t) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([p != UNDETERMINED and s >= least_score for p, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
