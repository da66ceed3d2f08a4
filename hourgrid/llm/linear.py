"""Sparse linear models trained over partitions, with numpy inside the tasks.

Training rows hold ``y`` (one 0/1 or class number per task), ``idx`` and ``val``.
A round sends the current state to every shard, each shard runs one epoch of
follow-the-regularised-leader updates, and the shards' states are averaged
weighted by their rows. A state is a fixed-size pair of arrays, so what is
broadcast and what comes back is bounded by dimension x outputs x shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader with elastic-net penalties.

    ``heads`` outputs; with ``softmax`` they are one multinomial model, else
    independent logistic models. The last coordinate is the unpenalised bias.
    """

    dim: int
    heads: int
    softmax: bool
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    z: np.ndarray = field(default=None)
    n: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        if self.z is None:
            self.z = np.zeros((self.dim + 1, self.heads), np.float32)
            self.n = np.zeros((self.dim + 1, self.heads), np.float32)

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def _bias(self) -> np.ndarray:
        return -self.z[self.dim] / ((self.beta + np.sqrt(self.n[self.dim])) / self.alpha)

    def dense(self) -> np.ndarray:
        """All weights, the bias in the last row."""
        w = self.weights()
        w[self.dim] = self._bias()
        return w.astype(np.float32)

    def update(self, idx: np.ndarray, val: np.ndarray, target: np.ndarray, importance: np.ndarray | float = 1.0) -> None:
        w = self.weights(idx)
        bias = self._bias()
        p = probabilities((val[:, None] * w).sum(0) + bias, self.softmax)
        error = ((p - target) * importance).astype(np.float32)
        for rows, g, now in ((idx, val[:, None] * error, w), (np.array([self.dim]), error[None, :], bias[None, :])):
            before = self.n[rows]
            after = before + g * g
            self.z[rows] += g - (np.sqrt(after) - np.sqrt(before)) / self.alpha * now
            self.n[rows] = after


def probabilities(scores: np.ndarray, softmax: bool) -> np.ndarray:
    if softmax:
        e = np.exp(scores - scores.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)
    return 1.0 / (1.0 + np.exp(-np.clip(scores, -40, 40)))


def fit(rows: DataFrame, model: Ftrl, epochs: int, shards: int, label: str = "y", folds: int = 0) -> list[np.ndarray]:
    """Train on ``rows`` (label, idx, val, shard, and fold if ``folds``) and return dense weights.

    Without folds the list has one entry. With folds entry 0 saw all rows and
    entry k > 0 saw all rows but those of fold k - 1. Rows are visited in an
    order fixed by ``shard`` and ``place``, so a rerun gives the same weights.
    """
    context = rows.sparkSession.sparkContext
    states = [(model.z, model.n) for _ in range(folds + 1)]
    shape, proto = model.z.shape, model
    names = [label, "idx", "val", "shard", "place"] + (["fold"] if folds else [])
    dealt = rows.select(*names).repartition(shards, "shard").sortWithinPartitions("shard", "place")
    for _ in range(epochs):
        sent = context.broadcast(states)

        def epoch(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own = [
                Ftrl(proto.dim, proto.heads, proto.softmax, proto.alpha, proto.beta, proto.l1, proto.l2, z.copy(), n.copy())
                for z, n in sent.value
            ]
            seen = [0] * len(own)
            for batch in batches:
                fold = batch["fold"] if folds else [None] * len(batch)
                for y, idx, val, f in zip(batch[label], batch["idx"], batch["val"], fold, strict=True):
                    idx, val = np.asarray(idx, np.int64), np.asarray(val, np.float32)
                    target = np.asarray(y, np.float32) if proto.heads > 1 or not np.isscalar(y) else np.float32(y)
                    target = np.eye(proto.heads, dtype=np.float32)[int(y)] if proto.softmax else np.atleast_1d(target)
                    for k, one in enumerate(own):
                        if k == 0 or f != k - 1:
                            one.update(idx, val, target)
                            seen[k] += 1
            if seen[0]:
                yield pd.DataFrame(
                    {
                        "k": range(len(own)),
                        "seen": seen,
                        "z": [m.z.tobytes() for m in own],
                        "n": [m.n.tobytes() for m in own],
                    }
                )

        parts = dealt.mapInPandas(epoch, "k int, seen long, z binary, n binary").collect()
        for k in range(folds + 1):
            mine = [p for p in parts if p["k"] == k and p["seen"]]
            total = sum(p["seen"] for p in mine)
            if total:
                states[k] = tuple(
                    sum(np.frombuffer(p[a], np.float32).reshape(shape) * (p["seen"] / total) for p in mine).astype(np.float32)
                    for a in ("z", "n")
                )
        sent.unpersist()
    return [
        Ftrl(proto.dim, proto.heads, proto.softmax, proto.alpha, proto.beta, proto.l1, proto.l2, z, n).dense()
        for z, n in states
    ]


def bounded_share(counts: dict, limit: int) -> dict:
    """Per key the share of rows to draw so that about ``limit`` remain."""
    return {k: min(1.0, limit / c) for k, c in counts.items() if c}


def dealt_to_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``place`` and ``shard``, fixed by the row's key."""
    place = F.xxhash64(F.lit("place"), F.col(key))
    return df.withColumn("place", place).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
