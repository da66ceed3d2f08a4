"""Gradient-boosted regression trees for counts (Poisson loss, log link), grown best leaf first.

With score ``s`` and mean ``mu = exp(s)`` the loss has gradient ``mu - y`` and curvature ``mu``. A leaf's
step is ``sum(y - mu) / (sum(mu) + l2)``; the gain of a split is what it adds to ``sum(gradient)**2 /
(sum(curvature) + l2)``.

Features are binned once and rows are written once, as blocks of packed columns. A pass over the
blocks adds up gradient, curvature and rows per (leaf, feature, bin) inside the tasks; Spark sums
these by key, and the driver sees at most ``max_leaves`` leaves of such sums. One pass serves all
leaves of a level that may still be among the best; of two sisters only the smaller is counted,
the other is the parent's rest. A leaf of at most ``SMALL`` rows is sent to one task, which grows what
is below it by the same steps. The order of the splits is settled by a queue on the driver, so a
tree is the one that splitting the best leaf first gives.

The finished ensemble is an ordinary ``GBTRegressionModel``, read from files in the layout of Spark's own
model writer, so scoring all trees is one expression and a stored model needs no refit.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyspark
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators.scoring import drop_nulls
from hourgrid.schemas import BOOSTING_FEATURES, TARGET
from hourgrid.session import (
    cut_lineage,
    delete_folder,
    release,
    session_setting,
    shared_folder,
    ship_code,
    shuffle_partitions,
)

# Bounds of the fitted mean while training; keep weights and targets finite.
MEAN_FLOOR, MEAN_CEILING = 1e-6, 1e9
# Rows of one block of packed columns.
BLOCK_ROWS = 1 << 16
BINS = 256
# Rows of a leaf that one task takes over, some 30 bytes each.
SMALL = 1 << 17
# Curvature that a child needs at least.
LEAST_CURVATURE = 1e-3


def _vector(features: Sequence[str]) -> Column:
    return array_to_vector(F.array(*[F.col(f).cast("double") for f in features]))


def _mean(score: Column | str = "score") -> Column:
    """The mean of a score, within the same bounds while training and scoring."""
    return F.least(F.greatest(F.exp(score), F.lit(MEAN_FLOOR)), F.lit(MEAN_CEILING))


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    bin: int


@dataclass
class Node:
    """A node of a growing tree: sums of gradient, curvature and rows, and its best split if it has one."""

    depth: int
    gradient: float
    curvature: float
    rows: float
    sums: np.ndarray | None = None
    split: Split | None = None
    children: tuple[int, int] | None = None
    # The least gain on the way here: splits happen in falling order of it.
    above: float = math.inf

    @property
    def rank(self) -> float:
        return min(self.above, self.split.gain)


@dataclass(frozen=True)
class Tree:
    """A finished tree in pre-order; ``feature`` is -1 and ``value`` the step at leaves."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row ends; ``bins`` has one line per feature."""
        at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while True:
            inside = self.feature[at] >= 0
            if not inside.any():
                return at
            below = bins[np.maximum(self.feature[at], 0), rows] <= self.bin[at]
            at = np.where(inside, np.where(below, self.left[at], self.right[at]), at)


def best_split(sums: np.ndarray, l2: float, min_leaf: int) -> Split | None:
    """The best split of (gradient, curvature, rows) x feature x bin sums; of equal gains the first feature and bin."""
    gradient, curvature, rows = np.cumsum(sums, axis=2)
    total_g, total_h, total_n = gradient[:, -1:], curvature[:, -1:], rows[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (
            gradient**2 / (curvature + l2)
            + (total_g - gradient) ** 2 / (total_h - curvature + l2)
            - total_g**2 / (total_h + l2)
        )
    enough = (np.minimum(rows, total_n - rows) >= min_leaf) & (np.minimum(curvature, total_h - curvature) >= LEAST_CURVATURE)
    gain = np.where(enough, gain, -np.inf)
    at = int(gain.argmax())
    best = float(gain.flat[at])
    return Split(best, *map(int, divmod(at, gain.shape[1]))) if best > 0 else None


def _arrays(nodes: list[Node], l2: float, order: list[int]) -> Tree:
    """The nodes of ``order`` (parents before children) as a tree; what is not in it is cut off."""
    number = {n: i for i, n in enumerate(order)}
    inside = [nodes[n].children is not None and nodes[n].children[0] in number for n in order]
    pick = lambda get, other, kind: np.array([get(nodes[n]) if i else other for n, i in zip(order, inside, strict=True)], kind)
    return Tree(
        pick(lambda n: n.split.feature, -1, np.int64),
        pick(lambda n: n.split.bin, 0, np.int64),
        pick(lambda n: number[n.children[0]], -1, np.int64),
        pick(lambda n: number[n.children[1]], -1, np.int64),
        np.array([-nodes[n].gradient / (nodes[n].curvature + l2) for n in order]),
    )


def best_first(nodes: list[Node], max_leaves: int) -> list[int]:
    """The nodes of the tree that splitting the leaf with most gain gives, in pre-order."""
    leaves, chosen = 1, set()
    queue = [(-nodes[0].split.gain, 0)] if nodes[0].split else []
    while queue and leaves < max_leaves:
        _, at = heapq.heappop(queue)
        if nodes[at].children is None:
            break  # nothing known below: the caller has counted enough levels before it asks
        chosen.add(at)
        leaves += 1
        for child in nodes[at].children:
            if nodes[child].split:
                heapq.heappush(queue, (-nodes[child].split.gain, child))
    order, ahead = [], [0]
    while ahead:
        at = ahead.pop()
        order.append(at)
        if at in chosen:
            ahead += reversed(nodes[at].children)
    return order


@dataclass(frozen=True)
class Growth:
    """The rules of a tree, for the driver and for tasks."""

    max_leaves: int
    max_depth: int
    min_leaf: int
    l2: float

    def least_rank(self, nodes: list[Node]) -> float:
        """A split of a lower rank comes after as many known ones as a tree has."""
        ranks = sorted((n.rank for n in nodes if n.split), reverse=True)
        return ranks[self.max_leaves - 2] if len(ranks) >= self.max_leaves - 1 else -math.inf

    def counted(self, node: Node, sums: np.ndarray) -> None:
        node.sums = sums
        node.split = best_split(sums, self.l2, self.min_leaf) if node.depth < self.max_depth else None

    def open_level(self, nodes: list[Node], level: list[int]) -> list[tuple[int, int, int]]:
        """Give the leaves of a level that may be split their children; (parent, smaller, larger child)."""
        least, pairs = self.least_rank(nodes), []
        for at in level:
            node = nodes[at]
            if not node.split or node.rank < least:
                continue
            left = node.sums[:, node.split.feature, : node.split.bin + 1].sum(axis=1)
            right = node.sums[:, node.split.feature].sum(axis=1) - left
            node.children = (len(nodes), len(nodes) + 1)
            nodes += [Node(node.depth + 1, *side, above=node.rank) for side in (left, right)]
            pairs.append((at, *(node.children if left[2] <= right[2] else node.children[::-1])))
        # Children too small to split need no sums of their own.
        able = lambda child: nodes[child].depth < self.max_depth and nodes[child].rows >= 2 * self.min_leaf
        return [p for p in pairs if able(p[1]) or able(p[2])]

    def grow(
        self, nodes: list[Node], count: Callable[[list[Node], list[int]], dict[int, np.ndarray]], small: int = 0
    ) -> list[int]:
        """Add levels below ``nodes[0]``, whose sums are there; ``count`` gives the sums of asked nodes.

        Leaves of at most ``small`` rows are not counted but returned.
        """
        level, aside = [0], []
        while pairs := self.open_level(nodes, level):
            aside += [c for p in pairs for c in p[1:] if nodes[c].rows <= small]
            asked = [p for p in pairs if nodes[p[2]].rows > small]
            sums = count(nodes, [p[1] for p in asked]) if asked else {}
            for at, less, more in asked:
                self.counted(nodes[more], nodes[at].sums - sums[less])
                if nodes[less].rows > small:
                    self.counted(nodes[less], sums[less])
            for at in level:
                nodes[at].sums = None
            level = [c for p in asked for c in p[1:] if nodes[c].rows > small]
        return aside


def sums_of(bins: np.ndarray, slot: np.ndarray, slots: int, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """(gradient, curvature, rows) x slot x feature x bin; rows of slot -1 do not count."""
    used = slot >= 0
    slot, total = slot[used] * BINS, np.zeros((3, len(bins), slots * BINS))
    weights = (gradient[used], curvature[used], None)
    for f, line in enumerate(bins):
        key = slot + line[used]
        for kind, weight in enumerate(weights):
            total[kind, f] += np.bincount(key, weight, slots * BINS)
    return total.reshape(3, len(bins), slots, BINS).transpose(0, 2, 1, 3)


def subtree(rules: Growth, depth: int, bins: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> list[Node]:
    """All nodes below and at a leaf of the given depth that may be among the best, from its rows."""
    top = sums_of(bins, np.zeros(len(gradient), np.int64), 1, gradient, curvature)[:, 0]
    nodes = [Node(depth, *top[:, 0].sum(axis=1))]
    rules.counted(nodes[0], top)

    def count(nodes: list[Node], wanted: list[int]) -> dict[int, np.ndarray]:
        places = _arrays(nodes, rules.l2, list(range(len(nodes)))).places(bins)
        slots = np.full(len(nodes), -1)
        slots[wanted] = np.arange(len(wanted))
        found = sums_of(bins, slots[places], len(wanted), gradient, curvature)
        return {n: found[:, i] for i, n in enumerate(wanted)}

    rules.grow(nodes, count)
    return nodes


@dataclass(frozen=True)
class PoissonBoostingModel:
    features: list[str]
    base_score: float
    ensemble: GBTRegressionModel | None
    train_loss: list[float] = field(default_factory=list)
    held_out_loss: list[float] = field(default_factory=list)

    @property
    def n_trees(self) -> int:
        return self.ensemble.getNumTrees if self.ensemble else 0

    def transform(self, df: DataFrame) -> DataFrame:
        if self.ensemble is None:
            return df.withColumn("yhat", F.lit(math.exp(self.base_score)))
        scored = self.ensemble.transform(df.select("*", self._input))
        return scored.withColumn("yhat", self._yhat).drop("_features", "_step")

    @cached_property
    def _input(self) -> Column:
        return _vector(self.features).alias("_features")

    @cached_property
    def _yhat(self) -> Column:
        return _mean(F.col("_step") + self.base_score)

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the model in a folder that all executors share; an older one there is replaced."""
        if self.ensemble is not None:
            self.ensemble.write().overwrite().save(f"{path}/ensemble")
        kept = {"features": self.features, "base_score": self.base_score, "trees": self.n_trees}
        kept |= {"train_loss": self.train_loss, "held_out_loss": self.held_out_loss}
        # Written last: a folder with it is whole.
        spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PoissonBoostingModel:
        kept = json.loads(spark.read.text(f"{path}/settings").first()[0])
        ensemble = GBTRegressionModel.load(f"{path}/ensemble") if kept["trees"] else None
        return cls(kept["features"], kept["base_score"], ensemble, kept["train_loss"], kept["held_out_loss"])


def _ensemble(spark: SparkSession, trees: list[Tree], edges: list[np.ndarray], rate: float) -> GBTRegressionModel:
    """Spark's own tree-ensemble model, through files in the layout of its writer."""
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    kept = {"timestamp": 0, "sparkVersion": pyspark.__version__, "defaultParamMap": {"impurity": "variance"}}
    columns = {"featuresCol": "_features", "predictionCol": "_step"}
    regression = "org.apache.spark.ml.regression"
    whole = kept | {"class": f"{regression}.GBTRegressionModel", "uid": f"poisson_{uuid.uuid4().hex[:12]}"}
    whole |= {"paramMap": columns, "numFeatures": len(edges), "numTrees": len(trees)}
    single = [kept | {"class": f"{regression}.DecisionTreeRegressionModel", "uid": f"tree_{i}", "paramMap": {}} for i in range(len(trees))]
    nodes = []
    for number, t in enumerate(trees):
        for i, feature in enumerate(t.feature.tolist()):
            split = (feature, [float(edges[feature][t.bin[i]])], -1) if feature >= 0 else (-1, [], -1)
            gain = 1.0 if feature >= 0 else -1.0
            nodes.append((number, (i, float(t.value[i]), 0.0, [1.0, 0.0, 0.0], 1, gain, int(t.left[i]), int(t.right[i]), split)))
    data = (
        "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
        "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
    )
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(nodes, data).coalesce(1).write.parquet(f"{path}/data")
    listed = [(i, json.dumps(m), rate) for i, m in enumerate(single)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    model = GBTRegressionModel.load(path)
    delete_folder(spark, path)
    return model


def bin_edges(rows: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """Upper bounds of each feature's bins but the last, at most ``max_bins`` - 1.

    Halfway between neighbours where a feature has up to ``max_bins`` values, else quantiles.
    """
    width = len(features)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set] = [set() for _ in range(width)]
        for batch in batches:
            for found, column in zip(seen, batch.columns, strict=True):
                if len(found) <= max_bins:
                    found.update(np.unique(column.to_numpy(zero_copy_only=False)).tolist())
        # One value too many tells that quantiles are needed, so no task hands on more than that.
        pairs = [(f, v) for f, found in enumerate(seen) for v in sorted(found)[: max_bins + 1]]
        columns = ([f for f, _ in pairs], [v for _, v in pairs])
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64())], ["feature", "value"])

    numbers = rows.select(*[F.col(f"features")[i].alias(f"f{i}") for i in range(width)])
    values = numbers.mapInArrow(distinct, "feature long, value double").distinct()
    ranked = values.groupBy("feature").agg(F.count("value").alias("n"), F.sort_array(F.slice(F.collect_set("value"), 1, max_bins + 1)).alias("values"))
    found = {r["feature"]: (r["n"], r["values"]) for r in ranked.collect()}
    many = [f for f in range(width) if found[f][0] > max_bins]
    shares = [i / max_bins for i in range(1, max_bins)]
    quantiles = numbers.approxQuantile([f"f{f}" for f in many], shares, 0.1 / max_bins) if many else []
    edges = []
    for f in range(width):
        if f in many:
            edges.append(np.unique(quantiles[many.index(f)]))
        else:
            listed = np.array(found[f][1], np.float64)
            edges.append((listed[1:] + listed[:-1]) / 2)
    return edges


def _blocks(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Blocks of rows: features as one byte each, the target, and which rows are held out, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                numbers = part.column("features").flatten().to_numpy().reshape(part.num_rows, len(edges)) if part.num_rows else np.zeros((0, len(edges)))
                bins = np.stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, numbers.T, strict=True)]).astype(np.uint8)
                y, held = part.column("y").to_numpy(), part.column("held_out").to_numpy(zero_copy_only=False)
                packed = [[bins.tobytes()], [y.astype(np.float64).tobytes()], [held.astype(bool).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in packed], ["bins", "y", "held_out"])

    spark = rows.sparkSession
    with session_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS)):
        return cut_lineage(rows.mapInArrow(pack, "bins binary, y binary, held_out binary"))


_STATE = "bins binary, y binary, held_out binary, score binary"


def _scored(blocks: DataFrame, trees: list[Tree], rate: float, base: float | None = None) -> DataFrame:
    """The blocks with the scores after some more trees, from ``base`` where there are none yet."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for row in batch.to_pylist():
                y = np.frombuffer(row["y"])
                bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, len(y))
                score = np.frombuffer(row["score"]) if base is None else np.full(len(y), base)
                for tree in trees:
                    score = score + rate * tree.value[tree.places(bins)]
                scores.append(score.tobytes())
            kept = [batch.column(c) for c in ("bins", "y", "held_out")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.binary())], ["bins", "y", "held_out", "score"])

    return blocks.mapInArrow(step, _STATE)


def _unpacked(batches: Iterator[pa.RecordBatch], losses: np.ndarray | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Bins, gradient, curvature and whether a row is held out, per block; adds (loss, rows) of both kinds of rows."""
    for batch in batches:
        for row in batch.to_pylist():
            y, held, score = np.frombuffer(row["y"]), np.frombuffer(row["held_out"], bool), np.frombuffer(row["score"])
            mean = np.clip(np.exp(score), MEAN_FLOOR, MEAN_CEILING)
            if losses is not None:
                each = mean - y * np.log(mean)
                for side in (0, 1):
                    losses[side] += each[held == side].sum(), (held == side).sum()
            yield np.frombuffer(row["bins"], np.uint8).reshape(-1, len(y)), mean - y, mean, held


def _counted(state: DataFrame, tree: Tree, wanted: list[int], width: int, with_loss: bool) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Sums per feature and bin of the ``wanted`` nodes, and (loss, rows) of training and held-out rows."""
    slots = np.full(len(tree.feature), -1)
    slots[wanted] = np.arange(len(wanted))
    size = len(wanted) * width * BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss = np.zeros((3, len(wanted), width, BINS)), np.zeros((2, 2))
        for bins, gradient, curvature, held in _unpacked(batches, loss if with_loss else None):
            total += sums_of(bins, np.where(held, -1, slots[tree.places(bins)]), len(wanted), gradient, curvature)
        total = total.reshape(3, size)
        seen = np.flatnonzero(total[2])
        columns = np.concatenate([total[:, seen], np.stack([loss[:, 0], loss[:, 0], loss[:, 1]])], axis=1)
        keys = np.concatenate([seen, [-1, -2]])
        yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, columns)], ["key", "g", "h", "n"])

    # Each task gives a key once, so the sums are dealt at once; keys are few, so are the partitions.
    parts = max(1, min(shuffle_partitions(state.sparkSession), len(wanted) * width // 32))
    dealt = state.mapInArrow(count, "key long, g double, h double, n double").repartition(parts, "key")
    summed = dealt.groupBy("key").agg(*[F.sum(c).alias(c) for c in "ghn"]).toArrow()
    keys = summed.column("key").to_numpy()
    values = np.stack([summed.column(c).to_numpy() for c in "ghn"])
    total, loss = np.zeros((3, size)), np.zeros((2, 2))
    total[:, keys[keys >= 0]] = values[:, keys >= 0]
    for side in (0, 1):
        loss[side] = values[0, keys == -1 - side].sum(), values[2, keys == -1 - side].sum()
    total = total.reshape(3, len(wanted), width, BINS)
    return {n: total[:, i] for i, n in enumerate(wanted)}, loss


_PIECE = "node long, bins binary, g binary, h binary, loss double, rows double"
_BELOW = ("node", "at", "depth", "left", "right", "feature", "bin")


def _finished(
    state: DataFrame, tree: Tree, wanted: dict[int, int], rules: Growth, width: int, with_loss: bool
) -> tuple[dict[int, list[Node]], np.ndarray]:
    """The subtrees of the ``wanted`` leaves (node and depth), each grown by the one task that gets its rows."""
    slots = np.full(len(tree.feature), -1)
    slots[list(wanted)] = list(wanted)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, pieces = np.zeros((2, 2)), []
        for bins, gradient, curvature, held in _unpacked(batches, loss if with_loss else None):
            slot = np.where(held, -1, slots[tree.places(bins)])
            for node in np.unique(slot[slot >= 0]).tolist():
                own = slot == node
                pieces.append((node, bins[:, own].tobytes(), gradient[own].tobytes(), curvature[own].tobytes(), 0.0, 0.0))
        pieces += [(-1 - side, b"", b"", b"", *loss[side].tolist()) for side in (0, 1)]
        types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
        columns = [pa.array(c, t) for c, t in zip(zip(*pieces, strict=True), types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["node", "bins", "g", "h", "loss", "rows"])

    def finish(pieces: pa.Table) -> pa.Table:
        node, parts = pieces.column("node")[0].as_py(), pieces.to_pylist()
        if node < 0:
            rows = [(node, 0, 0, -1, -1, -1, -1, 0.0, sum(p["loss"] for p in parts), 0.0, sum(p["rows"] for p in parts))]
        else:
            bins = np.concatenate([np.frombuffer(p["bins"], np.uint8).reshape(width, -1) for p in parts], axis=1)
            gradient, curvature = (np.concatenate([np.frombuffer(p[c]) for p in parts]) for c in "gh")
            rows = []
            for at, n in enumerate(subtree(rules, wanted[node], bins, gradient, curvature)):
                split = n.split or Split(0.0, -1, -1)
                rows.append((node, at, n.depth, *(n.children or (-1, -1)), split.feature, split.bin, split.gain, n.gradient, n.curvature, n.rows))
        names = [*_BELOW, "gain", "g", "h", "n"]
        types = [pa.int64()] * len(_BELOW) + [pa.float64()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    made = ", ".join([f"`{c}` long" for c in _BELOW] + [f"{c} double" for c in ("gain", "g", "h", "n")])
    parts = max(1, min(shuffle_partitions(state.sparkSession), len(wanted)))
    dealt = state.mapInArrow(deal, _PIECE).repartition(parts, "node")
    found: dict[int, list[Node]] = {node: [] for node in wanted}
    loss = np.zeros((2, 2))
    for row in sorted(dealt.groupBy("node").applyInArrow(finish, made).toArrow().to_pylist(), key=lambda r: (r["node"], r["at"])):
        if row["node"] < 0:
            loss[-1 - row["node"]] = row["g"], row["n"]
            continue
        split = Split(row["gain"], row["feature"], row["bin"]) if row["feature"] >= 0 else None
        children = (row["left"], row["right"]) if row["left"] >= 0 else None
        found[row["node"]].append(Node(row["depth"], row["g"], row["h"], row["n"], None, split, children))
    return found, loss


def _attached(nodes: list[Node], at: int, below: list[Node]) -> None:
    """Put a subtree in the place of the leaf ``at``; ranks follow the way from the root."""
    first = len(nodes) - 1
    place = lambda i: at if i == 0 else first + i
    above = {0: nodes[at].above}
    for i, node in enumerate(below):
        node.above = above[i]
        for child in node.children or ():
            above[child] = node.rank
        node.children = tuple(place(c) for c in node.children) if node.children else None
    nodes[at] = below[0]
    nodes += below[1:]


@dataclass(frozen=True)
class PoissonBoosting:
    """Settings; ``fit`` runs the training jobs.

    With ``validation_fraction`` that share of rows (by hash) is held out, and training stops
    after ``patience`` rounds without an improvement of more than ``tolerance``.
    """

    learning_rate: float = 0.05
    max_depth: int = 8
    max_leaves: int = 63
    max_bins: int = 255
    min_leaf: int = 50
    l2: float = 1e-4
    iterations: int = 300
    seed: int = 42
    validation_fraction: float | None = None
    patience: int = 10
    tolerance: float = 1e-7
    checkpoint_every: int = 10

    def fit(
        self, df: DataFrame, features: Sequence[str] = BOOSTING_FEATURES, target: str = TARGET
    ) -> PoissonBoostingModel:
        features = list(features)
        complete = drop_nulls(df, [*features, target])
        share = self.validation_fraction or 0.0
        # By the row's key where it is there: equal feature rows of quiet zones then spread over both sides.
        key = [c for c in ("hour_start", "pu_location") if c in df.columns] or [*features, target]
        held_out = F.pmod(F.xxhash64(F.lit(self.seed), *key), F.lit(1_000_000)) < int(share * 1_000_000)
        spark = df.sparkSession
        ship_code(spark)
        rows = cut_lineage(
            complete.select(
                F.array(*[F.col(f).cast("double") for f in features]).alias("features"),
                F.col(target).cast("double").alias("y"),
                held_out.alias("held_out"),
            ).repartition(shuffle_partitions(spark))
        )
        n, mean = rows.where(~F.col("held_out")).agg(F.count("y"), F.avg("y")).first()
        if not n:
            raise RuntimeError("no complete training rows")
        if mean <= 0:
            return PoissonBoostingModel(features, -math.inf, None)
        edges = bin_edges(rows, features, min(self.max_bins, BINS))
        blocks = _blocks(rows, edges)
        release(rows)
        # Plans of the passes are all alike and small: planning them again at run time only costs time.
        with session_setting(spark, "spark.sql.adaptive.enabled", "false"):
            trees, train, held = self._boost(blocks, len(features), math.log(max(mean, MEAN_FLOOR)), n)
        release(blocks)
        ensemble = _ensemble(spark, trees, edges, self.learning_rate)
        return PoissonBoostingModel(features, math.log(max(mean, MEAN_FLOOR)), ensemble, train, held)

    def _boost(self, blocks: DataFrame, width: int, base: float, rows: int) -> tuple[list[Tree], list[float], list[float]]:
        # Cached scores come from written ones and the trees since: a lost executor costs few trees, and plans stay small.
        stage, recent = cut_lineage(_scored(blocks, [], self.learning_rate, base)), []
        state, before = stage.persist(StorageLevel.MEMORY_AND_DISK), None
        trees: list[Tree] = []
        losses: tuple[list[float], list[float]] = ([], [])
        best, since_best = math.inf, 0
        for number in range(1, self.iterations + 2):
            # The first pass also fills the cache of the state; after the last tree it only measures.
            tree, loss = self._grown(state, width, rows) if number <= self.iterations else (None, self._loss(state, width))
            if before is not None:
                before.unpersist()
            if number > 1:  # the loss after the tree before
                for side, listed in enumerate(losses):
                    if loss[side, 1]:
                        listed.append(float(loss[side, 0] / loss[side, 1]))
                if losses[1]:
                    since_best = 0 if losses[1][-1] < best - self.tolerance else since_best + 1
                    best = min(best, losses[1][-1])
            if tree is None or (losses[1] and since_best >= self.patience):
                break
            trees.append(tree)
            recent.append(trees[-1])
            if len(recent) == self.checkpoint_every:
                old, stage, recent = stage, cut_lineage(_scored(stage, recent, self.learning_rate)), []
                release(old)
            before, state = state, _scored(stage, list(recent), self.learning_rate).persist(StorageLevel.MEMORY_AND_DISK)
        state.unpersist()
        release(stage)
        return trees, losses[0], losses[1]

    def _loss(self, state: DataFrame, width: int) -> np.ndarray:
        single = Tree(*(np.array([x]) for x in (-1, 0, -1, -1, 0.0)))
        return _counted(state, single, [0], width, True)[1]

    def _grown(self, state: DataFrame, width: int, rows: int) -> tuple[Tree, np.ndarray]:
        """The tree that always splits the leaf with the largest gain, and the losses before it.

        Leaves are counted level by level, those of few rows are finished in one more pass.
        """
        rules = Growth(self.max_leaves, self.max_depth, self.min_leaf, self.l2)
        nodes = [Node(0, 0.0, 0.0, float(rows))]
        current = lambda nodes: _arrays(nodes, 1.0, list(range(len(nodes))))
        if rows <= SMALL:
            below, loss = _finished(state, current(nodes), {0: 0}, rules, width, True)
            nodes = below[0]
            return _arrays(nodes, self.l2, best_first(nodes, self.max_leaves)), loss
        sums, loss = _counted(state, current(nodes), [0], width, True)
        nodes[0] = Node(0, *sums[0][:, 0].sum(axis=1))
        rules.counted(nodes[0], sums[0])
        count = lambda nodes, wanted: _counted(state, current(nodes), wanted, width, False)[0]
        aside = rules.grow(nodes, count, SMALL)
        least = rules.least_rank(nodes)
        wanted = {at: nodes[at].depth for at in aside if nodes[at].above >= least and nodes[at].rows >= 2 * self.min_leaf}
        if wanted:
            below, _ = _finished(state, current(nodes), wanted, rules, width, False)
            for at, part in below.items():
                _attached(nodes, at, part)
        return _arrays(nodes, self.l2, best_first(nodes, self.max_leaves)), loss

    def named(self) -> str:
        """The settings as text, to tell stored models apart."""
        return json.dumps(asdict(self), sort_keys=True)
