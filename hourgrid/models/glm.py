"""Poisson regression with log link on numeric columns and one-hot zones, for any number of zones.

The zone block of the Newton matrix is diagonal: rows of one zone touch only that zone's effect. So one
grouped aggregate per step (per zone: sums of the mean, of the mean times each numeric column and of the
residual) eliminates all zone effects exactly, and what is left is a system for the intercept and the
numeric columns. Zone effects are a DataFrame throughout; the driver sees a few numbers per step.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid.operators.scoring import drop_nulls, require_rows
from hourgrid.schemas import GLM_NUMERIC_FEATURES, TARGET
from hourgrid.session import cut_lineage, release

ZONE = "pu_location"
# Lists of names and coefficients on the driver are for models of up to so many columns.
MOST_LISTED = 4096
HALVINGS = 30


def _numbered(values: DataFrame, name: str) -> DataFrame:
    """Distinct values of a column with their place in its order, from 0.

    Ranges of values are numbered in parallel, and the sizes of earlier ranges added.
    """
    placed = cut_lineage(values.distinct().repartitionByRange(name).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range of values.
    earlier = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_earlier"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(name))
    return placed.join(earlier, "_part").select(name, (F.col("_earlier") + inside - 1).cast("int").alias("_place"))


def _listed(rows: DataFrame, what: str) -> list:
    found = rows.limit(MOST_LISTED + 1).collect()
    if len(found) > MOST_LISTED:
        raise ValueError(f"more than {MOST_LISTED} {what} are not listed on the driver; read them as a DataFrame")
    return found


@dataclass(frozen=True)
class ZoneOneHot:
    """Zone indicator columns without the smallest zone; an unseen zone is all zero.

    ``places`` has the number of every zone in their order, as a DataFrame.
    """

    places: DataFrame
    encoder: OneHotEncoderModel | None
    count: int

    @property
    def zones(self) -> list[int]:
        return [r[0] for r in _listed(self.places.select(ZONE).orderBy(ZONE), "zones")]

    @property
    def names(self) -> list[str]:
        return [f"{ZONE}_{z}" for z in self.zones[1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``zone_vector``, sparse, as long as there are zones but one."""
        places = self.places.select(F.col(ZONE).alias("_zone"), "_place")
        placed = df.join(places, F.col(ZONE) == F.col("_zone"), "left").drop("_zone")
        # The encoder drops the last number: that of the smallest zone and of all unseen ones.
        last = F.lit(float(self.count - 1))
        number = F.when(F.col("_place") > 0, F.col("_place") - 1.0).otherwise(last)
        return self.encoder.transform(placed.withColumn("_place", number)).drop("_place")


def fit_one_hot(df: DataFrame) -> ZoneOneHot:
    places = cut_lineage(_numbered(df.select(ZONE).where(F.col(ZONE).isNotNull()), ZONE))
    count = places.count()
    numbers = places.select(F.col("_place").cast("double").alias("_place"))
    encoder = OneHotEncoder(inputCols=["_place"], outputCols=["zone_vector"])
    return ZoneOneHot(places, encoder.fit(numbers), count)


@dataclass(frozen=True)
class Fitted:
    """Intercept and coefficients of the numeric columns; ``effects`` has (zone, effect), the smallest zone's is 0."""

    intercept: float
    slopes: list[float]
    effects: DataFrame
    steps: int
    loss: float

    @property
    def coefficients(self) -> list[float]:
        """All coefficients, numeric columns first, then zones in order but the smallest."""
        zones = _listed(self.effects.orderBy(ZONE), "zones")
        return [*self.slopes, *(r["effect"] for r in zones[1:])]


@dataclass(frozen=True)
class PoissonRegressionModel:
    regression: Fitted
    numeric: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``yhat``; an unseen zone has the smallest zone's effect, none."""
        effects = self.regression.effects.select(F.col(ZONE).alias("_zone"), "effect")
        joined = df.join(effects, F.col(ZONE) == F.col("_zone"), "left")
        slopes = [F.col(n).cast("double") * c for n, c in zip(self.numeric, self.regression.slopes, strict=True)]
        eta = sum(slopes, F.coalesce("effect", F.lit(0.0)) + self.regression.intercept)
        return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != "yhat"], F.exp(eta).alias("yhat"))

    def coefficients(self, spark: SparkSession | None = None) -> DataFrame:
        """Feature and coefficient, largest first: a distributed sort."""
        effects = self.regression.effects
        smallest = effects.agg(F.min(ZONE).alias("_least"))
        zones = effects.join(F.broadcast(smallest), F.col(ZONE) != F.col("_least")).select(  # one row
            F.concat(F.lit(f"{ZONE}_"), F.col(ZONE).cast("string")).alias("feature"), F.col("effect").alias("coefficient")
        )
        pairs = list(zip(self.numeric, self.regression.slopes, strict=True))
        frame = effects.sparkSession.createDataFrame(pairs, "feature string, coefficient double")
        return frame.unionByName(zones).orderBy(F.desc("coefficient"), "feature")


def _zone_sums(rows: DataFrame, effects: DataFrame, beta: np.ndarray, x: list[Column]) -> DataFrame:
    """Per zone at the current coefficients: effect, sums of the mean, of mean times x and x times x, residuals, loss.

    A zone with a third of all rows is one row per task, as its sums start inside the tasks.
    """
    eta = sum((v * float(b) for v, b in zip(x, beta, strict=True)), F.col("effect"))
    joined = rows.join(effects, ZONE).withColumn("_eta", eta).withColumn("_mu", F.exp("_eta"))
    residual = F.col("_mu") - F.col("y")
    sums = [F.sum("_mu").alias("d"), F.sum(residual).alias("g"), F.sum(F.col("_mu") - F.col("y") * F.col("_eta")).alias("loss")]
    for i, v in enumerate(x):
        sums += [F.sum(F.col("_mu") * v).alias(f"c{i}"), F.sum(residual * v).alias(f"r{i}")]
    for i, j in itertools.combinations_with_replacement(range(len(x)), 2):
        sums.append(F.sum(F.col("_mu") * x[i] * x[j]).alias(f"a{i}_{j}"))
    return joined.groupBy(ZONE).agg(F.first("effect").alias("effect"), *sums)


def fit_poisson_glm(
    df: DataFrame,
    numeric: Sequence[str] = GLM_NUMERIC_FEATURES,
    target: str = TARGET,
    alpha: float = 1e-4,
    max_iter: int = 2000,
    tolerance: float = 1e-10,
) -> PoissonRegressionModel:
    """Minimise mean Poisson half-deviance + alpha/2 · |coefficients|² by Newton steps with the zones eliminated.

    The intercept is not penalised. A step that does not lower the objective is halved. Ends when
    the step promises less than ``tolerance``.
    """
    numeric = list(numeric)
    complete = drop_nulls(df, [*numeric, ZONE, target])
    rows = cut_lineage(
        complete.select(ZONE, F.col(target).cast("double").alias("y"), *[F.col(n).cast("double").alias(f"x{i}") for i, n in enumerate(numeric)])
    )
    require_rows(rows, "no complete training rows")
    n, mean, smallest = rows.agg(F.count("y"), F.avg("y"), F.min(ZONE)).first()
    effects = cut_lineage(rows.select(ZONE).distinct().withColumn("effect", F.lit(0.0)))
    x = [F.lit(1.0), *[F.col(f"x{i}") for i in range(len(numeric))]]
    width = len(x)
    beta = np.zeros(width)
    if not mean:
        # The objective has no minimum: the intercept falls without end. Take what it falls to.
        return PoissonRegressionModel(Fitted(-math.inf, beta[1:].tolist(), effects, 0, 0.0), numeric)
    beta[0] = math.log(mean)
    penalty = np.array([0.0] + [alpha] * len(numeric))
    free = F.col(ZONE) != smallest

    def state(effects: DataFrame, beta: np.ndarray) -> tuple[DataFrame, float, np.ndarray, np.ndarray]:
        """Sums per zone, the objective, and the reduced matrix and right side."""
        zones = cut_lineage(_zone_sums(rows, effects, beta, x))
        d = F.col("d") / n + alpha
        g = F.col("g") / n + alpha * F.col("effect")
        part = [F.sum("loss").alias("loss"), F.sum(F.col("effect") ** 2).alias("square")]
        for i, j in itertools.combinations_with_replacement(range(width), 2):
            removed = F.when(free, F.col(f"c{i}") * F.col(f"c{j}") / (n * n) / d).otherwise(0.0)
            part.append(F.sum(F.col(f"a{i}_{j}") / n - removed).alias(f"a{i}_{j}"))
        for i in range(width):
            part.append(F.sum(F.col(f"r{i}") / n - F.when(free, F.col(f"c{i}") / n * g / d).otherwise(0.0)).alias(f"r{i}"))
        total = zones.agg(*part).first()
        matrix = np.array([[total[f"a{min(i, j)}_{max(i, j)}"] for j in range(width)] for i in range(width)])
        side = np.array([total[f"r{i}"] for i in range(width)]) + penalty * beta
        objective = total["loss"] / n + (penalty @ beta**2 + alpha * total["square"]) / 2
        return zones, objective, matrix + np.diag(penalty), side

    zones, objective, matrix, side = state(effects, beta)
    steps = 0
    for steps in range(1, max_iter + 1):  # noqa: B007
        step = np.linalg.lstsq(matrix, side, rcond=None)[0]
        own = F.col("g") / n + alpha * F.col("effect")
        cross = sum((F.col(f"c{i}") / n * float(s) for i, s in enumerate(step)), F.lit(0.0))
        move = F.when(free, (own - cross) / (F.col("d") / n + alpha)).otherwise(0.0)
        # What the step promises: half of gradient times step, over zones and columns.
        gained = zones.agg(F.sum(move * (own - cross))).first()[0] + float(step @ side)
        size, moved = 1.0, None
        for _ in range(HALVINGS):
            tried = zones.select(ZONE, (F.col("effect") - size * move).alias("effect"))
            found = state(tried, beta - size * step)
            if math.isfinite(found[1]) and found[1] <= objective + 1e-12 * abs(objective):
                moved = cut_lineage(tried)
                break
            release(found[0])
            size /= 2
        if moved is None:
            break
        old = (zones, effects)
        effects, beta = moved, beta - size * step
        zones, objective, matrix, side = found
        release(*old)
        if gained / 2 <= tolerance * max(1.0, abs(objective)):
            break
    release(zones, rows)
    return PoissonRegressionModel(Fitted(float(beta[0]), [float(b) for b in beta[1:]], effects, steps, float(objective)), numeric)
