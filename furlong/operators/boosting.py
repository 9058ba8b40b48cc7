"""Boosted trees that stop by a held-out loss, and the mean of several of them.

Rows to fit on and rows to stop by are told apart by columns; both are written once with their feature vector, as every round reads them. A model
adds trees until the loss of the held-out rows no longer falls by a share of itself, and keeps those up to its best round. The blend averages a model for each
loss and depth. Missing features get a value of their own.

Training needs a row to fit on and one to stop by, else ValueError. Rows without target are predicted only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import written


def with_vector(rows: DataFrame, features: Sequence[str], missing: float = -999.0, name: str = "features") -> DataFrame:
    """rows with the vector of their features; null and NaN become the missing value."""
    filled = {f"_f_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(missing)) for c in features}
    wide = rows.withColumns(filled)
    return VectorAssembler(inputCols=list(filled), outputCol=name).transform(wide).drop(*filled)


def stopped(rows: DataFrame, target: str, held_out: str, loss: str = "squared", depth: int = 5, trees: int = 50, step: float = 0.1, tolerance: float = 0.01, weight: str | None = None, seed: int = 42) -> GBTRegressionModel:
    """A model of the rows where held_out is false, stopped by those where it is true. rows have a features vector."""
    weights = {"weightCol": weight} if weight else {}
    return GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="_predicted", lossType=loss, maxDepth=depth, maxIter=trees, stepSize=step, validationIndicatorCol=held_out, validationTol=tolerance, minInstancesPerNode=5, seed=seed, **weights
    ).fit(rows)


def blend(rows: DataFrame, features: Sequence[str], target: str, fit: Column, stop: Column, losses: Sequence[str] = ("squared", "absolute"), depths: Sequence[int] = (4, 6), trees: int = 50, step: float = 0.1, tolerance: float = 0.01, name: str = "predicted") -> tuple[DataFrame, dict[tuple[str, int], int]]:
    """rows with the mean prediction of a model for each loss and depth, and how many trees each has."""
    no = F.lit(False)
    marked = rows.withColumn("_stop", F.coalesce(stop, no) & F.col(target).isNotNull()).withColumn("_fit", F.coalesce(fit, no) & F.col(target).isNotNull() & ~F.col("_stop"))
    wide = written(with_vector(marked, features), "boosting")
    known = wide.where("_fit or _stop")
    if known.select("_stop").distinct().count() < 2:
        raise ValueError("needs rows to fit on and rows to stop by")
    out, rounds, parts = wide, {}, []
    for loss in losses:
        for depth in depths:
            model = stopped(known, target, "_stop", loss, depth, trees, step, tolerance)
            rounds[loss, depth] = model.getNumTrees
            parts.append(f"_{loss}_{depth}")
            out = model.setPredictionCol(parts[-1]).transform(out)
    return out.withColumn(name, sum([F.col(p) for p in parts[1:]], F.col(parts[0])) / len(parts)).drop("features", "_fit", "_stop", *parts), rounds
