"""Learned figures: features, target encodings from earlier rows, a blend of boosted trees, a one-sided stretch of the top."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import allowances
from ..operators.calibrate import stretched
from ..operators.shrink import target_encoding
from ..sources.staging import written


@dataclass(frozen=True)
class Plan:
    features: tuple[str, ...]
    encode: tuple[tuple[str, ...], ...]  # keys whose mean target is a feature
    target: str
    train_until: int  # the last year of training
    trees: int = 50
    depth: int = 5
    step: float = 0.1
    missing: float = -999.0
    thresholds: tuple[float, ...] = (60.0, 70.0, 80.0, 90.0)
    shares: tuple[float, ...] = tuple(i / 50 for i in range(40))


def sample_weight(y: Column) -> Column:
    """More weight for high targets, less for low ones."""
    return F.when(y < 40, 0.7).otherwise(1 + F.least(F.greatest((y - 60) / 20, F.lit(0.0)), F.lit(3.0)))


def prepared(rows: DataFrame, plan: Plan, year: str = "year") -> DataFrame:
    """rows with the feature vector; encodings see training rows alone, missing numbers get a value of their own."""
    train = (F.col(year) <= plan.train_until) & F.col(plan.target).isNotNull()
    names = []
    for keys in plan.encode:
        name = "enc_" + "_".join(keys)
        rows = target_encoding(rows, list(keys), F.col(plan.target), train, name)
        names.append(name)
    filled = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(plan.missing)).alias(f"f_{c}") for c in plan.features]
    wide = rows.select("*", *filled)
    return VectorAssembler(inputCols=[f"f_{c}" for c in plan.features] + names, outputCol="features").transform(wide).drop(*[f"f_{c}" for c in plan.features])


def fit_predict(rows: DataFrame, plan: Plan, year: str = "year", name: str = "predicted") -> DataFrame:
    """rows with the mean prediction of trees for squared and for absolute error, the top stretched by the grid point that errs least on the last training year.

    Training needs at least one row; what is fitted on is written once, as every boosting round reads it."""
    wide = written(prepared(rows, plan, year), "features")
    train = wide.where((F.col(year) <= plan.train_until) & F.col(plan.target).isNotNull()).withColumn("_w", sample_weight(F.col(plan.target)))
    out = wide
    for loss in ("squared", "absolute"):
        model = GBTRegressor(featuresCol="features", labelCol=plan.target, weightCol="_w", predictionCol=f"_{loss}", lossType=loss, maxIter=plan.trees, maxDepth=plan.depth, stepSize=plan.step, subsamplingRate=0.8, minInstancesPerNode=5, seed=42).fit(train)
        out = model.transform(out)
    blended = out.withColumn("_blend", (F.col("_squared") + F.col("_absolute")) / 2).drop("_squared", "_absolute", "features")
    threshold, share = best_stretch(blended.where((F.col(year) == plan.train_until) & F.col(plan.target).isNotNull()), "_blend", plan.target, plan.thresholds, plan.shares)
    return blended.withColumn(name, stretched(F.col("_blend"), threshold, share)).drop("_blend")


def best_stretch(rows: DataFrame, x: str, y: str, thresholds: Sequence[float], shares: Sequence[float], top: float = 0.85) -> tuple[float, float]:
    """The threshold and share of least mean error on the top of the targets; ties go to the smaller ones. One pass, one row comes back."""
    cut = rows.agg(F.percentile(y, top).alias("cut")).first()["cut"]
    if cut is None:
        return float("inf"), 0.0
    grid = [(t, s) for t in sorted(thresholds) for s in sorted(shares)]
    errors = rows.where(F.col(y) >= cut).agg(*[F.avg(F.abs(stretched(F.col(x), t, s) - F.col(y))).alias(f"e{i}") for i, (t, s) in enumerate(grid)]).first()
    return min(zip(grid, errors, strict=True), key=lambda g: (round(g[1], 9), g[0]))[0]


def age_points(text: Column, own: Column) -> Column:
    """Pounds that a runner gets by a text's allowances: the largest of the race less its own; ages beyond the oldest get nothing, younger ones what the youngest gets."""
    table = allowances(text)
    ages, most = F.map_keys(table), F.array_max(F.map_values(table))
    exact = F.try_element_at(table, own)
    youngest = F.try_element_at(table, F.array_min(ages))
    return F.when(F.size(table) == 0, None).when(exact.isNotNull(), most - exact).when(own > F.array_max(ages), F.lit(0)).when(own < F.array_min(ages), most - youngest)
