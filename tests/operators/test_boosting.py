import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from furlong.operators import boosting as B


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    said = []
    for i in range(1200):
        a, b = rng.random(), rng.choice([None, rng.random()])
        said.append((i, a, b, (10.0 if a > 0.5 else 0.0) + (2.0 if b and b > 0.3 else 0.0) + rng.gauss(0, 1), i % 4))
    return spark.createDataFrame([*said, (5000, 0.9, 0.9, None, 0), (5001, None, float("nan"), None, 3)], "id long, a double, b double, y double, part int").cache()


def test_stops_at_the_best_round(rows):
    wide = B.with_vector(rows, ["a", "b"]).withColumn("held", F.col("part") == 3).where("y is not null")
    model = B.stopped(wide, "y", "held", depth=4, trees=20, step=0.5)
    whole = GBTRegressor(featuresCol="features", labelCol="y", maxDepth=4, maxIter=20, stepSize=0.5, minInstancesPerNode=5, seed=42).fit(wide.where("not held"))
    losses = whole.evaluateEachIteration(wide.where("held"), "squared")
    best, at = losses[0], 1
    for m, now in enumerate(losses[1:], 2):
        if best - now < 0.01 * max(now, 0.01):
            break
        if now < best:
            best, at = now, m
    assert model.getNumTrees == at < 20


def test_blend_is_the_mean_of_its_models(rows):
    out, rounds = B.blend(rows, ["a", "b"], "y", F.col("part") < 3, F.col("part") == 3, depths=(2, 4), trees=8, step=0.5)
    assert set(rounds) == {("squared", 2), ("squared", 4), ("absolute", 2), ("absolute", 4)} and all(1 <= n <= 8 for n in rounds.values())
    assert out.columns == [*rows.columns, "predicted"] and out.count() == rows.count() and out.where("predicted is null").count() == 0
    wide = B.with_vector(rows, ["a", "b"]).withColumn("held", F.col("part") == 3)
    sums = {}
    for loss, depth in rounds:
        model = B.stopped(wide.where("y is not null"), "y", "held", loss, depth, 8, 0.5)
        for r in model.transform(wide).select("id", "_predicted").collect():
            sums[r.id] = sums.get(r.id, 0) + r._predicted / 4
    assert all(r.predicted == pytest.approx(sums[r.id], abs=1e-6) for r in out.select("id", "predicted").collect())
    error = out.where("part = 3 and y is not null").agg(F.avg(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    assert error < 1.3


def test_needs_both_kinds_of_rows(rows):
    with pytest.raises(ValueError):
        B.blend(rows, ["a"], "y", F.col("part") < 3, F.lit(False))
