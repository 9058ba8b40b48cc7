import random

from pyspark.sql import functions as F

from furlong.plans import learned as L


def test_learned_figures_beat_the_mean_out_of_sample(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        a, key = rng.uniform(0, 1), rng.choice("xyz")
        rows.append((i, 2020 + i % 4, a if rng.random() > 0.05 else None, key, 40 + 40 * a + {"x": 0, "y": 8, "z": -8}[key] + rng.gauss(0, 2)))
    plan = L.Plan(("a",), (("key",),), "y", 2022, trees=10, depth=3, step=0.3)
    out = L.fit_predict(spark.createDataFrame(rows, "i int, year int, a double, key string, y double"), plan)
    held = out.where("year = 2023")
    error, spread = held.agg(F.avg(F.abs(F.col("predicted") - F.col("y"))), F.stddev("y")).first()
    assert out.count() == 1500 and error < 0.5 * spread


def test_stretch_is_the_best_of_its_grid(spark):
    rows = spark.createDataFrame([(float(x), float(x) if x <= 70 else 70 + 1.2 * (x - 70)) for x in range(40, 101)], "x double, y double")
    assert L.best_stretch(rows, "x", "y", (60.0, 70.0, 80.0), (0.0, 0.1, 0.2, 0.3)) == (70.0, 0.2)
    assert L.best_stretch(rows.limit(0), "x", "y", (60.0,), (0.0,)) == (float("inf"), 0.0)


def test_age_points(spark):
    text = "TWFA 3 9-2 TWFA 4 10-0"
    rows = spark.createDataFrame([(text, 3), (text, 4), (text, 7), (text, 2), ("", 3)], "t string, age int")
    assert [r[0] for r in rows.select(L.age_points(F.col("t"), F.col("age"))).collect()] == [12, 0, 0, 12, None]
