import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from furlong.operators import prefix, ranks, robust

SCHEMA = "k string, x double, tie long, other int"


def rows():
    rng = random.Random(6)
    out = []
    for i in range(3000):
        k = rng.choice(["hot"] * 6 + ["even", "ties", None, "far", "one"])
        x = {"hot": rng.gauss(0, 1), "even": float(rng.randint(0, 9)), "ties": 5.0, "far": 10.0 ** rng.randint(-300, 300), "one": rng.random(), None: rng.choice([None, 1.5, -2.0])}[k]
        out.append((k, x, i, 0))
    return out + [("lone", 3.0, 9001, 0), ("empty", None, 9002, 0), ("two", 1.0, 9003, 0), ("two", 2.0, 9004, 0)] + [("hot", 0.25, 9100 + i, 0) for i in range(400)]


def groups(said):
    found = {}
    for k, x, *_ in said:
        if x is not None:
            found.setdefault(k, []).append(x)
    return found


@pytest.mark.parametrize("bins, most", [(1024, 1_000_000), (16, 60)])
def test_percentiles(spark, bins, most):
    said, shares = rows(), [0.0, 0.01, 0.25, 0.5, 0.777, 1.0]
    df = spark.createDataFrame(said, SCHEMA).repartition(5)
    found = {r.k: r for r in ranks.percentiles(df, ["k"], "x", shares, bins=bins, most=most).collect()}
    want = groups(said)
    assert found.keys() == want.keys()
    for k, xs in want.items():
        assert found[k].n == len(xs)
        assert np.allclose(found[k].percentiles, np.percentile(xs, [100 * s for s in shares], method="linear"), rtol=1e-12, atol=0)


def test_odd_numbers_and_no_keys(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(x,) for x in [inf, -inf, nan, 1.0, 2.0, -1e308, 1e308, None]], "x double")
    at = ranks.percentiles(df, [], "x", [i / 6 for i in range(7)], bins=2, most=1).first()
    assert at.n == 7 and [str(v) for v in at.percentiles] == [str(v) for v in [-inf, -1e308, 1.0, 2.0, 1e308, inf, nan]]
    assert ranks.percentiles(df.where("false"), [], "x", [0.5]).count() == 0


def test_trimmed_medians(spark):
    said = rows()
    df = spark.createDataFrame(said, SCHEMA)
    for r in ranks.medians(df, ["k"], "x", trim=0.1).collect():
        xs = sorted(groups(said)[r.k])
        cut = math.floor(len(xs) * 0.1)
        cut = 0 if len(xs) - 2 * cut < 3 else cut
        assert r.median == pytest.approx(float(np.median(xs[cut : len(xs) - cut])))


@pytest.mark.parametrize("k, bins, most", [(4, 1024, 1_000_000), (7, 16, 60), (1, 16, 60)])
def test_ntiles_equal_the_window(spark, k, bins, most):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    known = df.where("x is not null")
    want = known.withColumn("tile", F.ntile(k).over(Window.partitionBy("k").orderBy("x", "tie")))
    out = ranks.ntiles(df, ["k"], "x", "tie", k, "tile", bins=bins, most=most)
    assert {(r.tie, r.tile) for r in out.where("x is not null").collect()} == {(r.tie, r.tile) for r in want.collect()}
    assert out.count() == df.count() and out.where("x is null and tile is not null").count() == 0


def test_no_task_holds_a_hot_key(spark):
    """One key with nearly all rows: after the histogram no task reads more than a few rows for each bin, and the second look reads one bin."""
    df = spark.range(200_000).select(F.when(F.col("id") % 1000 == 0, "cold").otherwise("hot").alias("k"), F.rand(3).alias("x"), F.col("id").alias("tie"), F.lit(0).alias("other"))
    plan = ranks.medians(df, ["k"], "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect_list" in plan
    assert ranks.medians(df, ["k"], "x").where("k = 'hot'").first().median == pytest.approx(df.where("k = 'hot'").agg(F.median("x")).first()[0])


@pytest.mark.parametrize("inclusive", [False, True])
def test_running_sums_equal_the_window(spark, inclusive):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    w = Window.partitionBy("k").orderBy("tie").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = df.select("tie", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("s"), F.count("x").over(w).alias("n"))
    plain = df.withColumn("x", F.when(F.abs("x") < 1e9, F.col("x")))
    want = plain.select("tie", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("s"), F.count("x").over(w).alias("n"))
    out = prefix.running(plain, ["k"], ["tie"], {"s": F.col("x"), "n": F.col("x").isNotNull().cast("long")}, inclusive, segments=7)
    assert out.columns == [*plain.columns, "s", "n"]
    got, want = ({r.tie: r for r in d.collect()} for d in (out, want))
    assert got.keys() == want.keys()
    for tie, r in want.items():
        assert got[tie].n == r.n and got[tie].s == pytest.approx(r.s, abs=1e-9)


def test_a_hot_key_is_cut_into_segments(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("k"), F.col("id").alias("tie"), F.lit(1.0).alias("x"))
    seen = {}
    real = prefix.written
    try:
        prefix.written = lambda d, name: seen.setdefault(name, real(d, name))
        out = prefix.running(df, ["k"], ["tie"], {"s": F.col("x")}, segments=10)
        assert out.where("k = 'hot'").agg(F.max("s")).first()[0] == 49_499
    finally:
        prefix.written = real
    sizes = [r["count"] for r in seen["segments"].groupBy("k", "_segment").count().where("k = 'hot'").collect()]
    assert len(sizes) >= 8 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_weighted_medians(spark):
    rng = random.Random(2)
    said = [(rng.choice("ab"), float(rng.randint(0, 20)), rng.random(), i) for i in range(500)] + [("c", None, 1.0, 1000), ("c", 2.0, None, 1001), ("d", 4.0, 1.0, 1002)]
    out = {r.k: r.weighted_median for r in prefix.weighted_medians(spark.createDataFrame(said, "k string, x double, w double, tie long"), ["k"], "x", "w", "tie", segments=5).collect()}
    for k in "ab":
        mine = sorted((x, t, w) for g, x, w, t in said if g == k)
        run, half = 0.0, sum(w for *_, w in mine) / 2
        for x, _, w in mine:
            run += w
            if run >= half - 1e-9:
                break
        assert out[k] == x
    assert out["d"] == 4.0 and "c" not in out


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ranks.ntiles(none, ["k"], "x", "tie", 4, "tile").count() == 0
    assert prefix.running(none, ["k"], ["tie"], {"s": F.col("x")}).count() == 0


def test_winsorized_large_equals_winsorized(spark):
    rng = random.Random(3)
    said = [(rng.choice(["a", "b", None]), rng.choice([1000.0, 1000.5, 1000 + rng.random()])) for _ in range(200)]
    said += [("one", 5.0), ("pair", 1.0), ("pair", 4.0), ("three", 1.0), ("three", 2.0), ("three", 9.0), ("same", 7.0), ("same", 7.0), ("same", 7.0), ("tie", 1.0), ("tie", 1.0), ("tie", 2.0), ("none", None)]
    df = spark.createDataFrame([(k, x, 1) for k, x in said], "k string, x double, n int").repartition(3)
    small, large = ({r.k: r for r in f(df, ["k"], "x").collect()} for f in (robust.winsorized, robust.winsorized_large))
    assert small.keys() == large.keys() and "none" not in large
    for k, r in small.items():
        assert large[k].n == r.n and large[k].winsor_mean == pytest.approx(r.winsor_mean, abs=1e-9) and large[k].winsor_median == pytest.approx(r.winsor_median, abs=1e-9)
        assert (large[k].winsor_se is None) == (r.winsor_se is None) and (r.winsor_se is None or large[k].winsor_se == pytest.approx(r.winsor_se, abs=1e-7))
