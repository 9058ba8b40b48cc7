import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from furlong.operators.bundle import Family, bundled, grouped, ranked


def frame(spark, n=60):
    rows = [(i, f"k{i % 3}" if i % 7 else None, f"m{i % 2}", float(i % 5) if i % 11 else None, "wide") for i in range(n)]
    return spark.createDataFrame(rows, "i long, k string, m string, v double, other string")


def running(*keys):
    return F.sum("v").over(Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, -1))


def test_columns_equal_plain_windows_and_null_keys_stay_out(spark):
    df = frame(spark)
    families = [Family(("k",), {"a": running("k")}, ("i", "v")), Family(("k", "m"), {"b": running("k", "m")}, ("i", "v")), Family(("k",), {"c": F.count(F.lit(1)).over(Window.partitionBy("k"))}, ())]
    got = {r.i: r for r in bundled(df, "i", families).collect()}
    want = df.select("*", running("k").alias("a"), running("k", "m").alias("b"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("c")).collect()
    assert len(got) == len(want) == 60
    for r in want:
        assert (got[r.i].a, got[r.i].b, got[r.i].c) == ((r.a, r.b, r.c) if r.k is not None else (None, None, None))
        assert (got[r.i].v, got[r.i].other) == (r.v, r.other)
    assert bundled(df.where("false"), "i", families).count() == 0


def test_families_of_one_partitioning_are_one(spark):
    one = Family(("k", "m"), {"a": F.lit(1)}, ("v",))
    two = Family(("m", "k"), {"b": F.lit(2)}, ("v", "i"))
    (both,) = grouped([one, two])
    assert set(both.columns) == {"a", "b"} and both.needs == ("v", "i")
    with pytest.raises(ValueError, match="named twice"):
        grouped([one, one])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_a_partitioning_shuffles_once_and_narrow(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        families = [Family(("k",), {"a": running("k"), "c": F.sum("v").over(Window.partitionBy("k", "m"))}, ("i", "v", "m")), Family(("m",), {"b": running("m")}, ("i", "v"))]
        text = plan(bundled(frame(spark), "i", families))
        assert len(re.findall(r"Exchange hashpartitioning\(k#", text)) == 1 and len(re.findall(r"Exchange hashpartitioning\(m#", text)) == 1
        assert len(re.findall(r"Exchange hashpartitioning\(i#", text)) == 3  # the wide rows once, each result once
        columns = ["v", *[f"x{j}" for j in range(74)]]
        wide = frame(spark).select("i", "k", "v", *[(F.col("v") * j).alias(f"x{j}") for j in range(74)])
        assert plan(ranked(wide, "i", "k", columns)).count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", 5.0, None), (2, "a", 7.0, None), (3, "a", 5.0, 1.0), (4, "a", None, 2.0), (5, "b", None, 0.0), (6, None, 9.0, 9.0)], "i long, k string, x double, y double")
    got = {r.i: (r.x_rank, r.y_rank) for r in ranked(df, "i", "k", ["x", "y"]).collect()}
    assert got == {1: (2, 3), 2: (1, 3), 3: (2, 2), 4: (4, 1), 5: (1, 1)}
