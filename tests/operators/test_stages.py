import datetime as dt

import pytest
from pyspark.sql import functions as F

from furlong.operators import stages as S

SCHEMA = "i int, k string, m string, x double, f double, y double"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def run(df, *stages):
    rows, tables = S.fitted(df, stages)
    assert rows.columns == df.columns
    return [r.f for r in rows.orderBy("i").collect()], tables


def test_offsets_shrink_clip_and_skip(spark):
    df = frame(spark, [("a", "p", 0.0, 10.0, 14.0), ("a", "p", 0.0, 10.0, 16.0), ("b", "p", 0.0, 0.0, 50.0), ("c", "q", 0.0, 1.0, None), (None, "q", 0.0, 2.0, 9.0), ("a", "p", 0.0, None, 9.0)])
    got, tables = run(df, S.offsets("o", "f", "y", {"k": "k"}, 2.0, clip=5.0).on(F.col("y").isNotNull() & F.col("f").isNotNull()))
    assert got == [12.5, 12.5, 5.0, 1.0, 2.0, None]  # (4 + 6) / 4; clipped; no table row; a null key; no figure
    assert run(df, S.offsets("o", "f", "y", {"k": "k"}, 2.0, least=2))[0][:3] == [12.5, 12.5, 0.0]
    assert run(df, S.offsets("o", "f", "y", {"m": "m", "k": "k"}, 0.0, within=("m", 4)))[0] == [10.0, 10.0, 0.0, 1.0, 2.0, None]  # p holds three rows with both, q one
    assert run(df, S.offsets("o", "f", "y", {"k": "k"}, 2.0, where=F.col("i") == 0))[0][:2] == [12.5, 10.0]
    again = S.applied(df, [S.offsets("o", "f", "y", {"k": "k"}, 2.0, clip=5.0), S.offsets("not there", "f", "y", {"k": "k"}, 0.0)], tables)
    assert [r.f for r in again.orderBy("i").collect()] == got


def test_stages_follow_one_another(spark):
    df = frame(spark, [("a", m, 0.0, 0.0, y) for m, y in (("p", 1.0), ("p", 3.0), ("q", 5.0), ("q", 11.0))])
    got, tables = run(df, S.offsets("first", "f", "y", {"k": "k"}, 0.0), S.offsets("second", "f", "y", {"m": "m"}, 0.0))
    assert got == [2.0, 2.0, 8.0, 8.0] and set(tables) == {"first", "second"}
    assert {r._key_m: r.offset for r in tables["second"].collect()} == {"p": -3.0, "q": 3.0}


def test_slopes_and_rescale(spark):
    df = frame(spark, [("a", "", float(v), 0.0, 3.0 * v) for v in range(-2, 3)] + [("b", "", 1.0, 0.0, 5.0)])
    got, _ = run(df, S.slopes("s", "f", "y", {"k": "k"}, "x", 3))
    assert got == pytest.approx([-6.0, -3.0, 0.0, 3.0, 6.0, 0.0], abs=1e-5)
    line = frame(spark, [("a", "", 0.0, float(v), 2.0 * v + 1) for v in range(10)] + [("b", "", 0.0, float(v), v * 1.01) for v in range(10)] + [("c", "", 0.0, 1.0, 9.0)])
    got, tables = run(line, S.rescale("r", "f", "y", {"k": "k"}, least=5))
    assert got == pytest.approx([2.0 * v + 1 for v in range(10)] + [float(v) for v in range(10)] + [1.0])
    assert [r._key_k for r in tables["r"].collect()] == ["a"]  # b is closer to 1 than 0.02, c too thin


def test_curves_choose_the_parabola_where_it_pays(spark):
    rows = [("a", "", 0.0, float(v), float(v * v)) for v in range(-20, 21)] + [("b", "", 0.0, float(v), 3.0 * v - 1) for v in range(41)] + [("c", "", 0.0, 7.0, 1.0)]
    got, tables = run(frame(spark, rows), S.curves("c", "f", "y", {"k": "k"}, least=40))
    assert got == pytest.approx([r[4] for r in rows[:-1]] + [7.0], abs=1e-6)
    assert {r._key_k: r.curved for r in tables["c"].collect()}["a"]


def test_quantiles_map_one_distribution_onto_another(spark):
    rows = [("a", "", 0.0, float(v), 10.0 * v + 5) for v in range(101)] + [("b", "", 0.0, 3.0, 9.0)]
    stage = S.quantiles("q", "f", "y", {"k": "k"}, [i / 10 for i in range(11)], least=100)
    got, tables = run(frame(spark, rows), stage)
    assert got == pytest.approx([r[4] for r in rows[:-1]] + [3.0]) and tables["q"].count() == 11
    beyond = frame(spark, [("a", "", 0.0, 500.0, None), ("a", "", 0.0, None, None)])
    assert [r.f for r in S.applied(beyond, [stage], tables).orderBy("i").collect()] == [1005.0, None]


def test_empty_tables_and_clashing_names(spark):
    df = frame(spark, [("a", "", 1.0, 2.0, 3.0)]).withColumn("offset", F.lit(dt.date(2020, 1, 1))).withColumn("n", F.lit("kept"))
    stages = [S.curves("c", "f", "y", {"k": "k"}), S.offsets("o", "f", "y", {"k": "k"}, 1.0), S.slopes("s", "f", "y", {"k": "k"}, "x", 0), S.rescale("r", "f", "y", {"k": "k"}), S.quantiles("q", "f", "y", {"k": "k"}, [0.0, 1.0])]
    rows, tables = S.fitted(df.where("false"), [s.on(F.col("y") > 0) for s in stages])
    assert rows.count() == 0 and all(t.count() == 0 for t in tables.values())
    (row,) = S.applied(df, stages, tables).collect()
    assert (row.f, row.n, row.offset) == (2.0, "kept", dt.date(2020, 1, 1))
