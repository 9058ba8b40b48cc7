import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from furlong.functions import columns as C
from furlong.functions import text as T
from furlong.operators import calibrate, interpolate, robust
from furlong.sources import cards, results


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i").select(column).collect()]


def test_margins(spark):
    said = ["nk", " SHD ", "1.5", "2nk", "2 nk", "dist", "abc", None, "dht", "3", "", "0", "hd", "snk", "sht-hd", ".5", "-1.5", "."]
    assert values(spark, [(s,) for s in said], "x string", T.margin(F.col("x"))) == [0.2, 0.1, 1.5, 2.2, 2.2, 30.0, None, 0.0, 0.0, 3.0, 0.0, 0.0, 0.15, 0.2, 0.15, 0.5, -1.5, None]
    said = ["1 L 1/2", "3/4 L", "CTE TETE", "ENC", "NEZ", "LOIN", "2 L", "xyz", None, "Tête", "1.5", "CT", "TTE", "2/3", "1/3 L", "nk", "TETE A"]
    assert values(spark, [(s,) for s in said], "x string", T.french_margin(F.col("x"))) == [1.5, 0.75, 0.05, 0.25, 0.03, 30.0, 2.0, None, 0.0, 0.1, 1.5, 0.05, 0.1, 0.67, 0.33, 0.25, None]


def test_columns(spark):
    assert values(spark, [("1.5",), ("x",), ("NaN",), (None,), ("",)], "x string", C.number("x")) == [1.5, None, None, None, None]
    assert values(spark, [(0.0,), (1.0,), (1.5,), (9.0,), (None,)], "x double", C.binned(F.col("x"), [0, 1, 3], "other")) == ["other", "0-1", "1-3", "other", "other"]
    assert values(spark, [(2.5,), (3.5,), (-0.5,)], "x double", C.half_even(F.col("x"))) == [2.0, 4.0, 0.0]
    days = values(spark, [("2024-02-01",), ("01/02/2024",), ("1/2/2024",), ("soon",), (None,)], "x string", C.any_date(F.col("x")).cast("string"))
    assert days == ["2024-02-01"] * 3 + [None, None]
    assert values(spark, [("a", 1), (None, 1)], "a string, b int", C.key("a", "b")) == ["a_1", None]


def test_allowances_and_classes(spark):
    assert values(spark, [("TWFA 3 9-2 TWFA 4 10-0",), ("none",), (None,)], "x string", T.allowances(F.col("x"))) == [{3: 128, 4: 140}, {}, None]
    rows = [("Prix Group I", 1), ("Prix X (LISTEE)", 1), ("GR. I", 1), ("A RECLAMER", 1), ("x", 60000), ("x", 100), (None, None)]
    assert values(spark, rows, "n string, p int", T.race_class(F.col("n"), F.col("p"))) == [1, 2, 1, 6, 3, 7, 7]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 100), st.integers(0, 100)), min_size=2, max_size=12, unique_by=lambda p: p[0]))
def test_monotone_cubic_goes_through_its_points_and_keeps_their_order(points):
    points = sorted((float(a), float(b)) for a, b in points)
    points = [(x, y) for (x, _), y in zip(points, sorted(y for _, y in points), strict=True)]
    pieces = calibrate.monotone_cubic(points)

    def at(x):
        start, *c = [p for p in pieces if p[0] <= x][-1]
        return sum(k * (x - start) ** i for i, k in enumerate(c))

    assert all(abs(at(x) - y) < 1e-6 for x, y in points[:-1])
    grid = [at(x) for x in np.linspace(points[0][0], points[-1][0] - 1e-9, 60)]
    assert all(b >= a - 1e-6 for a, b in zip(grid, grid[1:], strict=False))


def test_piecewise_column(spark):
    pieces = calibrate.monotone_cubic([(0.0, 0.0), (1.0, 2.0), (3.0, 3.0)])
    got = values(spark, [(0.0,), (1.0,), (3.0,), (None,), (0.5,)], "x double", calibrate.piecewise(F.col("x"), pieces))
    assert got[:4] == [0.0, 2.0, pytest.approx(3.0), None] and 0 < got[4] < 2
    assert values(spark, [(5.0,)], "x double", calibrate.piecewise(F.col("x"), calibrate.monotone_cubic([(1.0, 7.0)]))) == [7.0]


def test_interpolation_edges(spark):
    known = interpolate.curves(spark.createDataFrame([("a", 5.0, 10.0), ("a", 10.0, 20.0), ("b", 5.0, 1.0)], "k string, x double, y double"), ["k"], "x", "y")
    rows = spark.createDataFrame([("a", 7.5), ("a", 1.0), ("a", 10.4), ("a", 11.0), ("b", 9.0), ("c", 5.0), ("a", None)], "k string, d double")
    got = {(r.k, r.d): (r.v, r.g) for r in interpolate.join_at(interpolate.join_at(rows, known, ["k"], "d", "v"), known, ["k"], "d", "g", 0.05).collect()}
    assert got == {("a", 7.5): (15.0, 15.0), ("a", 1.0): (10.0, None), ("a", 10.4): (20.0, 20.0), ("a", 11.0): (20.0, None), ("b", 9.0): (1.0, None), ("c", 5.0): (None, None), ("a", None): (None, None)}


def test_robust_edges(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 100.0), ("b", 5.0), ("c", 1.0), ("c", 3.0), ("d", None)]
    got = {r.k: r for r in robust.winsorized(spark.createDataFrame(rows, "k string, x double"), ["k"], "x").collect()}
    assert (got["a"].winsor_mean, got["a"].winsor_median) == (2.5, 2.5) and math.isclose(got["a"].winsor_se, np.std([2, 2, 3, 3], ddof=1) / 2)
    assert (got["b"].winsor_mean, got["b"].winsor_se) == (5.0, None) and got["c"].winsor_mean == 2.0 and "d" not in got


def test_cards(spark):
    doc = '{"programme":{"reunions":[{"numOfficiel":1,"hippodrome":{"code":"LON"},"pays":"FRA","courses":[{"numOrdre":2,"discipline":"PLAT","distance":1600,"penetrometre":{"intitule":"Bon"},"dureeCourse":95000},{"numOrdre":3,"discipline":"HAIE"}]}]}}'
    races = cards.races(spark.createDataFrame([("2024-01-01", doc), ("2024-01-02", "{}"), ("2024-01-03", None)], "day string, doc string")).collect()
    assert [(r.day, r.meeting_no, r.course, r.country, r.race_no, r.distance_m, r.going, r.winner_time_s) for r in races] == [("2024-01-01", 1, "LON", "FRA", 2, 1600, "Bon", 95.0)]
    runner = '{"nom":"X","numPmu":3,"ordreArrivee":1,"tempsObtenu":13422,"handicapPoids":580,"distanceChevalPrecedent":{"libelleCourt":"1 L"},"dernierRapportDirect":{"rapport":4.2}}'
    row = cards.runners(spark.createDataFrame([(1, runner)], "race_id int, doc string")).first()
    assert (row.race_id, row.horse_name, row.time_seconds, row.weight_kg, row.beaten_lengths, row.odds, row.age) == (1, "X", 94.22, 58.0, "1 L", 4.2, None)


def test_ingest_is_repeatable_and_files_have_years(spark, tmp_path):
    new = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert cards.not_yet_stored(new, spark.createDataFrame([(2, "z")], "k int, v string"), ["k"]).collect() == [(1, "a")]
    (tmp_path / "results_2021.csv").write_text("course,time\nA,60.5\n")
    (tmp_path / "results_2022.csv").write_text("course,time\nB,bad\n")
    rows = results.yearly_csv(spark, f"{tmp_path}/results_*.csv", "course string, time double").orderBy("source_year").collect()
    assert [(r.course, r.time, r.source_year) for r in rows] == [("A", 60.5, 2021), ("B", None, 2022)]
    assert results.first_existing(spark, [f"{tmp_path}/none.csv", f"{tmp_path}/results_2021.csv"]) == f"{tmp_path}/results_2021.csv"
    results.write_csv(spark.createDataFrame([("A", 1.23456, None)], "c string, x double, y double"), f"{tmp_path}/out", ["c", "x", "y", "z"])
    assert spark.read.csv(f"{tmp_path}/out", header=True).collect() == [("A", "1.2346", None)]
