import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.plans import figures as G

SCHEMA = "race_id string, meeting_id string, day date, course string, surface string, distance double, going string, race_no int, position int, winner_time double, beaten double, weight double, age int, horse string, race_class int, target double"


def season(spark, seed=1, unit=1.0, scale=1.0):
    """Meetings at two courses whose true standards and allowances are known."""
    rng = random.Random(seed)
    rows, truth = [], {}
    pace = {"A": 12.0, "B": 12.4}
    for d in range(60):
        day = dt.date(2023, 1, 1) + dt.timedelta(days=d)
        for course in "AB":
            ga = rng.choice([0.0, 0.1, 0.3])
            meeting = f"{day}_{course}_Turf"
            truth[meeting] = ga
            for no in range(1, 7):
                f = rng.choice([5.0, 6.0, 8.0])
                quality = rng.gauss(0, 0.05)
                time = f * (pace[course] + 0.1 * (f - 5) + ga + quality * 0.1)
                race = f"{meeting}_{no}"
                for p in range(1, 6):
                    rows.append((race, meeting, day, course, "Turf", f * unit, "Good" if ga < 0.2 else "Soft", no, p, time, 1.5 * (p - 1), 126.0 + p, 3 + p % 3, f"h{rng.randint(0, 200)}", 4, 60.0 - p))
    rows.append(("bad", "2023-01-01_A_Turf", dt.date(2023, 1, 1), "A", "Turf", None, None, 9, None, None, None, None, None, "x", None, None))
    return spark.createDataFrame(rows, SCHEMA), truth


@pytest.mark.parametrize("settings", [G.Settings(passes=2), G.Settings(unit=G.METRES, class_per_furlong=0.0, trim=0.05, passes=2)])
def test_estimates_recover_differences_of_going(spark, settings):
    runners, truth = season(spark, unit=settings.unit)
    known, going = G.estimate(runners, settings)
    assert {(r.course, round(r.distance / settings.unit)) for r in known.collect()} == {(c, f) for c in "AB" for f in (5, 6, 8)}
    got = going.groupBy("base_id").agg(F.avg("ga").alias("ga")).collect()
    pairs = np.array([(r.ga * settings.unit, truth[r.base_id]) for r in got])
    assert len(pairs) == 120 and np.corrcoef(pairs.T)[0, 1] > 0.97
    rated = G.figures(runners, known, going, settings).where("raw_figure is not null").collect()
    assert len(rated) == 60 * 2 * 6 * 5


def test_figure_chain_by_hand(spark):
    s = G.UK
    known = spark.createDataFrame([("A", "Turf", 5.0, 60.0, 50, False)], "course string, surface string, distance double, standard double, n_races long, provisional boolean")
    going = spark.createDataFrame([("m", "m", 0.1, None, 6)], "meeting_id string, base_id string, ga double, se double, n long")
    day = dt.date(2023, 5, 1)
    row = lambda p, b, w: ("r", "m", day, "A", "Turf", 5.0, "Good", 1, p, 61.0, b, w, 3, f"h{p}", 4, 50.0)
    runners = spark.createDataFrame([row(1, 0.0, 126.0), row(2, 3.0, 120.0), row(3, 20.0, 126.0), row(4, 25.0, None)], SCHEMA)
    got = {r.position: r for r in G.figures(runners, known, going, s).collect()}
    lpl, ratio = 0.2 * 20, 60 / 61
    winner = 100 - (61 - 0.5 - 60) / 0.2 * lpl
    soft = lambda b, t=20 - 0.8: b if b <= t else t + 0.5 * (b - t)
    assert got[1].raw_figure == pytest.approx(winner)
    assert got[2].raw_figure == pytest.approx(winner - 3 * lpl * ratio) and got[2].weighted == pytest.approx(got[2].raw_figure - 6)
    assert got[3].raw_figure == pytest.approx(winner - soft(20.0) * lpl * ratio)
    assert got[4].raw_figure is None
    live = {r.position: r for r in G.figures(runners, known, going, s, live=True).collect()}
    assert live[4].raw_figure == pytest.approx(winner - soft(25.0) * lpl * ratio)


def test_age_allowance_and_checks(spark):
    runners, _ = season(spark)
    grid = spark.createDataFrame([("Turf", 3, m, d, p) for m in (1, 2) for d, p in ((5.0, 10.0), (8.0, 4.0))], "surface string, age int, month int, distance double, pounds double")
    out = G.add_age_allowance(runners.withColumn("weighted", F.lit(50.0)), grid).where("age is not null and distance = 6 and month(day) = 1").select("age", "allowance").distinct().collect()
    assert len(out) > 1 and all(r.allowance == (8.0 if r.age == 3 else 0.0) for r in out)
    rated = runners.withColumn("standard", F.when(F.col("distance") != 5, 60.0))
    checks = {r.race_id: r for r in G.race_checks(rated).collect()}
    five = next(r.race_id for r in runners.where("distance = 5").collect())
    assert checks[five].no_standard and checks[five].is_rejected


def test_calibration_reduces_error(spark):
    runners, _ = season(spark)
    rated = runners.where("position is not null").withColumn("adjusted", 3 * F.col("target") + 20 + F.when(F.col("course") == "A", 4.0).otherwise(0.0) + F.rand(3))
    out = G.report(G.calibrate(rated, "target"), ["surface"], "calibrated", "target").first()
    assert out.mae < 0.6 and out.n == 3600


def test_compression(spark):
    got = spark.createDataFrame([(90.0, 1), (120.0, 1), (120.0, 5), (120.0, None), (120.0, 6)], "f double, c int").select(G.compressed(F.col("f"), F.col("c")).alias("v")).collect()
    assert [round(r.v, 3) for r in got] == [90.0, 134.16, 105.84, 120.0, 100.0]
