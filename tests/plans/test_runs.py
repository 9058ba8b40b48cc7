from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from furlong.plans import figures as G
from furlong.plans import runs

from .test_figures import season

REGION = replace(runs.UK, settings=replace(G.UK, passes=1, tolerance=0.0))


@pytest.fixture(scope="module")
def done(spark):
    runners, truth = season(spark)
    half = runners.where("day < date'2023-02-20'")
    return runners, truth, runs.batch(half.withColumn("race_type", F.when(F.col("race_no") == 6, "Handicap Hurdle").otherwise("Flat")), REGION, drift_year=2023)


def test_batch_keeps_flat_runners_and_attaches_allowances(done):
    _, truth, run = done
    rows = run.rows.where("adjusted is not null").collect()
    assert rows and {r.race_no for r in rows} == {1, 2, 3, 4, 5}
    assert all(r.ga_se is not None and r.confidence in ("high", "medium", "low") for r in rows)
    assert {"standards", "allowances", "base", "by_class", "late_drift", "rescale"} <= set(run.tables)
    # nothing is fitted on the latest year, which is the only one here
    assert all(r.calibrated == r.adjusted for r in rows)


def test_tables_survive_a_version_and_rate_live_cards(spark, done, tmp_path):
    runners, _, run = done
    root = str(tmp_path / "versions")
    assert runs.store(spark, root, run) == 1
    tables = runs.stored(spark, root)
    assert set(tables) == set(run.tables)
    today = runners.where("day = date'2023-02-25'").drop("target")
    rows = runs.live(today, tables, REGION, 2023).collect()
    assert len(rows) == today.count()
    winners = [r for r in rows if r.position == 1]
    assert winners and all(r.winner_figure is not None and r.calibrated == pytest.approx(r.adjusted) for r in winners)
    fewer = {k: v for k, v in tables.items() if k not in ("by_age", "rescale")}  # as a version of before these stages
    assert runs.live(today, fewer, REGION, 2023).count() == len(rows)


def test_live_allowances_take_the_prior_where_races_are_few(spark):
    runners, _ = season(spark)
    known = spark.createDataFrame([("A", "Turf", 5.0, 60.0, 50, False), ("A", "Turf", 8.0, 98.0, 50, False)], "course string, surface string, distance double, standard double, n_races long, provisional boolean")
    day = runners.where("day = date'2023-01-05'")
    thin = day.where("course = 'A' and race_no <= 2").withColumn("going", F.when(F.lit(False), "x"))
    (row,) = G.live_allowances(thin, known, G.UK).collect()
    assert (row.ga, row.n, row.se) == (0.05, 0, None)  # no going counts as good
    both = {r.meeting_id: r for r in G.live_allowances(day, known, G.UK).collect()}
    full, none = both["2023-01-05_A_Turf"], both["2023-01-05_B_Turf"]
    assert full.n >= 3 and full.se is not None and none.n == 0 and none.ga in (0.05, 0.51)


def test_eligibility_is_a_setting(spark):
    """A table that carries race names and codes is judged by the rule of its region alone."""
    runners, _ = season(spark)
    named = runners.withColumn("race_name", F.lit("MAIDEN STAKES")).withColumn("race_code", F.lit("H")).withColumn("oldest_age", F.lit(5))
    assert G.estimate(named, replace(G.UK, passes=1))[0].count() == 6
    assert G.estimate(named, replace(G.UK, passes=1, eligibility="name"))[0].count() == 0
    assert G.estimate(named.withColumn("race_code", F.lit("P")), replace(G.UK, passes=1, eligibility=None))[0].count() == 6
