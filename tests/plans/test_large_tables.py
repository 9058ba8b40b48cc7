"""What queries do with values at thresholds, and how they deal out rows where tables are large."""

from functools import reduce
from operator import add

import pytest
from pyspark.sql import functions as F

from furlong.operators import calibrate, interpolate, windows
from furlong.operators.bundle import Family, segmented
from furlong.plans import catalog_rows, catalog_runs, features, figures, runs
from furlong.plans.catalog import QUERIES
from furlong.sources.staging import dealt, written

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


@pytest.fixture
def no_small_tables(spark):
    """Spark takes no table for small by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_mean_at_the_threshold_does_not_depend_on_the_order_of_its_sum(spark, tmp_path):
    cents = [8, 6, 0, 2, 3, 6, 5, 3, 1, 10, 6, 5, 0, 9, 1, 3, 5, 5, 0, 10, 6, 9, 4, 6, 4, 10, 8, 2, 2, 8, 9, 2, 10, 0, 9, 0, 6, 3, 3, 7]
    assert sum(cents) / 100 / 40 == 0.049 and abs(reduce(add, [c / 100 for c in cents]) / 40 - 0.05) < 0.001 < abs(0.049 - 0.05)
    line = spark.read.parquet(f"{SF}/lineitem.parquet").limit(1)
    given = F.explode(F.array(*[F.lit(c / 100) for c in cents]))
    line.withColumn("l_suppkey", F.lit(7).cast("long")).withColumn("l_discount", given).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(row) for row in QUERIES["course_bias"](spark, str(tmp_path)).collect()] == [(7, 0.049, 40)]


@pytest.mark.parametrize("name", ["late_corrections", "held_out_simulation"])
def test_corrections_by_a_few_keys_do_not_shuffle_the_rows_they_correct(spark, no_small_tables, name):
    found = plan(QUERIES[name](spark, SF))
    assert "SortMergeJoin" not in found and "ShuffledHashJoin" not in found


def test_curves_by_a_few_keys_do_not_shuffle_the_rows_they_are_fitted_on(spark, no_small_tables):
    part = spark.read.parquet(f"{SF}/part.parquet")
    for fitted in (calibrate.parabola(part, ["p_brand"], "p_size", "p_retailprice"), calibrate.rescaled(part, ["p_brand"], "p_size", "p_retailprice", "v")):
        assert "SortMergeJoin" not in plan(fitted) and "ShuffledHashJoin" not in plan(fitted)


def test_tasks_grow_in_number_with_the_rows(spark):
    rows = spark.range(1000).selectExpr("id % 300 as k", "id")
    assert dealt(rows, "k").rdd.getNumPartitions() == 4 and dealt(rows.where("false"), "k").rdd.getNumPartitions() == 4
    many = dealt(rows, "k", rows=90)
    assert many.rdd.getNumPartitions() == 12 and many.count() == 1000


@pytest.mark.parametrize("name", ["expect_residual", "race_ranks", "relative_draw"])
def test_windows_within_races_take_rows_dealt_by_their_number(spark, name):
    assert "REPARTITION_BY_NUM" in plan(QUERIES[name](spark, SF))


def test_documents_are_gathered_from_lines_dealt_by_their_number(spark, monkeypatch):
    keys = []
    monkeypatch.setattr(catalog_rows, "dealt", lambda df, *by: keys.append(by) or dealt(df, *by))
    assert QUERIES["json_key_paths"](spark, SF).count() > 0 and keys == [("l_orderkey",)]


def test_features_that_are_not_asked_for_are_not_written(spark, monkeypatch):
    wide = {}
    monkeypatch.setattr(features, "written", lambda df, name: wide.setdefault(name, df.columns) and written(df, name))
    QUERIES["form_features"](spark, SF)
    assert len(wide["form"]) < 50 and "horse_speed_career" not in wide["form"] and "horse_nfp_career" in wide["form"]


def test_the_card_is_written_with_what_is_asked_for_alone(spark, monkeypatch):
    wide = {}
    monkeypatch.setattr(features, "written", lambda df, name: wide.setdefault(name, df.columns) and written(df, name))
    out = QUERIES["form_features"](spark, SF)
    assert len(wide["card"]) < 25 and "race_merit" not in wide["card"] and "nfp" in wide["card"]
    found = plan(out)
    assert "hashpartitioning(race_date" not in found and "hashpartitioning(sire" not in found


def test_sums_by_segments_are_those_of_windows(spark):
    lines = spark.range(600).selectExpr("date_add(date'2024-01-01', cast(id div 40 as int)) d", "id", "nullif(concat('k', hash(id) % 3), 'k0') k", "cast(hash(id, 1) % 2 as double) x", "if(id % 5 = 0, null, id / 7) y")
    rows = written(lines.repartitionByRange(5, "id").sortWithinPartitions("id").withColumn(windows.BySegment.ROW, F.monotonically_increasing_id()), "rows")
    assert rows.select(windows.BySegment.segment()).distinct().count() == 5
    made = lambda s: {"n": s.count(), "sx": s.sum("x"), "my": s.mean("y"), "r3": s.recent(None, 3), "rx3": s.recent("x", 3)}
    by, everyone = windows.BySegment(["k"], "d"), windows.BySegment([], "d")
    got = segmented(rows, [(Family(("k",), made(by), ()), by), (Family((), {"all_y": everyone.mean("y")}, ()), everyone)])
    plain = windows.Earlier(["k"], ["id"], "d")
    want = rows.select("*", *[F.when(F.col("k").isNotNull(), c).alias(name) for name, c in made(plain).items()], windows.Earlier([], ["id"], "d").mean("y").alias("all_y"))
    for a, b in zip(got.orderBy("id").collect(), want.orderBy("id").collect(), strict=True):
        assert a.asDict() == pytest.approx(b.asDict())


def test_curves_are_looked_up_once_for_each_key_and_value(spark):
    rows = spark.createDataFrame([(i, "ab"[i % 2], None if i == 3 else float(i % 5)) for i in range(40)], "i int, k string, x double")
    known = interpolate.curves(spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, 30.0)], "k string, x double, y double"), ["k"], "x", "y")
    a, b, c = ({r.i: r.v for r in df.collect()} for df in (interpolate.joined_by_value(rows, known, ["k"], "x", "v"), interpolate.join_at(rows, known, ["k"], "x", "v"), interpolate.joined_by_value(rows.where("i < 5"), known, ["k"], "x", "v", asked=rows)))
    assert a == b and len(a) == 40 and a[2] == 20.0 and a[0] == 10.0 and a[1] is None and c == {i: a[i] for i in range(5)}


def test_steps_that_several_others_read_are_written(spark, monkeypatch):
    named = []
    keep = lambda df, name: named.append(name) or written(df, name)
    for module in (figures, runs, catalog_runs):
        monkeypatch.setattr(module, "written", keep)
    assert QUERIES["uk_live"](spark, SF).count() > 0
    assert named.count("every") == 1 and named.count("live_runners") == 1 and named.count("deviations") == named.count("means") == named.count("allowances")
