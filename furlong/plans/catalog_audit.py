"""Queries on audits of figures: what is left over by layer, drift, selections of standards, sweeps of constants, held-out corrections.

Lines are rated runs: a is what a run was worth, p what was predicted, e = p - a."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import shrink
from .registry import query, r, table

RATED = """(SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_returnflag AS going, l_linestatus AS surface, l_quantity AS beaten, year(l_shipdate) AS year, month(l_shipdate) AS month, l_discount AS ga, l_suppkey % 12 + 5 AS furlongs,
  l_quantity * 2 AS a, l_quantity + 25 + l_discount * 20 + l_suppkey % 7 AS p, l_quantity + 25 + l_discount * 20 + l_suppkey % 7 - l_quantity * 2 AS e FROM lineitem)"""


def rated(spark: SparkSession, sf: str) -> DataFrame:
    a, p = F.col("l_quantity") * 2, F.col("l_quantity") + 25 + F.col("l_discount") * 20 + F.col("l_suppkey") % 7
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_returnflag").alias("going"), F.col("l_linestatus").alias("surface"), F.col("l_quantity").alias("beaten"), F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"), F.col("l_discount").alias("ga"), (F.col("l_suppkey") % 12 + 5).alias("furlongs"), a.alias("a"), p.alias("p"), (p - a).alias("e"),
    )


@query(f"""
WITH d AS (SELECT furlongs, greatest(least(sum(-e) / (count(*) + 500), 8), -8) AS c1 FROM {RATED} WHERE year >= 1999 GROUP BY 1 HAVING count(*) >= 100),
x AS (SELECT r.*, e + coalesce(c1, 0) AS e1 FROM {RATED} r LEFT JOIN d USING (furlongs)),
g AS (SELECT going, sum(-e1) / (count(*) + 500) AS c2 FROM x WHERE year >= 1999 GROUP BY 1 HAVING count(*) >= 200),
y AS (SELECT x.*, e1 + coalesce(c2, 0) AS e2 FROM x LEFT JOIN g USING (going)),
t AS (SELECT surface, avg(-e2) AS c3 FROM y WHERE year IN (1999, 2000) GROUP BY 1 HAVING count(*) > 500)
SELECT l_orderkey, l_extendedprice, rnd(p + (e2 - e) + CASE WHEN year >= 1999 THEN coalesce(c3, 0) ELSE 0 END, 4) AS corrected FROM y LEFT JOIN t USING (surface)
""")
def late_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections learned on late years: by distance, then by going on what is left, then the drift of a surface, each with its support and shrinkage.

    The tables learned have a row for each distance (twelve), going and surface, so they are broadcast: a shuffle by such keys would put a third of all rows in one task."""
    rows = rated(spark, sf)
    late = F.col("year") >= 1999
    bounded = F.greatest(F.least(F.sum(-F.col("e")) / (F.count(F.lit(1)) + 500), F.lit(8.0)), F.lit(-8.0))
    by_distance = rows.where(late).groupBy("furlongs").agg(bounded.alias("c1"), F.count(F.lit(1)).alias("n")).where("n >= 100").drop("n")
    one = rows.join(F.broadcast(by_distance), "furlongs", "left").withColumn("e1", F.col("e") + F.coalesce("c1", F.lit(0.0)))
    by_going = one.where(late).groupBy("going").agg((F.sum(-F.col("e1")) / (F.count(F.lit(1)) + 500)).alias("c2"), F.count(F.lit(1)).alias("n")).where("n >= 200").drop("n")
    two = one.join(F.broadcast(by_going), "going", "left").withColumn("e2", F.col("e1") + F.coalesce("c2", F.lit(0.0)))
    drift = two.where(F.col("year").isin(1999, 2000)).groupBy("surface").agg(F.avg(-F.col("e2")).alias("c3"), F.count(F.lit(1)).alias("n")).where("n > 500").drop("n")
    moved = F.when(late, F.coalesce("c3", F.lit(0.0))).otherwise(0.0)
    return two.join(F.broadcast(drift), "surface", "left").select("l_orderkey", "l_extendedprice", r(F.col("p") + (F.col("e2") - F.col("e")) + moved).alias("corrected"))


@query(f"""
WITH w AS (SELECT *, first_value(e) OVER (PARTITION BY l_orderkey ORDER BY beaten, l_extendedprice) AS we FROM {RATED})
SELECT CASE WHEN beaten <= 1 THEN '0-1' WHEN beaten <= 10 THEN '1-10' WHEN beaten <= 30 THEN '10-30' ELSE 'other' END AS band, rnd(-sum(e - we) / (count(*) + 100), 4) AS correction, count(*)::BIGINT AS n FROM w GROUP BY 1
""")
def margin_band_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Errors against the race's winner by margin band, shrunk to zero and turned."""
    winner = F.first("e").over(Window.partitionBy("l_orderkey").orderBy("beaten", "l_extendedprice"))
    band = F.when(F.col("beaten") <= 1, "0-1").when(F.col("beaten") <= 10, "1-10").when(F.col("beaten") <= 30, "10-30").otherwise("other")
    rows = rated(spark, sf).withColumn("apart", F.col("e") - winner).withColumn("band", band)
    return rows.groupBy("band").agg(r(-shrink.toward_zero(F.col("apart"), 100.0)).alias("correction"), F.count(F.lit(1)).alias("n"))


@query(f"""
WITH m AS (SELECT avg(e) AS m FROM {RATED}) SELECT going, rnd(greatest(least(sum(e - m) / (count(*) + 200), 6), -6), 4) AS correction FROM {RATED}, m GROUP BY 1
""")
def going_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Errors against the whole's mean by going, shrunk and kept within six pounds."""
    rows = rated(spark, sf)
    mean = rows.agg(F.avg("e").alias("m"))  # one row
    shrunk = shrink.toward_zero(F.col("e") - F.col("m"), 200.0)
    return rows.crossJoin(F.broadcast(mean)).groupBy("going").agg(r(F.greatest(F.least(shrunk, F.lit(6.0)), F.lit(-6.0))).alias("correction"))


@query(f"SELECT month, furlongs, rnd(avg(ga * 10) - avg(e), 4) AS allowance, count(*)::BIGINT AS n FROM {RATED} GROUP BY ALL HAVING count(*) >= 20")
def age_rederivation(spark: SparkSession, sf: str) -> DataFrame:
    """The allowance of each month and distance that would leave no error, where support is enough."""
    cells = rated(spark, sf).groupBy("month", "furlongs").agg(r(F.avg(F.col("ga") * 10) - F.avg("e")).alias("allowance"), F.count(F.lit(1)).alias("n"))
    return cells.where("n >= 20")


@query(f"""
SELECT CASE WHEN a < 40 THEN 'low' WHEN a < 80 THEN 'middle' ELSE 'high' END AS band, rnd(regr_slope(p, a), 4) AS slope, rnd(corr(p, a), 4) AS correlation, rnd(min(p), 4) AS lowest, rnd(max(p), 4) AS highest, rnd(stddev_samp(p) / stddev_samp(a), 4) AS ratio
FROM {RATED} GROUP BY 1
""")
def local_slopes(spark: SparkSession, sf: str) -> DataFrame:
    """Slope, correlation, extremes and ratio of spreads by band of the target."""
    band = F.when(F.col("a") < 40, "low").when(F.col("a") < 80, "middle").otherwise("high")
    return rated(spark, sf).groupBy(band.alias("band")).agg(
        r(F.regr_slope("p", "a")).alias("slope"), r(F.corr("p", "a")).alias("correlation"), r(F.min("p")).alias("lowest"), r(F.max("p")).alias("highest"), r(F.stddev_samp("p") / F.stddev_samp("a")).alias("ratio")
    )


@query(f"""
SELECT l_orderkey, rnd(avg(ga), 4) AS allowance, rnd(avg((ga - m) * furlongs / 0.2 * 4), 4) AS moved FROM (SELECT *, avg(ga) OVER (PARTITION BY l_orderkey) AS m FROM {RATED}) GROUP BY 1
""")
def allowance_what_if(spark: SparkSession, sf: str) -> DataFrame:
    """How far figures would move if each run had its own allowance instead of its race's."""
    mean = F.avg("ga").over(Window.partitionBy("l_orderkey"))
    rows = rated(spark, sf).withColumn("apart", (F.col("ga") - mean) * F.col("furlongs") / 0.2 * 4)
    return rows.groupBy("l_orderkey").agg(r(F.avg("ga")).alias("allowance"), r(F.avg("apart")).alias("moved"))


@query(f"""
WITH y AS (SELECT l_suppkey, year, avg(p) AS m, count(*) AS n FROM {RATED} GROUP BY ALL)
SELECT l_suppkey, year, rnd(m - lag(m) OVER (PARTITION BY l_suppkey ORDER BY year), 4) AS moved, rnd(abs(m - lag(m) OVER (PARTITION BY l_suppkey ORDER BY year)) / nullif(abs(m), 0), 4) AS share, n::BIGINT AS n FROM y
""")
def yearly_stability(spark: SparkSession, sf: str) -> DataFrame:
    """How each key's yearly mean moves from year to year."""
    before = F.lag("m").over(Window.partitionBy("l_suppkey").orderBy("year"))
    years = rated(spark, sf).groupBy("l_suppkey", "year").agg(F.avg("p").alias("m"), F.count(F.lit(1)).alias("n"))
    return years.select("l_suppkey", "year", r(F.col("m") - before).alias("moved"), r(F.abs(F.col("m") - before) / F.nullif(F.abs("m"), F.lit(0.0))).alias("share"), "n")


@query(f"""
WITH s AS (SELECT l_suppkey, median(p) AS base, median(p) FILTER (going = 'N') AS s1, median(p) FILTER (going <> 'R') AS s2, median(p) FILTER (going = 'N' OR surface = 'F') AS s3, median(p) FILTER (month > 3) AS s4, median(p) FILTER (going = 'N' AND month > 3) AS s5 FROM {RATED} GROUP BY 1)
SELECT kind, count(v)::BIGINT AS n, rnd(avg(v - base), 4) AS apart, rnd(median(abs(v - base)), 4) AS typical FROM (
  SELECT base, unnest(['s1', 's2', 's3', 's4', 's5']) AS kind, unnest([s1, s2, s3, s4, s5]) AS v FROM s) GROUP BY 1
""")
def standard_selections(spark: SparkSession, sf: str) -> DataFrame:
    """Standards of five selections of races against those of all, from conditional medians in one aggregate."""
    going, late = F.col("going"), F.col("month") > 3
    tests = {"s1": going == "N", "s2": going != "R", "s3": (going == "N") | (F.col("surface") == "F"), "s4": late, "s5": (going == "N") & late}
    wide = rated(spark, sf).groupBy("l_suppkey").agg(F.median("p").alias("base"), *[F.median(F.when(t, F.col("p"))).alias(k) for k, t in tests.items()])
    long = wide.select("base", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("v")) for k in tests])).alias("s")).select("base", "s.kind", "s.v")
    return long.groupBy("kind").agg(F.count("v").alias("n"), r(F.avg(F.col("v") - F.col("base"))).alias("apart"), r(F.median(F.abs(F.col("v") - F.col("base")))).alias("typical"))


@query(f"""
WITH c AS (SELECT sum(-e) / (count(*) + 100) AS c, surface FROM {RATED} WHERE year <= 1999 GROUP BY surface)
SELECT surface, count(*)::BIGINT AS n, rnd(avg(abs(e)), 4) AS mae_before, rnd(avg(abs(e + c)), 4) AS mae_after, rnd(avg(e), 4) AS bias_before, rnd(avg(e + c), 4) AS bias_after FROM {RATED} JOIN c USING (surface) WHERE year > 1999 GROUP BY 1
""")
def held_out_simulation(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of later years before and after a correction that earlier years have taught."""
    rows = rated(spark, sf)
    taught = rows.where("year <= 1999").groupBy("surface").agg((-shrink.toward_zero(F.col("e"), 100.0)).alias("c"))
    after = F.col("e") + F.col("c")
    return rows.where("year > 1999").join(F.broadcast(taught), "surface").groupBy("surface").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg(F.abs("e"))).alias("mae_before"), r(F.avg(F.abs(after))).alias("mae_after"), r(F.avg("e")).alias("bias_before"), r(F.avg(after)).alias("bias_after")
    )


@query(f"""
SELECT c::INT AS pounds, rnd(avg(abs(100 - beaten * 0.2 * c * 5 / furlongs - a)), 4) AS mae, rnd(regr_slope(a, 100 - beaten * 0.2 * c * 5 / furlongs), 4) AS slope FROM {RATED}, (SELECT unnest(range(18, 29, 2)) AS c) GROUP BY 1
""")
def constant_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Errors for each value of pounds a second, from a literal grid."""
    grid = rated(spark, sf).withColumn("pounds", F.explode(F.array(*[F.lit(c) for c in range(18, 29, 2)])))
    made = 100 - F.col("beaten") * 0.2 * F.col("pounds") * 5 / F.col("furlongs")
    return grid.groupBy("pounds").agg(r(F.avg(F.abs(made - F.col("a")))).alias("mae"), r(F.regr_slope(F.col("a"), made)).alias("slope"))


@query(f"""
SELECT CASE WHEN beaten <= 10 THEN 'near' WHEN beaten <= 30 THEN 'middle' ELSE 'far' END AS place, rnd(avg(e) FILTER (going = 'A'), 4) AS "going_A", rnd(avg(e) FILTER (going = 'N'), 4) AS "going_N", rnd(avg(e) FILTER (going = 'R'), 4) AS "going_R"
FROM {RATED} GROUP BY 1 HAVING count(*) >= 50
""")
def residual_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Mean errors by place and going, places with support."""
    place = F.when(F.col("beaten") <= 10, "near").when(F.col("beaten") <= 30, "middle").otherwise("far")
    wide = rated(spark, sf).groupBy(place.alias("place")).agg(*[r(F.avg(F.when(F.col("going") == g, F.col("e")))).alias(f"going_{g}") for g in "ANR"], F.count(F.lit(1)).alias("n"))
    return wide.where("n >= 50").drop("n")


@query(f"""
SELECT l_suppkey, rnd(avg(ga), 4) AS mean_allowance, count(*)::BIGINT AS n FROM {RATED} GROUP BY 1 HAVING count(*) >= 20 AND abs(avg(ga) - 0.05) > 0.001
""")
def course_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Courses whose mean allowance is off, with support. Means at the threshold are told apart by exact decimal sums, whose order does not matter."""
    exact = F.col("ga").try_cast("decimal(28,18)")  # null for NaN and what is too large: then the sum of doubles
    mean = F.when(F.count(exact) == F.count("ga"), F.avg(exact).cast("double")).otherwise(F.avg("ga"))
    groups = rated(spark, sf).groupBy("l_suppkey").agg(mean.alias("m"), F.count(F.lit(1)).alias("n"))
    return groups.where("n >= 20 and abs(m - 0.05) > 0.001").select("l_suppkey", r("m").alias("mean_allowance"), "n")


@query(f"""
SELECT going, count(*)::BIGINT AS races, rnd(avg(spread), 4) AS spread, rnd(avg(sd), 4) AS sd FROM (SELECT l_orderkey, min(going) AS going, max(p) - min(p) AS spread, stddev_samp(p) AS sd FROM {RATED} GROUP BY 1 HAVING count(*) >= 3) GROUP BY 1
""")
def race_spreads(spark: SparkSession, sf: str) -> DataFrame:
    """Spread within races of three runners or more, by going."""
    races = rated(spark, sf).groupBy("l_orderkey").agg(F.min("going").alias("going"), (F.max("p") - F.min("p")).alias("spread"), F.stddev_samp("p").alias("sd"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    return races.groupBy("going").agg(F.count(F.lit(1)).alias("races"), r(F.avg("spread")).alias("spread"), r(F.avg("sd")).alias("sd"))
