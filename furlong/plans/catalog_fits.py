"""Queries on calibration, models and the iterated estimation of standards and allowances."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calibrate, interpolate, prefix, ranks, shrink
from ..operators.metrics import correlation
from ..sources.staging import written
from .registry import query, r, table


@query("""
WITH e AS (SELECT event_type, (props->>'$.k')::DOUBLE AS x, value AS y FROM events)
SELECT event_type, rnd(regr_slope(y, x), 4) AS slope, rnd(regr_intercept(y, x), 4) AS intercept, rnd(corr(y, x), 4) AS corr, rnd(sum(CASE WHEN x <> 0 THEN x * y END) / (sum(CASE WHEN x <> 0 THEN x * x END) + 1e-6), 4) AS origin FROM e GROUP BY 1
""")
def ols_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Least-squares lines by group, free and through the origin."""
    x, y = F.get_json_object("props", "$.k").cast("double"), F.col("value")
    slope, intercept = calibrate.line(x, y)
    out = table(spark, sf, "events").groupBy("event_type").agg(slope, intercept, correlation(x, y).alias("corr"), calibrate.origin_slope(x, y).alias("origin"))
    return out.select("event_type", *[r(c).alias(c) for c in ("slope", "intercept", "corr", "origin")])


@query("""
WITH m AS (SELECT p_brand, avg(p_size) AS mx FROM part GROUP BY 1),
s AS (SELECT p_brand, any_value(mx) AS mx, count(*) AS n, sum((p_size - mx) ** 2) AS s2, sum((p_size - mx) ** 3) AS s3, sum((p_size - mx) ** 4) AS s4, sum(p_retailprice) AS t0, sum((p_size - mx) * p_retailprice) AS t1,
  sum((p_size - mx) ** 2 * p_retailprice) AS t2 FROM part JOIN m USING (p_brand) GROUP BY 1),
b AS (SELECT *, (s2 * t2 - s3 * t1 - s2 * s2 * t0 / n) / (s2 * s4 - s3 * s3 - s2 * s2 * s2 / n) AS b2 FROM s)
SELECT p_brand, rnd((t0 - s2 * b2) / n, 4) AS b0, rnd((t1 - s3 * b2) / s2, 4) AS b1, rnd(b2, 4) AS b2 FROM b
""")
def ols_quadratic(spark: SparkSession, sf: str) -> DataFrame:
    """Parabolas by group from centred moments."""
    return calibrate.parabola(table(spark, sf, "part"), ["p_brand"], "p_size", "p_retailprice").select("p_brand", r("b0").alias("b0"), r("b1").alias("b1"), r("b2").alias("b2"))


@query("""
WITH a AS (SELECT *, value - 50 AS y, hour(ts) AS h FROM events), l1 AS (SELECT event_type, sum(y) / (count(*) + 100) AS o FROM a GROUP BY 1), b AS (SELECT a.*, y - o AS r1, o AS f1 FROM a JOIN l1 USING (event_type)),
l2 AS (SELECT user_id, least(greatest(sum(r1) / (count(*) + 100), -10), 10) AS o FROM b GROUP BY 1), c AS (SELECT b.*, r1 - o AS r2, f1 + o AS f2 FROM b JOIN l2 USING (user_id)),
l3 AS (SELECT event_type, h, sum(r2) / (count(*) + 200) AS o FROM c GROUP BY ALL)
SELECT event_id, rnd(f2 + o, 4) AS fitted FROM c JOIN l3 USING (event_type, h)
""")
def residual_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Layered shrunk corrections, each on what the ones before left."""
    events = table(spark, sf, "events").withColumn("y", F.col("value") - 50).withColumn("h", F.hour("ts"))
    return shrink.residual_layers(events, "y", [("event_type", 100, None), ("user_id", 100, 10.0), (["event_type", "h"], 200, None)]).select("event_id", r("fitted").alias("fitted"))


@query("""
WITH t AS (SELECT user_id, avg(value) AS m FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1), b AS (SELECT avg(value) AS base FROM events WHERE ts < TIMESTAMP '2024-01-20')
SELECT event_id, rnd(coalesce(m - base, 0), 4) AS encoded, ts < TIMESTAMP '2024-01-20' AS is_train FROM events LEFT JOIN t USING (user_id), b
""")
def target_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Mean targets of keys from earlier rows alone."""
    train = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    out = shrink.target_encoding(table(spark, sf, "events"), ["user_id"], F.col("value"), train, "encoded")
    return out.select("event_id", r("encoded").alias("encoded"), train.alias("is_train"))


@query("""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, median(value) AS m, quantile_cont(value, 0.75) AS b FROM events GROUP BY 1)
SELECT event_id, rnd(72 + (value - m) * least(greatest(18 / nullif((b - a) / 1.349, 0), 0.3), 2.0), 4) AS scaled FROM events JOIN q USING (event_type)
""")
def robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Each group moved to one centre and spread by its quartiles."""
    events = table(spark, sf, "events")
    q = ranks.percentiles(events, ["event_type"], "value", [0.25, 0.5, 0.75]).select("event_type", *[F.col("percentiles")[i].alias(c) for i, c in enumerate("amb")])
    return events.join(q, "event_type").select("event_id", r(calibrate.robust_scale(F.col("value"), F.col("m"), F.col("a"), F.col("b"), 72.0, 18.0)).alias("scaled"))


@query("""
WITH f AS (SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS s, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_extendedprice, rnd((l_quantity - mx) * s + my, 3) AS rescaled FROM lineitem JOIN f USING (l_returnflag)
""")
def final_rescale(spark: SparkSession, sf: str) -> DataFrame:
    """One scale moved onto another by its least-squares line."""
    out = calibrate.rescaled(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice", "v")
    return out.select("l_orderkey", "l_extendedprice", r("v", 3).alias("rescaled"))


@query("""
WITH g AS (SELECT t.t AS threshold, s.s / 100.0::DOUBLE AS share FROM range(40, 80, 10) t(t), range(0, 40, 5) s(s)),
e AS (SELECT threshold, share, rnd(avg(abs(CASE WHEN value > threshold THEN threshold + (1 + share) * (value - threshold) ELSE value END - k * 60)), 4) AS mae FROM (SELECT value, (props->>'$.k')::DOUBLE / 20 AS k FROM events), g GROUP BY ALL)
SELECT threshold::INT AS threshold, share, mae FROM e ORDER BY mae, threshold, share LIMIT 1
""")
def grid_search_stretch(spark: SparkSession, sf: str) -> DataFrame:
    """The stretch of least error among a literal grid of 32."""
    events = table(spark, sf, "events").select("value", (F.get_json_object("props", "$.k").cast("double") / 20 * 60).alias("y"))
    grid = [(t, s / 100) for t in range(40, 80, 10) for s in range(0, 40, 5)]
    error = lambda t, s: F.avg(F.abs(calibrate.stretched(F.col("value"), float(t), s) - F.col("y")))
    wide = events.agg(*[error(t, s).alias(f"e{i}") for i, (t, s) in enumerate(grid)])  # one pass, a column for each point
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(s).alias("share"), r(f"e{i}").alias("mae")) for i, (t, s) in enumerate(grid)])).alias("g")
    return wide.select(rows).select("g.*").orderBy("mae", "threshold", "share").limit(1)


QM_SHARES = [i / 20 for i in range(21)]


@query(f"""
WITH k AS (SELECT unnest(quantile_cont(l_quantity * 1000, {QM_SHARES})) AS x, unnest(quantile_cont(l_extendedprice, {QM_SHARES})) AS y FROM lineitem),
d AS (SELECT x, min(y) AS y FROM k GROUP BY 1), p AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM d)
SELECT DISTINCT l_quantity, rnd(CASE WHEN x1 IS NULL THEN y0 ELSE y0 + (l_quantity * 1000 - x0) / (x1 - x0) * (y1 - y0) END, 3) AS mapped FROM lineitem JOIN p ON l_quantity * 1000 >= x0 AND (x1 IS NULL OR l_quantity * 1000 < x1)
""")
def quantile_map_linear(spark: SparkSession, sf: str) -> DataFrame:
    """One distribution mapped onto another through 21 percentiles, linearly."""
    lines = table(spark, sf, "lineitem").withColumn("x", F.col("l_quantity") * 1000)
    points = calibrate.knots(lines, "x", "l_extendedprice", QM_SHARES)
    curve = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])
    return lines.select("l_quantity", "x").distinct().select("l_quantity", r(interpolate.at(curve, F.col("x")), 3).alias("mapped"))


@query()
def pchip_map(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a monotone cubic; tests hold it against the closed form."""
    lines = table(spark, sf, "lineitem").withColumn("x", F.col("l_quantity") * 1000)
    pieces = calibrate.monotone_cubic(calibrate.knots(lines, "x", "l_extendedprice", QM_SHARES))
    return lines.select("l_orderkey", "l_extendedprice", r(calibrate.piecewise(F.col("x"), pieces), 3).alias("mapped"))


@query()
def gbt_predict(spark: SparkSession, sf: str) -> DataFrame:
    """A boosted-tree prediction of prices, fitted on all earlier lines and applied to all; what is fitted on is written once, as every boosting round reads it."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_extendedprice", "l_quantity", "p_size", "p_retailprice", F.year("l_shipdate").alias("year"))
    features = VectorAssembler(inputCols=["l_quantity", "p_size", "p_retailprice"], outputCol="features")
    rows = written(features.transform(lines), "gbt_predict")
    model = GBTRegressor(labelCol="l_extendedprice", featuresCol="features", maxIter=10, maxDepth=4, stepSize=0.2, seed=42).fit(rows.where("year <= 1998"))
    return model.transform(rows).select("l_orderkey", "l_extendedprice", r("prediction", 2).alias("predicted"))


def _passes(n: int) -> str:
    sql = ["WITH f AS (SELECT l_orderkey, p_brand AS k, o_orderdate::DATE AS day, l_extendedprice / 1000 AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)", "g0 AS (SELECT DISTINCT day, 0.0::DOUBLE AS ga FROM f)"]
    for i in range(1, n + 1):
        sql.append(f"s{i} AS (SELECT k, median(t - ga) AS std FROM f JOIN g{i - 1} USING (day) GROUP BY 1)")
        sql.append(f"g{i} AS (SELECT day, sum(t - std) / (count(*) + 3) AS ga FROM f JOIN s{i} USING (k) GROUP BY 1)")
    return ", ".join(sql)


@query(f"{_passes(2)} SELECT day, rnd(ga, 4) AS allowance FROM g2")
def iterate_std_ga(spark: SparkSession, sf: str) -> DataFrame:
    """Two passes of standards corrected by allowances and allowances against standards, as one plan."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    facts = lines.select(F.col("p_brand").alias("k"), F.to_date("o_orderdate").alias("day"), (F.col("l_extendedprice") / 1000).alias("t"))
    allowance = facts.select("day").distinct().withColumn("ga", F.lit(0.0))
    for _ in range(2):
        standard = facts.join(allowance, "day").groupBy("k").agg(F.median(F.col("t") - F.col("ga")).alias("std"))
        allowance = facts.join(standard, "k").groupBy("day").agg((F.sum(F.col("t") - F.col("std")) / (F.count(F.lit(1)) + 3)).alias("ga"))
    return allowance.select("day", r("ga").alias("allowance"))


@query("""
WITH c AS (SELECT p_brand, p_size::DOUBLE AS x, median(l_extendedprice / l_quantity) AS y FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N' GROUP BY ALL HAVING count(*) >= 3),
e AS (SELECT p_brand, min(x) AS x0, max(x) AS x1, arg_min(y, x) AS y0, arg_max(y, x) AS y1 FROM c GROUP BY 1),
n AS (SELECT p_partkey, p_brand, any_value(e.y0) AS y0, any_value(e.y1) AS y1, p_size + 0.5 AS q, max(x) FILTER (x <= p_size + 0.5) AS lx, arg_max(y, x) FILTER (x <= p_size + 0.5) AS ly, min(x) FILTER (x >= p_size + 0.5) AS hx, arg_min(y, x) FILTER (x >= p_size + 0.5) AS hy
  FROM part LEFT JOIN c USING (p_brand) LEFT JOIN e USING (p_brand) GROUP BY p_partkey, p_brand, p_size),
s AS (SELECT p_partkey, CASE WHEN lx IS NULL THEN y0 WHEN hx IS NULL THEN y1 ELSE ly + coalesce((q - lx) / nullif(hx - lx, 0), 0) * (hy - ly) END AS std FROM n),
d AS (SELECT o_orderdate::DATE AS day, sum(l_extendedprice / l_quantity - std) / (count(*) + 3) AS ga FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON l_partkey = p_partkey WHERE std IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_extendedprice, rnd(100 - (l_extendedprice / l_quantity - ga - std) / 0.2, 3) AS figure FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON l_partkey = p_partkey JOIN d ON o_orderdate::DATE = day
""")
def flagship_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Figures from start to end: median standards, interpolated to each configuration, daily allowances against them, and what is left of each performance."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    rate = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", rate.alias("t"))
    days = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("day"))
    known = lines.where("l_returnflag = 'N'").join(part, "l_partkey").groupBy("p_brand", "p_size").agg(F.median("t").alias("y"), F.count(F.lit(1)).alias("n")).where("n >= 3")
    asked = part.withColumn("x", F.col("p_size") + 0.5)
    standards = interpolate.join_at(asked, interpolate.curves(known, ["p_brand"], "p_size", "y"), ["p_brand"], "x", "std").select("l_partkey", "std").where("std is not null")
    runs = lines.join(standards, "l_partkey").join(days, "l_orderkey").select("l_orderkey", "l_extendedprice", "day", "t", "std")
    allowances = runs.groupBy("day").agg((F.sum(F.col("t") - F.col("std")) / (F.count(F.lit(1)) + 3)).alias("ga"))
    return runs.join(allowances, "day").select("l_orderkey", "l_extendedprice", r(100 - (F.col("t") - F.col("ga") - F.col("std")) / 0.2, 3).alias("figure"))


@query("""
WITH y AS (SELECT p_brand, year(l_shipdate) AS yr, median(l_quantity) AS m, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT p_brand, rnd(regr_slope(m, yr), 4) AS drift, rnd(coalesce(regr_r2(m, yr), 0), 4) AS r2, count(*)::BIGINT AS n_years FROM y WHERE n >= 10 GROUP BY 1 HAVING count(*) >= 3
""")
def drift_regression(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly medians regressed on the year."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    years = lines.groupBy("p_brand", F.year("l_shipdate").alias("yr")).agg(F.median("l_quantity").alias("m"), F.count(F.lit(1)).alias("n")).where("n >= 10")
    return years.groupBy("p_brand").agg(r(F.regr_slope("m", "yr")).alias("drift"), r(F.coalesce(F.regr_r2("m", "yr"), F.lit(0.0))).alias("r2"), F.count(F.lit(1)).alias("n_years")).where("n_years >= 3")


@query("""
WITH h AS (SELECT unnest([2, 3, 5, 10]) AS half_life), w AS (SELECT half_life, o_orderpriority, o_totalprice, o_orderkey, exp(-0.693 * ((SELECT max(year(o_orderdate)) FROM orders) - year(o_orderdate)) / half_life) AS w FROM orders, h),
c AS (SELECT *, sum(w) OVER (PARTITION BY half_life, o_orderpriority ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY half_life, o_orderpriority) AS total FROM w)
SELECT half_life::INT AS half_life, o_orderpriority, min(o_totalprice) AS median FROM c WHERE run >= total / 2 - 1e-9 GROUP BY ALL
""")
def half_life_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted medians under several half-lives at once."""
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max(F.year("o_orderdate")).alias("last"))
    wide = orders.crossJoin(F.broadcast(last)).withColumn("half_life", F.explode(F.array(*[F.lit(h) for h in (2, 3, 5, 10)])))
    weighed = wide.withColumn("w", F.exp(-0.693 * (F.col("last") - F.year("o_orderdate")) / F.col("half_life")))
    return prefix.weighted_medians(weighed, ["half_life", "o_orderpriority"], "o_totalprice", "w", "o_orderkey", "median")


@query("""
SELECT user_id, ts::DATE AS day, rnd(corr(value, k), 4) AS corr, rnd(regr_slope(value, k), 4) AS slope, count(*) >= 4 AND stddev_samp(k) >= 0.5 AND abs(corr(value, k)) > 0.7 AS is_biased
FROM (SELECT *, (props->>'$.k')::DOUBLE AS k FROM events) GROUP BY ALL HAVING count(*) >= 4 AND stddev_samp(k) > 0
""")
def distance_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Meetings whose errors lean on distance."""
    k = F.col("k")
    days = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("double")).groupBy("user_id", F.to_date("ts").alias("day"))
    out = days.agg(correlation(F.col("value"), k).alias("c"), F.regr_slope("value", k).alias("s"), F.count(F.lit(1)).alias("n"), F.stddev_samp(k).alias("d")).where("n >= 4 and d > 0")
    return out.select("user_id", "day", r("c").alias("corr"), r("s").alias("slope"), ((F.col("n") >= 4) & (F.col("d") >= 0.5) & (F.abs("c") > 0.7)).alias("is_biased"))


@query("SELECT event_id, ntile(4) OVER (PARTITION BY event_type ORDER BY value, event_id)::INT AS quarter FROM events")
def quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Equal-count bins within groups."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return ranks.ntiles(events, ["event_type"], "value", "event_id", 4, "quarter").select("event_id", "quarter")
