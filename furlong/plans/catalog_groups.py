"""Queries on robust estimates, shrinkage, error reports, checks and profiles by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import metrics, ranks, robust, shrink
from ..sources.staging import written
from .registry import query, r, table


@query("""
SELECT p_brand, CASE WHEN p_size <= 25 THEN 'short' ELSE 'long' END AS band, rnd(median(l_extendedprice), 4) AS median_price, rnd(avg(l_extendedprice), 4) AS mean_price, count(*)::BIGINT AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL HAVING count(*) >= 20
""")
def std_times_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians by key with enough support."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    band = F.when(F.col("p_size") <= 25, "short").otherwise("long").alias("band")
    return lines.groupBy("p_brand", band).agg(r(F.median("l_extendedprice")).alias("median_price"), r(F.avg("l_extendedprice")).alias("mean_price"), F.count(F.lit(1)).alias("n")).where("n >= 20")


@query("""
SELECT p_brand, CASE WHEN n_good >= 20 THEN m_good ELSE m_all END AS standard, n_good >= 20 AS from_good FROM (
  SELECT p_brand, count(*) FILTER (l_returnflag = 'N') AS n_good, rnd(median(l_quantity) FILTER (l_returnflag = 'N'), 4) AS m_good, rnd(median(l_quantity), 4) AS m_all
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
""")
def std_times_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The preferred subset's median where it has enough rows, else that of all rows, in one aggregate."""
    good = F.col("l_returnflag") == "N"
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    both = lines.groupBy("p_brand").agg(F.count(F.when(good, 1)).alias("n_good"), F.median(F.when(good, F.col("l_quantity"))).alias("good"), F.median("l_quantity").alias("whole"))
    return both.select("p_brand", r(F.when(F.col("n_good") >= 20, F.col("good")).otherwise(F.col("whole"))).alias("standard"), (F.col("n_good") >= 20).alias("from_good"))


def _half_life(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max(F.year("o_orderdate")).alias("last"))
    return orders.crossJoin(F.broadcast(last)).withColumn("w", F.pow(F.lit(0.5), (F.col("last") - F.year("o_orderdate")) / 4))


HALF_LIFE_SQL = "(SELECT *, pow(0.5, ((SELECT max(year(o_orderdate)) FROM orders) - year(o_orderdate)) / 4.0) AS w FROM orders)"


@query(f"""
SELECT o_custkey, min(o_totalprice) AS weighted_median FROM (
  SELECT o_custkey, o_totalprice, sum(w) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY o_custkey) AS total FROM {HALF_LIFE_SQL})
WHERE run >= total / 2 - 1e-9 GROUP BY 1
""")
def weighted_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians weighted by a half-life of four years."""
    return robust.weighted_median(_half_life(spark, sf), ["o_custkey"], "o_totalprice", "w", "o_orderkey")


@query("""
SELECT p_brand, rnd(median(l_quantity), 4) AS trimmed_median FROM (
  SELECT p_brand, l_quantity, row_number() OVER (PARTITION BY p_brand ORDER BY l_quantity, l_orderkey, l_extendedprice) AS i, count(*) OVER (PARTITION BY p_brand) AS n, floor(count(*) OVER (PARTITION BY p_brand) * 0.05) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE k < 1 OR n - 2 * k < 3 OR (i > k AND i <= n - k) GROUP BY 1
""")
def trimmed_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians after five per cent of each tail is cut; a brand may hold any share of the rows."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select("p_brand", "l_quantity")
    return ranks.medians(written(lines, "lines"), ["p_brand"], "l_quantity", trim=0.05).select("p_brand", r("median").alias("trimmed_median"))


@query(f"""
WITH cut AS (
  SELECT o_custkey, o_totalprice, o_orderkey, w FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n, floor(count(*) OVER (PARTITION BY o_custkey) * 0.1) AS k FROM {HALF_LIFE_SQL})
  WHERE k < 1 OR n - 2 * k < 3 OR (i > k AND i <= n - k))
SELECT o_custkey, min(o_totalprice) AS weighted_median FROM (
  SELECT o_custkey, o_totalprice, sum(w) OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY o_custkey) AS total FROM cut)
WHERE run >= total / 2 - 1e-9 GROUP BY 1
""")
def weighted_trimmed_median(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted medians of what trimming leaves."""
    kept = robust.trimmed(_half_life(spark, sf), ["o_custkey"], "o_totalprice", 0.1, "o_orderkey")
    return robust.weighted_median(kept, ["o_custkey"], "o_totalprice", "w", "o_orderkey")


@query("""
WITH a AS (SELECT user_id, value, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value, event_id)),
e AS (SELECT user_id, max(n) AS n, coalesce(max(value) FILTER (i = 2 AND n > 2), min(value)) AS lo, coalesce(max(value) FILTER (i = n - 1 AND n > 2), max(value)) AS hi FROM a GROUP BY 1)
SELECT user_id, any_value(e.n)::BIGINT AS n, rnd(avg(least(greatest(value, lo), hi)), 4) AS winsor_mean, rnd(stddev_samp(least(greatest(value, lo), hi)) / sqrt(any_value(e.n)), 4) AS winsor_se,
  rnd(median(least(greatest(value, lo), hi)), 4) AS winsor_median FROM a JOIN e USING (user_id) GROUP BY 1
""")
def winsor_mean_se(spark: SparkSession, sf: str) -> DataFrame:
    """Means, standard errors and medians with the extremes pulled in."""
    out = robust.winsorized_large(table(spark, sf, "events"), ["user_id"], "value")
    return out.select("user_id", "n", *[r(c).alias(c) for c in ("winsor_mean", "winsor_se", "winsor_median")])


@query("""
SELECT event_id, user_id FROM (SELECT *, median(value) OVER (PARTITION BY user_id) AS m, stddev_samp(value) OVER (PARTITION BY user_id) AS s FROM events) WHERE s IS NULL OR s = 0 OR abs(value - m) / s <= 2
""")
def zscore_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows within two deviations of their user's median."""
    return robust.without_outliers(table(spark, sf, "events"), ["user_id"], "value", 2.0).select("event_id", "user_id")


@query("""
WITH h AS (SELECT user_id, ts::DATE AS day, value, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS i FROM events),
s AS (SELECT user_id, day, max(n) AS n, avg(value) FILTER (i <= n // 2) AS a, avg(value) FILTER (i > n // 2) AS b, var_samp(value) FILTER (i <= n // 2) AS va, var_samp(value) FILTER (i > n // 2) AS vb,
  count(*) FILTER (i <= n // 2) AS na, count(*) FILTER (i > n // 2) AS nb FROM h GROUP BY ALL)
SELECT user_id, day, n::BIGINT AS n, rnd(abs(a - b) / nullif(sqrt(va / na + vb / nb), 0), 4) AS t, coalesce(n >= 6 AND abs(a - b) / nullif(sqrt(va / na + vb / nb), 0) > 2.5 AND abs(a - b) > 0.1, false) AS is_split FROM s
""")
def split_card_test(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a user's day falls into two halves with different means."""
    days = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return robust.split_test(days, ["user_id", "day"], "value", ["ts", "event_id"]).select("user_id", "day", "n", r("t").alias("t"), "is_split")


@query("""
WITH u AS (SELECT user_id, event_type, avg(value) AS m, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT event_type, avg(value) AS prior FROM events GROUP BY 1),
s AS (SELECT user_id, event_type, (n * m + 3 * prior) / (n + 3) - 50 AS x FROM u JOIN p USING (event_type))
SELECT user_id, event_type, rnd(x, 4) AS shrunk, rnd(CASE WHEN abs(x) > 5 THEN x + sign(x) * 0.25 * (abs(x) - 5) * (abs(x) - 5) ELSE x END, 4) AS boosted FROM s
""")
def bayes_shrink(spark: SparkSession, sf: str) -> DataFrame:
    """Group means shrunk to the mean of their type, then boosted beyond a threshold."""
    events = table(spark, sf, "events")
    prior = events.groupBy("event_type").agg(F.avg("value").alias("prior"))
    means = events.groupBy("user_id", "event_type").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n")).join(prior, "event_type")
    x = means.withColumn("x", shrink.toward(F.col("m"), F.col("n"), F.col("prior"), 3.0) - 50)
    return x.select("user_id", "event_type", r("x").alias("shrunk"), r(shrink.boosted(F.col("x"), 5.0, 0.25)).alias("boosted"))


@query("""
WITH q AS (SELECT event_type, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events GROUP BY 1)
SELECT event_id, rnd(greatest(least(value, greatest(hi, 100.0)), least(lo, 1.0)), 4) AS capped FROM events JOIN q USING (event_type)
""")
def soft_cap_percentile(spark: SparkSession, sf: str) -> DataFrame:
    """Values kept between the outer percentiles of their type or fixed bounds, whichever are wider."""
    events = table(spark, sf, "events")
    q = ranks.percentiles(events, ["event_type"], "value", [0.01, 0.99]).select("event_type", F.col("percentiles")[0].alias("lo"), F.col("percentiles")[1].alias("hi"))
    return events.join(q, "event_type").select("event_id", r(robust.soft_cap(F.col("value"), F.col("lo"), F.col("hi"), 1.0, 100.0)).alias("capped"))


@query("""
SELECT p_partkey, rnd(avg(p_retailprice / p_size) OVER (PARTITION BY p_size // 10, p_type) / (p_retailprice / p_size), 4) AS factor FROM part
""")
def band_relative_factor(spark: SparkSession, sf: str) -> DataFrame:
    """A band's mean rate over the row's own."""
    rate = F.col("p_retailprice") / F.col("p_size")
    return table(spark, sf, "part").select("p_partkey", r(F.avg(rate).over(Window.partitionBy(F.floor(F.col("p_size") / 10), "p_type")) / rate).alias("factor"))


@query("""
WITH d AS (SELECT p_brand, p_size, avg(p_retailprice) AS m, count(*) AS n FROM part GROUP BY ALL), g AS (SELECT p_size, avg(p_retailprice) AS g FROM part GROUP BY 1)
SELECT p_brand, p_size, rnd(CASE WHEN n >= 3 THEN m ELSE (n * m + 15 * g) / (n + 15) END, 4) AS standard, n < 3 AS is_provisional FROM d JOIN g USING (p_size)
""")
def thin_group_blend(spark: SparkSession, sf: str) -> DataFrame:
    """Thin groups blended with the generic estimate, and marked."""
    part = table(spark, sf, "part")
    own = part.groupBy("p_brand", "p_size").agg(F.avg("p_retailprice").alias("m"), F.count(F.lit(1)).alias("n")).join(part.groupBy("p_size").agg(F.avg("p_retailprice").alias("g")), "p_size")
    return own.select("p_brand", "p_size", r(F.when(F.col("n") >= 3, F.col("m")).otherwise(shrink.toward(F.col("m"), F.col("n"), F.col("g"), 15.0))).alias("standard"), (F.col("n") < 3).alias("is_provisional"))


@query("""
WITH o AS (SELECT p_brand, avg(p_retailprice) AS v, count(*) AS n FROM part WHERE p_size > 45 GROUP BY 1), s AS (SELECT p_brand, min(p_retailprice) AS seed FROM part GROUP BY 1)
SELECT p_brand, rnd(CASE WHEN n >= 8 THEN v ELSE seed END, 4) AS prior, coalesce(n >= 8, false) AS is_observed FROM s LEFT JOIN o USING (p_brand)
""")
def empirical_prior_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """Observed priors where support is enough, else seeds."""
    part = table(spark, sf, "part")
    observed = part.where("p_size > 45").groupBy("p_brand").agg(F.avg("p_retailprice").alias("prior"), F.count(F.lit(1)).alias("n"))
    out = shrink.seeded(observed, part.groupBy("p_brand").agg(F.min("p_retailprice").alias("prior")), "p_brand", "prior", "n", 8)
    return out.select("p_brand", r("prior").alias("prior"), "is_observed")


@query("""
WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)
SELECT p_brand, arg_min(p_type, (-n, p_type)) AS label, rnd(max(n) / sum(n), 4) AS share, max(n) / sum(n) > 0.25 AS is_dominant FROM c GROUP BY 1
""")
def going_dominance(spark: SparkSession, sf: str) -> DataFrame:
    """The label that dominates each group."""
    return metrics.dominance(table(spark, sf, "part"), ["p_brand"], "p_type", 0.25).select("p_brand", "label", r("share").alias("share"), "is_dominant")


@query("""
SELECT p_brand, p_size, rnd(m, 4) AS m FROM (SELECT p_brand, p_size, m, lag(m) OVER (PARTITION BY p_brand ORDER BY p_size) AS p FROM (SELECT p_brand, p_size, median(p_retailprice) AS m FROM part GROUP BY ALL)) WHERE m <= p
""")
def monotonicity(spark: SparkSession, sf: str) -> DataFrame:
    """Points where a curve that should rise does not."""
    curve = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.median("p_retailprice").alias("m"))
    return metrics.not_rising(curve, ["p_brand"], "p_size", "m").select("p_brand", "p_size", r("m").alias("m"))


@query("""
WITH s AS (SELECT l_suppkey, avg(l_extendedprice) AS a, median(l_extendedprice) AS m FROM lineitem GROUP BY 1), z AS (SELECT *, avg(m) OVER () AS am, stddev_samp(m) OVER () AS sm FROM s)
SELECT l_suppkey, abs(a - m) / m >= 0.03 AS is_divergent, abs(a - m) / m >= 0.10 AS is_excluded, abs(m - am) / sm > 2.5 AS is_outlier FROM z
""")
def divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Groups whose mean and median part, or that lie far from the others."""
    s = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_extendedprice").alias("a"), F.median("l_extendedprice").alias("m"))
    whole = s.agg(F.avg("m").alias("am"), F.stddev_samp("m").alias("sm"))
    part = F.abs(F.col("a") - F.col("m")) / F.col("m")
    return s.crossJoin(F.broadcast(whole)).select("l_suppkey", (part >= 0.03).alias("is_divergent"), (part >= 0.1).alias("is_excluded"), (F.abs(F.col("m") - F.col("am")) / F.col("sm") > 2.5).alias("is_outlier"))


ERRORS_SQL = """count(*)::BIGINT AS n, rnd(avg(abs(e)), 4) AS mae, rnd(sqrt(avg(e * e)), 4) AS rmse, rnd(avg(e), 4) AS bias, rnd(corr(p, a), 4) AS corr, rnd(avg((abs(e) <= 5)::INT), 4) AS within_5, rnd(avg((abs(e) <= 10)::INT), 4) AS within_10"""
SCORED_SQL = "(SELECT *, p - a AS e FROM (SELECT l_returnflag, l_linestatus, year(l_shipdate)::INT AS year, l_quantity * 2 AS a, l_quantity + 25 + l_discount * 20 AS p FROM lineitem))"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"), (F.col("l_quantity") * 2).alias("a"), (F.col("l_quantity") + 25 + F.col("l_discount") * 20).alias("p"))


def _errors() -> list:
    return [r(e).alias(name) if name != "n" else e for e, name in zip(metrics.errors(F.col("p"), F.col("a")), ("n", "mae", "rmse", "bias", "corr", "within_5", "within_10"), strict=True)]


@query(f"SELECT l_returnflag, {ERRORS_SQL} FROM {SCORED_SQL} GROUP BY 1")
def error_report(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of a prediction by group."""
    return _scored(spark, sf).groupBy("l_returnflag").agg(*_errors())


@query(f"SELECT l_returnflag, l_linestatus, year, {ERRORS_SQL} FROM {SCORED_SQL} GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (year), (l_returnflag, year), ())")
def error_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The same by many factors in one pass."""
    keys = [F.col(c) for c in ("l_returnflag", "l_linestatus", "year")]
    sets = [[keys[0]], [keys[1]], [keys[2]], [keys[0], keys[2]], []]
    return _scored(spark, sf).groupingSets(sets, *keys).agg(*_errors()).select("l_returnflag", "l_linestatus", "year", "n", "mae", "rmse", "bias", "corr", "within_5", "within_10")


@query(f"""
WITH g AS (SELECT l_returnflag, avg(abs(e)) AS m, count(*) AS n FROM {SCORED_SQL} GROUP BY 1), t AS (SELECT avg(abs(e)) AS m, count(*) AS n FROM {SCORED_SQL})
SELECT l_returnflag, rnd(abs(g.m - t.m) * g.n / t.n, 4) AS contribution FROM g, t
""")
def error_contribution(spark: SparkSession, sf: str) -> DataFrame:
    """How much each group's error differs from the whole's, by its share."""
    e = F.abs(F.col("p") - F.col("a"))
    scored = _scored(spark, sf)
    groups, whole = scored.groupBy("l_returnflag").agg(F.avg(e).alias("m"), F.count(F.lit(1)).alias("n")), scored.agg(F.avg(e).alias("tm"), F.count(F.lit(1)).alias("tn"))
    return groups.crossJoin(F.broadcast(whole)).select("l_returnflag", r(F.abs(F.col("m") - F.col("tm")) * F.col("n") / F.col("tn")).alias("contribution"))


@query("SELECT l_returnflag, rnd(avg((l_linestatus = 'F')::INT), 4) AS \"share_F\", rnd(avg((l_linestatus = 'O')::INT), 4) AS \"share_O\" FROM lineitem GROUP BY 1")
def crosstab_pct(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of one label within another."""
    return metrics.crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"]).select("l_returnflag", r("share_F").alias("share_F"), r("share_O").alias("share_O"))


@query("SELECT p_brand, min(p_retailprice) FILTER (p_size = 10) AS size_10, min(p_retailprice) FILTER (p_size = 20) AS size_20, min(p_retailprice) FILTER (p_size = 30) AS size_30 FROM part GROUP BY 1")
def pivot_first(spark: SparkSession, sf: str) -> DataFrame:
    """One column for each of some named values."""
    wide = table(spark, sf, "part").groupBy("p_brand").pivot("p_size", [10, 20, 30]).agg(F.min("p_retailprice"))
    return wide.withColumnsRenamed({"10": "size_10", "20": "size_20", "30": "size_30"})


@query("""
WITH g AS (SELECT event_type, user_id, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY ALL)
SELECT event_type, rnd(var_samp(m), 4) AS between_groups, rnd(avg(v), 4) AS within_groups FROM g GROUP BY 1
""")
def variance_components(spark: SparkSession, sf: str) -> DataFrame:
    """Variance between and within groups."""
    groups = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.avg("value").alias("m"), F.var_samp("value").alias("v"))
    return groups.groupBy("event_type").agg(r(F.var_samp("m")).alias("between_groups"), r(F.avg("v")).alias("within_groups"))


@query("""
SELECT count(*)::BIGINT AS n, count(DISTINCT o_custkey)::BIGINT AS n_customers, rnd(avg((o_orderpriority <> '')::INT), 4) AS has_priority, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
  count(*) FILTER (o_totalprice >= 100000 AND o_totalprice < 200000)::BIGINT AS n_middle, rnd(stddev_samp(o_totalprice), 2) AS sd FROM orders
""")
def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    """One row of counts, ranges and completeness."""
    return table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_customers"), r(F.avg((F.col("o_orderpriority") != "").cast("int"))).alias("has_priority"),
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"),
        F.count(F.when((F.col("o_totalprice") >= 100000) & (F.col("o_totalprice") < 200000), 1)).alias("n_middle"), r(F.stddev_samp("o_totalprice"), 2).alias("sd"),
    )


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*)::BIGINT AS n, count(o_custkey)::BIGINT AS n_known, rnd(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def month_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The last twelve months of a table."""
    months = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count("o_custkey").alias("n_known"), r(F.avg("o_totalprice")).alias("mean"))
    return months.orderBy(F.desc("month")).limit(12)


@query("SELECT p_type, count(*)::BIGINT AS n, rnd(count(*) / (SELECT count(*) FROM part), 4) AS share FROM part GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Frequencies and shares of a label."""
    part = table(spark, sf, "part")
    return part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(part.agg(F.count(F.lit(1)).alias("t")))).select("p_type", "n", r(F.col("n") / F.col("t")).alias("share"))


@query("""
SELECT l_suppkey, rnd(avg(abs(l_extendedprice - 30000)), 4) AS mae FROM lineitem GROUP BY 1 HAVING count(*) > 20 ORDER BY avg(abs(l_extendedprice - 30000)) DESC, l_suppkey LIMIT 15
""")
def topk_worst(spark: SparkSession, sf: str) -> DataFrame:
    """The fifteen worst groups with support."""
    groups = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg(F.abs(F.col("l_extendedprice") - 30000)).alias("e"), F.count(F.lit(1)).alias("n"))
    return groups.where("n > 20").orderBy(F.desc("e"), "l_suppkey").limit(15).select("l_suppkey", r("e").alias("mae"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY abs(o_totalprice - 150000), o_orderkey LIMIT 20")
def nearest_by_abs(spark: SparkSession, sf: str) -> DataFrame:
    """The twenty rows nearest to a value."""
    return table(spark, sf, "orders").orderBy(F.abs(F.col("o_totalprice") - 150000), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("""
WITH o AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'N') AS done, max(l_quantity) = min(l_quantity) AND count(*) >= 3 AS flat, avg((l_discount > 0.07)::INT) >= 0.5 AS heavy,
  max(l_extendedprice) / avg(l_extendedprice) > 2.5 AS odd FROM lineitem GROUP BY 1)
SELECT l_orderkey, n::BIGINT AS n, flat, heavy, odd, flat OR heavy OR odd AS is_rejected, done = n AS is_complete FROM o
""")
def race_qc(spark: SparkSession, sf: str) -> DataFrame:
    """Rules by race that reject it, and whether it is complete."""
    x = F.col("l_extendedprice")
    races = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("done"), ((F.max("l_quantity") == F.min("l_quantity")) & (F.count(F.lit(1)) >= 3)).alias("flat"),
        (F.avg((F.col("l_discount") > 0.07).cast("int")) >= 0.5).alias("heavy"), (F.max(x) / F.avg(x) > 2.5).alias("odd"),
    )
    return races.select("l_orderkey", "n", "flat", "heavy", "odd", (F.col("flat") | F.col("heavy") | F.col("odd")).alias("is_rejected"), (F.col("done") == F.col("n")).alias("is_complete"))


@query("""
SELECT o_orderdate::DATE AS day, o_orderpriority, count(*)::BIGINT AS n, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS n_done, count(*) = count(*) FILTER (o_orderstatus = 'F') AS is_complete FROM orders GROUP BY ALL
""")
def completeness_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Meetings all of whose races have a result."""
    done = F.count(F.when(F.col("o_orderstatus") == "F", 1))
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), done.alias("n_done"), (F.count(F.lit(1)) == done).alias("is_complete"))
