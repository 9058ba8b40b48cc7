"""Queries on lag-safe histories: events as runs of users, orders as runs of customers, lines as runners of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import prefix, ranks
from ..operators import windows as W
from ..sources.staging import dealt
from .registry import query, r, table

USER, WHEN = ["user_id"], ["ts", "event_id"]
P = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"
ALL, L3, L5, L10 = (P.format(n) for n in ("UNBOUNDED", 3, 5, 10))
LAG = "lag({0}, {1}) OVER (PARTITION BY user_id ORDER BY ts, event_id)"


def _lags(x: str, n: int, form: str, start: int = 1) -> str:
    return " + ".join("coalesce(" + form.format(LAG.format(x, i), i) + ", 0)" for i in range(start, n + start))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with a metric that is null for some of them, as real results are."""
    x = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value", x.alias("x"), (F.col("value") > 60).cast("double").alias("won"), F.get_json_object("props", "$.k").cast("int").alias("k"))


RUNS = "(SELECT *, CASE WHEN event_type <> 'error' THEN value END AS x, (value > 60)::DOUBLE AS won, (props->>'$.k')::INT AS k FROM events)"


@query(f"""
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS runs, rnd(avg(x) {ALL}, 4) AS career, rnd({LAG.format('x', 1)}, 4) AS last, sum(won) {ALL} AS wins, rnd(max(x) {ALL}, 4) AS best,
  rnd(stddev_samp(x) {ALL}, 4) AS spread, rnd(sum(won) {ALL} / nullif(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1, 0), 4) AS rate FROM {RUNS}
""")
def lag_safe_career(spark: SparkSession, sf: str) -> DataFrame:
    """Career figures before each run."""
    by, x = (USER, WHEN), F.col("x")
    runs, wins = W.prior_count(*by), F.sum("won").over(W.prior(*by))
    return _runs(spark, sf).select(
        "event_id", runs.alias("runs"), r(W.prior_mean(x, *by)).alias("career"), r(F.lag(x).over(W.ordered(*by))).alias("last"), wins.alias("wins"), r(F.max(x).over(W.prior(*by))).alias("best"),
        r(W.prior_std(x, *by)).alias("spread"), r(F.try_divide(wins, runs)).alias("rate"),
    )


@query(f"""
SELECT event_id, rnd(avg(x) {L3}, 4) AS m3, rnd(avg(x) {L5}, 4) AS m5, rnd(avg(x) {L10}, 4) AS m10, rnd(CASE WHEN count(x) {L5} >= 2 THEN stddev_samp(x) {L5} END, 4) AS s5, rnd(avg(won) {L10}, 4) AS r10 FROM {RUNS}
""")
def rolling_prior(spark: SparkSession, sf: str) -> DataFrame:
    """Means and spreads of the last runs."""
    by, x = (USER, WHEN), F.col("x")
    means = [r(W.prior_mean(x, *by, n)).alias(f"m{n}") for n in (3, 5, 10)]
    return _runs(spark, sf).select("event_id", *means, r(W.prior_std(x, *by, 5)).alias("s5"), r(W.prior_mean(F.col("won"), *by, 10)).alias("r10"))


@query(f"""
SELECT event_id, CASE WHEN {LAG.format('event_id', 1)} IS NOT NULL THEN rnd({_lags('x', 5, '{0} / {1}')}, 4) END AS harmonic_5,
  rnd(({_lags('x', 5, '{0} * pow(0.85, {1} - 1)')}) / nullif({_lags('x', 5, 'CASE WHEN {0} IS NOT NULL THEN pow(0.85, {1} - 1) END')}, 0), 4) AS decayed_5 FROM {RUNS}
""")
def harmonic_and_decay(spark: SparkSession, sf: str) -> DataFrame:
    """Harmonic sums and decayed means of the last five runs."""
    by, x = (USER, WHEN), F.col("x")
    return _runs(spark, sf).select("event_id", r(W.harmonic(x, *by, 5)).alias("harmonic_5"), r(W.decayed(x, *by, 5, 0.85)).alias("decayed_5"))


@query(f"""
SELECT event_id, rnd(sqrt(greatest(avg(value * value) {L10} - 2 * value * avg(value) {L10} + value * value, 0)), 3) AS distance_10 FROM events
""")
def rmsd_lags(spark: SparkSession, sf: str) -> DataFrame:
    """How far a run's conditions lie from those of the last ten."""
    return table(spark, sf, "events").select("event_id", r(W.distance_to_last(F.col("value"), USER, WHEN, 10), 3).alias("distance_10"))


@query("""
SELECT o_orderkey, date_diff('day', lag(d, 1) OVER w, d) AS gap_1, date_diff('day', lag(d, 2) OVER w, d) AS gap_2, date_diff('day', lag(d, 1) OVER w, d) > 60 AS is_fresh
FROM (SELECT *, o_orderdate::DATE AS d FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def days_since(spark: SparkSession, sf: str) -> DataFrame:
    """Days since the last runs."""
    w, day = W.ordered(["o_custkey"], ["o_orderdate", "o_orderkey"]), F.to_date("o_orderdate")
    gap = lambda i: F.date_diff(day, F.lag(day, i).over(w)).cast("long")
    return table(spark, sf, "orders").select("o_orderkey", gap(1).alias("gap_1"), gap(2).alias("gap_2"), (gap(1) > 60).alias("is_fresh"))


@query("""
SELECT l_orderkey, l_extendedprice, rnd(l_quantity - avg(l_quantity) OVER o, 4) AS vs_mean, l_quantity - min(l_quantity) OVER o AS vs_min, max(l_quantity) OVER o - min(l_quantity) OVER o AS spread,
  rnd(100.0 * count(*) FILTER (l_discount > 0.05) OVER o / count(*) OVER o, 4) AS pressure FROM lineitem WINDOW o AS (PARTITION BY l_orderkey)
""")
def race_transform(spark: SparkSession, sf: str) -> DataFrame:
    """A runner against its race, and a share of the race."""
    o, q = Window.partitionBy("l_orderkey"), F.col("l_quantity")
    share = 100.0 * F.count(F.when(F.col("l_discount") > 0.05, 1)).over(o) / F.count(F.lit(1)).over(o)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", r(q - F.avg(q).over(o)).alias("vs_mean"), (q - F.min(q).over(o)).alias("vs_min"), (F.max(q).over(o) - F.min(q).over(o)).alias("spread"), r(share).alias("pressure"))


@query("""
WITH e AS (SELECT *, count(*) OVER o AS n, rank() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC) AS pos, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS exp FROM lineitem WINDOW o AS (PARTITION BY l_orderkey))
SELECT l_orderkey, l_extendedprice, rnd((n - pos) / nullif(n - 1, 0)::DOUBLE - (n - exp) / nullif(n - 1, 0)::DOUBLE, 4) AS residual FROM e
""")
def expect_residual(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised finish less that expected from the market's rank."""
    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    beaten = lambda c: F.try_divide((n - W.rank_desc(F.col(c), ["l_orderkey"])).cast("double"), n - 1)
    return dealt(table(spark, sf, "lineitem"), "l_orderkey").select("l_orderkey", "l_extendedprice", r(beaten("l_discount") - beaten("l_quantity")).alias("residual"))


@query(f"""
SELECT event_id, row_number() OVER t - 1 AS runs_of_type, row_number() OVER t = 1 AS is_first, rnd(avg(x) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4) AS mean_of_type
FROM {RUNS} WINDOW t AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
""")
def experience_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Experience under a condition before each run."""
    by = (["user_id", "event_type"], WHEN)
    return _runs(spark, sf).select("event_id", W.prior_count(*by).alias("runs_of_type"), (W.prior_count(*by) == 0).alias("is_first"), r(W.prior_mean(F.col("x"), *by)).alias("mean_of_type"))


@query(f"""
SELECT event_id, k - {LAG.format('k', 1)} AS step, rnd(k - avg(k) {L3}, 4) AS vs_last_3, k < {LAG.format('k', 1)} AS is_drop, k - {LAG.format('k', 3)} AS step_3, k - max(k) {ALL} AS vs_best,
  last_value(CASE WHEN won = 1 THEN k END IGNORE NULLS) {ALL} AS last_winning FROM {RUNS}
""")
def class_and_rating(spark: SparkSession, sf: str) -> DataFrame:
    """Movement of a class or rating over the runs, and the last one that won."""
    by, k = (USER, WHEN), F.col("k")
    lag = lambda i: F.lag(k, i).over(W.ordered(*by))
    return _runs(spark, sf).select(
        "event_id", (k - lag(1)).alias("step"), r(k - W.prior_mean(k, *by, 3)).alias("vs_last_3"), (k < lag(1)).alias("is_drop"), (k - lag(3)).alias("step_3"),
        (k - F.max(k).over(W.prior(*by))).alias("vs_best"), W.last_value_when(k, F.col("won") == 1, *by).alias("last_winning"),
    )


@query(f"""
SELECT event_id, rnd(pref, 4) AS preferred, rnd(abs(k - pref), 4) AS off_by FROM (SELECT *, sum(k * x) {ALL} / nullif(sum(CASE WHEN k IS NOT NULL THEN x END) {ALL}, 0) AS pref FROM {RUNS})
""")
def pref_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """The condition preferred so far, weighted by results, and how far today is from it."""
    w = W.prior(USER, WHEN)
    pref = F.try_divide(F.sum(F.col("k") * F.col("x")).over(w), F.sum(F.when(F.col("k").isNotNull(), F.col("x"))).over(w))
    return _runs(spark, sf).withColumn("pref", pref).select("event_id", r("pref").alias("preferred"), r(F.abs(F.col("k") - F.col("pref"))).alias("off_by"))


@query(f"""
SELECT event_id, CASE WHEN {LAG.format('x', 1)} IS NOT NULL THEN rnd(({_lags('x', 5, '{0} * ({1} - 3.0)')}) / 10, 4) END AS slope_5 FROM {RUNS}
""")
def form_slope(spark: SparkSession, sf: str) -> DataFrame:
    """The trend of the last five runs."""
    return _runs(spark, sf).select("event_id", r(W.slope_of_last(F.col("x"), USER, WHEN, 5)).alias("slope_5"))


@query("""
WITH d AS (SELECT ts::DATE AS day, sum(value) AS s, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT day, sum(s) OVER w AS s, sum(n) OVER w AS n FROM d WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e AS (SELECT event_id, event_type, ts, (coalesce(g.s, 0) + coalesce(sum(value) OVER i, 0)) / nullif(coalesce(g.n, 0) + count(*) OVER i, 0) AS world,
  sum(value) OVER t AS s, count(*) OVER t AS n FROM events JOIN g ON ts::DATE = g.day
  WINDOW i AS (PARTITION BY ts::DATE ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), t AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, rnd((coalesce(s, 0) + 20 * world) / (n + 20), 4) AS shrunk FROM e
""")
def pedigree_shrunk(spark: SparkSession, sf: str) -> DataFrame:
    """A parent's prior results shrunk to the world's prior mean. The world's running sums are taken by day, then within the day, so no window holds the whole table."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    days = events.groupBy("day").agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row a day
    world = days.select("day", F.sum("s").over(before).alias("ds"), F.sum("n").over(before).alias("dn"))
    today = W.prior(["day"], WHEN)
    zero = lambda c: F.coalesce(c, F.lit(0))
    mean = F.try_divide(zero(F.col("ds")) + zero(F.sum("value").over(today)), zero(F.col("dn")) + F.count(F.lit(1)).over(today))
    known = events.join(world, "day").select("event_id", "event_type", "ts", "value", mean.alias("world"))
    kind = prefix.running(known, ["event_type"], WHEN, {"s": F.col("value"), "n": F.lit(1)})  # a parent may hold any share of the rows
    return kind.select("event_id", r((F.col("s") + 20 * F.col("world")) / (F.col("n") + 20)).alias("shrunk"))


@query("""
SELECT a.event_id, nullif(count(b.event_id), 0) AS runs_3d, CASE WHEN count(b.event_id) > 0 THEN sum((b.value > 60)::INT)::BIGINT END AS wins_3d
FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND ((b.ts::DATE < a.ts::DATE AND date_diff('day', b.ts::DATE, a.ts::DATE) < 3) OR (b.ts::DATE = a.ts::DATE AND (b.ts, b.event_id) < (a.ts, a.event_id))) GROUP BY 1
""")
def hot_form_3d(spark: SparkSession, sf: str) -> DataFrame:
    """Runs and wins of the last days, earlier runs of the same day included."""
    day = F.unix_date(F.to_date("ts"))
    events = table(spark, sf, "events").withColumn("day", day).withColumn("won", (F.col("value") > 60).cast("int"))
    runs = W.recent(F.lit(1), USER, F.col("day"), WHEN, 3)
    before = Window.partitionBy("user_id").orderBy("day").rangeBetween(-2, -1)
    same = Window.partitionBy("user_id", "day").orderBy(*WHEN).rowsBetween(Window.unboundedPreceding, -1)
    wins = F.coalesce(F.sum("won").over(before), F.lit(0)) + F.coalesce(F.sum("won").over(same), F.lit(0))
    return events.select("event_id", runs.alias("runs_3d"), F.when(runs.isNotNull(), wins).alias("wins_3d"))


@query("""
SELECT l_orderkey, l_extendedprice, rank() OVER (PARTITION BY l_orderkey ORDER BY q DESC NULLS LAST) AS q_rank, rank() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC NULLS LAST) AS d_rank,
  rank() OVER (PARTITION BY l_orderkey ORDER BY l_tax) + (count(*) OVER (PARTITION BY l_orderkey, l_tax) - 1) / 2.0::DOUBLE AS tax_rank FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS q FROM lineitem)
""")
def race_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks within a race, nulls last, and ranks with ties averaged."""
    lines = dealt(table(spark, sf, "lineitem"), "l_orderkey").withColumn("q", F.when(F.col("l_returnflag") != "R", F.col("l_quantity")))
    by = ["l_orderkey"]
    return lines.select("l_orderkey", "l_extendedprice", W.rank_desc(F.col("q"), by).alias("q_rank"), W.rank_desc(F.col("l_discount"), by).alias("d_rank"), W.average_rank(F.col("l_tax"), by).cast("double").alias("tax_rank"))


@query("SELECT o_orderkey, dense_rank() OVER (PARTITION BY o_orderdate::DATE, o_orderpriority ORDER BY o_orderkey) AS race_number, count(*) OVER (PARTITION BY o_orderpriority) AS frequency FROM orders")
def race_number_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of races within a meeting, and a label's frequency."""
    number = F.dense_rank().over(Window.partitionBy(F.to_date("o_orderdate"), "o_orderpriority").orderBy("o_orderkey")).cast("long")
    orders = table(spark, sf, "orders")
    frequency = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("frequency"))
    return orders.select("o_orderkey", "o_orderpriority", number.alias("race_number")).join(frequency, "o_orderpriority").select("o_orderkey", "race_number", "frequency")


@query("""
SELECT l_orderkey, l_extendedprice, rnd((i - 1) / nullif(n - 1, 0)::DOUBLE, 4) AS draw, CASE WHEN n > 1 THEN CASE WHEN (i - 1) / (n - 1)::DOUBLE <= 0.25 THEN 1 WHEN (i - 1) / (n - 1)::DOUBLE <= 0.5 THEN 2 WHEN (i - 1) / (n - 1)::DOUBLE <= 0.75 THEN 3 ELSE 4 END END AS quarter
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
""")
def relative_draw(spark: SparkSession, sf: str) -> DataFrame:
    """The stall's place between the rails, and its quarter."""
    i, n = F.row_number().over(W.ordered(["l_orderkey"], ["l_extendedprice"])), F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    d = F.try_divide((i - 1).cast("double"), n - 1)
    quarter = F.when(d <= 0.25, 1).when(d <= 0.5, 2).when(d <= 0.75, 3).when(d.isNotNull(), 4)
    return dealt(table(spark, sf, "lineitem"), "l_orderkey").select("l_orderkey", "l_extendedprice", r(d).alias("draw"), quarter.alias("quarter"))


@query(f"""
WITH c AS (SELECT *, coalesce(sum(won) {ALL}, 0) AS wins, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS runs FROM {RUNS}), s AS (SELECT *, wins / nullif(runs, 0) AS rate FROM c)
SELECT event_id, rnd(avg(rate) OVER (PARTITION BY ts::DATE, event_type), 4) AS strength, rnd(rate - avg(rate) OVER (PARTITION BY ts::DATE, event_type), 4) + 0.0::DOUBLE AS vs_race FROM s
""")
def race_strength(spark: SparkSession, sf: str) -> DataFrame:
    """The mean prior record of a race's runners, and each against it."""
    by = (USER, WHEN)
    rate = F.try_divide(F.coalesce(F.sum("won").over(W.prior(*by)), F.lit(0.0)), W.prior_count(*by))
    race = Window.partitionBy(F.to_date("ts"), "event_type")
    return _runs(spark, sf).withColumn("rate", rate).select("event_id", r(F.avg("rate").over(race)).alias("strength"), r(F.col("rate") - F.avg("rate").over(race)).alias("vs_race"))


@query(f"""
SELECT event_id, CASE WHEN {LAG.format('event_type', 1)} IS NOT NULL THEN event_type <> {LAG.format('event_type', 1)} END AS changed, event_type = 'purchase' AND coalesce(sum((event_type = 'purchase')::INT) {ALL}, 0) = 0 AS first_ever FROM events
""")
def equipment_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Whether equipment changed, or is worn for the first time."""
    worn = (F.col("event_type") == "purchase").cast("int")
    first = (F.col("event_type") == "purchase") & (F.coalesce(F.sum(worn).over(W.prior(USER, WHEN)), F.lit(0)) == 0)
    return table(spark, sf, "events").select("event_id", (F.col("event_type") != F.lag("event_type").over(W.ordered(USER, WHEN))).alias("changed"), first.alias("first_ever"))


@query(f"""
SELECT event_id, rnd((std - value) / std * 100, 4) AS rating, rnd(avg((std - value) / std * 100) {L3}, 4) AS m3, rnd(max((std - value) / std * 100) {ALL}, 4) AS best FROM (SELECT *, median(value) OVER (PARTITION BY event_type) AS std FROM events)
""")
def relative_speed(spark: SparkSession, sf: str) -> DataFrame:
    """Speed against the standard of the configuration, and its history."""
    events = table(spark, sf, "events")
    standards = ranks.medians(events, ["event_type"], "value", name="std")
    rated = events.join(standards, "event_type").withColumn("v", (F.col("std") - F.col("value")) / F.col("std") * 100)
    return rated.select("event_id", r("v").alias("rating"), r(W.prior_mean(F.col("v"), USER, WHEN, 3)).alias("m3"), r(F.max("v").over(W.prior(USER, WHEN))).alias("best"))
