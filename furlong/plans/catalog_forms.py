"""Queries on form families: events as runs of a horse (user_id), with a field size, a price, a prize and a place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import windows as W
from .registry import query, r, table

BY, ORDER = ["user_id"], ["ts", "event_id"]
RUNS = """(SELECT *, won - 1.0 / n AS over_chance, 1 - (pos - 1)::DOUBLE / (n - 1) AS rb, 1.0 / price AS market FROM (
  SELECT event_id, user_id, ts, event_type AS jockey, 5 + event_id % 11 AS n, 1 + event_id % 5 AS pos, (event_id % 5 = 0)::DOUBLE AS won, 1 + value / 10 AS price, CASE WHEN event_type <> 'error' THEN value * 100 END AS prize FROM events))"""
W_ALL = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
LAG = "lag({0}, {1}) OVER (PARTITION BY user_id ORDER BY ts, event_id)"


def _weighted(x: str, last: int) -> str:
    lags = [LAG.format(x, i) for i in range(1, last + 1)]
    top = " + ".join(f"coalesce({v} / {i}, 0)" for i, v in enumerate(lags, 1))
    below = " + ".join(f"CASE WHEN {v} IS NULL THEN 0 ELSE 1.0 / {i} END" for i, v in enumerate(lags, 1))
    return f"rnd(({top}) / nullif({below}, 0), 4)"


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    n, pos = 5 + F.col("event_id") % 11, 1 + F.col("event_id") % 5
    base = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.col("event_type").alias("jockey"), n.alias("n"), pos.alias("pos"), (pos == 1).cast("double").alias("won"), (1 + F.col("value") / 10).alias("price"),
        F.when(F.col("event_type") != "error", F.col("value") * 100).alias("prize"),
    )
    return base.select("*", (F.col("won") - 1 / F.col("n")).alias("over_chance"), (1 - (F.col("pos") - 1) / (F.col("n") - 1)).alias("rb"), (1 / F.col("price")).alias("market"))


@query(f"""
WITH m AS (SELECT median(n) AS m FROM {RUNS})
SELECT event_id, rnd(avg(f) {W_ALL}, 4) AS career, rnd(avg(f * f) {W_ALL}, 4) AS career_squared, rnd(sum(over_chance) {W_ALL}, 4) AS cumulative FROM (SELECT r.*, rb * n / m AS f FROM {RUNS} r, m)
""")
def field_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    """Places against the field, weighted by its size over the median size, and wins over chance so far."""
    runs = _runs(spark, sf)
    middle = runs.agg(F.median("n").alias("m"))  # one row
    f = runs.crossJoin(F.broadcast(middle)).withColumn("f", F.col("rb") * F.col("n") / F.col("m"))
    w = W.prior(BY, ORDER)
    return f.select("event_id", r(W.prior_mean(F.col("f"), BY, ORDER)).alias("career"), r(W.prior_mean(F.col("f") * F.col("f"), BY, ORDER)).alias("career_squared"), r(F.sum("over_chance").over(w)).alias("cumulative"))


@query(f"""
SELECT event_id, {_weighted("market * n", 3)} AS odds_3, {_weighted("market * n", 5)} AS odds_5, {_weighted("market - 1.0 / n", 5)} AS gap_5, {_weighted("prize", 3)} AS prize_3, {_weighted("coalesce(prize, 0) / 100 * rb * rb", 3)} AS merit_3 FROM {RUNS}
""")
def recency_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Means of the last runs with weights 1, 1/2, 1/3, ...: odds against chance, price gaps, prizes and what was earned of them."""
    mean = lambda x, last: r(W.harmonic_mean(x, BY, ORDER, last))
    odds, gap, merit = F.col("market") * F.col("n"), F.col("market") - 1 / F.col("n"), F.coalesce("prize", F.lit(0.0)) / 100 * F.col("rb") * F.col("rb")
    return _runs(spark, sf).select("event_id", mean(odds, 3).alias("odds_3"), mean(odds, 5).alias("odds_5"), mean(gap, 5).alias("gap_5"), mean(F.col("prize"), 3).alias("prize_3"), mean(merit, 3).alias("merit_3"))


@query(f"""
WITH d AS (SELECT event_id, date_diff('day', {LAG.format("ts::DATE", 1)}, ts::DATE) AS d1, date_diff('day', {LAG.format("ts::DATE", 2)}, ts::DATE) AS d2, date_diff('day', {LAG.format("ts::DATE", 3)}, ts::DATE) AS d3,
  date_diff('day', {LAG.format("ts::DATE", 4)}, ts::DATE) AS d4 FROM {RUNS})
SELECT event_id, d1::INT AS days, rnd(coalesce(d2 - d1, 0) + 0.5 * coalesce(d3 - d2, 0) + 0.33 * coalesce(d4 - d3, 0), 4) AS trend,
  rnd((coalesce(d2 - d1, 0) + 0.5 * coalesce(d3 - d2, 0) + 0.33 * coalesce(d4 - d3, 0)) / nullif((d1 IS NOT NULL)::INT + (d2 IS NOT NULL)::INT + (d3 IS NOT NULL)::INT, 0), 4) AS final FROM d
""")
def days_between(spark: SparkSession, sf: str) -> DataFrame:
    """Days since the last run, their weighted change over the last four, and that by the number of the last three."""
    days, trend, final = W.gaps_between(F.to_date("ts"), BY, ORDER)
    return _runs(spark, sf).select("event_id", days.alias("days"), r(trend).alias("trend"), r(final).alias("final"))


@query(f"""
WITH s AS (SELECT *, CASE {LAG.format("pos", 1)} WHEN 1 THEN 17.41 WHEN 2 THEN 14.77 WHEN 3 THEN 12.62 ELSE 0 END AS score FROM {RUNS})
SELECT event_id, score::DOUBLE AS score, rnd(sum(score) OVER w / nullif(row_number() OVER (PARTITION BY user_id, jockey ORDER BY ts, event_id) - 1, 0) * 10, 4) AS jockey_index
FROM s WINDOW w AS (PARTITION BY user_id, jockey ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def last_place_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of a horse's last place, and their mean before each ride of a pairing."""
    scored = _runs(spark, sf).withColumn("score", W.place_score(F.lag("pos").over(W.ordered(BY, ORDER))))
    pair = (["user_id", "jockey"], ORDER)
    return scored.select("event_id", "score", r(F.try_divide(F.sum("score").over(W.prior(*pair)), W.prior_count(*pair)) * 10).alias("jockey_index"))


@query(f"""
SELECT event_id, least(k, 3)::BIGINT AS last_3, least(k, 10)::BIGINT AS last_10, rnd(list_sum(list_transform(range(1, least(k, 5) + 1), lambda i: 1.0 / i)), 4) AS weights_5, rnd(least(k, 5) / (n * 5.0) * 100, 4) AS interval_5
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM {RUNS})
""")
def recency_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the last runs there are, the sum of their weights, and their number against the field."""
    k = W.prior_count(BY, ORDER)
    weights = F.try_element_at(F.array(*[F.lit(sum(1 / j for j in range(1, i + 1)) if i else None).cast("double") for i in range(6)]), (F.least(F.col("k"), F.lit(5)) + 1).cast("int"))
    runs = _runs(spark, sf).withColumn("k", k)
    return runs.select("event_id", F.least("k", F.lit(3)).alias("last_3"), F.least("k", F.lit(10)).alias("last_10"), r(weights).alias("weights_5"), r(F.least("k", F.lit(5)) / (F.col("n") * 5.0) * 100).alias("interval_5"))


@query(f"""
WITH c AS (SELECT *, avg(rb) {W_ALL} AS career FROM {RUNS}), s AS (SELECT *, avg(career) OVER (PARTITION BY date_trunc('hour', ts), jockey) AS strength FROM c)
SELECT event_id, rnd(strength, 4) AS strength, rnd({LAG.format("strength", 1)}, 4) AS last_strength FROM s
""")
def last_race_strength(spark: SparkSession, sf: str) -> DataFrame:
    """The mean career of a race's runners before it, and that of each horse's last race."""
    runs = _runs(spark, sf).withColumn("career", W.prior_mean(F.col("rb"), BY, ORDER))
    strong = runs.withColumn("strength", F.avg("career").over(Window.partitionBy(F.date_trunc("hour", "ts"), "jockey")))
    return strong.select("event_id", r("strength").alias("strength"), r(F.lag("strength").over(W.ordered(BY, ORDER))).alias("last_strength"))
