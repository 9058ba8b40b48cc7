"""All form features over the lines of orders as runs: an order is a race, a part a horse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .features import features
from .registry import query, r, table

TIE = "ORDER BY race_date, race_time, track, horse_name"
BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def history(spark: SparkSession, sf: str) -> DataFrame:
    """A run for each order and part; the dearest part of an order wins."""
    read = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag")
    lines = read.repartition("l_orderkey").groupBy("l_orderkey", "l_partkey").agg(  # one shuffle serves the sums, the join and the windows
        F.round(F.sum("l_extendedprice"), 2).alias("x"), F.min("l_suppkey").alias("s"), F.min("l_linenumber").alias("no"), F.min("l_quantity").alias("q"), F.min("l_tax").alias("tax"), F.min("l_returnflag").alias("flag")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("race_date"), F.col("o_orderstatus").alias("track"), "o_orderpriority")
    race = Window.partitionBy("l_orderkey")
    going = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderpriority"))
    text = lambda c: F.col(c).cast("string")
    return lines.join(orders, "l_orderkey").select(
        "race_date", F.col("l_orderkey").alias("race_time"), "track", text("l_partkey").alias("horse_name"), F.row_number().over(race.orderBy(F.desc("x"), "l_partkey")).cast("double").alias("placing"),
        F.when(F.col("q") >= 3, text("s")).alias("jockey"), text("no").alias("trainer"), (2 + F.col("tax") * 100).alias("price"), F.count(F.lit(1)).over(race).cast("double").alias("runners"), (F.col("x") / 10).alias("prize"), going.alias("going"),
        (4 + F.col("no")).cast("double").alias("furlongs"), F.lit("Class 4").alias("race_class"), F.col("no").cast("double").alias("stall"), F.lit("Turf").alias("surface"), F.lit(None).cast("string").alias("margin"), (60 + F.col("q")).alias("seconds"),
        F.floor(F.col("x") / 1000).cast("double").alias("rating"), F.col("flag").alias("sire"), text("no").alias("damsire"), F.lit(None).cast("string").alias("headgear"), F.lit(None).cast("string").alias("comment"), F.lit(120.0).alias("weight"), F.lit(3.0).alias("age"),
    )


def _before(f: str, keys: str, rows: str = BEFORE) -> str:
    return f"{f} OVER (PARTITION BY {keys} {TIE} {rows})"


def _lag(x: str, i: int = 1) -> str:
    return f"lag({x}, {i}) OVER (PARTITION BY horse_name {TIE})"


def _known(keys: str, x: str) -> str:
    return f"CASE WHEN {' AND '.join(k + ' IS NOT NULL' for k in keys.split(', '))} THEN {x} END"


SQL = f"""
WITH lines AS (SELECT l_orderkey, l_partkey, round(sum(l_extendedprice), 2) AS x, min(l_suppkey) AS s, min(l_linenumber) AS no, min(l_quantity) AS q, min(l_tax) AS tax, min(l_returnflag) AS sire FROM lineitem GROUP BY ALL),
h AS MATERIALIZED (SELECT o_orderdate::DATE AS race_date, l_orderkey AS race_time, o_orderstatus AS track, l_partkey::VARCHAR AS horse_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY x DESC, l_partkey) AS pos, CASE WHEN q >= 3 THEN s::VARCHAR END AS jockey, no::VARCHAR AS trainer, 2 + tax * 100 AS price,
  count(*) OVER (PARTITION BY l_orderkey)::DOUBLE AS n, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS going, floor(x / 1000) AS rating, sire, no::VARCHAR AS damsire FROM lines JOIN orders ON o_orderkey = l_orderkey),
c AS MATERIALIZED (SELECT *, (pos = 1)::DOUBLE AS won, (pos <= 3)::DOUBLE AS placed, (n - pos) / nullif(n - 1, 0) AS nfp, (1 - (pos - 1) / nullif(n - 1, 0)) * n / (SELECT median(n) FROM h) AS fsarb, 1 / n AS chance FROM h),
w AS MATERIALIZED (SELECT *, {_before("avg(won)", "1")} AS all_won, {_before("avg(nfp)", "1")} AS all_nfp, won - chance AS over_chance, n / price AS odds_ratio FROM c),
f AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY horse_name {TIE}) - 1 AS horse_runs, {_before("avg(nfp)", "horse_name")} AS career, coalesce({_before("sum(won)", "horse_name")}, 0) AS horse_wins, coalesce({_before("sum(placed)", "horse_name")}, 0) AS horse_places,
  CASE {_lag("pos")} WHEN 1 THEN 17.41::DOUBLE WHEN 2 THEN 14.77 WHEN 3 THEN 12.62 ELSE 0 END AS score, race_date - {_lag("race_date")} AS d1, race_date - {_lag("race_date", 2)} AS d2, race_date - {_lag("race_date", 3)} AS d3, race_date - {_lag("race_date", 4)} AS d4,
  count(*) OVER (PARTITION BY trainer ORDER BY race_date RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) + count(*) OVER (PARTITION BY trainer, race_date {TIE} {BEFORE}) AS n14,
  coalesce(sum(won) OVER (PARTITION BY trainer ORDER BY race_date RANGE BETWEEN INTERVAL 13 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) + coalesce(sum(won) OVER (PARTITION BY trainer, race_date {TIE} {BEFORE}), 0) AS w14 FROM w),
g AS (SELECT *, avg(career) OVER (PARTITION BY race_time) AS strength FROM f)
SELECT race_time, horse_name, won, horse_runs, rnd(career, 4) AS horse_nfp_career, rnd({_before("avg(nfp)", "horse_name", "ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING")}, 4) AS horse_nfp_mean_3, rnd({_before("avg(fsarb)", "horse_name")}, 4) AS horse_fsarb_career,
  rnd({_before("sum(over_chance)", "horse_name")}, 4) AS horse_over_chance_total, rnd((coalesce({_lag("odds_ratio")}, 0) + coalesce({_lag("odds_ratio", 2)} / 2, 0) + coalesce({_lag("odds_ratio", 3)} / 3, 0)) / CASE least(horse_runs, 3) WHEN 1 THEN 1 WHEN 2 THEN 1.5 WHEN 3 THEN 1.5 + 1 / 3.0::DOUBLE END, 4) AS horse_odds_ratio_weighted_3,
  d1::INT AS horse_days_1, rnd((coalesce(d2 - d1, 0) + 0.5 * coalesce(d3 - d2, 0) + 0.33 * coalesce(d4 - d3, 0)) / nullif((d1 IS NOT NULL)::INT + (d2 IS NOT NULL)::INT + (d3 IS NOT NULL)::INT, 0), 4) AS horse_days_final, score AS horse_last_score,
  least(horse_runs, 3)::BIGINT AS horse_count_3, rnd(least(horse_runs, 5) / (n * 5) * 100, 4) AS horse_interval_5, rnd({_before("var_pop(nfp)", "horse_name", "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING")}, 4) AS horse_nfp_variance_5,
  row_number() OVER (PARTITION BY trainer {TIE}) - 1 AS trainer_runs, coalesce({_before("sum(won)", "trainer")}, 0) AS trainer_wins, rnd({_before("sum(won)", "trainer")} / {_before("sum(chance)", "trainer")}, 4) AS trainer_impact, rnd({_before("avg(placed)", "trainer")}, 4) AS trainer_placed,
  {_known("jockey", f"row_number() OVER (PARTITION BY jockey {TIE}) - 1")} AS jockey_runs, rnd({_known("jockey", _before("avg(nfp)", "jockey"))}, 4) AS jockey_nfp, rnd({_known("jockey", _before("sum(score)", "jockey") + f" / nullif(row_number() OVER (PARTITION BY jockey {TIE}) - 1, 0) * 10")}, 4) AS jockey_mounts,
  {_known("jockey", f"row_number() OVER (PARTITION BY trainer, jockey {TIE}) - 1")} AS pair_runs, {_known("going", f"row_number() OVER (PARTITION BY horse_name, going {TIE}) - 1")} AS horse_going_runs, nullif(n14, 0)::BIGINT AS trainer_runs_14d, rnd(w14 / nullif(n14, 0), 4) AS trainer_rate_14d,
  rnd((coalesce({_before("sum(won)", "sire")}, 0) + 20 * all_won) / ({_before("count(won)", "sire")} + 20), 4) AS sire_won_shrunk, rnd({_known("going", "(coalesce(" + _before("sum(nfp)", "sire, going") + ", 0) + 20 * all_nfp) / (" + _before("count(nfp)", "sire, going") + " + 20)")}, 4) AS sire_going_nfp_shrunk,
  row_number() OVER (PARTITION BY damsire {TIE}) - 1 AS damsire_runs, rnd(strength, 4) AS race_horse_nfp_career, rnd({_lag("strength")}, 4) AS race_horse_nfp_career_last, rank() OVER (PARTITION BY race_time ORDER BY rating DESC) AS rating_rank,
  rank() OVER (PARTITION BY race_time ORDER BY horse_runs DESC) AS horse_runs_rank, rank() OVER (PARTITION BY race_time ORDER BY horse_places DESC) AS horse_places_rank FROM g
"""
EXACT = ("won", "horse_runs", "horse_days_1", "horse_last_score", "horse_count_3", "trainer_runs", "trainer_wins", "jockey_runs", "pair_runs", "horse_going_runs", "trainer_runs_14d", "damsire_runs", "rating_rank", "horse_runs_rank", "horse_places_rank")
ROUNDED = (
    "horse_nfp_career", "horse_nfp_mean_3", "horse_fsarb_career", "horse_over_chance_total", "horse_odds_ratio_weighted_3", "horse_days_final", "horse_interval_5", "horse_nfp_variance_5", "trainer_impact", "trainer_placed", "jockey_nfp", "jockey_mounts", "trainer_rate_14d",
    "sire_won_shrunk", "sire_going_nfp_shrunk", "race_horse_nfp_career", "race_horse_nfp_career_last",
)


@query(SQL)
def form_features(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of every kind of family, by features(), which is asked for these alone; ranks whose values are counts or given, as other engines break ties of computed means otherwise."""
    return features(history(spark, sf), {*EXACT, *ROUNDED}).select("race_time", "horse_name", *EXACT, *[r(c).alias(c) for c in ROUNDED])
