"""Queries on the rules of racing: parsers, scales, filters and labels. Texts to parse are dealt to the rows of a table by its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from . import figures, scales
from .registry import query, r, table

COMMENTS = (
    "Made all, clear final furlong", "made most until headed", "led, ridden 2f out", "Led early, weakened", "soon led", "disputed lead", "with leader", "Chased leader", "tracked leader, led over 1f out", "tracked leaders", "pressed leader",
    "Prominent", "close up", "in touch", "front of mid-division", "held up in midfield", "held up in touch", "towards rear", "Held up behind", "last pair", "in rear", "always rear", "never dangerous", "", "slowly away",
)
GOINGS = ("Heavy", "Soft", " good to soft ", "Good", "Good to Firm", "Firm", "Hard", "Standard", "Standard to Slow", "Slow", "Yielding", "Yielding to Soft", "unknown", "", "Gd/Frm", "Fast")
MARGINS = ("", "0", "dht", "dh", "nse", "SHD", "hd", "sht-hd", "nk", "snk", "dist", "1.5", "2nk", "3 hd", "1shd", "2.25nse", "7", " 4 ", "abc", "10.", "nk2", ".5")
FRENCH = ("", "CTE TETE", "Courte tete", "CT", "C.T.", "CTE ENC.", "courte encolure", "NEZ", "ENC", "ENCOLURE", "ENK", "NK", "LOIN", "TETE", "Tête", "TTE", "1 L 1/2", "3/4 L", "2 L", "5", "1/3", "2/3 L", "1 L", "11/2", "xyz", "2.5", "0", "3 L 1/5")
NAMES = ("PRIX DU GROUPE I", "Prix (GR. II)", "Groupe III", "GROUP IV", "Prix LISTEE", "prix listée", "A RECLAMER", "Réclamer", "claiming stakes", "PRIX MAIDEN", "Debutants", "n'ayant jamais gagné", "PRIX DE LA VILLE", "")
TRACKS = ("PISTE EN SABLE FIBRE", "psf corde a gauche", "ligne droite", "", "Polytrack", "gazon")
FRENCH_GOINGS = ("PSF STANDARD", "Bon", "", "Souple", "psf rapide", "Collant", "Léger", "Très lourd", "nowhere")
KINDS = ("Handicap", "Maiden Hurdle", "Chase", "NH Flat", "N.H. flat race", "Novice Stakes", "Hunters chase", "Bumper", "National Hunt Flat", "Flat")
LIVE = ("NK", "hd", " SH ", "nse", "1.25", "", "abc", "Nk", "12")
COURSES = ("SOUTHWELL", "CHELMSFORD CITY", "YORK", "CURRAGH")
CODES = ("LON", "ASC", "DEA", "F03", "CHA", "ZUR", "VPR")


def dealt(values: Sequence[str], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dealt_sql(values: Sequence[str], key: str) -> str:
    return f"[{', '.join(map(literal, values))}][{key} % {len(values)} + 1]"


@query(rf"""
SELECT event_id, CASE WHEN regexp_matches(c, 'made virtually all|made all|made most|led to\b|led,|led early|led after|led before|led until|led over|soon led') THEN 6.0::DOUBLE
  WHEN regexp_matches(c, 'disputed|disputed lead|with leader') THEN 5.5 WHEN regexp_matches(c, 'chased leader|tracked leader|chased winner') THEN 5.0
  WHEN regexp_matches(c, 'pressed leader|tracked leaders|chased leaders|prominent|close up|in touch|in-touch|pressing leaders|chasing leaders|tracked front pair|tracked leading pair|chased leading|tracked\s|tracking leaders') THEN 4.0
  WHEN regexp_matches(c, 'front of mid-division|front of mid division|front of midfield|held up in midfield|held up in mid-division|towards rear of midfield|held up in touch') THEN 3.0
  WHEN regexp_matches(c, 'towards rear|held up behind|behind|held up|held up,|last pair|in rear|always rear') THEN 1.0 ELSE 3.0 END AS pace
FROM (SELECT event_id, lower({dealt_sql(COMMENTS, "event_id")}) AS c FROM events)
""")
def pace_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Early pace by the first pattern that a comment matches."""
    return table(spark, sf, "events").select("event_id", text.pace(dealt(COMMENTS, F.col("event_id"))).alias("pace"))


@query(f"""
SELECT event_id, CASE WHEN contains(g, 'heavy') THEN 1.0::DOUBLE WHEN contains(g, 'soft') THEN 2.0 WHEN contains(g, 'yielding') THEN 2.5 WHEN contains(g, 'good to soft') THEN 3.0 WHEN contains(g, 'good') THEN 4.0
  WHEN contains(g, 'good to firm') THEN 5.0 WHEN contains(g, 'firm') THEN 6.0 WHEN contains(g, 'hard') THEN 7.0 WHEN contains(g, 'standard') THEN 4.0 WHEN contains(g, 'standard to slow') THEN 3.0 WHEN contains(g, 'slow') THEN 2.0 ELSE 4.0 END AS ground
FROM (SELECT event_id, lower(trim({dealt_sql(GOINGS, "event_id")})) AS g FROM events)
""")
def ground_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Goings as numbers, by the first word that they hold."""
    return table(spark, sf, "events").select("event_id", text.ground(dealt(GOINGS, F.col("event_id"))).alias("ground"))


@query(rf"""
SELECT event_id, CASE WHEN m IN ('', '0', 'dht', 'dh') THEN 0.0::DOUBLE WHEN m = 'nse' THEN 0.05 WHEN m = 'shd' THEN 0.1 WHEN m IN ('hd', 'sht-hd') THEN 0.15 WHEN m IN ('nk', 'snk') THEN 0.2 WHEN m = 'dist' THEN 30.0
  WHEN regexp_matches(m, '^\d') THEN regexp_extract(m, '^(\d+\.?\d*)', 1)::DOUBLE + CASE regexp_extract(m, '^\d+\.?\d*\s*(nk|shd|hd|nse)', 1) WHEN 'nk' THEN 0.2 WHEN 'shd' THEN 0.1 WHEN 'hd' THEN 0.15 WHEN 'nse' THEN 0.05 ELSE 0 END ELSE try_cast(m AS DOUBLE) END AS lengths
FROM (SELECT event_id, lower(trim({dealt_sql(MARGINS, "event_id")})) AS m FROM events)
""")
def uk_margins(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths of British margins."""
    return table(spark, sf, "events").select("event_id", text.margin(dealt(MARGINS, F.col("event_id"))).alias("lengths"))


@query(rf"""
SELECT event_id, CASE WHEN m = '' THEN 0.0::DOUBLE WHEN regexp_matches(m, '^C(?:OURTE|TE)\.?\s+T(?:[EÊÈ]TE|TE)\.?$') THEN 0.05 WHEN regexp_matches(m, '^C\.?T\.?$') THEN 0.05 WHEN regexp_matches(m, '^C(?:OURTE|TE)\.?\s+ENC(?:OLURE)?\.?$') THEN 0.15
  WHEN m = 'NEZ' THEN 0.03 WHEN regexp_matches(m, '^ENC(?:OLURE)?\.?$|^ENK$|^NK$') THEN 0.25 WHEN m = 'LOIN' THEN 30.0 WHEN regexp_matches(m, '^T[EÊÈ]TE$|^TTE$') THEN 0.1
  WHEN n + f > 0 THEN n + f WHEN try_cast(m AS DOUBLE) >= 0 THEN m::DOUBLE END AS lengths
FROM (SELECT event_id, m, coalesce(try_cast(regexp_extract(m, '{(form := r"^(\d+)?\s*(?:L\s+)?(\d+/\d+)?\s*(?:L\.?)?$")}', 1) AS DOUBLE), 0) AS n, CASE regexp_extract(m, '{form}', 2) WHEN '1/4' THEN 0.25::DOUBLE WHEN '1/2' THEN 0.5 WHEN '3/4' THEN 0.75 WHEN '1/3' THEN 0.33 WHEN '2/3' THEN 0.67 ELSE 0 END AS f
  FROM (SELECT event_id, upper(trim({dealt_sql(FRENCH, "event_id")})) AS m FROM events))
""")
def french_margins(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths of French margins."""
    return table(spark, sf, "events").select("event_id", text.french_margin(dealt(FRENCH, F.col("event_id"))).alias("lengths"))


@query(rf"""
SELECT o_orderkey, CASE WHEN regexp_matches(n, 'GROUP?E?\s*I(\b|$)|GR\.?\s*I(\b|$)') THEN 1 WHEN regexp_matches(n, 'GROUP?E?\s*II(\b|$)|GR\.?\s*II(\b|$)') THEN 1 WHEN regexp_matches(n, 'GROUP?E?\s*III(\b|$)|GR\.?\s*III(\b|$)') THEN 2
  WHEN regexp_matches(n, 'LIST[ÉE]{{1,2}}') THEN 2 WHEN regexp_matches(n, 'R[ÉE]CLAM|CLAIMING') THEN 6 WHEN p >= 200000 THEN 1 WHEN p >= 100000 THEN 2 WHEN p >= 50000 THEN 3 WHEN p >= 25000 THEN 4 WHEN p >= 15000 THEN 5 WHEN p >= 8000 THEN 6 ELSE 7 END AS race_class,
  regexp_matches(n, 'MAIDEN|DEBUTANT|DÉBUTANT|N''AYANT PAS COURU|N''AYANT JAMAIS GAGN|N''AYANT JAMAIS COURU') AS is_maiden
FROM (SELECT o_orderkey, upper({dealt_sql(NAMES, "o_orderkey")}) AS n, o_totalprice - 20000 AS p FROM orders)
""")
def french_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of French races by name and prize, and maidens."""
    name = dealt(NAMES, F.col("o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", text.race_class(name, F.col("o_totalprice") - 20000).alias("race_class"), text.is_maiden(name).alias("is_maiden"))


@query(f"""
SELECT event_id, CASE WHEN contains(t, 'PSF') OR contains(t, 'FIBRE') OR contains(t, 'POLYTRACK') OR contains(t, 'SABLE') OR starts_with(upper(g), 'PSF') THEN 'All Weather' ELSE 'Turf' END AS surface,
  rnd(CASE g WHEN 'PSF STANDARD' THEN 0.087 WHEN 'Bon' THEN 0.118 WHEN '' THEN 0.133 WHEN 'Souple' THEN 0.332 WHEN 'Collant' THEN 0.919 WHEN 'Léger' THEN 0.386 WHEN 'Très lourd' THEN 1.534 ELSE 0.05 END::DOUBLE / 201.168, 8) AS prior
FROM (SELECT event_id, upper({dealt_sql(TRACKS, "event_id")}) AS t, {dealt_sql(FRENCH_GOINGS, "event_id")} AS g FROM events)
""")
def french_surfaces(spark: SparkSession, sf: str) -> DataFrame:
    """Surfaces of French races, and the prior of their going in seconds a metre."""
    rows = table(spark, sf, "events").select("event_id", text.surface(dealt(TRACKS, F.col("event_id")), dealt(FRENCH_GOINGS, F.col("event_id"))).alias("surface"), dealt(FRENCH_GOINGS, F.col("event_id")).alias("going"))
    priors = figures.going_priors(spark, figures.FRANCE)
    return rows.join(F.broadcast(priors), "going", "left").select("event_id", "surface", r(F.coalesce("prior", F.lit(figures.FRANCE.default_prior / figures.FRANCE.unit)), 8).alias("prior"))  # a literal table


@query(f"""
SELECT event_id, CASE WHEN g = 'Hard' THEN -0.25 WHEN g = 'Firm' THEN -0.21 WHEN g IN ('Good To Firm', 'Good to Firm', 'Gd/Frm') THEN -0.09 WHEN g = 'Fast' THEN -0.03 WHEN g IN ('Standard To Fast', 'Std/Fast') THEN 0.01 WHEN g IN ('Standard', 'Std') THEN 0.04 WHEN g = 'Good' THEN 0.05
    WHEN g IN ('Standard To Slow', 'Std/Slow', 'Standard/Slow') THEN 0.06 WHEN g IN ('Good to Yielding', 'Good To Yielding', 'Slow') THEN 0.15 WHEN g IN ('Good to Soft', 'Good To Soft', 'Gd/Sft') THEN 0.25 WHEN g = 'Yielding' THEN 0.35 WHEN g = 'Yielding To Soft' THEN 0.4
    WHEN g = 'Soft' THEN 0.51 WHEN g IN ('Soft To Heavy', 'Sft/Hvy', 'Hvy/Sft') THEN 0.65 WHEN g = 'Heavy' THEN 0.82 ELSE 0 END::DOUBLE AS prior,
  CASE WHEN g IN ('Hard', 'Firm', 'Fast') THEN 'Firm' WHEN g IN ('Gd/Frm', 'Good To Firm', 'Good to Firm', 'Std/Fast') THEN 'GdFm' WHEN g IN ('Good', 'Standard', 'Std') THEN 'Good'
    WHEN g IN ('Gd/Sft', 'Good to Soft', 'Good To Yielding', 'Good to Yielding', 'Std/Slow', 'Standard/Slow', 'Standard To Slow', 'Slow') THEN 'GdSft' WHEN g IN ('Soft', 'Yielding', 'Sft/Hvy', 'Hvy/Sft') THEN 'Soft' WHEN g = 'Heavy' THEN 'Heavy' END AS going_group
FROM (SELECT event_id, {dealt_sql(tuple(scales.GOING_SEEDS) + ("Sodden",), "event_id")} AS g FROM events)
""")
def uk_goings(spark: SparkSession, sf: str) -> DataFrame:
    """Priors and groups of British goings; unknown ones have prior 0 and no group."""
    rows = table(spark, sf, "events").select("event_id", dealt(tuple(scales.GOING_SEEDS) + ("Sodden",), F.col("event_id")).alias("going"))
    joined = rows.join(F.broadcast(figures.going_priors(spark, figures.UK)), "going", "left")  # a literal table
    return joined.select("event_id", F.coalesce("prior", F.lit(figures.UK.default_prior)).alias("prior"), scales.going_group(F.col("going")).alias("going_group"))


@query(f"""
SELECT event_id FROM (SELECT event_id, {dealt_sql(KINDS, "event_id")} AS k FROM events)
WHERE k NOT IN ('Maiden Hurdle', 'Chase', 'NH Flat', 'Bumper', 'National Hunt Flat') AND NOT regexp_matches(lower(k), 'hurdle|chase|bumper|nh flat|national hunt|n\\.?h\\.?\\s')
""")
def flat_races(spark: SparkSession, sf: str) -> DataFrame:
    """Races on the flat: neither a known kind of jump race nor one by its words."""
    return table(spark, sf, "events").where(~scales.is_jump_race(dealt(KINDS, F.col("event_id")))).select("event_id")


@query(f"""
SELECT l_orderkey, l_extendedprice, rnd(sum(CASE WHEN i = 1 THEN 0 ELSE m END) OVER (PARTITION BY l_orderkey ORDER BY i), 4) AS cumulative FROM (
  SELECT l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) AS i,
    coalesce(CASE trim(s) WHEN 'NK' THEN 0.15::DOUBLE WHEN 'nk' THEN 0.15 WHEN 'HD' THEN 0.1 WHEN 'hd' THEN 0.1 WHEN 'SH' THEN 0.05 WHEN 'sh' THEN 0.05 WHEN 'NSE' THEN 0.03 WHEN 'nse' THEN 0.03 ELSE try_cast(trim(s) AS DOUBLE) END, 0) AS m
  FROM (SELECT *, {dealt_sql(LIVE, "l_partkey")} AS s FROM lineitem))
""")
def live_margins(spark: SparkSession, sf: str) -> DataFrame:
    """Margin codes of live results, summed down the order of finish; the winner's counts as 0."""
    order = Window.partitionBy("l_orderkey").orderBy("l_extendedprice")
    own = F.when(F.row_number().over(order) == 1, F.lit(0.0)).otherwise(scales.live_margin(dealt(LIVE, F.col("l_partkey"))))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", own.alias("m"))
    return rows.select("l_orderkey", "l_extendedprice", r(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("cumulative"))


@query("""
SELECT event_id, CASE WHEN sex NOT IN ('f', 'm') THEN 0 WHEN month(ts) BETWEEN 5 AND 9 THEN 3 ELSE 5 END AS allowance, CASE WHEN abs(ga) <= 0.5 THEN 'high' WHEN abs(ga) <= 1.5 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN n < 30 THEN 'provisional' WHEN value > 20 AND pos <> 1 THEN 'low' ELSE 'high' END AS live_confidence, CASE WHEN value >= 110 THEN 'high' WHEN value >= 85 THEN 'good' ELSE 'avg' END AS label,
  rnd(60 + value * 0.2, 4) AS estimated_time
FROM (SELECT *, ['c', 'f', 'm', 'g'][user_id % 4 + 1] AS sex, value / 50 - 1 AS ga, user_id AS n, event_id % 5 AS pos FROM events)
""")
def figure_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Sex allowance, confidences, label and estimated time of each run."""
    rows = table(spark, sf, "events").withColumn("sex", dealt(("c", "f", "m", "g"), F.col("user_id")))
    return rows.select(
        "event_id", scales.sex_allowance(F.col("sex"), F.month("ts")).alias("allowance"), scales.confidence(F.col("value") / 50 - 1).alias("confidence"),
        scales.live_confidence(F.col("value"), F.col("event_id") % 5, F.col("user_id"), F.col("value")).alias("live_confidence"), scales.figure_label(F.col("value")).alias("label"), r(60 + F.col("value") * 0.2).alias("estimated_time"),
    )


def _grid_sql(region: str, age: str, surface: str, furlongs: str, unit: str) -> str:
    rows = ", ".join(f"({literal(s)}, {a}, {m}, {x}::DOUBLE, {y}::DOUBLE)" for s, a, m, x, y in scales.grid_rows(region))
    return f"""
WITH grid(surface, age, month, x, y) AS (VALUES {rows}), asked AS (SELECT l_orderkey, l_partkey, l_extendedprice, {age} AS age, {surface} AS surface, month(l_shipdate) AS month, {furlongs} / {unit} AS d FROM lineitem),
near AS (SELECT a.l_orderkey, a.l_partkey, a.l_extendedprice, a.d, max(x) FILTER (x <= d) AS lx, arg_max(y, x) FILTER (x <= d) AS ly, min(x) FILTER (x >= d) AS hx, arg_min(y, x) FILTER (x >= d) AS hy
  FROM asked a LEFT JOIN grid g ON g.surface = a.surface AND g.age = least(a.age, 12) AND g.month = a.month GROUP BY ALL)
SELECT l_orderkey, l_partkey, l_extendedprice, rnd(coalesce(CASE WHEN lx IS NULL THEN hy WHEN hx IS NULL THEN ly ELSE ly + coalesce((d - lx) / nullif(hx - lx, 0), 0) * (hy - ly) END, 0), 4) AS allowance FROM near
"""


def _allowed(rows: DataFrame, region: str, unit: float) -> DataFrame:
    adjusted = figures.add_age_allowance(rows.withColumn("figure", F.lit(0.0)), scales.age_grid(rows.sparkSession, region), "figure", "adjusted", unit)
    return adjusted.select("l_orderkey", "l_partkey", "l_extendedprice", r("allowance").alias("allowance"))


@query(_grid_sql("UK", "(l_partkey % 13 + 1)::INT", "CASE WHEN l_returnflag = 'A' THEN 'All Weather' ELSE 'Turf' END", "(l_quantity / 3 + 1)", "1.0"))
def uk_age_allowances(spark: SparkSession, sf: str) -> DataFrame:
    """Weight for age by surface, age, month and distance, older horses on turf included."""
    age, surface = (F.col("l_partkey") % 13 + 1).cast("int"), F.when(F.col("l_returnflag") == "A", "All Weather").otherwise("Turf")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.col("l_shipdate").alias("day"), age.alias("age"), surface.alias("surface"), (F.col("l_quantity") / 3 + 1).alias("distance"))
    return _allowed(rows, "UK", 1.0)


@query(_grid_sql("France", "(l_partkey % 5 + 2)::INT", "'Turf'", "(l_quantity * 60 + 800)", "201.168"))
def french_age_allowances(spark: SparkSession, sf: str) -> DataFrame:
    """French weight for age: twelve pounds at two, a table at three, nothing later."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", F.col("l_shipdate").alias("day"), (F.col("l_partkey") % 5 + 2).cast("int").alias("age"), F.lit("Turf").alias("surface"), (F.col("l_quantity") * 60 + 800).alias("distance"))
    return _allowed(rows, "France", scales.METRES)


@query(f"""
SELECT o_orderkey FROM (SELECT o_orderkey, {dealt_sql(COURSES, "o_orderkey")} AS c, o_orderdate::DATE + INTERVAL 8 YEAR + INTERVAL 15 YEAR + INTERVAL 1 YEAR AS day FROM orders)
WHERE NOT (c = 'SOUTHWELL' AND day < DATE '2022-01-01') AND NOT (c = 'CHELMSFORD CITY' AND day < DATE '2022-09-01')
""")
def surface_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs on surfaces that are still there."""
    rows = table(spark, sf, "orders").select("o_orderkey", dealt(COURSES, F.col("o_orderkey")).alias("course"), F.add_months(F.to_date("o_orderdate"), 288).alias("day"))
    return figures.flat_runners(rows).select("o_orderkey")


RUNNERS_SQL = f"""
(SELECT l_orderkey AS race_id, l_partkey AS horse, l_extendedprice AS x, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) AS position,
  CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) = 1 AND l_tax > 0.01 THEN l_quantity + 60 END AS winner_time, l_quantity * 20 AS distance, (l_partkey % 4 + 2)::INT AS age,
  {dealt_sql(CODES, "l_orderkey")} AS course, {dealt_sql(NAMES, "l_orderkey")} AS race_name FROM lineitem)
"""


def _runners(spark: SparkSession, sf: str) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_extendedprice", "l_partkey"))
    rows = table(spark, sf, "lineitem").withColumn("position", order)
    return rows.select(
        F.col("l_orderkey").alias("race_id"), F.col("l_partkey").alias("horse"), F.col("l_extendedprice").alias("x"), "position", F.when((F.col("position") == 1) & (F.col("l_tax") > 0.01), F.col("l_quantity") + 60).alias("winner_time"),
        (F.col("l_quantity") * 20).alias("distance"), (F.col("l_partkey") % 4 + 2).cast("int").alias("age"), dealt(CODES, F.col("l_orderkey")).alias("course"), dealt(NAMES, F.col("l_orderkey")).alias("race_name"),
    )


@query(f"""
SELECT race_id, horse, x FROM (SELECT *, max(winner_time) OVER (PARTITION BY race_id) AS w FROM {RUNNERS_SQL} WHERE course NOT IN ('ASC', 'F03', 'ZUR', 'VPR') AND distance > 0) WHERE w > 0
""")
def french_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Runners of French races whose winner has a time."""
    return figures.valid_french(_runners(spark, sf)).select("race_id", "horse", "x")


@query(f"""
SELECT race_id, age FROM {RUNNERS_SQL} WHERE position = 1 AND winner_time > 0 AND age <> 2
  AND NOT regexp_matches(upper(race_name), 'MAIDEN|DEBUTANT|DÉBUTANT|N''AYANT PAS COURU|N''AYANT JAMAIS GAGN|N''AYANT JAMAIS COURU')
""")
def french_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    """Winners whose times make standards."""
    return figures.eligible_french(figures.winners(_runners(spark, sf))).select("race_id", "age")


@query(f"SELECT race_id, min(age) AS youngest, max(age) AS oldest, count(*)::BIGINT AS n FROM {RUNNERS_SQL} GROUP BY 1")
def race_ages(spark: SparkSession, sf: str) -> DataFrame:
    """The youngest and oldest runner of each race."""
    return _runners(spark, sf).groupBy("race_id").agg(F.min("age").alias("youngest"), F.max("age").alias("oldest"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT n_name, o_orderkey, l_partkey, l_extendedprice FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND (c_mktsegment = 'BUILDING' OR c_mktsegment IS NULL)
""")
def relational_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Meetings, races and runners joined by key, filters pushed to each scan."""
    races = table(spark, sf, "orders").where("o_orderstatus = 'F' and o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-01-01'").select("o_orderkey", "o_custkey")
    meetings = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING' or c_mktsegment is null").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    runners = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_extendedprice")
    return meetings.join(races, "o_custkey").join(runners, "o_orderkey").select("n_name", "o_orderkey", "l_partkey", "l_extendedprice")


@query("""
SELECT y::INT AS year, greatest(a, make_date(y, 1, 1)) AS first_day, least(b, make_date(y, 12, 31)) AS last_day
FROM (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b, unnest(range(year(min(o_orderdate)), year(max(o_orderdate)) + 1)) AS y FROM orders)
""")
def year_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The range of days of a table, cut at the turns of years."""
    span = table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    years = span.select("a", "b", F.explode(F.sequence(F.year("a"), F.year("b"))).alias("year"))
    return years.select("year", F.greatest("a", F.make_date("year", F.lit(1), F.lit(1))).alias("first_day"), F.least("b", F.make_date("year", F.lit(12), F.lit(31))).alias("last_day"))


@query("""
SELECT c_mktsegment, rnd(sum(c_acctbal * w) / sum(w), 4) AS weighted_mean, rnd(max(c_acctbal) - min(c_acctbal), 4) AS spread, rnd(stddev_samp(c_acctbal), 4) AS sd
FROM (SELECT *, pow(0.5, c_nationkey / 4.0) AS w FROM customer) GROUP BY 1 HAVING count(*) >= 3
""")
def weighted_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted means and spreads by group."""
    w, x = F.pow(F.lit(0.5), F.col("c_nationkey") / 4), F.col("c_acctbal")
    groups = table(spark, sf, "customer").groupBy("c_mktsegment").agg(r(F.sum(x * w) / F.sum(w)).alias("weighted_mean"), r(F.max(x) - F.min(x)).alias("spread"), r(F.stddev_samp(x)).alias("sd"), F.count(F.lit(1)).alias("n"))
    return groups.where("n >= 3").drop("n")


@query("""
WITH k AS (SELECT p_brand, avg(p_retailprice) AS v, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 1.5 ELSE 3.0 END AS k, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand, rnd((n * v + k * 0.05) / (n + k), 4) AS shrunk FROM k
""")
def shrink_by_country(spark: SparkSession, sf: str) -> DataFrame:
    """Means shrunk to a prior, less so in some groups."""
    groups = table(spark, sf, "part").groupBy("p_brand").agg(F.avg("p_retailprice").alias("v"), F.count(F.lit(1)).alias("n"))
    k = F.when(F.col("p_brand").isin("Brand#1", "Brand#2"), figures.UK.k_irish).otherwise(figures.UK.k)
    return groups.select("p_brand", r((F.col("n") * F.col("v") + k * 0.05) / (F.col("n") + k)).alias("shrunk"))


@query("""
WITH s AS (SELECT p_brand, p_size, median(p_retailprice) AS y FROM part GROUP BY ALL), g AS (SELECT round(p_size / 10) AS near, median(y) AS g FROM s GROUP BY 1)
SELECT p_brand, p_size, rnd(y - g, 4) AS apart FROM s JOIN g ON near = round(p_size / 10)
""")
def generic_standard(spark: SparkSession, sf: str) -> DataFrame:
    """Standards against the median of standards at their rounded distance."""
    own = table(spark, sf, "part").groupBy("p_brand", "p_size").agg(F.median("p_retailprice").alias("y")).withColumn("near", F.round(F.col("p_size") / 10))
    return own.join(own.groupBy("near").agg(F.median("y").alias("g")), "near").select("p_brand", "p_size", r(F.col("y") - F.col("g")).alias("apart"))
