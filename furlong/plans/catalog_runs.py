"""Whole runs over orders as races and their lines as runners, with SQL for every step from runners to corrected figures.

Weeks are cut into two race days and statuses are courses, so meetings hold a handful of races at sf0.01 and have neighbours. The SQL states the settings as values of its own."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import written
from . import runs
from .catalog_rules import dealt, literal
from .registry import query, r, table
from .scales import grid_rows

PASSES = 2
DRIFT_YEAR = 1997
SPLIT_DAY = "1999-01-01"  # live runs rate what is run from this day on, with the tables of what was run before
GOINGS = {"UK": ("Good To Firm", "Good", "Good to Soft", "Soft", "Heavy", "Sticky"), "France": ("Bon Léger", "Bon", "Bon souple", "Souple", "Collant", "Sticky")}
REGIONS = {name: replace(region, settings=replace(region.settings, passes=PASSES, tolerance=0.0)) for name, region in (("UK", runs.UK), ("France", runs.FRANCE))}


def runners(spark: SparkSession, sf: str, region: str) -> DataFrame:
    """Orders as races, lines as runners: the dearest line wins, and prices behind it are lengths."""
    day = F.to_date("o_orderdate")
    meet = F.date_add(F.trunc(day, "week"), F.when(F.weekday(day) >= 3, 1).otherwise(0))
    races = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("course"), F.when(F.col("o_orderstatus") == "F", "All Weather").otherwise("Turf").alias("surface"), meet.alias("day"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("race_class"), F.row_number().over(Window.partitionBy(meet, "o_orderstatus").orderBy("o_orderkey")).alias("race_no"),
    )
    race = Window.partitionBy("l_orderkey")
    order = race.orderBy(F.desc("l_extendedprice"), "l_linenumber")
    kind = F.pmod(F.floor(F.unix_date("day") / 7), F.lit(6))
    lines = table(spark, sf, "lineitem").join(races, "l_orderkey").withColumn("place", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(race)).withColumn("kind", kind)
    furlongs = (F.col("n") + 4).cast("double")
    late = F.when((F.month("day") == 11) & (F.col("race_no") >= 4), 0.6).otherwise(0.0)
    pace = 12.2 + (F.col("kind") - 2) * 0.15 + F.col("l_discount") * 3 + F.col("l_extendedprice") / 500000 + late
    age = (F.floor(F.round(F.col("l_discount") * 100) / 3) + 2).cast("int")
    lines = lines.withColumn("age", age).withColumn("done", (F.col("place") == 1) | (F.col("l_discount") < 0.095))
    behind = (F.first("l_extendedprice").over(order) - F.col("l_extendedprice")) / 2000
    return lines.select(
        F.col("l_orderkey").cast("string").alias("race_id"), F.concat_ws("_", F.col("day").cast("string"), "course").alias("meeting_id"), "day", "course", "surface", (furlongs if region == "UK" else furlongs * 200).alias("distance"),
        dealt(GOINGS[region], F.col("kind")).alias("going"), "race_no", F.when(F.col("done"), F.col("place")).alias("position"), F.when((F.col("place") == 1) & (F.col("l_tax") > 0.005), furlongs * pace).alias("winner_time"), F.when(F.col("done"), behind).alias("beaten"),
        (110 + F.col("l_quantity") / 2).alias("weight"), "age", F.col("l_partkey").cast("string").alias("horse"), "race_class", F.max("age").over(race).alias("oldest_age"), F.when(F.month("day") == 6, "P").otherwise("H").alias("race_code"),
        F.when(F.month("day") == 6, "PRIX MAIDEN").otherwise("PRIX D'ETE").alias("race_name"), F.when(F.col("l_discount") > 0.005, F.when(F.col("l_discount") < 0.015, 0.0).otherwise(20 + F.col("l_extendedprice") / 1500 + F.col("race_class"))).alias("target"), "l_extendedprice",
    ).withColumn("winner_time", F.max("winner_time").over(Window.partitionBy("race_id")))


def _runners_sql(region: str) -> str:
    goings = ", ".join(map(literal, GOINGS[region]))
    return f"""
race AS MATERIALIZED (SELECT o_orderkey, o_orderstatus AS course, CASE WHEN o_orderstatus = 'F' THEN 'All Weather' ELSE 'Turf' END AS surface, (date_trunc('week', o_orderdate)::DATE + (isodow(o_orderdate) >= 4)::INT)::DATE AS day, left(o_orderpriority, 1)::INT AS race_class FROM orders),
numbered AS (SELECT *, row_number() OVER (PARTITION BY day, course ORDER BY o_orderkey) AS race_no, ((day - DATE '1970-01-01') // 7) % 6 AS kind FROM race),
line AS MATERIALIZED (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY l_orderkey) AS n, (first_value(l_extendedprice) OVER w - l_extendedprice) / 2000 AS behind, round(l_discount * 100)::INT // 3 + 2 AS age
  FROM lineitem JOIN numbered ON o_orderkey = l_orderkey WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber)),
ru AS MATERIALIZED (SELECT l_orderkey::VARCHAR AS race_id, day::VARCHAR || '_' || course AS meeting_id, day, course, surface, (n + 4)::DOUBLE * {1 if region == "UK" else 200} AS distance, [{goings}][kind + 1] AS going, race_no, CASE WHEN place = 1 OR l_discount < 0.095 THEN place END AS position,
  max(CASE WHEN place = 1 AND l_tax > 0.005 THEN (n + 4) * (12.2::DOUBLE + (kind - 2) * 0.15::DOUBLE + l_discount * 3 + l_extendedprice / 500000 + CASE WHEN month(day) = 11 AND race_no >= 4 THEN 0.6::DOUBLE ELSE 0 END) END) OVER (PARTITION BY l_orderkey) AS winner_time,
  CASE WHEN place = 1 OR l_discount < 0.095 THEN behind END AS beaten, 110 + l_quantity / 2 AS weight, age, race_class, max(age) OVER (PARTITION BY l_orderkey) AS oldest_age, month(day) = 6 AS maiden, l_extendedprice,
  CASE WHEN l_discount <= 0.005 THEN NULL WHEN l_discount < 0.015 THEN 0 ELSE 20 + l_extendedprice / 1500 + race_class END AS target FROM line{"" if region == "UK" else " QUALIFY position IS NOT NULL AND winner_time > 0"})"""


def _values(region: str) -> dict[str, object]:
    """The settings of a region, for SQL."""
    if region == "UK":
        prior = "CASE going WHEN 'Good To Firm' THEN -0.09::DOUBLE WHEN 'Good' THEN 0.05 WHEN 'Good to Soft' THEN 0.25 WHEN 'Soft' THEN 0.51 WHEN 'Heavy' THEN 0.82 ELSE 0 END"
        group = "CASE going WHEN 'Good To Firm' THEN 'GdFm' WHEN 'Good to Soft' THEN 'GdSft' WHEN 'Soft' THEN 'Soft' WHEN 'Heavy' THEN 'Heavy' ELSE 'Good' END"
        return {"unit": 1.0, "cls": "(-0.9::DOUBLE)", "prior": prior, "group": group, "good": "'Good To Firm', 'Good'", "thin_k": 15, "trim": 0, "fit": "NOT maiden AND oldest_age <> 2"}
    prior = "CASE going WHEN 'Bon Léger' THEN 0.02::DOUBLE WHEN 'Bon' THEN 0.118 WHEN 'Bon souple' THEN 0.196 WHEN 'Souple' THEN 0.332 WHEN 'Collant' THEN 0.919 ELSE 0.05 END"
    return {"unit": 201.168, "cls": "(0::DOUBLE)", "prior": prior, "group": "going", "good": "'Bon Léger', 'Bon'", "thin_k": 10, "trim": 0.05, "fit": "NOT maiden AND age <> 2"}


def _at(known: str, asked: str, keys: str, x: str, y: str) -> str:
    """The curve of known at x of asked, one row for each key and x, clamped to its ends."""
    key = ", ".join(f"a.{k}" for k in keys.split())
    same = " AND ".join(f"k.{k} = a.{k}" for k in keys.split())
    return f"""(SELECT *, CASE WHEN lx IS NULL THEN hy WHEN hx IS NULL THEN ly ELSE ly + coalesce(({x} - lx) / nullif(hx - lx, 0), 0) * (hy - ly) END AS v FROM (SELECT {key}, a.{x}, max(k.{x}) FILTER (k.{x} <= a.{x}) AS lx, arg_max(k.{y}, k.{x}) FILTER (k.{x} <= a.{x}) AS ly,
  min(k.{x}) FILTER (k.{x} >= a.{x}) AS hx, arg_min(k.{y}, k.{x}) FILTER (k.{x} >= a.{x}) AS hy FROM {asked} a JOIN {known} k ON {same} GROUP BY ALL))"""


def _rated_sql(i: str, wins: str, known: str) -> str:
    """Winners with their deviation a unit from standard, outliers dropped."""
    return f"""
p{i} AS MATERIALIZED (SELECT w.*, (winner_time - {{cls}} * w.distance / {{unit}} - v) / w.distance AS per FROM {wins} w JOIN {_at(known, f"(SELECT DISTINCT course, surface, distance FROM {wins})", "course surface", "distance", "standard")} c USING (course, surface, distance)),
z{i} AS MATERIALIZED (SELECT * FROM (SELECT *, abs(per - median(per) OVER m) / nullif(stddev_samp(per) OVER m, 0) AS z FROM p{i} WINDOW m AS (PARTITION BY meeting_id)) WHERE z IS NULL OR z <= 3)"""


def _allowances_sql(i: str) -> str:
    return f"""{_rated_sql(i, "wins", f"s{i}")},
h{i} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY meeting_id) AS n, row_number() OVER (PARTITION BY meeting_id ORDER BY race_no, race_id) AS i FROM z{i}),
q{i} AS (SELECT meeting_id, coalesce(n >= 6 AND abs(m1 - m2) / nullif(sqrt(v1 / c1 + v2 / c2), 0) > 2.5 AND abs(m1 - m2) > 0.1 / {{unit}}, false) AS halved FROM (SELECT meeting_id, max(n) AS n, avg(per) FILTER (i <= n // 2) AS m1, avg(per) FILTER (i > n // 2) AS m2,
  var_samp(per) FILTER (i <= n // 2) AS v1, var_samp(per) FILTER (i > n // 2) AS v2, count(*) FILTER (i <= n // 2) AS c1, count(*) FILTER (i > n // 2) AS c2 FROM h{i} GROUP BY 1)),
e{i} AS (SELECT CASE WHEN halved THEN meeting_id || CASE WHEN i <= n // 2 THEN '_early' ELSE '_late' END ELSE meeting_id END AS meeting_id, meeting_id AS base_id, per FROM h{i} JOIN q{i} USING (meeting_id)),
l{i} AS (SELECT meeting_id, base_id, list(per ORDER BY per) AS a, count(*) AS n FROM e{i} GROUP BY ALL HAVING count(*) >= 3),
m{i} AS MATERIALIZED (SELECT meeting_id, base_id, n, avg(x) AS raw, stddev_samp(x) / sqrt(n) AS se FROM (SELECT meeting_id, base_id, n, unnest([least(greatest(v, a[2]), a[n - 1]) FOR v IN a]) AS x FROM l{i}) GROUP BY meeting_id, base_id, n),
d{i} AS (SELECT course, surface, day, avg(raw) AS raw FROM m{i} JOIN meeting USING (base_id) GROUP BY ALL),
g{i} AS (SELECT course, surface, day, avg(raw) AS raw FROM (SELECT course, surface, (day + 1)::DATE AS day, raw FROM d{i} UNION ALL SELECT course, surface, (day - 1)::DATE, raw FROM d{i}) GROUP BY ALL),
v{i} AS (SELECT meeting_id, base_id, raw, se, n FROM m{i} UNION ALL SELECT base_id, base_id, raw, NULL, 3 FROM meeting JOIN g{i} USING (course, surface, day) WHERE base_id NOT IN (SELECT base_id FROM m{i})),
u{i} AS MATERIALIZED (SELECT meeting_id, base_id, CASE WHEN abs(x) > 0.3 / {{unit}} THEN x + sign(x) * 0.25 * {{unit}} * (abs(x) - 0.3 / {{unit}}) ** 2 ELSE x END AS ga, se, n FROM (SELECT v.*, (n * raw + 3 * {{prior}} / {{unit}}) / (n + 3) AS x FROM v{i} v JOIN meeting USING (base_id))),
ga{i} AS MATERIALIZED ({{capped_{i}}}),
by{i} AS MATERIALIZED (SELECT base_id AS meeting_id, avg(ga) AS ga, avg(se) AS se FROM ga{i} GROUP BY 1)"""


def _estimate_sql(region: str) -> str:
    values = _values(region)
    steps = [f"""
wins AS MATERIALIZED (SELECT * FROM ru WHERE position = 1 AND winner_time > 0 AND distance > 0),
fit AS MATERIALIZED (SELECT * FROM wins WHERE {values["fit"]}),
meeting AS MATERIALIZED (SELECT meeting_id AS base_id, min(day) AS day, min(course) AS course, min(surface) AS surface, min(going) AS going FROM wins GROUP BY 1),
s0 AS MATERIALIZED (SELECT course, surface, distance, CASE WHEN ng >= 20 THEN g ELSE a END AS standard, n FROM (SELECT course, surface, distance, median(t) FILTER (going IN ({{good}})) AS g, count(*) FILTER (going IN ({{good}})) AS ng, median(t) AS a, count(*) AS n
  FROM (SELECT *, winner_time - {{cls}} * distance / {{unit}} AS t FROM fit) GROUP BY ALL) WHERE n >= 20)""", _allowances_sql("0")]
    for i in range(1, PASSES + 1):
        steps.append(f"""
t{i} AS MATERIALIZED (SELECT course, surface, distance, race_id, winner_time - {{cls}} * distance / {{unit}} - ga * distance AS t, pow(0.5::DOUBLE, ((SELECT max(year(day)) FROM fit) - year(day)) / 4.0) AS w FROM fit JOIN by{i - 1} USING (meeting_id)),
r{i} AS MATERIALIZED (SELECT * FROM (SELECT *, count(*) OVER k AS n, row_number() OVER (PARTITION BY course, surface, distance ORDER BY t, race_id) AS i FROM t{i} WINDOW k AS (PARTITION BY course, surface, distance))
  WHERE floor(n * {{trim}}) < 1 OR n - 2 * floor(n * {{trim}}) < 3 OR (i > floor(n * {{trim}}) AND i <= n - floor(n * {{trim}}))),
o{i} AS MATERIALIZED (SELECT course, surface, distance, min(t) FILTER (run >= total / 2 - 1e-9) AS y, count(*) AS n FROM (SELECT *, sum(w) OVER (PARTITION BY course, surface, distance ORDER BY t, race_id ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY course, surface, distance) AS total FROM r{i}) GROUP BY ALL),
s{i} AS MATERIALIZED (SELECT course, surface, distance, CASE WHEN n >= 20 OR generic IS NULL THEN y ELSE (n * y + {{thin_k}} * generic) / (n + {{thin_k}}) END AS standard, n FROM o{i} LEFT JOIN (SELECT round_even(distance / {{unit}}, 0) AS near, median(y) AS generic FROM o{i} WHERE n >= 20 GROUP BY 1) ON near = round_even(distance / {{unit}}, 0) WHERE n >= 10)""")
        steps.append(_allowances_sql(str(i)))
    text = ",".join(steps)
    for i in range(PASSES + 1):
        bound = f"SELECT meeting_id, base_id, greatest(least(ga, greatest((SELECT quantile_cont(ga, 0.99) FROM u{i}), 2.5 / {{unit}})), least((SELECT quantile_cont(ga, 0.01) FROM u{i}), -1.5 / {{unit}})) AS ga, se, n FROM u{i}"
        text = text.replace(f"{{capped_{i}}}", bound if region == "France" else f"SELECT * FROM u{i}")
    return text.format(**values)


def _figures_sql(region: str, rows: str, by: str, live: bool = False) -> str:
    """Figures, age allowance and attached allowance of rows, as rated_<rows>, from the last standards and the allowances named."""
    grid = ", ".join(f"({literal(s)}, {a}, {m}, {x}::DOUBLE, {y}::DOUBLE)" for s, a, m, x, y in grid_rows(region))
    generic = "0.2 * 20 * (5 * {unit} / w.distance) * CASE w.surface WHEN 'All Weather' THEN 1.1 ELSE 1.0 END"
    asked = f"(SELECT DISTINCT course, surface, distance FROM {rows})"
    return f"""
pace_{rows} AS (SELECT course, surface, distance, avg(standard / distance) OVER (PARTITION BY surface, round_even(distance / {{unit}}, 0)) / (standard / distance) AS rel FROM s{PASSES}),
won_{rows} AS MATERIALIZED (SELECT race_id, v AS standard, ga, lpl, 100 - (winner_time - ga * distance - v) / 0.2 * lpl AS winner_figure FROM (SELECT w.race_id, w.winner_time, w.distance, c.v, b.ga, {generic} * coalesce(rel, 1) AS lpl
  FROM (SELECT * FROM {rows} WHERE position = 1 AND winner_time > 0 AND distance > 0) w JOIN {by} b USING (meeting_id) LEFT JOIN {_at(f"s{PASSES}", asked, "course surface", "distance", "standard")} c USING (course, surface, distance) LEFT JOIN pace_{rows} USING (course, surface, distance))),
soft_{rows} AS (SELECT x.*, o.* EXCLUDE (race_id), least(greatest(20 - 8 * ga, 10), 30) AS top, CASE WHEN position = 1 THEN 0.0 {"ELSE greatest(beaten, 0)" if live else "WHEN beaten <= 20 THEN greatest(beaten, 0)"} END AS b FROM {rows} x LEFT JOIN won_{rows} o USING (race_id)),
grid_{rows}(surface, age, month, furlongs, pounds) AS (VALUES {grid}),
raw_{rows} AS (SELECT *, winner_figure - CASE WHEN b <= top THEN b ELSE top + 0.5 * (b - top) END * lpl * least(greatest(standard / winner_time, 0.85), 1.15) + weight - 126 AS weighted, month(day) AS month, distance / {{unit}} AS furlongs FROM soft_{rows}),
aged_{rows} AS (SELECT r.*, weighted + coalesce(v, 0) AS adjusted FROM raw_{rows} r LEFT JOIN {_at(f"grid_{rows}", f"(SELECT DISTINCT surface, age, month, furlongs FROM raw_{rows})", "surface age month", "furlongs", "pounds")} p ON p.surface = r.surface AND p.age = r.age AND p.month = r.month AND p.furlongs = r.furlongs),
tied_{rows} AS MATERIALIZED (SELECT a.*, coalesce(b.ga, 0) AS ga_value, b.se FROM aged_{rows} a LEFT JOIN {by} b USING (meeting_id)),
rated_{rows} AS MATERIALIZED (SELECT *, coalesce(se, 0.5 * (SELECT stddev_samp(ga_value) FROM tied_{rows})) AS ga_se, {{group}} AS ggroup, least(greatest(age, 2), 4) AS agegroup, round_even(distance / {{unit}}, 0) AS near,
  CASE WHEN position = 1 THEN 'winner' WHEN beaten <= 0 OR beaten > 20 OR beaten IS NULL THEN 'other' WHEN beaten <= 1 THEN 'a' WHEN beaten <= 3 THEN 'b' WHEN beaten <= 5 THEN 'c' WHEN beaten <= 10 THEN 'd' WHEN beaten <= 15 THEN 'e' ELSE 'f' END AS band FROM tied_{rows})""".format(**_values(region))


def _chain_sql(rated: str, learn: str) -> str:
    """Each correction in turn: learned from `learn`, which goes through the chain as well, applied to `rated`. Where both are one table, it goes once."""
    both = [("a", rated)] if rated == learn else [("a", rated), ("b", learn)]
    source = both[-1][0]
    valid = "target <> 0 AND target BETWEEN -200 AND 200 AND f IS NOT NULL AND year(day) < (SELECT max(year(day)) FROM " + learn + ")"
    close = valid + " AND (coalesce(beaten, 0) <= 20 OR coalesce(position = 1, false)) AND abs(ga_value) <= 2"
    out = [f"{p}0 AS MATERIALIZED (SELECT *, adjusted AS f FROM {t})" for p, t in both]
    out.append(f"""
cm AS (SELECT surface, avg(f) AS mx FROM {source}0 WHERE {close} GROUP BY 1),
cs AS (SELECT surface, any_value(mx) AS mx, count(*) AS n, sum((f - mx) ** 2) AS s2, sum((f - mx) ** 3) AS s3, sum((f - mx) ** 4) AS s4, sum(target) AS t0, sum((f - mx) * target) AS t1, sum((f - mx) ** 2 * target) AS t2, regr_slope(target, f) AS m, regr_intercept(target, f) AS c FROM {source}0 JOIN cm USING (surface) WHERE {close} GROUP BY 1),
cb AS (SELECT *, (s2 * t2 - s3 * t1 - s2 * s2 * t0 / n) / nullif(s2 * s4 - s3 * s3 - s2 * s2 * s2 / n, 0) AS b2 FROM cs WHERE n >= 100),
ca AS (SELECT *, (t1 - s3 * b2) / nullif(s2, 0) AS b1, (t0 - s2 * b2) / n AS b0 FROM cb),
ck AS MATERIALIZED (SELECT surface, any_value(mx) AS mx, any_value(m) AS m, any_value(c) AS c, any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, coalesce(avg((b0 + b1 * (f - mx) + b2 * (f - mx) ** 2 - target) ** 2) < 0.999 * avg((m * f + c - target) ** 2), false) AS curved FROM {source}0 JOIN ca USING (surface) WHERE {close} GROUP BY 1)""")
    out += [f"{p}1 AS MATERIALIZED (SELECT x.* REPLACE (coalesce(CASE WHEN curved THEN b0 + b1 * (f - mx) + b2 * (f - mx) ** 2 ELSE m * f + c END, f) AS f) FROM {p}0 x LEFT JOIN ck USING (surface))" for p, _ in both]
    at = 1

    def step(keys: str, offset: str, having: str, where: str, add: str = "o") -> None:
        nonlocal at
        out.append(f"k{at} AS MATERIALIZED (SELECT {keys}, {offset} AS o FROM {source}{at} WHERE {where} GROUP BY ALL HAVING {having})")
        out.extend(f"{p}{at + 1} AS MATERIALIZED (SELECT x.* REPLACE (f + coalesce({add}, 0) AS f) FROM {p}{at} x LEFT JOIN k{at} USING ({keys}))" for p, _ in both)
        at += 1

    shrunk = lambda k: f"sum(target - f) / (count(*) + {k})"
    step("surface, race_class", shrunk(0), "true", close)
    step("surface, course, distance", f"least(greatest({shrunk(100)}, -10), 10)", "true", close)
    step("surface, ggroup", shrunk(100), "true", close)
    step("surface", "sum(ga_value * (target - f)) / (sum(ga_value ** 2) + 1e-6)", "count(*) FILTER (ga_value <> 0) > 200", close, "o * ga_value")
    step("surface, band", shrunk(100), "true", close)
    step("surface, agegroup", shrunk(100), "true", close)
    for keys, least in (("surface, near", 100), ("surface, ggroup", 200)):
        enough = f"surface IN (SELECT surface FROM {source}{at} WHERE {valid} GROUP BY 1 HAVING count(*) >= 500)"
        step(keys, shrunk(500), f"count(*) >= {least}", f"{valid} AND {enough}")
    step("surface", shrunk(0), "count(*) > 500", f"{valid} AND year(day) BETWEEN {DRIFT_YEAR} AND {DRIFT_YEAR + 1}", f"CASE WHEN year(day) >= {DRIFT_YEAR} THEN o END")
    out.append(f"kr AS MATERIALIZED (SELECT surface, regr_slope(target, f) AS m, avg(f) AS mx, avg(target) AS my FROM {source}{at} WHERE {valid} AND coalesce(beaten, 0) <= 20 GROUP BY 1 HAVING count(*) >= 2000 AND abs(regr_slope(target, f) - 1) >= 0.02)")
    out.append(f"final AS (SELECT x.* REPLACE (coalesce((f - mx) * m + my, f) AS f) FROM a{at} x LEFT JOIN kr USING (surface))")
    return ",\n".join(out)


def _batch_sql(region: str) -> str:
    return f"""WITH {_runners_sql(region)},{_estimate_sql(region)},{_figures_sql(region, "ru", f"by{PASSES}")},
{_chain_sql("rated_ru", "rated_ru")}
SELECT race_id, l_extendedprice, rnd(winner_figure, 3) AS winner_figure, rnd(adjusted, 3) AS adjusted, rnd(f, 3) AS calibrated, rnd(ga_value, 4) AS ga_value, rnd(ga_se, 4) AS ga_se, CASE WHEN abs(ga_value) <= 0.5 THEN 'high' WHEN abs(ga_value) <= 1.5 THEN 'medium' ELSE 'low' END AS confidence FROM final"""


def _batch(spark: SparkSession, sf: str, region: str) -> DataFrame:
    rows = runs.batch(runners(spark, sf, region), REGIONS[region], DRIFT_YEAR).rows
    return rows.select("race_id", "l_extendedprice", *[r(c, 3).alias(c) for c in ("winner_figure", "adjusted", "calibrated")], *[r(c).alias(c) for c in ("ga_value", "ga_se")], "confidence")


@query(_batch_sql("UK"))
def uk_batch(spark: SparkSession, sf: str) -> DataFrame:
    """British figures from runners to corrected ones, two passes."""
    return _batch(spark, sf, "UK")


@query(_batch_sql("France"))
def french_batch(spark: SparkSession, sf: str) -> DataFrame:
    """French figures in the same way: metres, trimmed standards, capped allowances, maidens by name."""
    return _batch(spark, sf, "France")


def _live_sql() -> str:
    cut = f"""every AS MATERIALIZED (SELECT * FROM every_day),
ru AS MATERIALIZED (SELECT * FROM every WHERE day < DATE '{SPLIT_DAY}'), today AS MATERIALIZED (SELECT * FROM every WHERE day >= DATE '{SPLIT_DAY}'), winners_today AS (SELECT * FROM today WHERE position = 1 AND winner_time > 0 AND distance > 0)"""
    allowances = f"""{_rated_sql("9", "winners_today", f"s{PASSES}")},
l9 AS (SELECT meeting_id, list(per ORDER BY per) AS a, count(*) AS n FROM z9 GROUP BY 1 HAVING count(*) >= 3),
m9 AS MATERIALIZED (SELECT meeting_id, n, median(x) AS raw, stddev_samp(x) / sqrt(n) AS se FROM (SELECT meeting_id, n, unnest([least(greatest(v, a[2]), a[n - 1]) FOR v IN a]) AS x FROM l9) GROUP BY meeting_id, n),
by9 AS MATERIALIZED (SELECT meeting_id, CASE WHEN x IS NULL THEN {{prior}} / {{unit}} WHEN abs(x) > 0.3 / {{unit}} THEN x + sign(x) * 0.25 * {{unit}} * (abs(x) - 0.3 / {{unit}}) ** 2 ELSE x END AS ga, se FROM (SELECT t.meeting_id, going, se, (n * raw + 3 * {{prior}} / {{unit}}) / (n + 3) AS x
  FROM (SELECT meeting_id, min(going) AS going FROM today GROUP BY 1) t LEFT JOIN m9 USING (meeting_id)))""".format(**_values("UK"))
    runners = _runners_sql("UK").replace("ru AS MATERIALIZED", "every_day AS")
    return f"""WITH {runners}, {cut},{_estimate_sql("UK")},{_figures_sql("UK", "ru", f"by{PASSES}")},{allowances},{_figures_sql("UK", "today", "by9", True)},
{_chain_sql("rated_today", "rated_ru")}
SELECT race_id, l_extendedprice, rnd(adjusted, 3) AS adjusted, rnd(f, 3) AS calibrated, rnd(ga_value, 4) AS ga_value, rnd(ga_se, 4) AS ga_se, CASE WHEN n < 30 AND f IS NOT NULL THEN 'provisional' WHEN beaten > 20 AND position IS DISTINCT FROM 1 THEN 'low' ELSE 'high' END AS confidence
FROM final LEFT JOIN s{PASSES} USING (course, surface, distance)"""


@query(_live_sql())
def uk_live(spark: SparkSession, sf: str) -> DataFrame:
    """The last years' cards rated live, by the tables that a batch over the years before leaves."""
    every = written(runners(spark, sf, "UK"), "every")  # both parts read it
    before, today = (every.where(F.col("day") < F.lit(SPLIT_DAY).cast("date")), every.where(F.col("day") >= F.lit(SPLIT_DAY).cast("date")))
    tables = runs.batch(before, REGIONS["UK"], DRIFT_YEAR).tables
    rows = runs.live(today, tables, REGIONS["UK"], DRIFT_YEAR)
    return rows.select("race_id", "l_extendedprice", *[r(c, 3).alias(c) for c in ("adjusted", "calibrated")], *[r(c).alias(c) for c in ("ga_value", "ga_se")], "confidence")
