"""Queries on scans, derived columns, filters, joins, texts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.columns import binned, clamp, mapped
from ..operators import interpolate
from ..sources.cards import odds_of
from ..sources.discovery import key_paths
from ..sources.staging import dealt
from .registry import query, r, table


@query("""
SELECT l_orderkey, concat_ws('_', strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority, l_linenumber) AS race_id, year(o_orderdate)::INT AS source_year,
  try_cast(regexp_extract(o_orderpriority, '(\\d+)', 1) AS INT) AS priority_no, rnd(l_extendedprice / nullif(l_quantity, 0), 4) AS unit_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_quantity > 5 AND l_returnflag IN ('A', 'R')
""")
def scan_filter_derive(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered join with composite keys, a source year and coerced numbers."""
    lines = table(spark, sf, "lineitem").where("l_quantity > 5 and l_returnflag in ('A', 'R')")
    orders = table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", F.concat_ws("_", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority", F.col("l_linenumber").cast("string")).alias("race_id"), F.year("o_orderdate").alias("source_year"),
        F.regexp_extract("o_orderpriority", r"(\d+)", 1).try_cast("int").alias("priority_no"), r(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price"),
    )


CUTOFFS = [("1-URGENT", "1997-01-01"), ("2-HIGH", "1999-06-01")]


@query("""
SELECT o_orderkey, o_orderpriority FROM orders LEFT JOIN (VALUES ('1-URGENT', DATE '1997-01-01'), ('2-HIGH', DATE '1999-06-01')) c(p, cutoff) ON o_orderpriority = p
WHERE cutoff IS NULL OR o_orderdate::DATE >= cutoff
""")
def cutoff_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows on or after their key's cutoff date; keys without one stay."""
    cutoffs = spark.createDataFrame(CUTOFFS, "o_orderpriority string, cutoff string").select("o_orderpriority", F.to_date("cutoff").alias("cutoff"))
    joined = table(spark, sf, "orders").join(F.broadcast(cutoffs), "o_orderpriority", "left")  # a literal table
    return joined.where(F.col("cutoff").isNull() | (F.to_date("o_orderdate") >= F.col("cutoff"))).select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice > 300000)")
def eligibility_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without a large finished order."""
    large = table(spark, sf, "orders").where("o_orderstatus = 'F' and o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").join(large, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)")
def membership_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that some large line has."""
    return table(spark, sf, "part").join(table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_partkey")


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 1 WHEN 'purchase' THEN 5 ELSE -1 END AS ordinal FROM events")
def map_with_default(spark: SparkSession, sf: str) -> DataFrame:
    """A literal mapping with a default."""
    return table(spark, sf, "events").select("event_id", mapped(F.col("event_type"), {"click": 3, "view": 1, "purchase": 5}, -1).alias("ordinal"))


@query("SELECT event_id, coalesce(try_cast(props->>'$.k' AS INT), try_cast(props->>'$.j' AS INT), 0) AS k, (props->>'$.k') IS NOT NULL AS has_k FROM events")
def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    """A field of a JSON text with fallbacks."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select("event_id", F.coalesce(k.try_cast("int"), F.get_json_object("props", "$.j").try_cast("int"), F.lit(0)).alias("k"), k.isNotNull().alias("has_k"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'password|token') THEN 6.0::DOUBLE WHEN regexp_matches(lower(text), 'licen[cs]e') THEN 5.0 WHEN regexp_matches(lower(text), '\\bthe\\b.*\\band\\b') THEN 4.0
  WHEN regexp_matches(lower(text), 'der|die') THEN 3.0 ELSE 1.0 END AS score, regexp_matches(upper(text), 'MAIDEN|NOVICE|THE') AS has_keyword FROM documents
""")
def regex_ladder(spark: SparkSession, sf: str) -> DataFrame:
    """The score of the first pattern that matches, and a keyword flag, over whole texts."""
    ladder = [("password|token", 6.0), ("licen[cs]e", 5.0), (r"\bthe\b.*\band\b", 4.0), ("der|die", 3.0)]
    return table(spark, sf, "documents").select("doc_id", text.first_match(F.lower("text"), ladder, 1.0).alias("score"), F.upper("text").rlike("MAIDEN|NOVICE|THE").alias("has_keyword"))


@query("SELECT p_partkey, try_cast(regexp_extract(p_brand, '(\\d+)', 1) AS INT) AS brand_no, upper(split_part(p_type, ' ', 1)) AS kind, starts_with(p_type, 'S') AS is_s FROM part")
def regex_extract_int(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and words out of labels."""
    return table(spark, sf, "part").select("p_partkey", text.first_int(F.col("p_brand")).alias("brand_no"), F.upper(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("kind"), F.startswith("p_type", F.lit("S")).alias("is_s"))


@query("""
SELECT l_orderkey, l_extendedprice, CASE WHEN l_quantity <= 0 THEN 'other' WHEN l_quantity <= 5 THEN '0-5' WHEN l_quantity <= 10 THEN '5-10' WHEN l_quantity <= 30 THEN '10-30' ELSE 'other' END AS band,
  least(greatest(l_quantity, 10.0), 30.0) AS clamped FROM lineitem
""")
def banding(spark: SparkSession, sf: str) -> DataFrame:
    """Right-closed bands with a rest, and a clamp."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", binned(F.col("l_quantity"), [0, 5, 10, 30], "other").alias("band"), clamp(F.col("l_quantity"), 10.0, 30.0).alias("clamped"))


@query("""
SELECT l_orderkey, l_extendedprice, rnd(sum(gap) OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice), 4) AS cumulative FROM (
  SELECT l_orderkey, l_extendedprice, coalesce(l_extendedprice - lag(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice), 0) AS gap FROM lineitem)
""")
def margin_cumsum(spark: SparkSession, sf: str) -> DataFrame:
    """Running margins behind the first of each order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_extendedprice")
    gaps = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", F.coalesce(F.col("l_extendedprice") - F.lag("l_extendedprice").over(w), F.lit(0.0)).alias("gap"))
    return gaps.select("l_orderkey", "l_extendedprice", r(F.sum("gap").over(w)).alias("cumulative"))


CURVE_SQL = """
WITH curve AS (SELECT p_brand, p_size::DOUBLE AS x, median(p_retailprice) AS y FROM part GROUP BY ALL),
asked AS (SELECT p_partkey, p_brand, p_size + 0.5 AS x FROM part),
ends AS (SELECT p_brand, min(x) AS x0, max(x) AS x1, arg_min(y, x) AS y0, arg_max(y, x) AS y1 FROM curve GROUP BY 1),
near AS (
  SELECT a.*, e.x0, e.x1, e.y0, e.y1, max(c.x) FILTER (c.x <= a.x) AS lx, arg_max(c.y, c.x) FILTER (c.x <= a.x) AS ly, min(c.x) FILTER (c.x >= a.x) AS hx, arg_min(c.y, c.x) FILTER (c.x >= a.x) AS hy
  FROM asked a LEFT JOIN curve c USING (p_brand) LEFT JOIN ends e USING (p_brand) GROUP BY ALL)
SELECT p_partkey, rnd(CASE WHEN lx IS NULL THEN y0 WHEN hx IS NULL THEN y1 ELSE ly + coalesce((x - lx) / nullif(hx - lx, 0), 0) * (hy - ly) END, 4) AS {name} FROM near {where}
"""


def _curves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf, "part")
    points = part.groupBy("p_brand", "p_size").agg(F.median("p_retailprice").alias("y"))
    return part.select("p_partkey", "p_brand", (F.col("p_size") + 0.5).alias("x")), interpolate.curves(points, ["p_brand"], "p_size", "y")


@query(CURVE_SQL.format(name="value", where=""))
def interp_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Linear interpolation between a brand's known sizes, clamped at the ends."""
    asked, known = _curves(spark, sf)
    return interpolate.join_at(asked, known, ["p_brand"], "x", "v").select("p_partkey", r("v").alias("value"))


@query("SELECT p_partkey, CASE WHEN ok THEN value END AS value FROM (" + CURVE_SQL.replace("AS {name} FROM near", "AS value, x >= x0 * 0.95 AND x <= x1 * 1.05 AS ok FROM near").replace("{where}", "") + ")")
def interp_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """The same, null where it would reach more than five per cent outside."""
    asked, known = _curves(spark, sf)
    return interpolate.join_at(asked, known, ["p_brand"], "x", "v", 0.05).select("p_partkey", r("v").alias("value"))


@query("""
WITH grid(m, x, y) AS (VALUES (1, 5.0, 13.0), (1, 20.0, 9.0), (1, 40.0, 7.0), (2, 5.0, 10.0), (2, 30.0, 4.0), (3, 10.0, 5.0))
SELECT p_partkey, rnd(CASE WHEN lx IS NULL THEN hy WHEN hx IS NULL THEN ly ELSE ly + coalesce((p_size - lx) / nullif(hx - lx, 0), 0) * (hy - ly) END, 4) AS allowance FROM (
  SELECT p_partkey, p_size, max(x) FILTER (x <= p_size) AS lx, arg_max(y, x) FILTER (x <= p_size) AS ly, min(x) FILTER (x >= p_size) AS hx, arg_min(y, x) FILTER (x >= p_size) AS hy
  FROM part LEFT JOIN grid ON m = p_partkey % 4 GROUP BY ALL)
""")
def grid_interp(spark: SparkSession, sf: str) -> DataFrame:
    """A literal grid by month and distance, interpolated over distance; null for months it lacks."""
    rows = [(1, 5.0, 13.0), (1, 20.0, 9.0), (1, 40.0, 7.0), (2, 5.0, 10.0), (2, 30.0, 4.0), (3, 10.0, 5.0)]
    grid = interpolate.curves(spark.createDataFrame(rows, "m int, x double, y double"), ["m"], "x", "y")
    return interpolate.join_at(table(spark, sf, "part").withColumn("m", (F.col("p_partkey") % 4).cast("int")), grid, ["m"], "p_size", "v").select("p_partkey", r("v").alias("allowance"))


@query("""
WITH days AS (SELECT user_id, ts::DATE AS day, avg(value) AS v FROM events GROUP BY ALL)
SELECT a.user_id, a.day, rnd(avg(b.v), 4) AS neighbour_mean FROM days a JOIN days b ON a.user_id = b.user_id AND abs(date_diff('day', a.day, b.day)) = 1 GROUP BY ALL
""")
def neighbour_day(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's day with the mean of the days next to it."""
    days = table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.avg("value").alias("v"))
    near = interpolate.day_neighbours(days, ["user_id"], "day", "v")
    return days.join(near, ["user_id", "day"]).select("user_id", "day", r("neighbour_mean").alias("neighbour_mean"))


@query("""
SELECT l_orderkey, l_extendedprice, rnd(w - CASE WHEN gap <= 20000 THEN gap ELSE 20000 + 0.5 * (gap - 20000) END * least(greatest(w / 30000, 0.85), 1.15), 4) AS figure FROM (
  SELECT l_orderkey, l_extendedprice, max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS w, max(l_extendedprice) OVER (PARTITION BY l_orderkey) - l_extendedprice AS gap FROM lineitem)
""")
def winner_extend(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of all runners from their winner's, with softened margins."""
    w = F.max("l_extendedprice").over(Window.partitionBy("l_orderkey"))
    gaps = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", w.alias("w")).withColumn("gap", F.col("w") - F.col("l_extendedprice"))
    return gaps.select("l_orderkey", "l_extendedprice", r(F.col("w") - text.attenuated(F.col("gap"), F.lit(20000.0), 0.5) * clamp(F.col("w") / 30000, 0.85, 1.15)).alias("figure"))


@query("""
SELECT kind, count(*)::BIGINT AS n FROM (
  SELECT 'union' AS kind, k FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders) UNION ALL
  SELECT 'except', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL
  SELECT 'intersect', k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'all', o_custkey FROM orders) GROUP BY kind
""")
def set_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of union, difference, intersection and union all of two key columns."""
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    parts = {"union": a.union(b).distinct(), "except": a.subtract(b), "intersect": a.intersect(b), "all": b}
    tagged = [df.select(F.lit(kind).alias("kind")) for kind, df in parts.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT coalesce(k, user_id) AS user_id, coalesce(v, value) AS value FROM (SELECT user_id, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1)
FULL JOIN (SELECT user_id AS k, min(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1) ON k = user_id
""")
def upsert_right_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Two keyed tables merged, the right one's values winning."""
    events = table(spark, sf, "events")
    old = events.where("event_type = 'view'").groupBy("user_id").agg(F.max("value").alias("old"))
    new = events.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("value").alias("new"))
    return old.join(new, "user_id", "full").select("user_id", F.coalesce("new", "old").alias("value"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """One row per key, the first by date and key."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").withColumn("i", F.row_number().over(w)).where("i = 1").select("o_custkey", "o_orderkey", "o_totalprice")


@query("""
SELECT doc_id, len(regexp_extract_all(text, '[A-Z][a-z]+ [a-z]+'))::BIGINT AS n_pairs, list_max(list_transform(regexp_extract_all(text, '[0-9]{2,6}'), lambda x: x::INT)) AS largest FROM documents
""")
def multi_match(spark: SparkSession, sf: str) -> DataFrame:
    """All matches of patterns in whole texts: how many, and the largest number of two to six digits."""
    numbers = F.transform(F.regexp_extract_all("text", F.lit("[0-9]{2,6}"), F.lit(0)), lambda x: x.cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+ [a-z]+"), F.lit(0))).cast("long").alias("n_pairs"), F.array_max(numbers).alias("largest"))


@query("SELECT event_id, CASE WHEN k > 0 THEN (k // 10000) * 60 + (k // 100) % 100 + (k % 100) / 100.0 END AS seconds FROM (SELECT event_id, event_id * 37 % 60000 AS k FROM events)")
def packed_time(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes, seconds and hundredths out of one packed integer."""
    return table(spark, sf, "events").select("event_id", text.packed_seconds(F.col("event_id") * 37 % 60000).alias("seconds"))


@query("""
SELECT event_id, CASE WHEN o > 0 THEN o END AS odds FROM (SELECT event_id, coalesce(try_cast(json_extract_string('{"a":{"b":' || value || '}}', '$.a.b') AS DOUBLE), 0) AS o FROM events)
""")
def nested_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """A nested field of a built document with the source's fallback chain."""
    doc = F.concat(F.lit('{"dernierRapportDirect":{"rapport":'), F.col("value").cast("string"), F.lit("}}"))
    return table(spark, sf, "events").select("event_id", odds_of(doc).alias("odds"))


@query("""
WITH o AS (SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders),
l AS (SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem JOIN o ON l_orderkey = o_orderkey),
s AS (SELECT l_orderkey, count(*) AS items FROM l GROUP BY 1)
SELECT '' AS path, 'object' AS kinds, count(*) AS n, 3 + min((priority LIKE '1%')::INT) AS least, 3 + max((priority LIKE '1%')::INT) AS most, NULL AS preview FROM s JOIN o ON l_orderkey = o_orderkey
UNION ALL SELECT 'id', 'integer', count(*), NULL, NULL, min(l_orderkey::VARCHAR) FROM s
UNION ALL SELECT 'rush', 'boolean', count(*), NULL, NULL, 'true' FROM s JOIN o ON l_orderkey = o_orderkey WHERE priority LIKE '1%' HAVING count(*) > 0
UNION ALL SELECT 'status', CASE WHEN min((status = 'F')::INT) = 1 THEN 'string' WHEN max((status = 'F')::INT) = 0 THEN 'object' ELSE 'object,string' END, count(*),
  CASE WHEN min((status = 'F')::INT) = 0 THEN 1 END, CASE WHEN min((status = 'F')::INT) = 0 THEN 1 END, CASE WHEN max((status = 'F')::INT) = 1 THEN '"F"' END FROM s JOIN o ON l_orderkey = o_orderkey
UNION ALL SELECT 'status["now.is"]', 'string', count(*), NULL, NULL, min('"' || status || '"') FROM s JOIN o ON l_orderkey = o_orderkey WHERE status <> 'F' HAVING count(*) > 0
UNION ALL SELECT 'lines', 'array', count(*), min(items), max(items), NULL FROM s
UNION ALL SELECT 'lines[]', 'object', sum(items)::BIGINT, 2, 2, NULL FROM s
UNION ALL SELECT 'lines[].no', 'integer', count(*), NULL, NULL, min(l_linenumber::VARCHAR) FROM l
UNION ALL SELECT 'lines[].flag', 'string', count(*), NULL, NULL, min('"' || l_returnflag || '"') FROM l
""")
def json_key_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Every path of nested order documents with its kinds, counts, sizes and a preview; one key is optional, one is a text or an object."""
    lines = dealt(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_orderkey").groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_returnflag").alias("flag")))).alias("lines"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status = F.when(F.col("o_orderstatus") == "F", F.lit('"F"')).otherwise(F.format_string('{"now.is":"%s"}', "o_orderstatus"))
    rush = F.when(F.col("o_orderpriority").startswith("1"), F.lit(',"rush":true')).otherwise("")
    doc = F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"), F.lit(',"status":'), status, rush, F.lit(',"lines":'), "lines", F.lit("}"))
    return key_paths(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(doc.alias("doc")))
