"""Queries on the comparison of maps and on what a model leans on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting, compare, mapping
from ..operators.importance import importance
from ..sources.staging import written
from .registry import query, r, table

_CIRCLE = "coalesce(lead({0}) OVER w, first_value({0}) OVER w)"


@query(f"""
WITH e AS (SELECT event_id, value, (props->>'$.k')::DOUBLE AS k, hour(ts)::INT AS hour, user_id FROM events),
f AS (SELECT regr_slope(value, k) AS slope, avg(k) AS mk FROM e), h AS (SELECT hour, avg(value) AS level FROM e GROUP BY 1),
x AS (SELECT *, substr(md5(event_id::VARCHAR), 1, 2) AS bucket, md5(event_id::VARCHAR || '-' || c) AS place FROM e, (VALUES (''), ('k'), ('hour'), ('user_id')) t(c)),
s AS (SELECT c, value, CASE WHEN c = 'k' THEN {_CIRCLE.format('k')} ELSE k END AS k, CASE WHEN c = 'hour' THEN {_CIRCLE.format('hour')} ELSE hour END AS hour FROM x WINDOW w AS (PARTITION BY c, bucket ORDER BY place)),
m AS (SELECT c, avg(abs(value - (level + slope * (k - mk)))) AS error FROM s JOIN h USING (hour), f GROUP BY 1)
SELECT c AS "column", rnd(error, 4) AS error, rnd(error - (SELECT error FROM m WHERE c = ''), 4) AS increase FROM m WHERE c <> ''
""")
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """How the error of a prediction by hour and line grows when each of its columns is shuffled; one it does not use adds nothing."""
    events = table(spark, sf, "events").select("event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").alias("hour"), "user_id")
    line = events.agg(F.regr_slope("value", "k").alias("slope"), F.avg("k").alias("mk"))  # one row
    levels = events.groupBy("hour").agg(F.avg("value").alias("level"))  # 24 rows

    def predict(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(levels), "hour").crossJoin(F.broadcast(line)).withColumn("predicted", F.col("level") + F.col("slope") * (F.col("k") - F.col("mk")))

    return importance(events, "event_id", ["k", "hour", "user_id"], "value", predict, digits=2).select("column", r("error").alias("error"), r("increase").alias("increase"))


@query()
def mapping_bake_off(spark: SparkSession, sf: str) -> DataFrame:
    """Every map of a coarse scale onto prices, fitted by return flag on earlier years and scored on later ones; tests hold the maps against closed forms."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_quantity") * 1000).alias("x"), "l_extendedprice", F.year("l_shipdate").alias("year"))
    scores = mapping.bake_off(lines, "l_returnflag", "x", "l_extendedprice", F.col("year") <= 1996)
    return scores.select("method", "n", *[r(c, 3).alias(c) for c in ("mae", "bias", "rmse", "corr")])


@query()
def boosted_blend(spark: SparkSession, sf: str) -> DataFrame:
    """The mean of four boosted models of prices, fitted on years up to 1996 and stopped by those of 1997; tests hold rounds and mean against models fitted apart."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select("l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "p_size", "p_retailprice", F.year("l_shipdate").alias("year"))
    out, _ = boosting.blend(rows, ["l_quantity", "l_discount", "p_size", "p_retailprice"], "l_extendedprice", F.col("year") <= 1996, F.col("year") == 1997, depths=(3, 4), trees=8, step=0.3)
    return out.select("l_orderkey", "l_extendedprice", r("predicted", 2).alias("predicted"))


def _fold_sql(name: str, trains: str, tests: str) -> str:
    """SQL for the errors of a line on quantity and of a plane on quantity and size, by the closed forms of least squares."""
    return f"""
SELECT '{name}' AS fold, setting, count(*) AS n, rnd(avg(abs(e)), 3) AS mae, rnd(sqrt(avg(e * e)), 3) AS rmse, rnd(avg(e), 3) AS bias, rnd(avg(abs(e) - abs(e0)), 3) AS change,
  rnd(stddev_samp(abs(e) - abs(e0)) / sqrt(count(*)), 3) AS change_se
FROM (WITH t AS (SELECT * FROM x WHERE {trains}),
  m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM t),
  e AS (SELECT my + ay / aa * (a - ma) - y AS e0, my + (ay * bb - yb * ab) / (aa * bb - ab * ab) * (a - ma) + (yb * aa - ay * ab) / (aa * bb - ab * ab) * (b - mb) - y AS e1,
    my + ay / (1.5 * aa) * (a - ma) - y AS e2, my + (ay * 1.5 * bb - yb * ab) / (2.25 * aa * bb - ab * ab) * (a - ma) + (yb * 1.5 * aa - ay * ab) / (2.25 * aa * bb - ab * ab) * (b - mb) - y AS e3
    FROM x, m WHERE {tests})
  SELECT 'base / 0' AS setting, e0 AS e, e0 FROM e UNION ALL SELECT 'base / 0.5', e2, e0 FROM e UNION ALL SELECT 'more / 0', e1, e0 FROM e UNION ALL SELECT 'more / 0.5', e3, e0 FROM e)
GROUP BY setting"""


@query(
    "WITH x AS (SELECT l_quantity AS a, p_size AS b, l_extendedprice AS y, year(l_shipdate) AS year FROM lineitem JOIN part ON l_partkey = p_partkey)"
    + " UNION ALL ".join(_fold_sql(str(y), f"year < {y}", f"year = {y}") for y in (1996, 1997, 1998))
)
def feature_sets_compared(spark: SparkSession, sf: str) -> DataFrame:
    """Prices by quantity, with and without size, at two penalties, on three temporal folds: errors, and paired differences from the plain line."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = written(lines.select("l_quantity", "p_size", "l_extendedprice", F.year("l_shipdate").alias("year")), "compared")
    folds = {str(y): (F.col("year") < y, F.col("year") == y) for y in (1996, 1997, 1998)}
    tested, settings = compare.linear_sets(rows, "l_extendedprice", {"base": ["l_quantity"], "more": ["l_quantity", "p_size"]}, folds, (0.0, 0.5))
    report = compare.paired(tested, "l_extendedprice", settings, "base / 0")
    return report.select("fold", "setting", "n", *[r(c, 3).alias(c) for c in ("mae", "rmse", "bias", "change", "change_se")])
