"""Permutation importance: how much a prediction's error grows when one column's values change places among the rows.

All columns are shuffled in one pass: every row is repeated once for each column and once as it is, and in the copies of a column its
values move on by one row around a circle. The circles are ordered by a digest of key and column within buckets by a digest of the key, so the shuffling is the same in every
run, differs by column, moves every value (but in circles of one row), and needs no window larger than a bucket, of which there are 16 to the power of `digits`
(by default so many that a bucket has 1,000 rows or more, as circles of few rows would hide importance).

Keys must be unique, or the partner of equal keys is undefined; a null key counts as an empty one. Null values move like others. Rows whose target or prediction is null
do not count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AS_IS = ""


def shuffled(rows: DataFrame, key: str, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """rows once as they are (_shuffled empty) and once for each column with its values shuffled (_shuffled its name)."""
    if digits is None:
        digits = int(math.log(max(rows.count() / 1000, 1), 16))
    said = F.coalesce(F.col(key).cast("string"), F.lit(""))
    each = rows.withColumn("_shuffled", F.explode(F.array(*[F.lit(c) for c in (AS_IS, *columns)])))
    circle = Window.partitionBy("_shuffled", "_bucket").orderBy("_place")
    placed = each.withColumn("_bucket", F.substring(F.md5(said), 1, digits)).withColumn("_place", F.md5(F.concat(said, F.lit("-"), F.col("_shuffled"))))
    following = lambda c: F.when(F.lead(F.lit(True)).over(circle).isNull(), F.first(c).over(circle)).otherwise(F.lead(c).over(circle))
    moved = {c: F.when(F.col("_shuffled") == c, following(c)).otherwise(F.col(c)) for c in columns}
    return placed.select(*[moved[c].alias(c) if c in moved else c for c in rows.columns], "_shuffled")


def importance(rows: DataFrame, key: str, columns: Sequence[str], target: str, predict: Callable[[DataFrame], DataFrame], predicted: str = "predicted", loss: Callable[[Column, Column], Column] | None = None, digits: int | None = None) -> DataFrame:
    """column, error (with it shuffled), increase (over the error of the rows as they are), rank (from the largest increase to twelve digits, then name).

    predict adds the predicted column and keeps all others; loss takes target and prediction, by default their absolute difference."""
    loss = loss or (lambda y, p: F.abs(y - p))
    scored = predict(shuffled(rows, key, columns, digits)).groupBy("_shuffled").agg(F.avg(loss(F.col(target), F.col(predicted))).alias("error"))
    base = scored.where(F.col("_shuffled") == AS_IS).select(F.col("error").alias("_base"))  # one row
    out = scored.where(F.col("_shuffled") != AS_IS).crossJoin(F.broadcast(base)).select(F.col("_shuffled").alias("column"), "error", (F.col("error") - F.col("_base")).alias("increase"))
    return out.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("increase", 12)), "column")))  # a row for each column
