"""Error reports and checks by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: Pearson's correlation, null where one side has no spread."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def errors(predicted: Column, actual: Column) -> list[Column]:
    """Aggregates: n, mae, rmse, bias, corr, within_5 and within_10 of predicted against actual."""
    e = predicted - actual
    return [
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), correlation(predicted, actual).alias("corr"),
        F.avg((F.abs(e) <= 5).cast("double")).alias("within_5"), F.avg((F.abs(e) <= 10).cast("double")).alias("within_10"),
    ]


def dominance(df: DataFrame, by: Sequence[str], label: str, above: float) -> DataFrame:
    """Per key: the most frequent label (the first of equals), its share, and whether the share is above a limit."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("minus"), F.col(label).alias("label"))).alias("_best"), F.sum("_n").alias("_total"))
    share = -F.col("_best.minus") / F.col("_total")
    return best.select(*by, F.col("_best.label").alias("label"), share.alias("share"), (share > above).alias("is_dominant"))


def not_rising(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Rows whose y does not exceed that of the next lower x of their key."""
    before = F.lag(y).over(Window.partitionBy(*by).orderBy(x))
    return df.withColumn("previous", before).where(F.col(y) <= F.col("previous"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Shares of the column values within each row value; all values are named, so no pass is needed to find them."""
    total = F.count(F.lit(1))
    return df.groupBy(rows).agg(*[(F.sum((F.col(columns) == v).cast("long")) / total).alias(f"share_{v}") for v in values])
