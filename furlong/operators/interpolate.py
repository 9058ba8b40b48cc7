"""Piecewise-linear lookups between known points, and neighbours in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def curves(points: DataFrame, by: Sequence[str], x: str, y: str, name: str = "curve") -> DataFrame:
    """One row per key with its points as a sorted array of (x, y); a curve holds the distinct distances of a key, not its rows."""
    return points.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).alias(name))


def _beside(curve: Column, x: Column) -> tuple[Column, Column]:
    """The points next to x."""
    return F.try_element_at(F.filter(curve, lambda p: p["x"] <= x), F.lit(-1)), F.try_element_at(F.filter(curve, lambda p: p["x"] >= x), F.lit(1))


def at(curve: Column, x: Column, guard: float | None = None) -> Column:
    """The curve's value at x, clamped to its ends. With a guard, null further outside than that share of the end."""
    return _between(curve, x, *_beside(curve, x), guard)


def with_value(rows: DataFrame, curve: str, x: str, name: str, guard: float | None = None) -> DataFrame:
    """rows with at() as a column. The points next to x are columns on the way, so a row's curve is searched once for each, not at every mention."""
    low, high = _beside(F.col(curve), F.col(x).cast("double"))
    beside = rows.withColumns({"_low": low, "_high": high})
    return beside.withColumn(name, _between(F.col(curve), F.col(x).cast("double"), F.col("_low"), F.col("_high"), guard)).drop("_low", "_high")


def _between(curve: Column, x: Column, low: Column, high: Column, guard: float | None) -> Column:
    first, last = F.try_element_at(curve, F.lit(1)), F.try_element_at(curve, F.lit(-1))
    between = low["y"] + F.coalesce(F.try_divide(x - low["x"], F.nullif(high["x"] - low["x"], F.lit(0.0))), F.lit(0.0)) * (high["y"] - low["y"])
    value = F.when(low.isNull(), first["y"]).when(high.isNull(), last["y"]).otherwise(between)
    if guard is not None:
        value = F.when((x >= first["x"] * (1 - guard)) & (x <= last["x"] * (1 + guard)), value)
    return F.when(x.isNotNull(), value)


def join_at(rows: DataFrame, known: DataFrame, by: Sequence[str], x: str, name: str, guard: float | None = None) -> DataFrame:
    """rows with the value of their key's curve at column x. known: (by..., curve); Spark picks the join by its size."""
    return with_value(rows.join(known, list(by), "left"), "curve", x, name, guard).drop("curve")


def joined_by_value(rows: DataFrame, known: DataFrame, by: Sequence[str], x: str, name: str, guard: float | None = None, asked: DataFrame | None = None) -> DataFrame:
    """What join_at() gives, for columns x of few distinct values: curves are looked up once for each key and x, however many rows there are, and what is found is joined back by both.

    asked: rows with at least the same keys and x, if they are read more cheaply than rows."""
    points = (rows if asked is None else asked).select(*by, x).distinct().join(known, list(by))
    found = points.withColumn(name, at(F.col("curve"), F.col(x).cast("double"), guard)).drop("curve")
    return rows.join(found, [*by, x], "left")


def day_neighbours(df: DataFrame, by: Sequence[str], day: str, value: str, name: str = "neighbour_mean") -> DataFrame:
    """(by..., day, mean of the values one day before and after), for every key and day that has such a neighbour."""
    shifted = df.select(*by, F.explode(F.array(F.date_add(day, 1), F.date_add(day, -1))).alias(day), F.col(value).alias("_v"))
    return shifted.groupBy(*by, day).agg(F.avg("_v").alias(name))
