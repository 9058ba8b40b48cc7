"""Shrinkage of group estimates toward priors, and what is layered on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def toward(mean: Column, n: Column, prior: Column | float, k: float) -> Column:
    """(n * mean + k * prior) / (n + k); the prior alone where there is no mean."""
    prior = prior if isinstance(prior, Column) else F.lit(prior)
    return F.coalesce((n * mean + k * prior) / (n + k), prior)


def toward_zero(x: Column, k: float) -> Column:
    """An aggregate: the sum of x over its count plus k."""
    return F.sum(x) / (F.count(x) + k)


def boosted(x: Column, threshold: float, beta: float) -> Column:
    """x, with a quadratic extra beyond a threshold on either side."""
    return F.when(F.abs(x) > threshold, x + F.signum(x) * beta * (F.abs(x) - threshold) ** 2).otherwise(x)


def seeded(observed: DataFrame, seeds: DataFrame, key: str, value: str, n: str, least: int) -> DataFrame:
    """Every key of the seeds with its observed value where enough rows support it, else its seed."""
    enough = observed.where(F.col(n) >= least).select(key, F.col(value).alias("_observed"))
    return seeds.join(enough, key, "left").select(key, F.coalesce("_observed", value).alias(value), F.col("_observed").isNotNull().alias("is_observed"))


def residual_layers(df: DataFrame, target: str, layers: Sequence[tuple[str | Sequence[str], float, float | None]], name: str = "fitted") -> DataFrame:
    """Layer upon layer of shrunk group means of what the layers before left over.

    layers: (key columns, k, clip): each adds sum(residual) / (n + k) of its group, clipped to +-clip. Every layer is one aggregate and one join."""
    out = df.withColumn("_rest", F.col(target).cast("double")).withColumn(name, F.lit(0.0))
    for i, (keys, k, clip) in enumerate(layers):
        keys = [keys] if isinstance(keys, str) else list(keys)
        offset = toward_zero(F.col("_rest"), k)
        if clip is not None:
            offset = F.least(F.greatest(offset, F.lit(-clip)), F.lit(clip))
        means = out.groupBy(*keys).agg(offset.alias(f"_offset_{i}"))
        step = F.coalesce(f"_offset_{i}", F.lit(0.0))
        out = out.join(means, keys, "left").withColumn(name, F.col(name) + step).withColumn("_rest", F.col("_rest") - step).drop(f"_offset_{i}")
    return out.drop("_rest")


def target_encoding(df: DataFrame, keys: Sequence[str], target: Column, train: Column, name: str) -> DataFrame:
    """Mean target of a key's training rows less the mean of all training rows; 0 for keys that training lacks."""
    base = df.agg(F.avg(F.when(train, target)).alias("_base"))
    means = df.where(train).groupBy(*keys).agg(F.avg(target).alias("_mean"))
    return df.join(means, list(keys), "left").crossJoin(F.broadcast(base)).withColumn(name, F.coalesce(F.col("_mean") - F.col("_base"), F.lit(0.0))).drop("_mean", "_base")
