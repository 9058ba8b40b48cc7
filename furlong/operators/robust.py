"""Robust estimates by group: weighted, trimmed and winsorized statistics, outliers, split tests.

All are aggregates or windows over the keys; a group's sorted values are gathered only where an estimate needs them by rank, after
which a row per group is left."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written
from .ranks import medians


def weighted_median(df: DataFrame, by: Sequence[str], x: str, weight: str, tie: str, name: str = "weighted_median") -> DataFrame:
    """Per key the first value, in ascending order, at which the running weight reaches half of the total (but for rounding)."""
    w = Window.partitionBy(*by).orderBy(x, tie)
    run = df.where(F.col(x).isNotNull() & F.col(weight).isNotNull()).select(
        *by, F.col(x).alias("_x"), F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_run"), F.sum(weight).over(Window.partitionBy(*by)).alias("_total")
    )
    return run.where(F.col("_run") >= F.col("_total") / 2 - 1e-9).groupBy(*by).agg(F.min("_x").alias(name))


def trimmed(df: DataFrame, by: Sequence[str], x: str, share: float, tie: str, least: int = 3) -> DataFrame:
    """The rows left when a share of each tail is cut by rank, within keys; keys that would keep fewer than `least` rows stay whole."""
    known = df.where(F.col(x).isNotNull())
    n, i = F.count(F.lit(1)).over(Window.partitionBy(*by)), F.row_number().over(Window.partitionBy(*by).orderBy(x, tie))
    ranked = known.withColumn("_n", n).withColumn("_i", i).withColumn("_k", F.floor(F.col("_n") * share))
    whole = (F.col("_k") < 1) | (F.col("_n") - 2 * F.col("_k") < least)
    return ranked.where(whole | ((F.col("_i") > F.col("_k")) & (F.col("_i") <= F.col("_n") - F.col("_k")))).drop("_n", "_i", "_k")


def trimmed_median(df: DataFrame, by: Sequence[str], x: str, share: float, tie: str, name: str = "trimmed_median") -> DataFrame:
    return trimmed(df, by, x, share, tie).groupBy(*by).agg(F.median(x).alias(name))


def winsorized(df: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """Per key: n, and mean, standard error and median after the lowest value is lifted to the second and the highest lowered to the last but one.

    Keys of one or two values are left as they are. A key's values are gathered, which suits cards and the like; winsorized_large() takes keys of any size."""
    extremes = F.sort_array(F.collect_list(x))
    gathered = df.where(F.col(x).isNotNull()).groupBy(*by).agg(extremes.alias("_a"))
    n = F.size("_a")
    low, high = F.when(n > 2, F.element_at("_a", 2)).otherwise(F.element_at("_a", 1)), F.when(n > 2, F.element_at("_a", -2)).otherwise(F.element_at("_a", -1))
    clamped = gathered.withColumn("_c", F.transform("_a", lambda v: F.least(F.greatest(v, low), high)))
    mean = F.aggregate("_c", F.lit(0.0), lambda s, v: s + v) / n
    with_mean = clamped.withColumn("_m", mean)
    square = F.aggregate(F.transform("_c", lambda v: (v - F.col("_m")) * (v - F.col("_m"))), F.lit(0.0), lambda s, v: s + v)
    middle = (F.element_at("_c", F.floor((n + 1) / 2).cast("int")) + F.element_at("_c", F.floor((n + 2) / 2).cast("int"))) / 2
    return with_mean.select(*by, n.cast("long").alias("n"), F.col("_m").alias("winsor_mean"), F.when(n > 1, F.sqrt(square / (n - 1)) / F.sqrt(n)).alias("winsor_se"), middle.alias("winsor_median"))


def winsorized_large(df: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """What winsorized() gives, for keys of any size: no key's values are gathered.

    One pass takes each key's moments and ends, a second the values next to the ends; the mean and error follow in closed form, and the median
    is that of the values themselves, as the ends that move stay on their sides. The narrow input is written once."""
    values = written(df.where(F.col(x).isNotNull()).select(F.struct(*by).alias("_key"), F.col(x).cast("double").alias("_x")), "winsorized")
    ends = values.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"), F.avg("_x").alias("_mean"), F.coalesce(F.var_samp("_x"), F.lit(0.0)).alias("_var"))
    at_low, at_high = F.col("_x") == F.col("_low"), F.col("_x") == F.col("_high")
    inner = values.join(ends.select("_key", "_low", "_high"), "_key").groupBy("_key").agg(
        F.count_if(at_low).alias("_lows"), F.min(F.when(~at_low, F.col("_x"))).alias("_above"), F.count_if(at_high).alias("_highs"), F.max(F.when(~at_high, F.col("_x"))).alias("_below")
    )
    n, mean = F.col("n"), F.col("_mean")
    low = F.when((n > 2) & (F.col("_lows") == 1), F.col("_above")).otherwise(F.col("_low"))
    high = F.when((n > 2) & (F.col("_highs") == 1), F.col("_below")).otherwise(F.col("_high"))
    moved = mean + ((low - F.col("_low")) + (high - F.col("_high"))) / n
    off = lambda v: (v - mean) * (v - mean)
    square = F.greatest(F.col("_var") * (n - 1) - off(F.col("_low")) - off(F.col("_high")) + off(low) + off(high) - n * off(moved), F.lit(0.0))
    middle = medians(values, ["_key"], "_x").select("_key", "median")
    out = ends.join(inner, "_key").join(middle, "_key")
    return out.select(*[F.col("_key").getField(c).alias(c) for c in by], n, moved.alias("winsor_mean"), F.when(n > 1, F.sqrt(square / (n - 1)) / F.sqrt(n)).alias("winsor_se"), F.col("median").alias("winsor_median"))


def without_outliers(df: DataFrame, by: Sequence[str], x: str, most: float = 3.0) -> DataFrame:
    """Rows whose distance from their key's median is at most `most` standard deviations; keys without spread stay whole."""
    w = Window.partitionBy(*by)
    centre, spread = F.median(x).over(w), F.stddev_samp(x).over(w)
    z = F.try_divide(F.abs(F.col(x) - centre), F.nullif(spread, F.lit(0.0)))
    return df.withColumn("_z", z).where(F.col("_z").isNull() | (F.col("_z") <= most)).drop("_z")


def split_test(df: DataFrame, by: Sequence[str], x: str, order: Sequence[str], least: int = 6, t: float = 2.5, shift: float = 0.1) -> DataFrame:
    """Per key: both halves' sizes, means and Welch's t, and whether they differ: `least` rows, |t| above t, means apart by more than shift."""
    n, i = F.count(F.lit(1)).over(Window.partitionBy(*by)), F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    halved = df.withColumn("_n", n).withColumn("_first", i <= F.floor(n / 2))
    half = lambda f, first: f(F.when(F.col("_first") == first, F.col(x)))
    out = halved.groupBy(*by).agg(
        F.max("_n").alias("n"), half(F.avg, True).alias("mean_1"), half(F.avg, False).alias("mean_2"),
        half(F.var_samp, True).alias("_v1"), half(F.var_samp, False).alias("_v2"), half(F.count, True).alias("_n1"), half(F.count, False).alias("_n2"),
    )
    error = F.nullif(F.sqrt(F.col("_v1") / F.col("_n1") + F.col("_v2") / F.col("_n2")), F.lit(0.0))
    welch = F.abs(F.col("mean_1") - F.col("mean_2")) / error
    is_split = F.coalesce((F.col("n") >= least) & (welch > t) & (F.abs(F.col("mean_1") - F.col("mean_2")) > shift), F.lit(False))
    return out.select(*by, "n", "mean_1", "mean_2", welch.alias("t"), is_split.alias("is_split"))


def soft_cap(x: Column, low: Column, high: Column, floor: float, ceiling: float) -> Column:
    """Clamp to [min(low, floor), max(high, ceiling)]; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.greatest(high, F.lit(ceiling))), F.least(low, F.lit(floor))))
