"""Exact order statistics of groups of any size, without sorting or gathering a group.

A range histogram over all keys at once (equal widths between a key's least and greatest value) tells which bin holds each wanted
rank; only those bins are read again, and the ranks are found among their distinct values. A bin that is one value needs no second look,
however many rows it has; one that holds more rows than a task should take gets a histogram of its own, and so on. So a key with most of
the rows is counted by all tasks, and what comes back is one row for each wanted rank. Every value stays exact: bins only have to be in order.

Nulls have no rank; NaN stands above all other numbers, as in Spark. Null keys are a group of their own. Columns must be numeric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written

#: Bins of a histogram, and the rows of a bin that one task may sort.
BINS, MOST = 1024, 1_000_000


def _number(depth: int) -> Column:
    """_x on the scale of a depth, which keeps its order: as it is on even ones; its sign times its logarithm, moved beyond zero, on odd ones. So no range of numbers takes many looks."""
    number = F.col("_x").cast("double")
    return F.when(number == 0, 0.0).otherwise(F.signum(number) * (F.log(F.abs(number)) + 800)) if depth % 2 else number


def _ends(values: DataFrame, depth: int = 0) -> DataFrame:
    """Per key: n, and the least and greatest finite number."""
    number = _number(depth)
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return values.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(finite).alias("_least"), F.max(finite).alias("_greatest"))


def _bin(bins: int, depth: int) -> Column:
    """The bin of _x, in the order of values; what isn't finite has bins outside."""
    number = _number(depth)
    share = F.try_divide(number / 2 - F.col("_least") / 2, F.nullif(F.col("_greatest") / 2 - F.col("_least") / 2, F.lit(0.0)))
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1).cast("bigint"))
    return F.when(F.isnan(number), bins + 1).when(number == float("inf"), bins).when(number == float("-inf"), -1).otherwise(inside).cast("bigint")


def _found(values: DataFrame, ends: DataFrame, wanted: DataFrame, bins: int, most: int, depth: int = 0) -> DataFrame:
    """(_key, rank, value, below, equal) for each wanted (_key, rank): how many rows are less, and how many are equal. values: (_key, _x)."""
    binned = values.join(ends.select("_key", "_least", "_greatest"), "_key").select("_key", "_x", _bin(bins, depth).alias("_bin"))
    counts = binned.groupBy("_key", "_bin").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"))
    below = F.sum("n").over(Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")  # a row for each bin of a key
    hits = written(wanted.join(counts.withColumn("below", below), "_key").where("below < rank and rank <= below + n"), "ranks")
    single = F.col("low") == F.col("high")
    done = hits.where(single).select("_key", "rank", F.col("low").alias("value"), "below", F.col("n").alias("equal"))
    deepest = hits.where(~single).agg(F.max("n").alias("n")).first()["n"]
    if deepest is None:
        return done
    open_bins = hits.where(~single).select("_key", "_bin", "below").distinct()
    inside = binned.join(open_bins, ["_key", "_bin"])
    if deepest <= most:
        distinct = inside.groupBy("_key", "_bin", "below", "_x").agg(F.count(F.lit(1)).alias("equal"))
        before = F.col("below") + F.sum("equal").over(Window.partitionBy("_key", "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)) - F.col("equal")
        placed = distinct.select("_key", "_bin", "_x", "equal", before.alias("before"))
        rest = hits.where(~single).select("_key", "_bin", "rank").join(placed, ["_key", "_bin"]).where("before < rank and rank <= before + equal")
        return done.unionByName(rest.select("_key", "rank", F.col("_x").alias("value"), F.col("before").alias("below"), "equal"))
    nested = F.struct("_key", "_bin", "below").alias("_key")
    deeper = written(inside.select(nested, "_x"), "bins")
    within = hits.where(~single).select(nested, (F.col("rank") - F.col("below")).alias("rank"))
    rest = _found(deeper, written(_ends(deeper, depth + 1), "ends"), within, bins, most, depth + 1)
    back = rest.select("_key._key", (F.col("rank") + F.col("_key.below")).alias("rank"), "value", (F.col("below") + F.col("_key.below")).alias("below"), "equal")
    return done.unionByName(back)


def _values(df: DataFrame, by: Sequence[str], x: str | Column) -> tuple[DataFrame, DataFrame]:
    """(_key, _x) of the rows with a value, and their ends."""
    x = F.col(x) if isinstance(x, str) else x
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    values = df.select(key.alias("_key"), x.alias("_x")).where(F.col("_x").isNotNull())
    return values, written(_ends(values), "ends")


def _opened(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("_key").getField(c).alias(c) for c in by], *[c for c in df.columns if c != "_key"])


def percentiles(df: DataFrame, by: Sequence[str], x: str | Column, shares: Sequence[float], trim: float = 0.0, least: int = 3, name: str = "percentiles", bins: int = BINS, most: int = MOST) -> DataFrame:
    """Per key: n, and an array of the exact percentiles at those shares, interpolated between neighbouring ranks.

    trim: the share of rows left out at each end first, unless fewer than `least` would stay. Keys without values have no row."""
    values, ends = _values(df, by, x)
    cut = F.floor(F.col("_n") * trim)
    cut = F.when(F.col("_n") - 2 * cut < least, 0).otherwise(cut)
    kept = ends.select("_key", "_n", cut.cast("bigint").alias("_cut")).withColumn("_last", F.col("_n") - 2 * F.col("_cut") - 1)
    at = F.transform(F.array(*[F.lit(float(s)) for s in shares]), lambda s: F.col("_last") * s)
    ranks = F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(F.floor(p), F.ceil(p)))))
    wanted = kept.select("_key", F.explode(ranks).alias("rank"), "_cut").select("_key", (F.col("rank") + 1 + F.col("_cut")).alias("rank"))
    found = _found(values, ends, wanted, bins, most).groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.col("value").cast("double")))).alias("_at"))
    value = lambda k: F.element_at("_at", k + 1 + F.col("_cut"))
    between = lambda p: F.when(F.floor(p) == F.ceil(p), value(F.floor(p))).otherwise(value(F.floor(p)) * (F.ceil(p) - p) + value(F.ceil(p)) * (p - F.floor(p)))
    return _opened(kept.join(found, "_key").select("_key", F.col("_n").alias("n"), F.transform(at, between).alias(name)), by)


def medians(df: DataFrame, by: Sequence[str], x: str | Column, trim: float = 0.0, name: str = "median", bins: int = BINS, most: int = MOST) -> DataFrame:
    """Per key: n and the exact median."""
    return percentiles(df, by, x, [0.5], trim, name=name, bins=bins, most=most).withColumn(name, F.col(name)[0])


def ntiles(df: DataFrame, by: Sequence[str], x: str, tie: str, k: int, name: str, bins: int = BINS, most: int = MOST) -> DataFrame:
    """df with the number, from 1, of the equal-count bin of each row within its key, by x, then tie; null where x is null.

    Sizes differ by one at most, the larger bins first. What is joined back is k - 1 borders for each key."""
    values, ends = _values(df, by, x)
    each, larger = F.floor(F.col("_n") / k), F.col("_n") % k
    last = F.array(*[(each * b + F.least(F.lit(b).cast("bigint"), larger)) for b in range(1, k)])
    wanted = ends.select("_key", F.explode(F.array_distinct(F.filter(last, lambda v: v > 0))).alias("rank"))
    found = written(_found(values, ends, wanted, bins, most), "borders")
    split = found.where("rank < below + equal").select(F.struct("_key", "value").alias("_key"), (F.col("rank") - F.col("below")).alias("rank"))  # a border amid equal values
    borders = found.where("rank = below + equal").select("_key", F.struct(F.col("value").alias("x"), F.lit(None).cast(df.schema[tie].dataType).alias("tie")).alias("border"))
    if split.take(1):
        key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
        equal = df.select(F.struct(key.alias("_key"), F.col(x).alias("value")).alias("_key"), F.col(tie).alias("_x")).join(split.select("_key").distinct(), "_key", "left_semi")
        ties = _found(equal, written(_ends(equal), "ends"), split, bins, most)
        borders = borders.unionByName(ties.select("_key._key", F.struct(F.col("_key.value").alias("x"), F.col("value").alias("tie")).alias("border")))
    held = ends.select("_key").join(borders.groupBy("_key").agg(F.collect_list("border").alias("_borders")), "_key", "left")
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    beyond = lambda b: (F.col(x) > b["x"]) | ((F.col(x) == b["x"]) & F.coalesce(F.col(tie) > b["tie"], F.lit(False)))
    number = F.when(F.col(x).isNotNull(), F.coalesce(F.size(F.filter("_borders", beyond)), F.lit(0)) + 1).cast("int")
    return df.withColumn("_key", key).join(held, "_key", "left").withColumn(name, number).drop("_key", "_borders")
