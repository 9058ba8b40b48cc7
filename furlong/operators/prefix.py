"""Running sums over keys of any size: no window holds a key.

Rows are range-partitioned by key and order, so a large key is spread over many segments of about equal size. Each segment is summed;
the sums of a key's earlier segments are carried into the next; within a segment an ordinary window adds the rest. The segmented rows are
written once, as the borders of a range partitioning are drawn from a sample and must not move between the two steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Mapping[str, Column], inclusive: bool = False, segments: int | None = None) -> DataFrame:
    """df with a column for each sum: that of the expression over a key's earlier rows (inclusive: and the row itself), nulls counting as nothing.

    order must be unique within a key, or what counts as earlier is undefined; nulls in it come first. Null keys are a group of their own. segments: the number of range
    partitions, by default that of the session's shuffle partitions. The output has a row for each row of df."""
    n = segments or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    terms = {f"_t_{name}": value for name, value in sums.items()}
    ranged = written(df.withColumns(terms).repartitionByRange(n, *by, *order).withColumn("_segment", F.spark_partition_id()), "segments")
    key = F.struct(*by, "_segment").alias("_key")
    totals = ranged.groupBy(*by, "_segment").agg(*[F.sum(t).alias(t) for t in terms])
    earlier = Window.partitionBy(*by).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)  # a row for each segment of a key
    carried = totals.select(key, *[F.sum(t).over(earlier).alias(f"_c{t}") for t in terms])
    within = Window.partitionBy(*by, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = ranged.withColumns({f"_l{t}": F.sum(t).over(within) for t in terms}).withColumn("_key", key)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = local.join(carried, "_key")
    return out.select(*df.columns, *[(zero(f"_c_t_{name}") + zero(f"_l_t_{name}")).alias(name) for name in sums])


def weighted_medians(df: DataFrame, by: Sequence[str], x: str, weight: str, tie: str, name: str = "weighted_median", segments: int | None = None) -> DataFrame:
    """Per key the first value, in ascending order, at which the running weight reaches half of the total (but for rounding), for keys of any size."""
    known = df.where(F.col(x).isNotNull() & F.col(weight).isNotNull()).select(*by, x, weight, tie)
    run = running(known, by, [x, tie], {"_run": F.col(weight)}, inclusive=True, segments=segments).withColumn("_key", F.struct(*by))
    totals = known.groupBy(F.struct(*by).alias("_key")).agg(F.sum(weight).alias("_total"))
    return run.join(totals, "_key").where(F.col("_run") >= F.col("_total") / 2 - 1e-9).groupBy(*by).agg(F.min(x).alias(name))
