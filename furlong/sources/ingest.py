"""Ingest by day that can be broken off and resumed.

A batch writes its rows and its errors first, under its own name, and commits last, by adding one file to the state: a row for each of its days, with how many rows and errors it
holds. Readers take, for each day, what the newest batch committed, so what a broken batch has left is never read, and days done again replace what they held.
Days are settled up to the watermark, the newest day of the source less `late_days`; later days are readable, but open: the next run does them again.
Settled days without source rows are committed as empty. Batches are calendar years, so a run that breaks off loses one year's work at most.

Null days and days outside the range are left out. A row whose key holds a null is kept like any other; of several rows of one day with the same key, the one whose
columns are least in order stays. One run at a time may write."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .results import first_existing
from .staging import written

STATE = "day date, batch string, number bigint, n_rows bigint, n_errors bigint, settled boolean"


def state(spark: SparkSession, root: str) -> DataFrame:
    """What was committed for each day by the newest batch that holds it."""
    if first_existing(spark, [f"{root}/state"]) is None:
        return spark.createDataFrame([], STATE)
    rows = spark.read.schema(STATE).parquet(f"{root}/state")
    return rows.groupBy("day").agg(F.max_by(F.struct("batch", "number", "n_rows", "n_errors", "settled"), "number").alias("s")).select("day", "s.*")


def open_days(spark: SparkSession, root: str, start: date, end: date, with_errors: bool = False) -> DataFrame:
    """The days of a range that are not settled; with_errors: and those that hold errors."""
    span = F.explode(F.sequence(F.lit(start), F.lit(end))) if start <= end else F.explode(F.array().cast("array<date>"))
    done = state(spark, root).where("settled" + " and n_errors = 0" * with_errors)
    return spark.range(1).select(span.alias("day")).join(done, "day", "left_anti")


def gaps(spark: SparkSession, root: str, start: date, end: date, with_errors: bool = False) -> DataFrame:
    """The same as runs of days: first, last, n_days. A range has as many rows as days, so one window holds them."""
    each = open_days(spark, root, start, end, with_errors)
    each = each.withColumn("run", F.date_sub("day", F.row_number().over(Window.orderBy("day"))))
    return each.groupBy("run").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count(F.lit(1)).alias("n_days")).drop("run")


def stored(spark: SparkSession, root: str, what: str = "rows") -> DataFrame:
    """The committed rows, or what="errors"."""
    return spark.read.parquet(f"{root}/{what}").join(state(spark, root).select("day", "batch"), ["day", "batch"], "left_semi")


def ingest(source: DataFrame, root: str, start: date, end: date, key: Sequence[str], parse: Callable[[DataFrame], DataFrame], late_days: int = 0, with_errors: bool = False) -> int:
    """Take the open days of a range from a source with a column day; returns how many days were committed.

    parse adds a column error to the rows it is given and may change others but day; rows whose error is not null go to the errors, one by one."""
    spark = source.sparkSession
    last = source.where(F.col("day").between(F.lit(start), F.lit(end))).agg(F.max("day").alias("day")).first()["day"]
    watermark = None if last is None else last - timedelta(days=late_days)
    days = sorted(r["day"] for r in open_days(spark, root, start, end, with_errors).where(F.col("day") <= F.lit(last)).collect()) if last else []  # days of a calendar
    for year in sorted({d.year for d in days}):
        own = [d for d in days if d.year == year]
        wanted = F.broadcast(spark.createDataFrame([(d,) for d in own], "day date"))
        rows = source.where(F.col("day").between(F.lit(own[0]), F.lit(own[-1]))).join(wanted, "day", "left_semi")
        first = Window.partitionBy("day", *key).orderBy(*[F.col(c).cast("string") for c in source.columns])
        once = rows.withColumn("_at", F.row_number().over(first)).where("_at = 1").drop("_at")
        batch = uuid.uuid4().hex
        parsed = written(parse(once).withColumn("batch", F.lit(batch)), "parsed")
        for what, held in (("rows", parsed.where("error is null").drop("error")), ("errors", parsed.where("error is not null"))):
            held.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(f"{root}/{what}")
        counts = parsed.groupBy("day").agg(F.count_if(F.col("error").isNull()).alias("n_rows"), F.count("error").alias("n_errors"))
        commit(root, batch, wanted.join(counts, "day", "left"), watermark)
    return len(days)


def commit(root: str, batch: str, days: DataFrame, watermark: date) -> None:
    """Add a batch's days (day, n_rows, n_errors) to the state, in one file."""
    number = state(days.sparkSession, root).agg(F.coalesce(F.max("number"), F.lit(0)).alias("n")).first()["n"] + 1
    rows = days.select("day", F.lit(batch).alias("batch"), F.lit(number).cast("bigint").alias("number"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_rows", "n_errors")], (F.col("day") <= F.lit(watermark)).alias("settled"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/state")
