"""Results as they arrive: a meeting is rated when all its races have a result, and again when one changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.results import replace_partition
from ..sources.staging import written


def complete(runners: DataFrame, scheduled: DataFrame) -> DataFrame:
    """The (meeting_id) of which every scheduled race has a winner. scheduled: (meeting_id, race_id)."""
    done = runners.where("position = 1").select("race_id").distinct().withColumn("done", F.lit(1))
    counts = scheduled.join(done, "race_id", "left").groupBy("meeting_id").agg(F.count(F.lit(1)).alias("n"), F.count("done").alias("n_done"))
    return counts.where("n = n_done").select("meeting_id")


def follow(spark: SparkSession, source: str, schema: str, store: str, output: str, checkpoint: str, scheduled: DataFrame, rate: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Read new JSON result files until none are left, keep all rows by meeting in store, and write the rated meetings that are complete.

    Both tables are partitioned by meeting and only the touched meetings are replaced, so a batch that runs twice changes nothing. Of a
    race and horse that arrive again, the rows of the later file count."""

    def batch(new: DataFrame, _: int) -> None:
        new = new.withColumn("arrived", F.col("_file_time")).drop("_file_time")
        touched = new.select("meeting_id").distinct()
        try:
            old = spark.read.schema(new.schema).parquet(store).join(touched, "meeting_id", "left_semi")
            rows = old.unionByName(new)
        except Exception as e:  # the store has no first batch yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = new
        latest = rows.groupBy("race_id", "horse").agg(F.max("arrived").alias("arrived"))
        kept = written(rows.join(latest, ["race_id", "horse", "arrived"], "left_semi").dropDuplicates(["race_id", "horse"]).select(*new.columns), "arrived")
        replace_partition(kept, store, "meeting_id")
        ready = kept.join(complete(kept, scheduled.join(touched, "meeting_id", "left_semi")), "meeting_id", "left_semi")
        replace_partition(rate(ready), output, "meeting_id")

    stream = spark.readStream.schema(schema).json(source).withColumn("_file_time", F.col("_metadata.file_modification_time"))
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rolling_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums of an event stream by type in event-time windows; rows later than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
