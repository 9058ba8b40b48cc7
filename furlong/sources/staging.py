"""Tables written on the way: they cut the lineage of iterated jobs and survive lost executors."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one in local mode if it names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="furlong-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def dealt(df: DataFrame, *keys: str, rows: int = 500_000) -> DataFrame:
    """df shuffled by keys into as many tasks as take about `rows` rows each, at least the session's shuffle partitions.

    Windows and groupings by these keys then sort about as many rows in a task, however large the table is. The rows are counted first."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(df.count() / rows)), *keys)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back."""
    path = f"{shared_folder(df.sparkSession)}/furlong-{df.sparkSession.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
