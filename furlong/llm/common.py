"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of this process where it is unset (local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="furlong-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/furlong-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage is cut and a lost executor costs nothing.

    Spark deletes the shuffle files of the write when it ends, as the table takes their place."""
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=list(partition_by) or None)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete what stage() wrote, once nothing reads it any more."""
    spark, path = df.sparkSession, getattr(df, "staged_path", None)
    if path:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold a thousand rows instead of ten thousand, as whole texts are long; a session that has set another number keeps it."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def row_numbers() -> Iterator[int]:
    """Numbers that no other row of the job gets: the partition in the upper bits, a counter in the lower 36.

    The same partition read again gives the same numbers, as scans and staged tables return their rows in one order."""
    at = TaskContext.get().partitionId() << 36
    while True:
        yield at
        at += 1


def least_frequency(df: DataFrame, column: str, most: int) -> int | None:
    """The least value of an integer column from which on there are at most `most` rows, on a grid of 16 steps per power of two; None if even the top step holds more.

    What reaches the driver is one count per step, a thousand at most."""
    step = F.floor(F.log2(F.greatest(F.col(column), F.lit(1)).cast("double")) * 16).alias("step")
    total, least = 0, None
    for row in df.groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low")).orderBy(F.desc("step")).collect():
        total += row["n"]
        if total > most:
            break
        least = row["low"]
    return least


def tokenizer(path: str, cache: dict = {}):  # noqa: B006  one load for each worker process
    """The tokenizer of a .json file, loaded once per worker process; it runs single-threaded, as Spark owns the cores."""
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        cache[path] = loaded
    return cache[path]


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """The rows of buckets with two classes or more, dealt out to pairs (i, j) of their blocks; home: the block of the row."""
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / block).alias("n_blocks"))
    home = F.pmod(F.xxhash64("key"), F.col("n_blocks")).alias("home")
    dealt = rows.join(sizes, "bucket").select(*rows.columns, home, F.explode(F.sequence(F.lit(0), F.col("n_blocks").cast("int") - 1)).alias("other"))
    return dealt.withColumn("i", F.least("home", "other")).withColumn("j", F.greatest("home", "other")).drop("other")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (bucket, i, j) as one batch for each such group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        ids = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("bucket", "i", "j")], 1)
        if not len(ids):
            continue
        cuts = [0, *(np.flatnonzero((np.diff(ids, axis=0) != 0).any(1)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            this = tuple(ids[a])
            if this != last and held:
                yield joined(held)
                held = []
            last = this
            held.append(batch.slice(a, b - a))
    if held:
        yield joined(held)


def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
