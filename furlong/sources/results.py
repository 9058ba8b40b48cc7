"""Yearly result files and written artifacts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def yearly_csv(spark: SparkSession, pattern: str, schema: StructType | str) -> DataFrame:
    """All files of a glob such as .../results_*.csv, with the year of each file's name as source_year."""
    rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(pattern)
    return rows.withColumn("source_year", F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4})", 1).try_cast("int"))


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of some paths that the session's file systems hold."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            return path
    return None


def write_csv(df: DataFrame, path: str, columns: list[str], decimals: int | None = 4) -> None:
    """Those of the columns that df has, doubles with fixed decimals, sorted within partitions by the first of them."""
    have = [c for c in columns if c in df.columns]
    kinds = dict(df.dtypes)
    shown = [F.format_string(f"%.{decimals}f", F.col(c)).alias(c) if decimals is not None and kinds[c] == "double" else F.col(c) for c in have]
    df.sortWithinPartitions(*have[:1]).select(*[F.when(F.col(c).isNotNull(), s).alias(c) if kinds[c] == "double" else s for c, s in zip(have, shown, strict=True)]).write.mode("overwrite").option("header", True).csv(path)


def replace_partition(df: DataFrame, path: str, by: str) -> None:
    """Write df by a partition column, replacing only the partitions that it has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def safe_name(column: str) -> str:
    return re.sub(r"\W+", "_", column.strip()).lower()
