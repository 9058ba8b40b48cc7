"""The register of queries over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; sql is DuckDB SQL with the same columns and rows, rnd() in it being r()."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql.replace("rnd(", "round(1e-6 + ")
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded, for comparison with another engine; moved by a millionth first, as exact ties may fall on either side."""
    return F.round(F.lit(1e-6) + (F.col(c) if isinstance(c, str) else c), digits)
