"""Column expressions for cleaning: coercion, bands, clamps, mappings, fixed schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def number(c: Column | str) -> Column:
    """A double, or null for text that is no number and for NaN."""
    x = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(~F.isnan(x), x)


def clamp(x: Column, low: float, high: float) -> Column:
    """x within bounds; null stays null."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def half_even(x: Column, step: float = 1.0) -> Column:
    """x on a grid, ties to the even step."""
    return F.rint(x / step) * step


def mapped(x: Column, values: Mapping, default=None) -> Column:
    """values[x], else the default."""
    pairs = [F.lit(v) for kv in values.items() for v in kv]
    found = F.try_element_at(F.create_map(*pairs), x)
    return found if default is None else F.coalesce(found, F.lit(default))


def binned(x: Column, edges: Sequence[float], rest: str | None = None) -> Column:
    """Labels 'low-high' of right-closed bins; values outside (and the lowest edge) and nulls get `rest`."""
    out = F.when(x.isNull() | (x <= edges[0]), F.lit(rest))
    for low, high in zip(edges, edges[1:], strict=False):
        out = out.when(x <= high, F.lit(f"{low:g}-{high:g}"))
    return out.otherwise(F.lit(rest))


def any_date(c: Column, patterns: Sequence[str] = ("yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "yyyyMMdd")) -> Column:
    """The date of a text by the first pattern that fits, ISO first."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(p))) for p in patterns])


def key(*parts: Column | str) -> Column:
    """A composite text key; null if a part is null."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[x for i, c in enumerate(columns) for x in ((F.lit("_"), c.cast("string")) if i else (c.cast("string"),))])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """df with exactly the columns of a schema: missing ones null, others cast where they can be."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return [c for c in after.columns if c not in set(before.columns)]
