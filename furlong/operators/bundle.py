"""Families of window columns over many partitionings of one table, without carrying wide rows through every shuffle.

bundled() groups the families by partitioning; keys that hold those of another family share its partitioning. Each partitioning shuffles only a row id, its keys and
the columns that its windows read, and its results come back by the row id, so the wide rows are shuffled once, by id, however many partitionings there are.
segmented() takes families of sums by keys of few values: rows go by segments of the order, not by key, so no task holds a key. ranked() ranks any number of columns within
groups in one shuffle: values go long next to their group, are ranked by (group, column), and come back wide in the same partition."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import BySegment


@dataclass(frozen=True)
class Family:
    """Named window columns that partition by keys (or by keys and more), and the columns they read beside the keys."""

    keys: tuple[str, ...]
    columns: Mapping[str, Column]
    needs: tuple[str, ...]


def grouped(families: Sequence[Family]) -> list[Family]:
    """One family for each set of keys. A name that two families share is an error."""
    out: dict[frozenset[str], Family] = {}
    names: set[str] = set()
    for f in families:
        if twice := names & set(f.columns):
            raise ValueError(f"named twice: {sorted(twice)}")
        names |= set(f.columns)
        held = out.get(frozenset(f.keys))
        out[frozenset(f.keys)] = f if held is None else Family(held.keys, {**held.columns, **f.columns}, tuple(dict.fromkeys(held.needs + f.needs)))
    return list(out.values())


def chosen(families: Sequence[Family], names: Collection[str]) -> list[Family]:
    """The families with those of their columns that are named, and what these read; families without any are left out."""
    cut = [Family(f.keys, {name: c for name, c in f.columns.items() if name in names}, f.needs) for f in families]
    return [Family(f.keys, f.columns, tuple(c for c in f.needs if c in read([f], f.needs))) for f in cut if f.columns]


def read(families: Sequence[Family], among: Collection[str]) -> set[str]:
    """Those of the names that keys or columns of the families mention."""
    words = {w for f in families for c in f.columns.values() for w in re.findall(r"\w+", str(c))} | {k for f in families for k in f.keys}
    return words & set(among)


def known(keys: Sequence[str]) -> Column:
    """All keys are there."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def shared(families: Sequence[Family]) -> list[list[Family]]:
    """Families that one partitioning serves: the first one's keys are among those of all others."""
    out: list[list[Family]] = []
    for f in sorted(grouped(families), key=lambda f: len(f.keys)):
        host = next((group for group in out if set(group[0].keys) <= set(f.keys)), None)
        out.append([f]) if host is None else host.append(f)
    return out


def bundled(rows: DataFrame, row_id: str, families: Sequence[Family], onto: DataFrame | None = None) -> DataFrame:
    """rows (or onto, which has the same row ids) with the columns of all families. row_id must be unique and the same at each reading, so rows should come from a written table.

    Rows with a null key take no part in a partitioning and get nulls for its columns: they never meet in one task."""
    out = rows if onto is None else onto
    for group in shared(families):
        host = group[0]
        needs = [c for c in dict.fromkeys(c for f in group for c in f.keys + f.needs) if c != row_id]
        narrow = rows.where(known(host.keys)).select(row_id, *needs).repartition(*host.keys)
        made = [(c if f is host else F.when(known(f.keys), c)).alias(name) for f in group for name, c in f.columns.items()]
        out = out.join(narrow.select(row_id, *made), row_id, "left")
    return out


def segmented(rows: DataFrame, families: Sequence[tuple[Family, BySegment]]) -> DataFrame:
    """rows with the columns of families whose sums are taken by segment: sums of a key's earlier segments are broadcast and carried into the next.

    rows must come from a written table that has the segments' row id and is cut by it. A table of sums has a row for each segment (or day) and key, so keys must have few values."""
    segment = BySegment.segment()
    out = rows.withColumn("_segment", segment).repartitionByRange("_segment")  # by range, as few numbers of segments would meet in a task by hash
    used = {w for f, _ in families for c in f.columns.values() for w in re.findall(r"[\w.]+", str(c))}
    made: list[Column] = []
    held: set[str] = set()
    for f, sums in families:
        for name, table in sums.tables(rows.withColumn("_segment", segment), used).items():
            if name not in held:  # two families may share a table
                out = out.join(F.broadcast(table), [c for c in table.columns if c != name], "left")
                held.add(name)
        made += [F.when(known(f.keys), c).alias(name) for name, c in f.columns.items()]
    return out.select(*rows.columns, *made)


def ranked(rows: DataFrame, row_id: str, by: str, columns: Sequence[str], suffix: str = "_rank") -> DataFrame:
    """(row_id, a rank for each column): competition ranks from the highest value within `by`, nulls last. Rows without a group are left out."""
    long = rows.where(F.col(by).isNotNull()).select(row_id, by, *columns).repartition(by).select(
        row_id, by, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])).alias("_c")
    )
    rank = F.rank().over(Window.partitionBy(by, "_c.i").orderBy(F.col("_c.v").desc_nulls_last())).cast("long")
    placed = long.select(row_id, by, F.col("_c.i").alias("_i"), rank.alias("_r"))
    wide = placed.groupBy(by, row_id).agg(*[F.max(F.when(F.col("_i") == i, F.col("_r"))).alias(c + suffix) for i, c in enumerate(columns)])
    return wide.drop(by)
