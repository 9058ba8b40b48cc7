"""Corrections as stages: each is fitted to a small table and applied by a join, so a batch run, a live run and another region share them.

A chain moves one column, its figure, toward a target. A stage is fitted on what the stages before it made of the training rows, and its table is
written; whoever holds the tables (a batch run, or a live run that read them from an artifact version) applies the chain without the training rows.
Tables hold a row per key of their stage. Rows whose keys a table lacks, or hold null, keep their figure, as do rows without one; an empty table
changes nothing. Stages keep the rows and columns of their input; derived keys get names that begin with an underscore, and are dropped."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written
from . import calibrate, interpolate, ranks


@dataclass(frozen=True)
class Stage:
    """fit: training rows to a table; apply: rows and that table to rows with the figure moved; train: the rows to fit on, null counting as no."""

    name: str
    fit: Callable[[DataFrame], DataFrame]
    apply: Callable[[DataFrame, DataFrame], DataFrame]
    train: Column | None = None

    def on(self, train: Column) -> Stage:
        return replace(self, train=train)


def fitted(rows: DataFrame, stages: Sequence[Stage]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """rows after all stages, and the tables by name. rows is read a few times a stage, so pass a written table."""
    tables: dict[str, DataFrame] = {}
    for stage in stages:
        tables[stage.name] = written(stage.fit(rows if stage.train is None else rows.where(stage.train)), stage.name)
        rows = stage.apply(rows, tables[stage.name])
    return rows, tables


def applied(rows: DataFrame, stages: Sequence[Stage], tables: Mapping[str, DataFrame]) -> DataFrame:
    """rows after those stages whose tables are there; a version that lacks one leaves that stage out."""
    for stage in stages:
        if stage.name in tables:
            rows = stage.apply(rows, tables[stage.name])
    return rows


def _keyed(rows: DataFrame, keys: Mapping[str, Column | str]) -> tuple[DataFrame, list[str]]:
    named = {f"_key_{name}": F.col(c) if isinstance(c, str) else c for name, c in keys.items()}
    return rows.select("*", *[c.alias(name) for name, c in named.items()]), list(named)


def _moved(rows: DataFrame, table: DataFrame, keys: Mapping[str, Column | str], figure: str, value: Column) -> DataFrame:
    """rows joined to a table by key, the figure replaced where value is not null."""
    keyed, names = _keyed(rows, keys)
    joined = keyed.join(table.select(*names, F.struct(*[c for c in table.columns if c not in names]).alias("_fit")), names, "left")
    return joined.select(*[F.coalesce(value, F.col(figure)).alias(c) if c == figure else c for c in rows.columns])


def offsets(name: str, figure: str, target: str, keys: Mapping[str, Column | str], k: float, clip: float | None = None, least: int = 1, within: tuple[str, int] | None = None, where: Column | None = None) -> Stage:
    """Adds sum(target - figure) / (n + k) of a key's training rows, clipped to +-clip; keys with fewer than `least` rows add nothing.

    within: (one of the keys, fewest training rows that all keys with its value hold together). where: rows to which it is added (all)."""

    def fit(train: DataFrame) -> DataFrame:
        keyed, names = _keyed(train, keys)
        rest = F.col(target) - F.col(figure)
        out = keyed.groupBy(*names).agg((F.sum(rest) / (F.count(rest) + k)).alias("offset"), F.count(rest).alias("n"))
        if within is not None:  # a row a key
            out = out.withColumn("_all", F.sum("n").over(Window.partitionBy(f"_key_{within[0]}"))).where(F.col("_all") >= within[1]).drop("_all")
        out = out.where(F.col("n") >= least)
        return out if clip is None else out.withColumn("offset", F.least(F.greatest("offset", F.lit(-clip)), F.lit(clip)))

    step = F.col(figure) + F.col("_fit.offset")
    return Stage(name, fit, lambda rows, table: _moved(rows, table, keys, figure, step if where is None else F.when(where, step)))


def slopes(name: str, figure: str, target: str, keys: Mapping[str, Column | str], x: str, more_than: int) -> Stage:
    """Adds slope * x, the slope through the origin of what is left on x, of keys with more than so many training rows whose x is not 0."""

    def fit(train: DataFrame) -> DataFrame:
        keyed, names = _keyed(train, keys)
        rest = F.col(target) - F.col(figure)
        out = keyed.groupBy(*names).agg(calibrate.origin_slope(F.col(x), rest).alias("slope"), F.count_if(F.col(x) != 0).alias("n"))
        return out.where(F.col("n") > more_than)

    return Stage(name, fit, lambda rows, table: _moved(rows, table, keys, figure, F.col(figure) + F.col("_fit.slope") * F.col(x)))


def curves(name: str, figure: str, target: str, keys: Mapping[str, Column | str], least: int = 100, gain: float = 0.999) -> Stage:
    """A parabola in place of the figure where its squared error is below `gain` times that of the line, else the line; keys with fewer than `least` rows keep the figure."""
    x = F.col(figure)

    def fit(train: DataFrame) -> DataFrame:
        keyed, names = _keyed(train, keys)
        arcs = calibrate.parabola(keyed, names, figure, target)
        lines = keyed.groupBy(*names).agg(*calibrate.line(x, F.col(target)))
        both = written(arcs.join(lines, names).where(F.col("n") >= least), name)  # a row a key
        d = x - F.col("x_mean")
        arc_miss = F.avg((F.col("b0") + F.col("b1") * d + F.col("b2") * d * d - F.col(target)) ** 2)
        line_miss = F.avg((F.col("slope") * x + F.col("intercept") - F.col(target)) ** 2)
        misses = keyed.join(F.broadcast(both), names).groupBy(*names).agg(F.coalesce(arc_miss < gain * line_miss, F.lit(False)).alias("curved"))
        return both.join(misses, names)

    d = x - F.col("_fit.x_mean")
    arc = F.col("_fit.b0") + F.col("_fit.b1") * d + F.col("_fit.b2") * d * d
    value = F.when(F.col("_fit.curved"), arc).otherwise(F.col("_fit.slope") * x + F.col("_fit.intercept"))
    return Stage(name, fit, lambda rows, table: _moved(rows, table, keys, figure, value))


def rescale(name: str, figure: str, target: str, keys: Mapping[str, Column | str], least: int = 2000, near: float = 0.02) -> Stage:
    """(figure - mean) * slope + mean of the target; keys with fewer than `least` training rows, or a slope closer to 1 than `near`, keep their figure."""
    x, y = F.col(figure), F.col(target)

    def fit(train: DataFrame) -> DataFrame:
        keyed, names = _keyed(train, keys)
        out = keyed.groupBy(*names).agg(F.count(x * y).alias("n"), F.regr_slope(y, x).alias("slope"), F.avg(x).alias("x_mean"), F.avg(y).alias("y_mean"))
        return out.where((F.col("n") >= least) & (F.abs(F.col("slope") - 1) >= near))

    value = (x - F.col("_fit.x_mean")) * F.col("_fit.slope") + F.col("_fit.y_mean")
    return Stage(name, fit, lambda rows, table: _moved(rows, table, keys, figure, value))


def quantiles(name: str, figure: str, target: str, keys: Mapping[str, Column | str], shares: Sequence[float], least: int = 500) -> Stage:
    """The figure's distribution mapped onto the target's, through matching exact percentiles by key, linear between them and constant beyond; keys with fewer than `least` rows keep the figure."""

    def fit(train: DataFrame) -> DataFrame:
        keyed, names = _keyed(train, keys)
        known = keyed.where(F.col(figure).isNotNull() & F.col(target).isNotNull())
        xs = ranks.percentiles(known, names, figure, shares, name="xs").where(F.col("n") >= least)
        both = xs.join(ranks.percentiles(known, names, target, shares, name="ys").drop("n"), names)
        return both.select(*names, "n", F.explode(F.arrays_zip("xs", "ys")).alias("_at")).groupBy(*names, "n", F.col("_at.xs").alias("x")).agg(F.min("_at.ys").alias("y"))

    def apply(rows: DataFrame, table: DataFrame) -> DataFrame:
        names = [c for c in table.columns if c.startswith("_key_")]
        return _moved(rows, interpolate.curves(table, names, "x", "y"), keys, figure, interpolate.at(F.col("_fit.curve"), F.col(figure)))

    return Stage(name, fit, apply)
