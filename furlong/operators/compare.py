"""Feature sets and settings compared on shared temporal folds, by paired errors.

All settings read one table. `linear_sets` fits every set of columns with every penalty from one matrix of moments for each fold (two aggregates, whose
size depends on the columns alone), and puts the predictions of all settings beside each test row in one pass. `with_models` does the same for models of any other
kind, which are fitted one after the other. `paired` then gives the errors of all settings in one aggregate, with those of the same rows under a baseline: the mean
difference of absolute errors, its standard error, and the share of rows on which the setting is nearer.

Rows whose target is null do not count; nor do those with a null prediction, for that setting, and its pair needs both predictions. A null feature counts
as the column's mean in the fold's training rows (0 if it has none). A fold without training rows or without test rows gives no rows. A row may train several folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distances within which errors are counted by default.
WITHIN = (1, 2, 3, 5, 10)

Fold = tuple[Column, Column]  # which rows train, which rows test
Model = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]  # training rows -> rows -> rows with column `predicted`


def by_fold(rows: DataFrame, folds: Mapping[str, Fold], part: int) -> DataFrame:
    """rows once for each fold that they train (part 0) or test (part 1), with its name as fold."""
    names = F.array_compact(F.array(*[F.when(fold[part], F.lit(name)) for name, fold in folds.items()]))
    return rows.withColumn("fold", F.explode(names))


def picked(values: Mapping[str, float]) -> Column:
    """The value of a row's fold."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("fold")]


def linear_sets(rows: DataFrame, target: str, sets: Mapping[str, Sequence[str]], folds: Mapping[str, Fold], penalties: Sequence[float] = (0.0,)) -> tuple[DataFrame, list[str]]:
    """Test rows by fold with a column of predictions for each setting, and the settings' names: those of the sets, followed by " / penalty" where there are several.

    A penalty is in shares of a column's sum of squares. Columns that others determine get the least-squares solution of least norm."""
    columns = sorted(set().union(*sets.values()))
    rows = rows.where(F.col(target).isNotNull())
    train = by_fold(rows, folds, 0).select("fold", F.col(target).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    xs = [f"x{i}" for i in range(len(columns))]
    means = {r["fold"]: r for r in train.groupBy("fold").agg(F.avg("y").alias("y"), *[F.coalesce(F.avg(x), F.lit(0.0)).alias(x) for x in xs]).collect()}  # a row a fold
    settings = {name if len(penalties) == 1 else f"{name} / {p:g}": (sorted(own), p) for name, own in sets.items() for p in penalties}
    if not means:
        return by_fold(rows, {"": (F.lit(False), F.lit(False))}, 1).withColumns({s: F.lit(None).cast("double") for s in settings}), list(settings)
    mean = {c: picked({f: m[c] for f, m in means.items()}) for c in ["y", *xs]}
    centred = train.select("fold", (F.col("y") - mean["y"]).alias("y"), *[F.coalesce(F.col(x) - mean[x], F.lit(0.0)).alias(x) for x in xs])
    pairs = [(a, b) for i, a in enumerate(xs) for b in [*xs[i:], "y"]]
    moments = {r["fold"]: r for r in centred.groupBy("fold").agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a, b in pairs], F.lit(1).alias("_")).collect()}
    weights = {s: {f: solved(moments[f], [columns.index(c) for c in own], p) for f in means} for s, (own, p) in settings.items()}
    test = by_fold(rows, {f: fold for f, fold in folds.items() if f in means}, 1)
    out = {}
    for s, (own, _) in settings.items():
        total = mean["y"]
        for at, c in enumerate(own):
            total = total + picked({f: float(w[at]) for f, w in weights[s].items()}) * F.coalesce(F.col(c).cast("double") - mean[f"x{columns.index(c)}"], F.lit(0.0))
        out[s] = total
    return test.withColumns(out), list(settings)


def solved(moments: Mapping[str, float], own: list[int], penalty: float) -> np.ndarray:
    if not own:
        return np.zeros(0)
    square = np.array([[moments[f"x{min(i, j)}_x{max(i, j)}"] for j in own] for i in own])
    square += penalty * np.diag(np.diag(square))
    scale = np.sqrt(np.where(np.diag(square) > 0, np.diag(square), 1.0))
    return np.linalg.lstsq(square / np.outer(scale, scale), np.array([moments[f"x{i}_y"] for i in own]) / scale, rcond=1e-12)[0] / scale


def with_models(rows: DataFrame, target: str, models: Mapping[str, Model], folds: Mapping[str, Fold]) -> DataFrame:
    """Test rows by fold with a column of predictions for each model, fitted on the fold's training rows. rows should be a table, as every fit reads it."""
    rows, parts = rows.where(F.col(target).isNotNull()), []
    for name, (trains, tests) in folds.items():
        train, part = rows.where(trains), rows.where(tests).withColumn("fold", F.lit(name))
        if train.isEmpty():
            continue
        for setting, model in models.items():
            part = model(train)(part).withColumnRenamed("predicted", setting)
        parts.append(part)
    if not parts:
        return rows.where(F.lit(False)).withColumn("fold", F.lit("")).withColumns({s: F.lit(None).cast("double") for s in models})
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def paired(rows: DataFrame, target: str, settings: Sequence[str], baseline: str, by: Sequence[str] = ("fold",), within: Sequence[float] = WITHIN, least: int = 1) -> DataFrame:
    """A row for each group and setting: setting, n, mae, rmse, bias, corr, within_<d> (shares), and against the baseline n_pairs, change, change_se and nearer.

    change is the setting's mean absolute error less the baseline's, below 0 if it is better; nearer does not count ties; corr is null where either side is constant. Groups of fewer than `least` rows are left out."""
    y = F.col(target).cast("double")
    other = F.abs(F.col(f"`{baseline}`") - y)
    each = []
    for s in settings:
        p = F.col(f"`{s}`")
        error, gain = p - y, F.abs(p - y) - other
        together = F.try_divide(F.covar_pop(p, y), F.stddev_pop(p) * F.stddev_pop(F.when(p.isNotNull(), y)))
        each.append(
            F.struct(
                F.lit(s).alias("setting"), F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(error).alias("bias"), together.alias("corr"),
                *[F.avg((F.abs(error) <= d).cast("double")).alias(f"within_{d:g}") for d in within],
                F.count(gain).alias("n_pairs"), F.avg(gain).alias("change"), (F.stddev_samp(gain) / F.sqrt(F.count(gain))).alias("change_se"),
                (F.avg((gain < 0).cast("double"))).alias("nearer"),
            )
        )
    told = rows.groupBy(*by).agg(F.array(*each).alias("each")) if by else rows.agg(F.array(*each).alias("each"))
    return told.select(*by, F.inline("each")).where(F.col("n") >= least)
