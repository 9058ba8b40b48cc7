import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.operators import compare as C

SCHEMA = "year int, a double, b double, noise double, y double, grp string"


def folds():
    return {"one": (F.col("year") <= 1, F.col("year") == 2), "two": (F.col("year") <= 2, F.col("year") == 3)}


def said(n=600):
    rng = random.Random(8)
    out = []
    for i in range(n):
        a, b = rng.gauss(0, 1), rng.gauss(5, 2)
        out.append((i % 4, a, b if i % 11 else None, rng.random(), 3 * a + b + rng.gauss(0, 0.1) if i % 13 else None, "x" if i % 3 else "y"))
    return out


def by_hand(rows, columns, train, test, penalty=0.0):
    rows = [r for r in rows if r[4] is not None]
    at = {"a": 1, "b": 2, "noise": 3}
    inside = [r for r in rows if train(r[0])]
    means = [np.mean([r[at[c]] for r in inside if r[at[c]] is not None]) for c in columns]
    fill = lambda r: [(r[at[c]] - m if r[at[c]] is not None else 0.0) for c, m in zip(columns, means, strict=True)]
    x, y = np.array([fill(r) for r in inside]), np.array([r[4] for r in inside])
    square = x.T @ x
    w = np.linalg.solve(square + penalty * np.diag(np.diag(square)), x.T @ (y - y.mean()))
    outside = [r for r in rows if test(r[0])]
    return np.array([y.mean() + np.dot(w, fill(r)) for r in outside]), np.array([r[4] for r in outside])


def test_sets_and_penalties_agree_with_solutions_by_hand(spark):
    rows = said()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out, settings = C.linear_sets(df, "y", {"base": ["a"], "more": ["a", "b"]}, folds(), (0.0, 0.5))
    assert settings == ["base / 0", "base / 0.5", "more / 0", "more / 0.5"]
    report = {(r.fold, r.setting): r for r in C.paired(out, "y", settings, "base / 0").collect()}
    assert len(report) == 8
    for fold, train, test in (("one", lambda v: v <= 1, lambda v: v == 2), ("two", lambda v: v <= 2, lambda v: v == 3)):
        base, y = by_hand(rows, ["a"], train, test)
        for name, columns in (("base", ["a"]), ("more", ["a", "b"])):
            for penalty in (0.0, 0.5):
                p, _ = by_hand(rows, columns, train, test, penalty)
                r, gain = report[fold, f"{name} / {penalty:g}"], np.abs(p - y) - np.abs(base - y)
                assert (r.n, r.n_pairs) == (len(y), len(y))
                assert [r.mae, r.rmse, r.bias, r.corr, r.within_1] == pytest.approx([np.abs(p - y).mean(), np.sqrt(((p - y) ** 2).mean()), (p - y).mean(), np.corrcoef(p, y)[0, 1], (np.abs(p - y) <= 1).mean()])
                assert [r.change, r.change_se] == pytest.approx([gain.mean(), gain.std(ddof=1) / np.sqrt(len(y))], abs=1e-9)
    assert report["one", "more / 0"].change < -4 * report["one", "more / 0"].change_se and report["one", "more / 0"].nearer > 0.8
    assert report["two", "base / 0"].nearer == 0 and report["two", "base / 0"].change == 0


def test_columns_that_others_determine(spark):
    df = spark.createDataFrame(said(), SCHEMA).withColumn("twice", 2 * F.col("a")).withColumn("still", F.lit(7.0))
    out, settings = C.linear_sets(df, "y", {"one": ["a"], "two": ["a", "twice", "still"], "none": []}, folds())
    assert out.where(F.abs(F.col("one") - F.col("two")) > 1e-6).count() == 0 and out.select("fold", "none").distinct().count() == 2


def test_models_groups_and_slices(spark):
    df = spark.createDataFrame(said(), SCHEMA)

    def level(train):
        mean = train.agg(F.avg("y").alias("m")).first().m
        return lambda rows: rows.withColumn("predicted", F.lit(mean))

    def blank(train):
        return lambda rows: rows.withColumn("predicted", F.when(F.col("grp") == "x", F.col("y")))

    out = C.with_models(df, "y", {"level": level, "blank": blank}, folds() | {"never": (F.lit(False), F.lit(True))})
    found = {(r.fold, r.grp, r.setting): r for r in C.paired(out, "y", ["level", "blank"], "level", by=("fold", "grp"), least=0).collect()}
    assert len(found) == 8 and found["one", "y", "blank"].n == 0 and found["one", "y", "blank"].mae is None
    assert found["one", "x", "blank"].mae == 0 and found["one", "x", "blank"].nearer == 1 and found["one", "x", "blank"].change == -found["one", "x", "level"].mae
    assert C.paired(out, "y", ["level", "blank"], "level", by=()).count() == 2 and C.paired(out, "y", ["level", "blank"], "level", by=("fold", "grp"), least=1).count() == 6


def test_empty_tables_and_folds(spark):
    none = spark.createDataFrame([], SCHEMA)
    out, settings = C.linear_sets(none, "y", {"base": ["a"]}, folds())
    assert settings == ["base"] and C.paired(out, "y", settings, "base").count() == 0
    assert C.with_models(none, "y", {"m": None}, folds()).count() == 0
    one, settings = C.linear_sets(spark.createDataFrame(said(), SCHEMA), "y", {"base": ["a"]}, {"some": folds()["one"], "never": (F.lit(False), F.lit(True)), "nowhere": (F.lit(True), F.lit(False))})
    assert [r.fold for r in C.paired(one, "y", settings, "base").collect()] == ["some"]
