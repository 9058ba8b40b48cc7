from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from furlong.sources import ingest as I

START, END = date(2023, 12, 28), date(2024, 1, 8)


def source(spark, skip=(), bad=(), until=END):
    days = [START + timedelta(days=i) for i in range((until - START).days + 1)]
    rows = [(d, race, f"{'x' if (d, race) in bad else d.day * race}") for d in days if d not in skip for race in (1, 2, 2)]
    return spark.createDataFrame([*rows, (None, 9, "1"), (date(2030, 1, 1), 9, "1")], "day date, race int, doc string").repartition(3)


def parse(rows):
    value = F.col("doc").try_cast("int")
    return rows.withColumn("value", value).withColumn("error", F.when(value.isNull(), F.concat(F.lit("no number: "), "doc")))


def held(spark, root, what="rows"):
    return sorted((r.day, r.race, r.value) for r in I.stored(spark, root, what).collect())


def runs(df):
    return sorted((r["first"], r["last"], r.n_days) for r in df.collect())


def test_killed_between_rows_and_commit_then_resumed(spark, tmp_path, monkeypatch):
    root, gap, bad = f"{tmp_path}/in", date(2024, 1, 3), {(date(2023, 12, 30), 2)}
    assert runs(I.gaps(spark, root, START, END)) == [(START, END, 12)]
    real, seen = I.commit, []

    def killed(*args):
        if seen:
            raise RuntimeError("killed")
        seen.append(1)
        real(*args)

    monkeypatch.setattr(I, "commit", killed)
    with pytest.raises(RuntimeError, match="killed"):
        I.ingest(source(spark, {gap}, bad), root, START, END, ["race"], parse)
    assert runs(I.gaps(spark, root, START, END)) == [(date(2024, 1, 1), END, 8)]
    assert {r[0].year for r in held(spark, root)} == {2023}
    assert spark.read.parquet(f"{root}/rows").where("year(day) = 2024").count() == 14  # left by the killed batch

    monkeypatch.setattr(I, "commit", real)
    assert I.ingest(source(spark, {gap}, bad), root, START, END, ["race"], parse) == 8
    days = [START + timedelta(days=i) for i in range(12)]
    assert held(spark, root) == [(d, race, d.day * race) for d in days if d != gap for race in (1, 2) if (d, race) not in bad]
    assert [(r.day, r.race, r.error) for r in I.stored(spark, root, "errors").collect()] == [(date(2023, 12, 30), 2, "no number: x")]
    assert runs(I.gaps(spark, root, START, END)) == [] and I.ingest(source(spark), root, START, END, ["race"], parse) == 0
    assert {r.day: (r.n_rows, r.n_errors) for r in I.state(spark, root).collect()}[gap] == (0, 0)

    assert runs(I.gaps(spark, root, START, END, with_errors=True)) == [(date(2023, 12, 30), date(2023, 12, 30), 1)]
    assert I.ingest(source(spark), root, START, END, ["race"], parse, with_errors=True) == 1
    assert len(held(spark, root)) == 22 and held(spark, root, "errors") == [] and (date(2023, 12, 30), 2, 60) in held(spark, root)


def test_days_after_the_watermark_are_done_again(spark, tmp_path):
    root = f"{tmp_path}/in"
    assert I.ingest(source(spark, until=date(2024, 1, 2)), root, START, END, ["race"], parse, late_days=2) == 6
    assert len(held(spark, root)) == 12 and runs(I.gaps(spark, root, START, END)) == [(date(2024, 1, 1), END, 8)]
    later = source(spark, {date(2024, 1, 1)}, until=date(2024, 1, 4))
    assert I.ingest(later, root, START, END, ["race"], parse) == 4
    assert {r[0] for r in held(spark, root)} == {START + timedelta(days=i) for i in range(8)} - {date(2024, 1, 1)}


def test_empty(spark, tmp_path):
    assert I.ingest(source(spark).where("false"), f"{tmp_path}/in", START, END, ["race"], parse) == 0
    assert I.gaps(spark, f"{tmp_path}/in", END, START).count() == 0
