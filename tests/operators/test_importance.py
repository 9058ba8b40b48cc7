import hashlib
import random

import pytest
from pyspark.sql import functions as F

from furlong.operators import importance as I


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def rows():
    rng = random.Random(12)
    return [(i, float(rng.randint(0, 9)), rng.choice(["a", "b", None]), rng.random(), float(i % 4)) for i in range(800)]


SCHEMA = "id long, strong double, label string, unused double, weak double"


@pytest.mark.parametrize("digits", [0, 1, 3, None])
def test_shuffles_like_circles_by_hand(spark, digits):
    said = rows()
    df = spark.createDataFrame(said, SCHEMA).repartition(4)
    got = {(r._shuffled, r.id): r for r in I.shuffled(df, "id", ["strong", "label"], digits).collect()}
    assert len(got) == 3 * len(said)
    for column, at in (("strong", 1), ("label", 2)):
        circles = {}
        for r in said:
            circles.setdefault(md5(str(r[0]))[: digits or 0], []).append(r)
        for circle in circles.values():
            circle.sort(key=lambda r: md5(f"{r[0]}-{column}"))
            for r, following in zip(circle, [*circle[1:], circle[0]], strict=True):
                out = got[column, r[0]]
                assert out[column] == following[at]
                assert all(out[c] == r[i] for i, c in enumerate(df.columns) if c != column)
    assert all(tuple(got["", r[0]])[:5] == r for r in said)


def test_ranks_a_planted_signal(spark):
    df = spark.createDataFrame(rows(), SCHEMA).withColumn("y", 5 * F.col("strong") + F.col("weak") + F.col("unused") / 100)
    predict = lambda d: d.withColumn("predicted", 5 * F.col("strong") + F.col("weak"))
    out = {r.column: r for r in I.importance(df, "id", ["unused", "weak", "strong", "label"], "y", predict, digits=1).collect()}
    assert [c for c in sorted(out, key=lambda c: out[c]["rank"])] == ["strong", "weak", "label", "unused"]
    assert out["unused"].increase == pytest.approx(0, abs=1e-12) and out["label"].increase == pytest.approx(0, abs=1e-12) and out["strong"].increase > 8 > out["weak"].increase > 0.8
    squared = I.importance(df, "id", ["strong"], "y", predict, loss=lambda y, p: (y - p) ** 2).first()
    assert squared.increase > 350  # 25 times twice the variance of 0 to 9 is 412


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert I.importance(none, "id", ["strong"], "weak", lambda d: d.withColumn("predicted", F.lit(1.0))).count() == 0
