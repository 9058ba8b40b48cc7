import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.llm import embedding_dedup as E


def brute(ids, vectors, threshold):
    n = len(ids)
    good = [v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v) for v in vectors]
    units = np.array([np.array(v, float) / np.linalg.norm(v) if g else np.zeros(16) for v, g in zip(vectors, good, strict=True)])
    linked = (units @ units.T >= threshold - 1e-12) & np.array(good)[:, None] & np.array(good)[None, :]
    np.fill_diagonal(linked, False)
    label = np.arange(n)
    while True:
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(n)])
        if (new == label).all():
            break
        label = new
    least = {k: min(i for i, x in zip(ids, label, strict=True) if x == k) for k in set(label)}
    return {i: (int(linked[k].sum()), least[label[k]], i == least[label[k]]) for k, i in enumerate(ids)}


def vectors(n=500):
    rng = np.random.default_rng(5)
    out = [rng.normal(size=16).tolist() for _ in range(n)]
    for base in range(0, 60, 6):
        for spread in (0.01, 0.05, 0.1, 0.1, 0.15):
            out.append((np.array(out[base]) + spread * rng.normal(size=16)).tolist())
    out += [out[3], out[3], [2 * x for x in out[3]], [0.0] * 16, None, [float("nan")] * 16, [1.0, None] * 8, [1.0, 2.0], [float("inf")] + [1.0] * 15, [-0.0] * 15 + [1.0], [0.0] * 15 + [1.0]]
    rng.shuffle(ids := list(range(len(out))))
    return ids, out


@pytest.mark.parametrize("block", [1024, 4])
def test_recall_and_precision_against_brute_force(spark, block):
    ids, said = vectors()
    frame = spark.createDataFrame(list(zip(ids, said, strict=True)), "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.neighbours(frame, 0.9, block=block).collect()}
    want = brute(ids, said, 0.9)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][0] for i in want) >= 0.98 * sum(want[i][0] for i in want) > 50
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_the_given_vectors_are_found_whole(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = frame.collect()
    units = np.array([r.embedding for r in rows], float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    links = (units @ units.T >= 0.9).sum(1) - 1
    got = {r.vec_id: r.n_links for r in E.neighbours(frame, 0.9).collect()}
    assert got == {r.vec_id: int(n) for r, n in zip(rows, links, strict=True)}


def test_estimates_are_unbiased_within_their_error():
    rng = np.random.default_rng(3)
    dim, n = 64, 4000
    x = rng.normal(size=(n, dim))
    y = x + 0.5 * rng.normal(size=(n, dim))
    x, y = x / np.linalg.norm(x, axis=1)[:, None], y / np.linalg.norm(y, axis=1)[:, None]
    a, b = x @ E.rotations(dim, 1), y @ E.rotations(dim, 1)
    f = np.abs(a).sum(1) / 8
    off = (np.where(a >= 0, 1, -1) * b).sum(1) / 8 / f - (x * y).sum(1)
    error = np.sqrt((1 - f**2) / f**2 / (dim - 1)) * np.sqrt(1 - (x * y).sum(1) ** 2)
    assert abs(off.mean()) < 0.003 and 0.9 < (off / error).std() < 1.1


def test_null_ids_and_empty_table(spark):
    v = [1.0] + [0.0] * 15
    frame = spark.createDataFrame([(None, v), (4, v), (None, None)], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in E.neighbours(frame).collect()), key=str)
    assert got == sorted([(None, 1, 4, False), (4, 1, 4, True), (None, 0, None, False)], key=str)
    assert E.neighbours(frame.limit(0)).count() == 0


def test_every_length_is_compared_with_its_own(spark):
    """Vectors of fewer lengths link as well, those of unlike lengths never, even where one is the other filled with zeros."""
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=7).tolist(), rng.normal(size=33).tolist()
    said = [x, x, [2 * c for c in x], x + [0.0], [*x, 0.0], y, y, [1.0], [3.0], [-1.0], [], None, [1.0, 0.0], *rng.normal(size=(40, 16)).tolist()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.neighbours(spark.createDataFrame(list(enumerate(said)), "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(said)
    assert [got[i] for i in range(13)] == [(2, 0)] * 3 + [(1, 3)] * 2 + [(1, 5)] * 2 + [(1, 7)] * 2 + [(0, 9), (0, 10), (0, 11), (0, 12)]
