import random

import numpy as np
import pytest

from furlong.llm import jaccard_join as J
from furlong.llm.components import components


def brute(rows, k, num, den):
    """component by id, sets compared pair by pair"""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (n, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), n)
    return sorted((n, len(sets[i]), least[find(i)]) for i, (n, _) in enumerate(rows))


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = " ".join(rng.choices(vocabulary, k=60))
    texts = ["", None, "a", "A", "a b", "one two three", "One  two\tthree", "é É", "é É", " \n "]
    bases = [rng.choices(vocabulary, k=rng.choice([3, 5, 8, 12, 20, 40, 70, 100, 300])) for _ in range(30)]
    while len(texts) < n:
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            at = rng.randrange(len(words) + 1)
            words[at : at + rng.choice([0, 1])] = rng.choices(vocabulary, k=rng.choice([0, 1, 1]))
        text = " ".join(words)
        texts.append(text.upper() if rng.random() < 0.1 else text + " " + shared if rng.random() < 0.1 else text)
    ids = rng.sample(range(10_000), n)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize(("seed", "k", "num", "bucket", "hot"), [(1, 4, 85, 400, 1 << 40), (2, 5, 80, 1 << 30, 1 << 40), (3, 2, 60, 300, 3), (4, 3, 90, 200, 0)])
def test_equals_brute_force(spark, seed, k, num, bucket, hot):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(3)
    got = sorted(tuple(r) for r in J.groups(docs, k, num, 100, bucket=bucket, hot=hot, block=8 if seed > 2 else 1024).collect())
    assert got == brute(rows, k, num, 100)


def test_file_splits_may_change_between_readings(spark, tmp_path, monkeypatch):
    rows = corpus(5)
    spark.createDataFrame(rows + rows[:3], "doc_id long, text string").repartition(6).write.parquet(f"{tmp_path}/d")
    docs, key, before = spark.read.parquet(f"{tmp_path}/d"), "spark.sql.files.minPartitionNum", J.memberships

    def replanned(*args):
        spark.conf.set(key, "1")  # all files in one partition from here on
        return before(*args)

    monkeypatch.setattr(J, "memberships", replanned)
    want = brute(rows + rows[:3], 5, 80, 100)
    try:
        assert sorted(tuple(r) for r in J.groups(docs, 5, 80, 100).collect()) == want
        spark.conf.unset(key)
        kept = sorted(r.doc_id for r in J.keep_one(docs, 5, 80, 100).collect())
    finally:
        spark.conf.unset(key)
    assert kept == sorted([i for i, n, c in set(want) if n and i == c] + [i for i, n, _ in want if not n])


def test_pigeonhole_holds_for_pairs():
    """A linked pair always shares a signature that the smaller set probes."""
    rng = np.random.default_rng(0)
    sketch = rng.integers(0, 50, 1 << J.SKETCH_BITS[0])
    for num in (60, 80, 85, 95):
        plan = J.Scheme(num, 100)
        for size in [*range(1, 40), 63, 64, 65, 100, 500]:
            for _ in range(6):
                x = np.unique(rng.integers(1, 1 << 63, size, np.uint64))
                drop, extra = rng.integers(0, 1 + size // 6, 2)
                y = np.unique(np.concatenate([rng.permutation(x)[drop:], rng.integers(1, 1 << 63, extra, np.uint64)]))
                both = len(np.intersect1d(x, y))
                if 100 * both < num * len(np.union1d(x, y)):
                    continue
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                band = plan.band(len(y))
                plan.band(plan.bounds[band + 1])
                assert plan.band(len(x)) in (band, band - 1)
                assert np.isin(J.chosen(x, band, plan, sketch), J.indexed(y, plan)).any()


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 5, 60, 700, 9000):
        x = np.unique(rng.integers(1, 1 << 63, n, np.uint64))
        y = np.unique(np.concatenate([x[n // 5 :], rng.integers(1, 1 << 63, n // 4 + 1, np.uint64)]))
        a, b = J.folded([J.odd_sketch(x), J.odd_sketch(y)])
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_ids_that_are_null_or_repeated_and_empty_table(spark):
    text = "the quick brown fox jumps over the lazy dog"
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (9, text + " "), (None, None), (7, "other words")], "doc_id long, text string")
    got = sorted((tuple(r) for r in J.groups(docs, 4, 85, 100).collect()), key=str)
    assert got == sorted([(None, 6, 5), (5, 6, 5), (5, 6, 5), (9, 6, 5), (None, 0, None), (7, 1, 7)], key=str)
    assert J.groups(docs.limit(0), 4, 85, 100).count() == 0


def chained(n, seed=3):
    """Versions of one text, each three words from the one before, so that most of them are linked along the chain alone; and some that are linked with none."""
    rng = random.Random(seed)
    words, out = rng.choices([f"v{i}" for i in range(5000)], k=120), []
    for i in range(n):
        words = list(words)
        words[rng.randrange(len(words))] = f"new{i}"
        out.append((i, " ".join(words)))
    for i in range(n, n + 30):
        far = list(words)
        far[::9] = [f"far{i}-{j}" for j in range(len(far[::9]))]
        out.append((i, " ".join(far)))
    return out


def test_rows_that_leave_the_blocks_grow_with_the_classes(spark, monkeypatch):
    rows, seen, before = chained(300), [], J.local_links

    def counted(dealt, *rest):
        n = dealt.count()
        links = before(dealt, *rest)
        seen.append((links.count(), n))
        return links

    monkeypatch.setattr(J, "local_links", counted)
    monkeypatch.setattr(J, "FEW", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in J.groups(docs, 5, 80, 100, block=32).collect()) == brute(rows, 5, 80, 100)
    assert 0 < seen[0][0] < seen[0][1]


def test_sets_that_share_half_a_number_stay_apart(spark, monkeypatch):
    """All first halves are put in doubt, so that the second halves number the classes."""
    rows = corpus(9, 80)
    halves = dict(J.class_of(h) for h in (J.shingles(t, 5) for _, t in rows) if len(h))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    measured, asked = J.measured, []

    def doubtful(*args):
        sizes, sketch, _ = measured(*args)
        firsts = frozenset(r.key for r in sizes.select("key").distinct().collect() if r.key is not None)
        asked.append(len(firsts))
        pairs = spark.createDataFrame([*halves.items()], "key long, second long")
        path, sizes = sizes.staged_path, sizes.join(pairs, "key", "left").drop("key").withColumnRenamed("second", "key").select("row", "mark", "id", "n_shingles", "key")
        sizes.staged_path = path
        return sizes, sketch, firsts

    monkeypatch.setattr(J, "measured", doubtful)
    assert sorted(tuple(r) for r in J.groups(docs, 5, 80, 100).collect()) == brute(rows, 5, 80, 100)
    assert asked[0] == len(halves)


def test_columns_that_clash_with_inner_names(spark):
    text = "the quick brown fox jumps over the lazy dog again"
    docs = spark.createDataFrame([(3, text, "p", 1, 1), (4, text, "q", 2, 2), (5, None, "r", 3, 3)], "doc_id long, text string, root string, row int, mark int")
    got = J.keep_one(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=str) == [(3, text, "p", 1, 1), (5, None, "r", 3, 3)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
