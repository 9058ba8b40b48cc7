import collections
import json
import random

from furlong.sources.discovery import key_paths


def kind(v):
    return {dict: "object", list: "array", str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}[type(v)]


def walk(path, v, found):
    found[path].append(v)
    if isinstance(v, dict):
        for k, inner in v.items():
            following = f".{k}" if k.isidentifier() else '["' + k.replace('"', '\\"') + '"]'
            walk((path + following).removeprefix("."), inner, found)
    elif isinstance(v, list):
        for inner in v:
            walk(path + "[]", inner, found)


def made(rng, depth):
    roll = rng.random()
    if depth and roll < 0.35:
        return {rng.choice(["a", "b", "c", "d.e", 'f"g', "é"]): made(rng, depth - 1) for _ in range(rng.randint(0, 3))}
    if depth and roll < 0.55:
        return [made(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([None, True, False, 3, -12, 2.5, "text", "", "x" * 200])


def test_walks_like_python(spark):
    rng = random.Random(4)
    docs = [made(rng, 4) for _ in range(300)]
    got = {r.path: r for r in key_paths(spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string").repartition(5)).collect()}
    found = collections.defaultdict(list)
    for d in docs:
        walk("", d, found)
    # a letter of \w is ASCII in Spark's patterns, so é is quoted
    found = {p.replace(".é", '["é"]') if p != "é" else '["é"]': v for p, v in found.items()}
    found = {('["é"]' + p[1:] if p.startswith("é") else p): v for p, v in found.items()}
    assert set(got) == set(found)
    for path, values in found.items():
        r, sizes = got[path], [len(v) for v in values if isinstance(v, dict | list)]
        assert (r.kinds.split(","), r.n) == (sorted({kind(v) for v in values}), len(values)), path
        assert (r.least, r.most) == ((min(sizes), max(sizes)) if sizes else (None, None))
        plain = [json.dumps(v, ensure_ascii=False) for v in values if not isinstance(v, dict | list)]
        assert r.preview == (min((p if len(p) <= 80 else p[:77] + "..." for p in plain), default=None))


def test_null_broken_deep_and_empty(spark):
    deep = "[" * 9 + "1" + "]" * 9
    rows = [(None, 1), ("{", 2), ("", 3), ('{"a":1,"a":2}', 4), (deep, 5), ("7", 6)]
    got = {r.path: (r.kinds, r.n) for r in key_paths(spark.createDataFrame(rows, "doc string, path int")).collect()}
    assert got[""] == ("array,integer,invalid", 5) and got["[]" * 9] == ("integer", 1) and len(got) == 10
    assert key_paths(spark.createDataFrame([], "doc string")).count() == 0
    assert key_paths(spark.createDataFrame([(None,)], "doc string")).count() == 0
