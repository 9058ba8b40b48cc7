import hashlib
import random

import pytest
from pyspark.sql import functions as F

from furlong.llm import fill_middle as M

ODD = [None, "", "a", "<P>", "x<S>y", "<M", "<<P", "<P", "S><", "\n", "\r\n", "é", "é", "😀😀a", "\0", "<S", "P>", "ab" * 70_000, " ", " x", "<p>"]


def by_hand(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    chars = list(text)
    n = len(chars)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    pre, mid, suf = "".join(chars[:a]), "".join(chars[a:b]), "".join(chars[b:])
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + suf + "<P>" + pre + "<M>" + mid
    return n, "psm", a, b - a, "<P>" + pre + "<S>" + suf + "<M>" + mid


def test_equals_cuts_by_hand_and_restores(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("<>PSMa é😀\n") for _ in range(rng.randint(1, 30))) for _ in range(200)] + ["same text"] * 5
    docs = spark.createDataFrame([(i or None, t, "x", 7) for i, t in enumerate(texts)] + [(3, texts[3], None, None)], "doc_id long, text string, output string, n int").repartition(3)
    rows = M.transform(docs).withColumn("back", M.restored(F.col("form"), F.col("output"))).collect()
    assert len(rows) == len(texts) + 1 and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        text = texts[r.doc_id or 0]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, text)
        assert r.back == (text or "")


def test_digest(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    for r in M.digest(M.transform(docs)).collect():
        text = {1: "hello world", 2: ""}[r.doc_id]
        assert r.output_sha256 == hashlib.sha256(by_hand(r.doc_id, text)[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("unit", [r"\s*\S+\s*", r"[^\n]*\n|[^\n]+"])
def test_other_units(spark, unit):
    texts = ["one two  three\nfour", "a", "  b ", "", None, "<P> x", " " * 3, "l1\nl2\n\nl3"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in M.transform(docs, seed=9, plain=0, spm=50, unit=unit).withColumn("back", M.restored(F.col("form"), F.col("output"))).collect():
        assert r.back == (texts[r.doc_id] or "")
        if texts[r.doc_id] == "one two  three\nfour":
            assert r.n == (4 if "S" in unit else 2)


def test_empty_table(spark):
    assert M.digest(M.transform(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
