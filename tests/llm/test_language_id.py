import zlib

import numpy as np
from pyspark.sql import functions as F

from furlong.llm import language_id as L


def brute_scores(model, text):
    """Scores of one text, gram by gram."""
    low = []
    for c in text.replace("\0", " ").lower():
        if c.isalpha():
            low.append(c)
        elif low and low[-1] != " ":
            low.append(" ")
    total = model.priors.copy()
    for order, n in enumerate(L.ORDERS):
        for i in range(len(low) - n + 1):
            total = total + model.matrix[L.Grams(["z" + "".join(low[i : i + n])]).orders[order][1]]
    return total


def test_held_out_accuracy_and_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.fit(docs.where(~L.is_held_out("doc_id")))
    rows = L.identify(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    for r in sorted(rows, key=lambda r: len(r.text))[:8]:
        joint = brute_scores(model, r.text)
        assert r.lang_pred == model.langs[int(joint.argmax())]


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 !? ²", None), (None, "the dog", "en"), (1, "the cat and the dog", "en"), (6, "漢字", None), (7, "x\0y the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit(1))
    out = L.identify(docs, L.fit(docs)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1].lang_pred == by_id[None].lang_pred == "en" and by_id[2].lang_pred == "fr" and by_id[6].lang_pred == "en"
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (3, 4, 5))
    empty = docs.limit(0)
    assert L.identify(empty, L.fit(empty)).count() == 0
    assert {r.lang_pred for r in L.identify(docs, L.fit(empty)).collect()} == {"und"}
    kept = L.keep_identified(docs, L.fit(docs))
    assert kept.columns == docs.columns and kept.count() == 6


def test_long_texts_come_out_as_short_ones_do(monkeypatch):
    text = "".join(np.random.default_rng(0).choice(list("abc déf "), 5000)).strip()
    model = L.Model(["a", "b"], np.zeros(2), np.random.default_rng(1).normal(size=(L.BUCKETS + 1, 2)).astype(np.float32) / 100)
    model.matrix[L.BUCKETS] = 0
    joint = brute_scores(model, text)
    for span in (1 << 18, 700, 64):
        monkeypatch.setattr(L, "SPAN", span)
        langs, scores = model.predict([text, None])
        assert langs == [model.langs[int(joint.argmax())], "und"]
        assert abs(scores[0] - 1 / (1 + np.exp(joint.min() - joint.max()))) < 1e-3
