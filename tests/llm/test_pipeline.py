import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from .test_jaccard_join import brute
from .test_secret_scan import brute as brute_secrets


def test_stages_against_brute_force(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = spark.createDataFrame([(9001, None, "en", "x", 0), (9002, "12 34 !!", "en", "x", 8), (9003, "the and with token=abcdef123456 of this", None, "x", 5), (9004, "the and with token=abcdef123456 of this", None, "x", 5)], given.schema)
    (docs := given.unionByName(more)).write.parquet(f"{tmp_path}/documents.parquet")
    docs, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)
    known = steps["language"](spark, docs, "").collect()
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in known} == {9001, 9002}
    table = spark.createDataFrame(known, docs.schema).coalesce(2)
    table.write.parquet(f"{tmp_path}/known")
    kept = steps["near_duplicates"](spark, spark.read.parquet(f"{tmp_path}/known"), "").collect()
    want = {i for i, _, c in brute([(r.doc_id, r.text) for r in known], 5, 80, 100) if i == c}
    assert sorted(r.doc_id for r in kept) == sorted(want) and 9003 in want
    assert {tuple(r) for r in kept} <= {tuple(r) for r in known}
    clean = steps["secrets"](spark, spark.createDataFrame(kept, docs.schema), "").collect()
    before = {r.doc_id: r.text for r in kept}
    for r in clean:
        assert not brute_secrets(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[r.doc_id]) == (not brute_secrets(before[r.doc_id])) or "[SECRET]" in r.text
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {r.doc_id: len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean}


def test_empty_table(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_of_repeated_rows_and_null_ids_stays(spark, tmp_path):
    text = "the quick brown fox jumps over the lazy dog"
    spark.createDataFrame([(3, text, 1), (3, text, 1), (None, text, 2), (None, "other words here now then", 3), (None, None, 4), (5, "", 5)], "doc_id long, text string, n int").write.parquet(f"{tmp_path}/d")
    kept = corpus_pipeline.jaccard_join.keep_one(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert sorted((tuple(r) for r in kept), key=str) == sorted([(3, text, 1), (None, "other words here now then", 3), (None, None, 4), (5, "", 5)], key=str)
