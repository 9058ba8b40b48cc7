import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from furlong.llm import piece_codec as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b  ", "▁a", "a▁▁ b", "　x", "ﬁ", "é", "\0", "x\0y", "😀😀", "<s>a</s>", "<0x41>", "<unk>", "\n\n", "a\n b \n", "ΑΒ", "日本語のテキスト", "'s don't",
    "a" * 50_000, "ab" * 20_000, "\n" * 500, " " * 500, " " * 20 + "x", "word " * 20_000, "ÉÈ" * 400,
]


def texts():
    rng = random.Random(2)
    pool = [p.replace("▁", " ") for p in P.merges(PATH).names[259:]]
    spelled = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(800)]
    return ODD + spelled + ["".join(rng.choice("aeiouthnsr .,") for _ in range(rng.randint(1, 80))) for _ in range(800)]


def test_equals_the_library(spark):
    said = texts()
    docs = spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(said)] + [(4, said[4], "y")], "doc_id long, text string, ids string").repartition(3)
    rows = P.code(docs, PATH).collect()
    assert len(rows) == len(said) + 1
    for r in rows:
        ids = LIBRARY.encode(said[r.doc_id or 0] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_ids_and_back(spark):
    said = texts()[:100]
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    coded = P.encode(docs, PATH)
    assert {r.doc_id: r.ids for r in coded.collect()} == {i: LIBRARY.encode(t or "") for i, t in enumerate(said)}
    assert {r.doc_id: r.text for r in P.decode(coded, PATH).collect()} == {i: LIBRARY.decode(LIBRARY.encode(t or "")) for i, t in enumerate(said)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 270) | st.just(28_705), max_size=8))
def test_decodes_any_ids(ids):
    assert P.merges(PATH).decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_encodes_any_text(text):
    n, ids, back = P.Coder(PATH).code(text)
    want = LIBRARY.encode(text)
    assert ([int(i) for i in ids.split(",") if i], n, back) == (want, len(want), LIBRARY.decode(want))


def test_steps_back_and_never_tries_a_failed_place_twice():
    model = P.merges(PATH)
    word = "▁" + "ciónoradoundsche" * 2000
    met = []
    fit, model.fit = model.fit, lambda a, b: met.append((a, b)) or fit(a, b)
    try:
        assert model.encode(word) == LIBRARY.encode(word[1:])
    finally:
        model.fit = fit
    assert len(met) < 3 * len(word)
    assert not model.fit(*[model.ids[x] for x in ("▁a", "n")]) and "▁an" in model.ids


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "MEMO", 5)
    memo = P.Memo(str.upper)
    assert [memo[c] for c in "abcdefghabca"] == list("ABCDEFGHABCA") and len(memo) <= 5 and len(memo.old) <= 5
    assert memo["x" * 65] == "X" * 65 and len(memo) <= 5


def test_other_models_raise(tmp_path):
    with pytest.raises(Exception):
        P.Merges(str(tmp_path / "none.model"))


def test_empty_table(spark):
    assert P.code(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
