import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from furlong.llm import bpe_codec as B

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["th", "er", "on", "é", "ß", "ing", "a", "'s", "7", "!"]) for _ in range(rng.randint(1, 4)))
    passage = lambda n: "".join(word() + rng.choice([" ", " ", " ", "\n", "  ", ", "]) for _ in range(n))
    shared = [passage(400) for _ in range(3)]
    out = [None, "", " ", "a", "<|endoftext|>", "x" * 9000, "é" * 5000, "İ \x1cΣας ﬁ ＡＢ é 😀 " * 30]
    for _ in range(30):
        out.append(passage(rng.randint(1, 80)) + "".join(rng.choice(shared)[rng.randint(0, 50) :] + word() for _ in range(rng.randint(0, 3))) + passage(20))
    return out + out[-5:] + [shared[0].strip().replace(" ", "")] * 3


@pytest.mark.parametrize("shared", [B.SHARED, 0])
def test_equals_the_library(spark, shared):
    tok = Tokenizer.from_file(PATH)
    said = texts()
    docs = spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(said)], "doc_id long, text string, n_tokens string").repartition(3)
    rows = B.code(docs, PATH, shared=shared).collect()
    assert len(rows) == len(said)
    for r in rows:
        ids = tok.encode(said[r.doc_id or 0] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_shared_passages_give_shared_chunks(spark):
    said = [t for t in texts() if t]
    docs = spark.createDataFrame([(t,) for t in said], "text string")
    assert len(B.shared_hashes(docs, 1 << 20)) > 10
    for t in said:
        assert b"".join(c for _, c in B.chunks_of(t)).decode() == t
        assert all(len(c) <= B.MOST for _, c in B.chunks_of(t))
    shared = B.Shared(B.shared_hashes(docs, 1 << 20), B.unit_encoder(PATH))
    assert any(len(shared.split(t)) > 3 for t in said) and all("".join(x for _, x in shared.split(t)) == t for t in said)


def test_empty_table(spark):
    assert B.code(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
