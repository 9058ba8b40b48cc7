import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from furlong.llm import token_count as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "a", "a ", " a", "a  b", "a   b\n\n c", "\n \nb", "x\t  y", "don't we'll I'M 'tis", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "é ß x y　z",
    "1234 ½²x", "\x1c\x1d a\x85b", "😀 emoji 😀😀", "ꟁ exotic", "é combining", "word " * 30_000, "x" * 50_000, "\u0000nul \u0000",
]


def fuzz(n=150):
    rng = random.Random(5)
    return ["".join(rng.choice(["a", "the", " ", " ", "\n", "'", "s", "7", "!", "\t", "é", " ", "<|endoftext|>", "X", "_"]) for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("hot", [0, 5, 100_000])
def test_equals_the_library(spark, hot):
    texts = ODD + fuzz()
    tok = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(i or None, t, 1) for i, t in enumerate(texts)] + [(7, texts[7], 2)], "doc_id long, text string, n_tokens int")
    out = T.count_tokens(docs, PATH, 5, hot=hot).collect()
    assert len(out) == len(texts) + 1
    for row in out:
        text = texts[row.doc_id or 0] or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 5), text[:50]


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, 5).count() == 0
