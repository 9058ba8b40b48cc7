import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from furlong.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(counts, capacity, patterns):
    got = Counter()
    for contents, times in patterns:
        assert sum(contents) <= capacity and times > 0
        for x in contents:
            got[x] += times
    assert got == Counter(counts)
    return sum(t for _, t in patterns)


def fewest(items, capacity):
    """Brute force over all ways to fill bins."""
    best = [len(items)]

    def go(left, bins, used):
        if used >= best[0]:
            return
        if not left:
            best[0] = used
            return
        x, rest = left[0], left[1:]
        for i in range(len(bins)):
            if bins[i] + x <= capacity and bins[i] not in bins[:i]:
                go(rest, [*bins[:i], bins[i] + x, *bins[i + 1 :]], used)
        go(rest, [*bins, x], used + 1)

    go(sorted(items, reverse=True), [], 0)
    return best[0]


def test_small_cases_are_optimal():
    rng = random.Random(2)
    for _ in range(60):
        items = [rng.randint(1, 20) for _ in range(rng.randint(0, 9))]
        counts = Counter(items)
        assert check(counts, 20, P.pack_counts(counts, 20)) == fewest(items, 20)
    hard = Counter([11, 11, 9, 9, 6, 6, 5, 5, 4, 4, 5, 5])  # full bins exist
    assert check(hard, 20, P.pack_counts(hard, 20)) == 4


def planted(n, parts, low, seed):
    """Pieces that fill n sequences of 2048, each cut into some parts of at least `low` tokens."""
    rng, out = random.Random(seed), Counter()
    for _ in range(n):
        cuts = sorted(rng.sample(range(2048 - parts * low), parts - 1))
        out.update(b - a + low for a, b in zip([0, *cuts], [*cuts, 2048 - parts * low], strict=True))
    return out


def test_planted_sequences_are_nearly_found():
    for n, parts, low in [(300, 3, 513), (300, 3, 1), (200, 4, 1), (100, 4, 400)]:
        counts = planted(n, parts, low, parts)
        assert n <= check(counts, 2048, P.pack_counts(counts, 2048)) <= n * 103 // 100  # the last one is not solved: 103


def test_fullest_filling_is_that_of_all_subsets():
    rng = random.Random(4)
    for _ in range(200):
        counts = Counter(rng.randint(1, 40) for _ in range(rng.randint(0, 8)))
        gap = rng.randint(0, 90)
        got = P.fullest(counts, sorted(counts), gap)
        sums = {0}
        for x in counts.elements():
            sums |= {s + x for s in sums}
        assert sum(got) == max(s for s in sums if s <= gap) and not Counter(got) - counts


def test_large_counts_reach_the_lower_bound():
    rng = random.Random(3)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(200_000))
    counts[2048] += 100_000
    patterns = P.pack_counts(counts, 2048)
    assert check(counts, 2048, patterns) <= P.lower_bound(counts, 2048) + 1
    assert len(patterns) < 8192


def test_pieces_hold_the_library_ids(spark):
    tok = Tokenizer.from_file(PATH)
    texts = [None, "", "Hello, world's  end", "é ß<|endoftext|> x\x1cy", "İ 😀 don't", "word, " * 700, "a " * 4096 + "b"] + ["same text here"] * 40
    docs = spark.createDataFrame([(i or None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, length int").repartition(3)
    rows = P.pack(docs, PATH, 512).collect()
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id or 0].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces] == [(k, s, len(ids[s : s + 512]), zlib.crc32(ids[s : s + 512].tobytes())) for k, s in enumerate(range(0, len(ids), 512))]
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) == P.lower_bound(Counter(r.length for r in rows), 512)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_ids_of_texts_with_any_white_space_and_repeated_words():
    import array

    import public_tokenizers
    import pyarrow as pa

    from furlong.llm import packing
    from furlong.llm.common import tokenizer
    from furlong.llm.word_units import UnitEncoder

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = ["", None, " ", "One one ONE, one. it's IT'S a1b22", "x y　z\x85w\xa0v", "\n\tÀ à Ⱥ ⱥ İ ǅ <|endoftext|> a<|b|>c ***&&& “quoted” 日本語", "one " * 3000]
    odd = ["a\x1cb c\x1dd", "one\x1f two", None, ""]
    for texts in (plain, odd, plain + odd, [None], []):
        encoder = UnitEncoder(path, lambda ids: array.array("I", ids).tobytes(), b"".join)
        for _ in range(2):
            got = [array.array("I", b).tolist() for b in packing.ids_of(pa.array(texts, pa.string()), encoder)]
            assert got == [tokenizer(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [array.array("I", b).tolist() for b in packing.ids_of(pa.array([*plain, *odd], pa.string()).slice(3, 4), encoder)] == [tokenizer(path).encode(t or "", add_special_tokens=False).ids for t in plain[3:]]
