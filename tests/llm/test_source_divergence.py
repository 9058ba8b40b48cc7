import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from furlong.llm import source_divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall(lowered(text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if df[w] >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        sources = sorted({d[1] for d in mine})
        p = {s: share(counts[s]) for s in sources}
        q = share(sum((counts[s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


def corpus():
    rng = random.Random(8)
    words = ["the", "Of", "straße", "Ünder", "naïve", "x1y", "rare", "日本", "a", "B", "état", "ÉTAT", "end"]
    rows = []
    for i in range(300):
        lang, source = rng.choice(["en", "en", "en", "de", None, "", "xx"]), rng.choice(["s1", "s2", "S3", None, "", f"t{rng.randint(0, 4)}"])
        some = words if lang != "de" else words[:6]
        rows.append((rng.choice([" ", "-", "\n", "9"]).join(rng.choice(some) for _ in range(rng.randint(0, 12))), lang, source))
    rows += [(None, "en", "only null"), ("", "zz", "a"), ("unique words alone", "zz", "b"), ("the " * 20_000, "en", "long"), ("12 34", "en", "digits")] + [("the the of", "en", "s1")] * 5
    return rows


@pytest.mark.parametrize("most, terms, sources", [(5_000_000, 4096, 64), (1, 3, 2), (4, 5, 3)])
def test_equals_brute_force(spark, monkeypatch, most, terms, sources):
    rows = corpus()
    monkeypatch.setattr(D, "ENTRIES", 500 if sources < 64 else 1 << 22)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int").repartition(3)
    out = D.audit(docs, least_docs=8, top=4, most_terms=most, terms=terms, sources=sources)
    assert out.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(tuple(r) for r in out.collect()) == by_hand(rows, 8, 4)


def test_terms_of_touching_texts():
    rng = random.Random(1)
    for _ in range(200):
        texts = ["".join(rng.choice("aZ é9_日\0[") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 7))]
        whole = pa.array(["skipped", *texts], pa.string())
        assert D.terms_of(whole.slice(1)).to_pylist() == [[*TERM.findall(lowered(t)), ""] for t in texts]


def test_empty_table_and_too_few_documents(spark):
    schema = "text string, lang string, source string"
    assert D.audit(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([("a b", "en", "s"), ("a c", "en", "t")], schema)
    assert sorted(tuple(r) for r in D.audit(few).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
