"""Source divergence audit: how far the term distributions of a language's sources lie apart, and which terms set each source apart.

Each language gets a CountVectorizer of its own, with a least number of documents for a term and the largest vocabulary size there is, so
its sparse document vectors are exact counts. They are summed by source and term, as a Summarizer would sum them but over
the non-zero entries alone and in whole numbers. Distances of sources come from those sums: a task gets a block of terms
and two blocks of sources, fills in what a source has for terms it lacks, and gives partial distances, which are added up; terms
that no source of two blocks has are added in closed form. All arithmetic is on whole numbers.

A vocabulary passes through the driver, as CountVectorizer has it. A kept term has at least least_docs tokens, which bounds it; where a language has
so many tokens that this bound exceeds MOST_TERMS, its terms are dealt by hash to several vectorizers, one after the other, so many
that each holds about that number of distinct terms at most.

Null texts, languages and sources are empty strings. Texts without terms count as documents of their group. Languages with too few documents or
terms keep none: their pairs have value 0. An empty table gives an empty result. One fit is run for each language that has enough documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, small_batches, stage

#: Terms of one vectorizer; terms and sources of a block; entries of vectors that a task adds up at a time.
MOST_TERMS, TERMS, SOURCES, ENTRIES = 5_000_000, 4096, 64, 1 << 22
SCALE, PRIOR = 1_000_000_000, 5
#: What each byte of a term becomes: A-Z lower case, zero for what ends a term, others (letters, and all bytes beyond ASCII) themselves.
FOLDED = np.array([0 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b <= 0x5A else b for b in range(256)], np.uint8)


def terms_of(texts: pa.Array) -> pa.ListArray:
    """The terms of each text in order, and an empty string behind them, which stands for the document itself. texts: a string array without nulls."""
    n, _, raw = len(texts), *texts.buffers()[:2]
    data = texts.buffers()[2]
    offsets = np.frombuffer(raw, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    folded = FOLDED[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    inside = folded != 0
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(folded))]  # two texts may touch
    starts[borders] |= inside[borders]
    ends[borders - 1] |= inside[borders - 1]
    first = np.flatnonzero(starts)
    lengths = np.flatnonzero(ends) + 1 - first
    before = np.searchsorted(first, offsets)  # terms before each text
    ends_of = np.insert(np.cumsum(lengths), before[1:], np.append(0, np.cumsum(lengths))[before[1:]])  # where each string ends, the empty ones included
    values = pa.Array.from_buffers(pa.string(), len(ends_of), [None, pa.py_buffer(np.append(0, ends_of).astype(np.int32)), pa.py_buffer(folded[inside])])
    return pa.ListArray.from_arrays(pa.array(before + np.arange(n + 1), pa.int32()), values)


def tokenised(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, terms, n_terms) of every document; terms has an empty one more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = terms_of(batch.column(2).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, pa.array(terms.value_lengths().to_numpy() - 1, pa.int32())], ["lang", "source", "terms", "n_terms"])

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text")).mapInArrow(work, "lang string, source string, terms array<string>, n_terms int")


def group_counts(rows: DataFrame, lang: str, least_docs: int, share: int, shares: int, first: int) -> tuple[DataFrame, int]:
    """(lang, source, at, term, n) of one language and one share of its terms: n occurrences of the term in the source; and how many
    terms there are. at numbers terms from first on. The empty term counts documents, so no vocabulary is empty."""
    if shares > 1:
        rows = rows.withColumn("terms", F.filter("terms", lambda t: (t == "") | (F.pmod(F.xxhash64(t), F.lit(shares)) == share)))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least_docs), vocabSize=2**31 - 1).fit(rows)
    vectors = model.transform(rows).select("source", F.unwrap_udt("vector").alias("v")).select("source", "v.indices", "v.values")
    sums = vectors.mapInArrow(added, "source string, i int, n bigint").groupBy("source", "i").agg(F.sum("n").alias("n"))
    words = model.vocabulary
    names = rows.sparkSession.createDataFrame(pa.table({"i": pa.array(range(len(words)), pa.int32()), "term": pa.array(words, pa.string())}))
    return sums.join(names, "i").select(F.lit(lang).alias("lang"), "source", (F.col("i") + F.lit(first).cast("bigint")).alias("at"), "term", "n"), len(words)


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source, i, n) of rows (source, indices, values), summed over ENTRIES entries or little more at a time."""
    names: dict[str, int] = {}
    keys, values, held = [], [], 0

    def out() -> pa.RecordBatch:
        cells, where = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(where, np.concatenate(values)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()).take(pa.array(cells >> 32)), pa.array((cells & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], ["source", "i", "n"])

    for batch in batches:
        sources = np.array([names.setdefault(x, len(names)) for x in batch.column(0).to_pylist()], np.int64)
        keys.append(np.repeat(sources, batch.column(1).value_lengths().to_numpy(zero_copy_only=False)) << 32 | batch.column(1).flatten().to_numpy())
        values.append(batch.column(2).flatten().to_numpy())
        held += len(keys[-1])
        if held >= ENTRIES:
            yield out()
            names.clear()
            keys, values, held = [], [], 0
    if keys:
        yield out()


def share_of(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + PRIOR) / (total + PRIOR terms)); null where there are no terms."""
    return F.call_function("div", F.lit(SCALE).cast("bigint") * (n + PRIOR), F.nullif(total + PRIOR * terms, F.lit(0).cast("bigint"))) + 1


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", most_terms: int = MOST_TERMS, terms: int = TERMS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part (pair, term), item (other source, term), value, rank (by value, then item).

    pair: the summed differences to every other source of the language. term: the `top` terms with the largest excess over the whole language."""
    spark = docs.sparkSession
    small_batches(spark)
    tokens = stage(tokenised(docs, text_col, lang_col, source_col).withColumn("folder", F.sha1("lang")), "tokens", "folder")  # each fit reads its language alone
    groups = stage(tokens.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_terms").alias("tokens")), "groups")
    counted, sizes = [], []
    for row in groups.groupBy("lang").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where(F.col("docs") >= least_docs).orderBy("lang").collect():
        rows, shares, first = tokens.where(F.col("folder") == hashlib.sha1(row["lang"].encode()).hexdigest()).select("source", "terms"), 1, 0
        if row["tokens"] > least_docs * most_terms:
            distinct = rows.select(F.explode("terms").alias("term")).agg(F.approx_count_distinct("term", 0.02)).first()[0]
            shares = -(-distinct // most_terms)
        for share in range(shares):
            counts, n = group_counts(rows, row["lang"], least_docs, share, shares, first)
            counted.append(counts)
            first += n
        sizes.append((row["lang"], first, first - shares))
    none = spark.createDataFrame([], "lang string, source string, at bigint, term string, n bigint")
    counts = stage(reduce(DataFrame.unionByName, counted, none).where("term <> ''"), "counts")
    drop(tokens)
    langs = spark.createDataFrame(sizes, "lang string, n_at bigint, n_terms bigint")  # one row for each fit
    known = groups.select("lang", "source").join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    stats = known.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("n_at", F.lit(0)).alias("n_at"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"), place.alias("s"))
    stats = stage(stats.withColumn("none", share_of(F.lit(0).cast("bigint"), F.col("total"), F.col("n_terms"))), "stats")
    by_group = counts.join(stats, ["lang", "source"]).withColumn("p", share_of(F.col("n"), F.col("total"), F.col("n_terms")))
    return pair_part(by_group, stats, terms, sources).unionByName(term_part(by_group, counts, stats, top))


def term_part(by_group: DataFrame, counts: DataFrame, stats: DataFrame, top: int) -> DataFrame:
    """The terms of each group with the largest excess of its share over the language's."""
    whole = stats.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("n_terms").alias("lang_terms"))
    shares = counts.groupBy("lang", "at").agg(F.sum("n").alias("lang_n")).join(whole, "lang").select("lang", "at", share_of(F.col("lang_n"), F.col("lang_total"), F.col("lang_terms")).alias("q"))
    excess = by_group.join(shares, ["lang", "at"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return ranked(excess).where(F.col("rank") <= top)


def pair_part(by_group: DataFrame, stats: DataFrame, terms: int, sources: int) -> DataFrame:
    """The distance of each two sources of a language, both ways."""
    blocks = F.floor((F.max("s").over(Window.partitionBy("lang")) / sources)) + 1
    own = F.floor(F.col("s") / sources)
    placed = stats.withColumn("n_blocks", blocks).withColumn("home", own)
    each_pair = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)).alias("other")
    sides = [F.least("home", "other").alias("a"), F.greatest("home", "other").alias("b")]
    # what a source has for a term it lacks goes to each block of terms
    heads = placed.where("n_terms > 0").select("lang", "s", "home", F.lit(-1).cast("bigint").alias("at"), F.col("none").alias("p"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_at") - 1) / terms))).alias("block"), "n_blocks")
    entries = by_group.join(placed.select("lang", "source", "home", "n_blocks"), ["lang", "source"]).select("lang", "s", "home", "at", "p", F.floor(F.col("at") / terms).alias("block"), "n_blocks")
    dealt = heads.unionByName(entries).select("lang", "s", "at", "p", "block", "home", each_pair).select("lang", "s", "at", "p", "block", *sides)

    def distances(key: tuple, rows: pa.Table) -> pa.Table:
        s, at, p = (rows.column(c).to_numpy() for c in ("s", "at", "p"))
        head = at < 0
        who, first = np.unique(s[head], return_index=True)
        columns, where = np.unique(at[~head], return_inverse=True)
        table = np.repeat(p[head][first][:, None], len(columns), 1)
        table[np.searchsorted(who, s[~head]), where] = p[~head]
        home = who // sources
        left, right = np.flatnonzero(home == key[2].as_py()), np.flatnonzero(home == key[3].as_py())
        out = []
        for i in left.tolist():
            others = right[right > i]
            out.append((np.full(len(others), who[i]), who[others], np.abs(table[others] - table[i]).sum(1)))
        a, b, d = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "s": a, "t": b, "apart": d, "seen": np.full(len(a), len(columns))})

    parts = dealt.groupBy("lang", "block", "a", "b").applyInArrow(distances, "lang string, s bigint, t bigint, apart bigint, seen bigint")
    summed = parts.groupBy("lang", "s", "t").agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen"))
    side = lambda s, name, none: stats.select("lang", F.col("s").alias(s), F.col("source").alias(name), F.col("none").alias(none), F.col("n_terms").alias(f"{s}_terms"))
    pairs = side("s", "source", "none_s").join(side("t", "item", "none_t"), "lang").where("s < t").join(summed, ["lang", "s", "t"], "left")
    rest = (F.col("s_terms") - F.coalesce("seen", F.lit(0))) * F.coalesce(F.abs(F.col("none_s") - F.col("none_t")), F.lit(0))
    both = pairs.select("lang", (F.coalesce("apart", F.lit(0)) + rest).alias("value"), F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"))
    return ranked(both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value"))


def ranked(rows: DataFrame) -> DataFrame:
    """rows with their rank in their group, by value from the top, then item."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 30),
g AS (SELECT DISTINCT lang, source FROM d), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
z AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source)::BIGINT AS total, v FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v) AS p, 1 + (1000000000 * (sum(n) OVER (PARTITION BY lang, term)::BIGINT + 5)) // (sum(n) OVER (PARTITION BY lang)::BIGINT + 5 * v) AS q FROM z),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT s.lang, s.source, t.source AS item, sum(abs(s.p - t.p)) AS value FROM p s JOIN p t ON s.lang = t.lang AND s.term = t.term AND s.source <> t.source GROUP BY ALL) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM pair UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
"""
