"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the hashed n-grams (2 to 4 letters, runs of other characters count as one space) of every labelled
text per language in numpy, sums them in Spark by language and slab of buckets, and gives one matrix of
log-probabilities (BUCKETS + 1 rows, a column for each language), which is broadcast. Scoring gathers the rows of the
n-grams that a batch of texts holds and sums them by text, so only those entries are touched.

A text that is null or holds no letter is `und` with score 0, and so is every text if no row is labelled. A text whose
n-grams are unknown gets the most frequent language. Ties go to the first language in alphabetical order. Whole texts
are read, long ones in slices that carry their last letters over. Null ids and repeated rows are kept.
At most MAX_LANGUAGES labels are allowed; more raise ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BITS, ORDERS, SLABS = 16, (2, 3, 4), 128
BUCKETS = 1 << BITS
MAX_LANGUAGES = 1000
SMOOTHING = 0.5
#: Characters that are handled at once.
SPAN = 1 << 18
PAD = max(ORDERS) - 1
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter; made once in each worker process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


class Grams:
    """The hashed n-grams of some lower-case texts laid end to end: a bucket for each order and first position, BUCKETS where a window leaves its text.

    carried: how many first characters of each text have been counted before; windows that end in them are not counted again."""

    def __init__(self, texts: list[str], carried: list[int] | None = None):
        gap = "\0" * PAD
        flat = np.frombuffer((gap.join(texts) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters()[flat]
        inside = flat != 0
        fresh = inside.copy()
        at = 0
        for text, n in zip(texts, carried or (), strict=False):
            fresh[at : at + n] = False
            at += len(text) + PAD
        before = np.concatenate([[False], letter[:-1]])
        keep = letter | before | ~inside  # the first of each run of other characters, and the gaps
        codes = np.where(letter, flat, 32)[keep].astype(np.uint32)
        inside, fresh, self.letter = inside[keep], fresh[keep], letter[keep]
        ends = np.flatnonzero(~inside)[PAD - 1 :: PAD] + 1
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.orders = []
        h, valid = codes * np.uint32(0x9E3779B1), inside
        for n in range(2, max(ORDERS) + 1):
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[n - 1 :] * np.uint32(0xC2B2AE3D)
            valid = valid[:-1] & inside[n - 1 :]
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F)
                self.orders.append(np.where(valid & fresh[n - 1 :], mixed >> np.uint32(32 - BITS), BUCKETS))


def slices(texts: list[str]) -> Iterator[tuple[list[int], Grams]]:
    """Rows and the n-grams of their texts in groups of about SPAN characters; longer texts come in parts."""
    rows, group, carried, held = [], [], [], 0
    for i, text in enumerate(texts):
        text = text.replace("\0", " ").lower()
        if len(text) > SPAN:  # single spaces, so that a part needs no more than the last characters of the one before
            text = " ".join("".join([c if c.isalpha() else " " for c in text]).split())
        for at in range(0, max(1, len(text)), SPAN):
            first = max(0, at - PAD - 1)
            part = text[first : at + SPAN]
            if held and held + len(part) > SPAN:
                yield rows, Grams(group, carried)
                rows, group, carried, held = [], [], [], 0
            rows.append(i)
            group.append(part)
            carried.append(at - first)
            held += len(part) + PAD
    if rows:
        yield rows, Grams(group, carried)


def counted(train: DataFrame) -> DataFrame:
    """(lang, slab, counts as int64 bytes) of the texts in train(lang, text)."""
    width = BUCKETS // SLABS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for rows, grams in slices(batch.column(1).to_pylist()):
                for lang in {langs[r] for r in rows}:
                    mine = np.array([langs[r] == lang for r in rows])
                    sizes = np.diff(np.append(grams.starts, len(grams.letter)))
                    chosen = np.repeat(mine, sizes)
                    total = totals.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                    for bucket in grams.orders:
                        total += np.bincount(bucket[chosen[: len(bucket)]], minlength=BUCKETS + 1)
        for lang, total in totals.items():
            slabs = [total[k * width : (k + 1) * width].tobytes() for k in range(SLABS)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * SLABS), pa.array(range(SLABS), pa.int32()), pa.array(slabs, pa.binary())], ["lang", "slab", "counts"])

    def add(key: tuple, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width, np.int64)
        for frame in rows:
            for counts in frame["counts"]:
                total += np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"lang": [key[0]], "slab": [key[1]], "counts": [total.tobytes()]})

    return train.mapInArrow(work, "lang string, slab int, counts binary").groupBy("lang", "slab").applyInPandas(add, "lang string, slab int, counts binary")


class Model:
    """Languages, log priors, and the log-probability matrix; its size depends on the number of languages alone."""

    def __init__(self, langs: list[str], priors: np.ndarray, matrix: np.ndarray):
        self.langs, self.priors, self.matrix = langs, priors, matrix

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its posterior probability."""
        known = np.zeros((len(texts), len(self.langs)), np.float64)
        has_letter = np.zeros(len(texts), bool)
        for rows, grams in slices([t or "" for t in texts]):
            np.logical_or.at(has_letter, rows, np.logical_or.reduceat(grams.letter, grams.starts))
            if self.langs:
                for bucket in grams.orders:
                    padded = np.concatenate([bucket, np.full(len(grams.letter) - len(bucket), BUCKETS)])
                    np.add.at(known, rows, np.add.reduceat(self.matrix[padded], grams.starts, 0, np.float64))
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        joint = known + self.priors
        best = joint.argmax(1)
        weights = np.exp(joint - joint.max(1, keepdims=True))
        score = weights.max(1) / weights.sum(1)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)], np.where(has_letter, score, 0.0)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all rows whose text and language are not null."""
    small_batches(docs.sparkSession)
    train = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(sizes)
    matrix = np.zeros((BUCKETS + 1, len(langs)), np.float32)
    counts = np.zeros((BUCKETS, len(langs)))
    width = BUCKETS // SLABS
    for row in counted(train).collect():  # SLABS rows a language
        counts[row["slab"] * width : (row["slab"] + 1) * width, langs.index(row["lang"])] = np.frombuffer(row["counts"], np.int64)
    if langs:
        matrix[:BUCKETS] = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS))
    priors = np.log(np.array([sizes[x] for x in langs], float) / max(1, sum(sizes.values())))
    return Model(langs, priors, matrix)


def is_held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose language is found with a score of at least `least`; `und` rows go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = shared.value.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array((np.array(lang, object) != "und") & (score >= least), pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
