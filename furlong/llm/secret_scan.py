"""Secret scans: rule spans plus spans that a pair of character Markov models finds.

Two first-order Markov models over characters are trained from labelled samples, one of random strings
(label 1) and one of ordinary identifiers (label 0). Transition counts are a grouped sum in Spark; the two
log-probability tables have one row and column for each of 66 symbol classes, so what is broadcast never grows.
A candidate (a maximal run of key characters, of any length) is a secret when its log-likelihood ratio
reaches a threshold. Runs too short to reach it with the largest ratio of all in every place are not scored.

Null and empty texts have no spans. Offsets are code points, ends are exclusive. Repeated rows are scanned
alike and all kept. An empty table gives an empty result; with no labelled sample, the models find nothing
and the rule spans stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# The rules and the order of their kinds.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
SYMBOLS = len(ALPHABET)
#: Least log-likelihood ratio of a whole candidate, in nats: odds of about 3,000 to one.
THRESHOLD = 8.0
#: Share of each row of transition probabilities that is spread over all symbols, so that ratios settle as the corpus grows; UNSEEN counts in each cell keep rows of few counts near that.
SPREAD, UNSEEN = 0.05, 0.5
CODES = np.full(256, 255, np.uint8)
CODES[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(SYMBOLS)


def rule_spans(text: str, lowered: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rule matches; matches that are too short are dropped, not searched again."""
    out = []
    if any(w in lowered for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"akia" in lowered:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out


def long_runs(data: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of at least that many bytes of a class, over one buffer."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = member[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def byte_class(characters: str) -> np.ndarray:
    table = np.zeros(256, np.int8)
    table[np.frombuffer(characters.encode(), np.uint8)] = 1
    return table


HEX_BYTES, KEY_BYTES = byte_class("0123456789abcdef"), byte_class(ALPHABET)


def ratios_of(counted: DataFrame) -> np.ndarray:
    """The log-likelihood ratios (symbols x symbols) from rows (label, cell, n); at most 2 x 66 x 66 sums reach the driver."""
    tables = np.zeros((2, SYMBOLS * SYMBOLS))
    for label, cell, n in counted.groupBy("label", "cell").agg(F.sum("n").alias("n")).collect():
        tables[label, cell] = n
    if not (tables.sum(1) > 0).all():
        return np.full((SYMBOLS, SYMBOLS), -np.inf)
    counts = tables.reshape(2, SYMBOLS, SYMBOLS)
    smooth = counts + UNSEEN + SPREAD * counts.mean(2, keepdims=True)
    logs = np.log(smooth / smooth.sum(2, keepdims=True))
    return logs[1] - logs[0]


def add_transitions(table: np.ndarray, data: np.ndarray) -> None:
    """Count the neighbouring symbols of a byte string; other bytes break the chain."""
    codes = CODES[data].astype(np.int64)
    pairs = codes[:-1] * SYMBOLS + codes[1:]
    table += np.bincount(pairs[(codes[:-1] < SYMBOLS) & (codes[1:] < SYMBOLS)], minlength=SYMBOLS * SYMBOLS)


def cell_rows(tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    labels, cells = np.nonzero(tables)
    yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(cells, pa.int32()), pa.array(tables[labels, cells], pa.int64())], ["label", "cell", "n"])


def train(samples: DataFrame, text: str = "text", label: str = "label") -> np.ndarray:
    """Log-likelihood ratios from labelled strings (1 random, 0 ordinary); rows with nulls or other labels are ignored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for batch in batches:
            for kind, string in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                add_transitions(tables[kind], np.frombuffer(string.encode("utf-8", "surrogatepass"), np.uint8))
        yield from cell_rows(tables)

    known = samples.where(F.col(label).isin(0, 1) & F.col(text).isNotNull())
    return ratios_of(known.select(F.col(label).cast("int"), F.col(text).cast("string")).mapInArrow(work, "label int, cell int, n bigint"))


def train_on_corpus(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """train() on the samples that all texts hold: values of assignments and access keys are random strings,
    whole runs of key characters outside the rule spans, as scan() scores them, are ordinary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        for batch in batches:
            ordinary = []
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                spans = rule_spans(text, raw.lower())
                for start, kind, end in spans:
                    value = ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]
                    add_transitions(tables[1], np.frombuffer(value.encode(), np.uint8))
                ordinary.append(raw if not spans else without(text, spans).encode("utf-8", "surrogatepass"))
            if ordinary:
                data = np.frombuffer(b"\n".join(ordinary), np.uint8)
                starts, ends = long_runs(data, HEX_BYTES, 24)
                inside = np.zeros(len(data) + 1, np.int8)
                np.add.at(inside, starts, 1)
                np.add.at(inside, ends, -1)
                add_transitions(tables[0], np.where(np.cumsum(inside[:-1]) > 0, 10, data).astype(np.uint8))
        yield from cell_rows(tables)

    return ratios_of(docs.select(F.col(text_col).cast("string")).mapInArrow(work, "label int, cell int, n bigint"))


def without(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with its spans taken out, a line break in place of each."""
    out, done = [], 0
    for start, _, end in sorted(spans):
        if end > done:
            out.append(text[done : max(start, done)])
            done = end
    return "\n".join([*out, text[done:]])


def scan(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, and spans array<struct<kind:string, start:long, end:long>> sorted by start, then kind.

    Rule spans all stay. A Markov span is a candidate run that overlaps no rule span."""
    small_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(ratios)
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        llr = table.value
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            kinds, starts, ends, offsets = [], [], [], [0]
            for spans in spans_of(texts, llr, threshold):
                for start, kind, end in spans:
                    kinds.append(KINDS[kind])
                    starts.append(start)
                    ends.append(end)
                offsets.append(len(kinds))
            structs = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["kind", "start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)], ["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def spans_of(texts: list[str], llr: np.ndarray, threshold: float = THRESHOLD) -> Iterator[list[tuple[int, int, int]]]:
    """The sorted (start, kind number, end) spans of each text."""
    most = llr.max()  # of one transition
    least = int(np.ceil(threshold / most)) + 1 if most > 0 else None  # characters; no run reaches the threshold if None
    padded = np.zeros((256, 256))  # by bytes; 0 at the ends of a run
    padded[np.ix_(*2 * [np.frombuffer(ALPHABET.encode(), np.uint8)])] = llr
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        spans = rule_spans(text, raw.lower())
        data = np.frombuffer(raw, np.uint8)
        hexes = [x.tolist() for x in long_runs(data, HEX_BYTES, 24)]
        starts, ends = long_runs(data, KEY_BYTES, max(least, 1)) if least else ((), ())
        likely = []
        if len(starts):
            sums = np.add.reduceat(np.append(padded[data[:-1], data[1:]], 0.0), np.stack([starts, ends], 1).ravel()[: -1 if ends[-1] == len(data) else None])[::2]
            at = np.flatnonzero(sums >= threshold)
            likely = list(zip(starts[at].tolist(), ends[at].tolist(), strict=True))
        if hexes[0] or likely:
            before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            spans += [(int(before[a]), 2, int(before[b])) for a, b in zip(*hexes, strict=True)]
            taken = sorted((s, e) for s, _, e in spans)
            i = furthest = 0
            for a, b in likely:
                a, b = int(before[a]), int(before[b])
                while i < len(taken) and taken[i][0] < b:
                    furthest = max(furthest, taken[i][1])
                    i += 1
                if furthest <= a:
                    spans.append((a, 3, b))
        yield sorted(spans)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scan as one flat row per document: counts per rule, a digest of the rule spans, and all spans as text."""
    said = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.transform(F.filter("spans", lambda s: s["kind"] != "markov"), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select(F.col("id").alias(id_col), n("assign"), n("access"), n("hex"), F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"), F.concat_ws(",", said).alias("spans"))


def redact(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", mark: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """docs with every span replaced by a mark, all other columns and all rows kept; texts without spans (null included) are unchanged.

    Overlapping spans become one mark."""
    small_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(ratios)
    at = docs.columns.index(text_col)

    def clean(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        out, done = [], 0
        for start, _, end in spans:
            if start >= done:
                out += [text[done:start], mark]
            done = max(done, end)
        return "".join([*out, text[done:]]) if spans else text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            cleaned = [clean(t, s) for t, s in zip(texts, spans_of([t or "" for t in texts], table.value, threshold), strict=True)]
            columns = batch.columns
            columns[at] = pa.array(cleaned, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(work, docs.schema)
