"""BPE encoding and decoding of whole texts with content-defined chunk reuse.

A rolling hash over 16 bytes cuts every text into chunks of about CHUNK bytes, so passages that documents share
give the same chunks wherever they stand. Chunks that occur more than once are encoded once, for all documents,
and joined back by hash; the rest of a text is encoded in place. A chunk may begin or end inside a word, so only
its core is reused: the words at its joins are re-encoded with their neighbours from the text itself, in windows that
grow until the core's ids agree with those of the chunk within the longer window.
At most SHARED chunk hashes are broadcast, the most frequent ones; chunks beyond that are encoded in place,
which changes no result.

Null and empty texts have no tokens and decode to the empty string. Null ids and repeated rows are kept, one result
row for each input row.
"""

from __future__ import annotations

import array
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_frequency, row_numbers, small_batches, stage, tokenizer
from .word_units import WHITE, UnitEncoder, units_of

#: Mean bytes of a chunk (the upper eight of the hash's 16 bits are zero at a cut), least and most bytes, and the bound of the broadcast hashes.
CHUNK, LEAST, MOST, SHARED = 256, 64, 4096, 1 << 20
#: Units that a worker remembers a generation; a unit's four renderings take some half a kilobyte.
MEMO = 60_000
GEAR = np.random.default_rng(16).integers(0, 1 << 16, 256, np.uint16)
FIRST_WHITE = regex.compile(f"[{WHITE}]")
LAST_WHITE = regex.compile(f"[{WHITE}](?=[^{WHITE}]*\\Z)")


def boundaries(data: np.ndarray) -> np.ndarray:
    """Offsets at which the bytes of a text are cut, 0 and the end included; never inside a character."""
    if len(data) < 2 * LEAST:
        return np.array([0, len(data)])
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # h[i] then depends on the 16 bytes that end there
        h[k:] += h[:-k] << np.uint16(k)
    at = np.flatnonzero(h >> np.uint16(8) == 0) + 1
    at = at[at < len(data)]
    at = at[(data[at] & 0xC0) != 0x80]
    cuts, last = [0], 0
    for cut in at.tolist():
        if cut - last >= LEAST:
            while cut - last > MOST:
                last = char_start(data, last + MOST)
                cuts.append(last)
            if cut > last:
                cuts.append(cut)
                last = cut
    while len(data) - last > MOST:
        last = char_start(data, last + MOST)
        cuts.append(last)
    return np.array([*cuts, len(data)])


def char_start(data: np.ndarray, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def chunk_hash(chunk: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)


def chunks_of(text: str) -> Iterator[tuple[int, bytes]]:
    raw = text.encode()
    cuts = boundaries(np.frombuffer(raw, np.uint8)).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        chunk = raw[a:b]
        yield chunk_hash(chunk), chunk


def core(chunk: str, encoder: UnitEncoder) -> tuple[int, int] | None:
    """Where the reusable core of a chunk begins and ends: at white space, moved inwards until the library's ids of a window across it
    are those of its two sides encoded apart. None if there is no such core."""

    def apart(left: str, right: str) -> bool:
        words = units_of(left), units_of(right)
        ids = b"".join([encoder.units[u][3] for w in words for u in w])
        return array.array("H", ids).tolist() == encoder.encode(left + right)

    first, last = FIRST_WHITE.search(chunk), LAST_WHITE.search(chunk)
    a, b = (first.start(), last.start()) if first else (0, 0)
    while a < b and not apart(chunk[:a], chunk[a : min(b, a + 24)]):
        following = FIRST_WHITE.search(chunk, a + 1)
        a = following.start() if following else b
    while a < b and not apart(chunk[max(a, b - 24) : b], chunk[b:]):
        before = LAST_WHITE.search(chunk, 0, b)
        b = before.start() if before else a
    return (a, b) if a < b else None


def shared_hashes(docs: DataFrame, most: int) -> np.ndarray:
    """Sorted hashes of the chunks that occur more than once in the corpus, the most frequent `most` at the utmost."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [h for text in batch.column(0).to_pylist() for h, _ in chunks_of(text)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64())], ["hash"])

    counts = docs.select("text").where(F.length("text") > 0).mapInArrow(work, "hash bigint").groupBy("hash").count().where("count > 1")
    counts = stage(counts, "chunks")
    least = least_frequency(counts, "count", most)
    if least is None:
        return np.zeros(0, np.int64)
    found = counts.where(F.col("count") >= least).select("hash").toArrow().column(0).to_numpy()
    return np.sort(found)


class Shared:
    """Membership of hashes in a sorted array, and the cores that this worker has found (at most 50,000)."""

    def __init__(self, hashes: np.ndarray, encoder: UnitEncoder):
        self.hashes, self.encoder = hashes, encoder
        self.cores: dict[int, tuple[int, int] | None] = {}

    def core(self, key: int, chunk: bytes) -> tuple[int, int] | None:
        if key not in self.cores:
            if len(self.cores) >= 50_000:
                self.cores.clear()
            self.cores[key] = core(chunk.decode(), self.encoder)
        return self.cores[key]

    def split(self, text: str) -> list[tuple[int | None, str]]:
        """The text as runs: (hash, core text) of shared chunks, (None, text) of what lies between."""
        if not len(self.hashes):
            return [(None, text)]
        found = list(chunks_of(text))
        keys = np.array([k for k, _ in found], np.int64)
        at = np.searchsorted(self.hashes, keys)
        member = self.hashes[np.minimum(at, len(self.hashes) - 1)] == keys
        if not member.any():
            return [(None, text)]
        runs, own = [], []
        for (key, chunk), shared in zip(found, member.tolist(), strict=True):
            where = self.core(key, chunk) if shared else None
            piece = chunk.decode()
            if where is None:
                own.append(piece)
                continue
            a, b = where
            runs += [(None, "".join([*own, piece[:a]])), (key, piece[a:b])]
            own = [piece[b:]]
        return [*runs, (None, "".join(own))]


def code(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shared: int = SHARED) -> DataFrame:
    """Per row of docs: id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (of the decoded text)."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    hashes = docs.sparkSession.sparkContext.broadcast(shared_hashes(docs, shared))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(path)
        shared, numbers = Shared(hashes.value, encoder), row_numbers()
        sent: set[int] = set()
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                runs = [shared.split(t or "") for t in texts[at : at + 500]]
                words = [[None if k is not None else units_of(t) for k, t in r] for r in runs]
                encoder.renew()
                units = encoder.units
                for r, w in zip(runs, words, strict=True):
                    if len(r) == 1:
                        rows.append((next(numbers), *digests(list(map(units.__getitem__, w[0]))), []))
                        continue
                    parts = []
                    for (key, text), own in zip(r, w, strict=True):
                        if key is None:
                            parts.append((None, b"".join([units[u][3] for u in own]), None))
                        else:
                            if len(sent) >= 200_000:
                                sent.clear()
                            parts.append((key, None, None if key in sent else text))
                            sent.add(key)
                    rows.append((next(numbers), None, None, None, parts))
            row, n, ids, decoded, parts = (list(c) for c in zip(*rows, strict=True)) if rows else [[]] * 5
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]) if parts else [0]
            flat = list(zip(*(x for p in parts for x in p), strict=True)) or [[], [], []]
            structs = pa.StructArray.from_arrays([pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.binary()), pa.array(flat[2], pa.string())], ["hash", "ids", "text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)],
                ["row", "id", "n_tokens", "ids_sha256", "decoded_sha256", "parts"],
            )

    coded = stage(docs.mapInArrow(encode, f"row bigint, id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, parts array<struct<hash:bigint,ids:binary,text:string>>"), "coded")
    whole = coded.where("n_tokens is not null").select("id", "n_tokens", "ids_sha256", "decoded_sha256")
    parts = coded.where("n_tokens is null").select("row", "id", F.posexplode("parts").alias("pos", "part")).select("row", "id", "pos", "part.*")

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(path)
        for batch in batches:
            words = [units_of(t) for t in batch.column(1).to_pylist()]
            encoder.renew()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b"".join([encoder.units[u][3] for u in w]) for w in words], pa.binary())], ["hash", "core_ids"])

    chunks = parts.where("text is not null").groupBy("hash").agg(F.min("text").alias("text")).mapInArrow(encode_chunks, "hash bigint, core_ids binary")
    own = parts.where("hash is null").select("row", "id", "pos", "ids")
    reused = parts.where("hash is not null").select("row", "id", "pos", "hash").join(chunks, "hash").select("row", "id", "pos", F.col("core_ids").alias("ids"))
    gathered = own.unionByName(reused).groupBy("row", "id").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("parts"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, decimal = signs(path)
        for batch in batches:
            rows = []
            for parts in batch.column(1).to_pylist():
                ids = array.array("H", b"".join(p["ids"] for p in parts)).tolist()
                rows.append((len(ids), sha(" ".join([decimal[i] for i in ids])), sha(" ".join([names[i] for i in ids]))))
            n, ids, decoded = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    joined = gathered.select("id", "parts").mapInArrow(assemble, whole.schema)
    return whole.unionByName(joined).withColumnRenamed("id", id_col)


def unit_encoder(path: str) -> UnitEncoder:
    """Units as: how many ids, the ids in decimal, the text they decode to, and the ids in two bytes each."""
    names, decimal = signs(path)

    def render(ids: list[int]) -> tuple[int, str, str, bytes]:
        return len(ids), " ".join([decimal[i] for i in ids]), " ".join([names[i] for i in ids]), array.array("H", ids).tobytes()

    def combine(parts: list[tuple[int, str, str, bytes]]) -> tuple[int, str, str, bytes]:
        if len(parts) == 2:
            (n, d, t, i), (m, e, u, j) = parts
            return n + m, f"{d} {e}", f"{t} {u}", i + j
        return sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]), b"".join([p[3] for p in parts])

    return UnitEncoder(path, render, combine, MEMO)


def signs(path: str) -> tuple[list[str], list[str]]:
    """What each id decodes to, and its decimal."""
    tok = tokenizer(path)
    size = tok.get_vocab_size()
    return [tok.decode([i], skip_special_tokens=False) for i in range(size)], [str(i) for i in range(size)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digests(units: list[tuple[int, str, str, bytes]]) -> tuple[int, str, str]:
    if not units:
        return 0, sha(""), sha("")
    sizes, ids, decoded, _ = zip(*units, strict=True)
    return sum(sizes), sha(" ".join(ids)), sha(" ".join(decoded))
