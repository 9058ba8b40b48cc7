"""N-gram Jaccard join by partitioning the universe of shingles.

A document's set is that of its distinct shingles of k words. Sets fall into bands of sizes so narrow that linked
sets lie in one band or in neighbouring ones. For the band of the larger set, hashing cuts the universe into m segments.
Linked sets differ in at most H shingles, so whichever thresholds e_i (-1: skip the segment, 0: equal, 1: equal up
to one shingle) a set chooses, if their sum of (e_i + 1) exceeds H, some segment of its partner differs from its own by e_i
or less (pigeonhole). The larger set indexes all its segments, the smaller one probes those that it chose:
the cheapest by the frequencies of all segment subsets (a count sketch over the whole corpus, sized by the number of documents), where a
threshold of 1 costs the neighbourhood of one deletion. That neighbourhood is indexed for sets below DELETION_SIZE; larger
sets have enough segments without it.

Candidates that share a subset are verified exactly on their whole sets. Equal sets are one class from the start; classes are numbered by 64 bits of
a 128-bit hash, and where two sets meet in those, by the other 64. Every class is first compared with one leader, of those that share
most subsets with others. Where that leaves two classes of a subset apart, parity sketches give a lower bound of their difference, and
pairs within it are open. Blocks with few open pairs hand them on, each to be compared once; where a block has more of them than rows (and than FEW), they are
compared inside it, and only links that join components leave it. So no link between components goes unseen, and what leaves a block grows with its rows. The members of a subset's most frequent root never meet each other again, so the others alone
are dealt out to several blocks. Shingles are 64-bit hashes. Subsets that the sketch calls hot are grouped by Spark's joins instead of in memory.

Null and empty texts have an empty set (n_shingles 0) and are linked with nothing. Texts with fewer than k words are one
shingle. Null ids and repeated rows are kept; a null id never becomes a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, runs, small_batches, stage
from .components import components

#: Least and most bits of the count sketch, documents for each of its slots beyond the least size, and slabs that sketches travel in.
SKETCH_BITS, SKETCH_DOCS, SLABS = (18, 22), 1500, 256
#: Rows whose sets are fetched with a Bloom filter (of 16 bits a row); more are joined by row.
BLOOM_ROWS = 1 << 24
DELETION_SIZE = 64
#: Entries that a bucket of subsets holds on average, and the sketch count from which a subset is hot.
BUCKET, HOT = 400_000, 2_000_000
#: Entries that a task gathers before it sends them on.
FLUSH = 1 << 19
#: Rows of a block of a subset's members, and shingles that they hold together on average.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22
#: Open pairs that a block may hand on whatever its rows, and keys that are broadcast (a million numbers of eight bytes); more are joined by a shuffle.
FEW, BROADCAST_KEYS = 64, 1 << 20

_rng = np.random.default_rng(3)
BYTE_KEYS = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
PLACE = np.uint64(0x9E3779B97F4A7C13)  # 3 by 4, so that swapped bytes give different sums
PLACE_INVERSE = np.uint64(pow(int(PLACE), -1, 1 << 64))
WORD_KEYS = _rng.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((PLACE, PLACE_INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's k-word shingles."""
    raw = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())  # bytes: A-Z alone change, ASCII white space alone parts
    if not raw:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(raw + b" ", np.uint8)
    up, down = powers(len(data))
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_KEYS[data] * up[: len(data)])])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = min(k, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = total + words[i : len(words) - n + 1 + i] * WORD_KEYS[i % 64]
    return np.unique(mix(total))


class Scheme:
    """Bands of sizes and their numbers of segments for Jaccard >= num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.bounds = [1, 2]

    def band(self, size: int) -> int:
        while self.bounds[-1] <= size:
            last = self.bounds[-1]
            self.bounds.append(max(last + 1, (last - 1) * self.den // self.num + 1))
        return int(np.searchsorted(self.bounds, size, "right")) - 1

    def differing(self, total: int) -> int:
        """How many shingles linked sets may differ in, by the sum of their sizes."""
        return total * (self.den - self.num) // (self.den + self.num)

    def segments(self, band: int) -> int:
        most = self.differing(2 * (self.bounds[band + 1] - 1)) + 1
        return most + most // 8 + (most > 1)


@lru_cache(4096)
def segment_ids(band: int, m: int) -> np.ndarray:
    return mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))


def subsets(hashes: np.ndarray, band: int, m: int, deletions: bool) -> tuple:
    """For each segment its signature and size; and, if asked for, the segment of each shingle and the signature after its deletion."""
    segment = ((hashes >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # ascends with the hashes
    at = np.searchsorted(segment, np.arange(m + 1, dtype=np.uint64))
    own = mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own)])
    totals, ids = sums[at[1:]] - sums[at[:-1]], segment_ids(band, m)
    if not deletions:
        return mix(totals + ids), np.diff(at), None, None
    segment = segment.astype(np.int64)
    return mix(totals + ids), np.diff(at), segment, mix(totals[segment] - own + ids[segment])


def slot(signatures: np.ndarray, slots: int) -> np.ndarray:
    return (signatures >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def indexed(hashes: np.ndarray, scheme: Scheme) -> np.ndarray:
    """What a set indexes as the larger one: its segments in the scheme of its band, and their deletions if it is small."""
    band = scheme.band(len(hashes))
    signatures, _, _, deleted = subsets(hashes, band, scheme.segments(band), len(hashes) < DELETION_SIZE)
    return signatures if deleted is None else np.concatenate([signatures, deleted])


def probed(made: tuple, size: int, band: int, scheme: Scheme, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments that a set probes as they are, and those whose deletions it probes, as the smaller set in the scheme of a band.

    Both are empty if no set of that band can be linked with it. made: its subsets there."""
    none = np.zeros(0, np.int64)
    largest = min(scheme.bounds[band + 1] - 1, size * scheme.den // scheme.num)
    if largest < scheme.bounds[band]:
        return none, none
    units = scheme.differing(size + largest) + 1
    signatures, sizes, segment, deleted = made
    cost = sketch[slot(signatures, len(sketch))] + np.where(sizes == 0, 1 << 40, 0)
    if deleted is None or scheme.bounds[band + 1] > DELETION_SIZE:  # larger partners don't index their deletions
        return np.argpartition(cost, units - 1)[:units], none
    more = np.bincount(segment, sketch[slot(deleted, len(sketch))] + 1, len(signatures)).astype(np.int64)  # of a second unit
    more[sizes == 0] = 1 << 41
    steps = sorted([(c, 0, i) for i, c in enumerate(cost.tolist())] + [(max(c, d), 1, i) for i, (c, d) in enumerate(zip(cost.tolist(), more.tolist(), strict=True))])[:units]
    return np.array([i for _, e, i in steps if not e], np.int64), np.array([i for _, e, i in steps if e], np.int64)


def chosen(hashes: np.ndarray, band: int, scheme: Scheme, sketch: np.ndarray) -> np.ndarray:
    """The signatures that a set probes as the smaller one in the scheme of a band."""
    made = subsets(hashes, band, scheme.segments(band), len(hashes) < DELETION_SIZE)
    exact, near = probed(made, len(hashes), band, scheme, sketch)
    return made[0][exact] if not len(near) else np.concatenate([made[0][exact], made[3][np.isin(made[2], near)]])


def entries_of(hashes: np.ndarray, scheme: Scheme, sketch: np.ndarray) -> np.ndarray:
    """All signatures of a set, the last bit telling probes: what it indexes in its own band's scheme, and its probes there and in the next."""
    one, size = np.uint64(1), len(hashes)
    band = scheme.band(size)
    scheme.band(scheme.bounds[band + 1])
    made = subsets(hashes, band, scheme.segments(band), size < DELETION_SIZE)
    exact, near = probed(made, size, band, scheme, sketch)
    own = made[0] & ~one
    own[exact] |= one
    out = [own, chosen(hashes, band + 1, scheme, sketch) | one]
    if made[3] is not None:
        deleted = made[3] & ~one
        deleted[np.isin(made[2], near)] |= one
        out.append(deleted)
    return np.concatenate(out)


def odd_sketch(hashes: np.ndarray) -> bytes:
    """Bit i is the parity of how many hashes fall on it. Two sets differ in at least as many hashes as their sketches differ in bits."""
    size = 1 << min(13, max(6, (2 * len(hashes) - 1).bit_length()))
    bits = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, the longer ones folded to the length of the shortest."""
    words = min(len(s) for s in sketches) // 8
    out = np.empty((len(sketches), words), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, words), 0)
    return out


def class_of(hashes: np.ndarray) -> tuple[int, int]:
    """The two halves of one number for equal sets."""
    halves = [mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes)), mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]
    return tuple(mix(np.array(halves, np.uint64)).view(np.int64).tolist())


def key_of(hashes: np.ndarray, doubtful: frozenset[int]) -> int:
    """The number of a set's class: the first half, or the second where different sets share the first."""
    first, second = class_of(hashes)
    return second if first in doubtful else first


def summed_slabs(df: DataFrame, kind: np.dtype, union: bool) -> dict[int, np.ndarray]:
    """Rows (slab, data) merged by slab in Spark: sums, or bitwise unions. SLABS rows of fixed size reach the driver."""

    def merge(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for data in frame["data"]:
                got = np.frombuffer(data, kind)
                total = got.copy() if total is None else (total | got if union else total + got)
        if total is not None:
            yield pd.DataFrame({"slab": [key[0]], "data": [total.tobytes()]})

    return {r["slab"]: np.frombuffer(r["data"], kind) for r in df.groupBy("slab").applyInPandas(merge, "slab int, data binary").collect()}


def slab_rows(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = [(i, p.tobytes()) for i, p in enumerate(np.split(table, SLABS)) if p.any()]
    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["slab", "data"])


def assembled(slabs: dict[int, np.ndarray], size: int, kind: np.dtype) -> np.ndarray:
    return np.concatenate([slabs.get(i, np.zeros(size // SLABS, kind)) for i in range(SLABS)])


def row_of(id_col: str, text_col: str) -> list[Column]:
    """The two numbers by which readings of a table tell its rows apart: hashes of id and text, as places in a table change with Spark's file splits. Repeated rows share them."""
    return [F.xxhash64(id_col, text_col).alias("row"), F.xxhash64(F.lit(1), text_col, id_col).alias("mark")]


MEASURED = ["row", "mark", "id", "n_shingles", "key", "second", "slab", "data"]


def measured(docs: DataFrame, k: int, scheme: tuple[int, int]) -> tuple[DataFrame, np.ndarray, frozenset[int]]:
    """Of docs (row, mark, id, text): (row, mark, id, n_shingles, key) of every document, the sketch of all that their sets index, and the first
    halves that different sets share (of n sets, n^2 / 2^65 on average)."""
    slots = 1 << min(SKETCH_BITS[1], max(SKETCH_BITS[0], (docs.count() // SKETCH_DOCS).bit_length()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, sketch = Scheme(*scheme), np.zeros(slots, np.int64)
        last = None
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for text in batch.column(3).to_pylist():
                hashes = shingles(text, k)
                sizes.append(len(hashes))
                keys.append(class_of(hashes) if len(hashes) else (None, None))
                if len(hashes):
                    signatures.append(slot(indexed(hashes, plan), slots))
            if signatures:
                sketch += np.bincount(np.concatenate(signatures), minlength=slots)
            last = batch.schema.field(2).type
            first, second = zip(*keys, strict=True) if keys else ((), ())
            n = len(sizes)
            yield measured_batch(batch.column(0), batch.column(1), batch.column(2), sizes, first, second, [None] * n, [None] * n)
        if last is not None:
            for part in slab_rows(sketch):
                n = len(part)
                none = [None] * n
                yield measured_batch(none, none, pa.nulls(n, last), none, none, none, part.column(0), part.column(1))

    both = stage(docs.mapInArrow(work, f"row bigint, mark bigint, id {docs.schema[2].dataType.simpleString()}, n_shingles bigint, key bigint, second bigint, slab int, data binary"), "measured")
    sketch = assembled(summed_slabs(both.where("slab is not null").select("slab", "data"), np.dtype(np.int64), False), slots, np.int64)
    rows = both.where("slab is null")
    shared = rows.where("key is not null").groupBy("key").agg(F.min("second").alias("low"), F.max("second").alias("high")).where("low < high")
    doubtful = frozenset(r["key"] for r in shared.select("key").collect())
    key = F.when(F.col("key").isin(*doubtful), F.col("second")).otherwise(F.col("key")) if doubtful else F.col("key")
    sizes = rows.select("row", "mark", "id", "n_shingles", key.alias("key"))
    sizes.staged_path = both.staged_path
    return sizes, sketch, doubtful


def measured_batch(*columns) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), None, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([c if t is None else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], MEASURED)


def memberships(docs: DataFrame, k: int, scheme: tuple[int, int], sketch: np.ndarray, doubtful: frozenset[int], bucket: int, hot: int) -> DataFrame:
    """(signature, key, probe, times) of all sets in subsets that two classes share and one of them probes.

    Subsets with the same classes are one from here on, named by a hash of those classes: times says how many they were, and probe whether the
    class probes any of them. Two names that meet only add pairs to compare. Entries travel as blocks, one for each bucket that a task has entries of:
    pairs of a signature, whose last bit says whether it is a probe, and a key."""
    n_buckets = min(1 << 24, max(1, int(sketch.sum()) * 2 // bucket))
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    one = np.uint64(1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, sketch = Scheme(*scheme), shared.value
        signatures, keys, seen = [], [], set()
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            signature = np.concatenate(signatures)
            key = np.repeat(np.array(keys, np.int64), [len(x) for x in signatures])
            signatures.clear()
            keys.clear()
            is_hot = sketch[slot(signature, len(sketch))] >= hot
            if is_hot.any():
                m = int(is_hot.sum())
                yield block_batch([None] * m, [None] * m, signature[is_hot].view(np.int64), key[is_hot])
                signature, key = signature[~is_hot], key[~is_hot]
            part = (((signature >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)).astype(np.uint16 if n_buckets <= 1 << 16 else np.uint32)
            order = np.argsort(part, kind="stable")
            entries = np.stack([signature[order].view(np.int64), key[order]], 1)
            cuts = np.flatnonzero(np.diff(part[order], prepend=part[order][:1] + 1)).tolist() + [len(order)]
            for i in range(0, len(cuts) - 1, 2000):
                spans = list(zip(cuts[i : i + 2000], cuts[i + 1 : i + 2001], strict=False))
                yield block_batch([int(part[order[a]]) for a, _ in spans], [entries[a:b].tobytes() for a, b in spans], [None] * len(spans), [None] * len(spans))

        for batch in batches:
            for text in batch.column(3).to_pylist():
                hashes = shingles(text, k)
                key = key_of(hashes, doubtful) if len(hashes) else None
                if key is None or key in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(key)
                signatures.append(entries_of(hashes, plan, sketch))
                keys.append(key)
                n += len(signatures[-1])
                if n >= FLUSH:
                    yield from out()
                    n = 0
        if keys:
            yield from out()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks = None, []
        for batch in batches:
            is_hot = pa.compute.is_null(batch.column(0))
            if pa.compute.any(is_hot).as_py():
                found = batch.filter(is_hot)
                signature = found.column(2).to_numpy().view(np.uint64)
                yield member_batch(signature >> one, found.column(3).to_numpy(), signature & one, True)
                batch = batch.filter(pa.compute.invert(is_hot))
            for number, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if number != at and blocks:
                    yield shared_subsets(blocks)
                    blocks = []
                at = number
                blocks.append(np.frombuffer(block.as_buffer(), np.int64).copy())
        if blocks:
            yield shared_subsets(blocks)

    sent = docs.mapInArrow(emit, "bucket bigint, block binary, signature bigint, key bigint")
    dealt = sent.repartition(min(n_buckets, 100_000), F.coalesce("bucket", F.xxhash64("signature", "key"))).sortWithinPartitions("bucket")
    made = dealt.mapInArrow(join, "signature bigint, key bigint, probe boolean, hot boolean")
    found = stage(made.groupBy("signature", "key", "hot").agg(F.max("probe").alias("probe"), F.when(F.col("hot"), 1).otherwise(F.count(F.lit(1))).alias("times")), "members")
    hot_rows = found.where("hot")
    heads = hot_rows.groupBy("signature").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max("probe").alias("probed")).where("probed and first < last").select("signature")
    members = found.where("not hot").unionByName(hot_rows.join(heads, "signature")).drop("hot")
    members.staged_path = found.staged_path
    return members


def block_batch(buckets: list, blocks: list, signatures, keys) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(blocks, pa.binary()), pa.array(signatures, pa.int64()), pa.array(keys, pa.int64())], ["bucket", "block", "signature", "key"])


def member_batch(subset: np.ndarray, key: np.ndarray, probe: np.ndarray, hot: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(subset.view(np.int64)), pa.array(key), pa.array(probe.astype(bool)), pa.array(np.full(len(key), hot))], ["signature", "key", "probe", "hot"])


def shared_subsets(blocks: list[np.ndarray]) -> pa.RecordBatch:
    """The entries of a bucket whose subset is shared by two classes, one of them probing; equal sets of classes get equal names."""
    entries = np.concatenate(blocks).reshape(-1, 2)
    subset, probe, key = entries[:, 0].view(np.uint64) >> np.uint64(1), entries[:, 0] & 1, entries[:, 1]
    order = np.lexsort((key, subset))
    subset, probe, key = subset[order], probe[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(subset) != 0) | (np.diff(key) != 0)]))
    subset, probe, key = subset[first], np.maximum.reduceat(probe, first), key[first]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(subset) != 0]))
    sizes = np.diff(np.append(starts, len(subset)))
    kept = (sizes > 1) & (np.maximum.reduceat(probe, starts) == 1)
    inside = np.repeat(kept, sizes)
    names = mix(np.add.reduceat(mix(key.view(np.uint64)), starts) + sizes.astype(np.uint64))
    return member_batch(np.repeat(names, sizes)[inside], key[inside], probe[inside], False)


def sets_of(docs: DataFrame, k: int, rows: DataFrame, doubtful: frozenset[int]) -> DataFrame:
    """(key, hashes, size, sketch) of the rows of docs that rows (key, row) names, and of few others: a Bloom filter spares the rest, or a join where there are too many rows for one.

    A key without a set is an error: docs has changed since it was measured."""
    n = rows.count()
    bits = max(16, (16 * n).bit_length())
    if n > BLOOM_ROWS:
        docs, packed = docs.join(rows.select("row").distinct(), "row", "left_semi").select(*docs.columns), None
    else:

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bloom = np.zeros(1 << (bits - 3), np.uint8)
            for batch in batches:
                at = bloom_slots(batch.column(0).to_numpy(), bits).ravel()
                np.bitwise_or.at(bloom, at >> 3, (1 << (at & 7)).astype(np.uint8))
            yield from slab_rows(bloom)

        packed = assembled(summed_slabs(rows.select("row").mapInArrow(fill, "slab int, data binary"), np.dtype(np.uint8), True), 1 << (bits - 3), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for batch in batches:
            texts = batch.column(3)
            if bloom is not None:
                at = bloom_slots(batch.column(0).to_numpy(), bits)
                texts = texts.filter(pa.array((bloom[at >> 3] >> (at & 7) & 1).all(0)))
            found = [(key_of(h, doubtful), h.tobytes(), len(h), odd_sketch(h)) for h in (shingles(t, k) for t in texts.to_pylist()) if len(h)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.binary()), strict=True)], ["key", "hashes", "size", "sketch"])

    sets = docs.mapInArrow(work, "key bigint, hashes binary, size bigint, sketch binary")
    found = stage(sets.groupBy("key").agg(*[F.any_value(c).alias(c) for c in ("hashes", "size", "sketch")]), "sets")
    if lost := rows.join(found, "key", "left_anti").count():
        raise RuntimeError(f"{lost} sets are gone: the documents differ between two readings")
    return found


def bloom_slots(row: np.ndarray, bits: int) -> np.ndarray:
    h = mix(row.view(np.uint64))
    return np.stack([h >> np.uint64(64 - bits), h & np.uint64((1 << bits) - 1)]).astype(np.int64)


def is_linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return den * shared >= num * (len(both) - shared)


def compared(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, linked) of pairs (a, b): exactly whether den * intersection >= num * union of their sets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                linked.append(is_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    joined = pairs.join(sets.select(F.col("key").alias("b"), F.col("hashes").alias("y")), "b").join(sets.select(F.col("key").alias("a"), F.col("hashes").alias("x")), "a")
    return stage(joined.select("a", "b", "x", "y").mapInArrow(work, "a bigint, b bigint, linked boolean"), "compared")


def dealt_apart(rows: DataFrame, block: int) -> DataFrame:
    """The rows of each bucket (with main, its most frequent root, the numbers of blocks n_others and n_main of its other rows and of those of main, and whole,
    whether all of it is one block) dealt out to pairs (i, j) of blocks, so that every two rows of different roots meet; home: the block of the row.

    Rows of main need no block of their own kind, so with n_others 1 nothing but the others is dealt out more than once."""
    is_main, spot = F.col("root") == F.col("main"), F.xxhash64("key")
    home = F.when(is_main & ~F.col("whole"), F.col("n_others") + F.pmod(spot, F.col("n_main"))).otherwise(F.pmod(spot, F.col("n_others")))
    last = F.when(F.col("whole"), 0).when(is_main, F.col("n_others") - 1).otherwise(F.col("n_others") + F.col("n_main") - 1)
    dealt = rows.select("*", home.alias("home"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("other"))
    dealt = dealt.withColumn("i", F.least("home", "other")).withColumn("j", F.greatest("home", "other")).drop("other", "main", "n_others", "n_main", "whole")
    dealt.staged_path = rows.staged_path
    return dealt


class Group:
    """The rows of two blocks of a subset (or of one): for each, which of the later rows may be linked with it."""

    def __init__(self, batch: pa.RecordBatch, num: int, den: int):
        self.get = lambda c: batch.column(batch.schema.get_field_index(c))
        self.key, self.root, self.size, self.home = (self.get(c).to_numpy() for c in ("key", "root", "size", "home"))
        self.probe, self.sketch = self.get("probe").to_numpy(zero_copy_only=False), folded(self.get("sketch").to_pylist())
        self.crossing = self.get("i")[0].as_py() != self.get("j")[0].as_py()
        self.num, self.den = num, den

    def partners(self, i: int, root: np.ndarray) -> np.ndarray:
        """Those of other roots, the most alike first."""
        most = (self.size[i] + self.size[i + 1 :]) * (self.den - self.num) // (self.den + self.num)
        fits = (root[i + 1 :] != root[i]) & (self.probe[i + 1 :] | self.probe[i]) & (np.abs(self.size[i + 1 :] - self.size[i]) <= most)
        if self.crossing:
            fits &= self.home[i + 1 :] != self.home[i]
        at = np.flatnonzero(fits)
        apart = np.bitwise_count(self.sketch[i + 1 + at] ^ self.sketch[i]).sum(1)
        order = np.argsort(apart, kind="stable")
        return i + 1 + at[order][apart[order] <= most[at[order]]]


def open_subsets(members: DataFrame, roots: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """The rows of subsets with classes of two roots or more, dealt out to pairs of blocks, as a staged table."""
    classes = sets.select("key", "size").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "size", F.coalesce("root", "key").alias("root"))
    rooted = members.select(F.col("signature").alias("bucket"), "key", "probe").join(classes, "key")
    by_root = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    all_of = by_root.groupBy("bucket").agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root", "shingles")).alias("most"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"))
    n_blocks = lambda n, shingles: F.greatest(F.ceil(n / block), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1))
    split = all_of.where("roots > 1").select(
        "bucket", F.col("most.root").alias("main"), n_blocks(F.col("n") - F.col("most.n"), F.col("shingles") - F.col("most.shingles")).alias("n_others"), n_blocks(F.col("most.n"), F.col("most.shingles")).alias("n_main"), (n_blocks(F.col("n"), F.col("shingles")) == 1).alias("whole"),
    )
    return dealt_apart(stage(rooted.join(split, "bucket").join(sets.select("key", "sketch"), "key"), "split"), block)


def in_groups(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def local_links(dealt: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that join all classes of different roots that are linked in some block."""
    columns = dealt.schema.fieldNames()

    def may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            group = Group(batch, num, den)
            taken, a, b = np.zeros(len(batch), bool), [], []
            n = 0
            for i in range(len(batch) - 1):
                at = group.partners(i, group.root)
                n += len(at)
                if len(at):
                    taken[at] = taken[i] = True
                    if n <= max(FEW, len(batch)):
                        a.append(np.full(len(at), group.key[i]))
                        b.append(group.key[at])
            if n > max(FEW, taken.sum()):
                some = batch.filter(pa.array(taken))
                yield pa.RecordBatch.from_arrays([*some.columns, *2 * [pa.nulls(len(some), pa.int64())]], [*batch.schema.names, "a", "b"])
            elif n:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([*[pa.nulls(n, c.type) for c in batch.columns], pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], [*batch.schema.names, "a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            group = Group(batch, num, den)
            hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.get("hashes")]
            root, a, b = group.root.copy(), [], []
            for i in range(len(batch) - 1):
                for at in group.partners(i, root).tolist():
                    if root[at] != root[i] and is_linked(hashes[i], hashes[at], num, den):
                        a.append(group.key[i])
                        b.append(group.key[at])
                        root[root == root[at]] = root[i]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    found = stage(in_groups(dealt).mapInArrow(may_link, f"{fields}, a bigint, b bigint"), "open")
    pairs, dense = found.where("a is not null").select("a", "b").distinct(), found.where("a is null").select(*columns)
    keys = stage(pairs.select(F.explode(F.array("a", "b")).alias("key")).unionByName(dense.select("key")).distinct(), "keys")
    needed = stage(sets.select("key", "hashes").join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "key", "left_semi"), "needed")
    single = compared(pairs, needed, num, den)
    whole = dense.join(needed, "key").select(*columns, "hashes")
    joined = stage(in_groups(whole).mapInArrow(join, "a bigint, b bigint"), "links")
    for done in (found, keys, needed):
        drop(done)
    links = stage(single.where("linked").select("a", "b").unionByName(joined), "links")
    drop(single)
    drop(joined)
    return links


def labelled_rows(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, bucket: int = BUCKET, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(row, mark, id, n_shingles, root) of every row of docs, as a staged table: rows with one root are one component; root is null where a set is empty.

    docs is read three times; rows are told apart by row_of(), so their order and their partitions may differ between the readings."""
    small_batches(docs.sparkSession)
    docs = docs.withColumn(text_col, F.col(text_col).cast("string")) if docs.schema[text_col].dataType.simpleString() != "string" else docs
    docs = docs.select(*row_of(id_col, text_col), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sizes, sketch, doubtful = measured(docs, k, (num, den))
    members = memberships(docs, k, (num, den), sketch, doubtful, bucket, hot)
    wanted = stage(sizes.join(members.select("key").distinct(), "key").groupBy("key").agg(F.min("row").alias("row")), "wanted")
    sets = sets_of(docs, k, wanted, doubtful)
    drop(wanted)
    degree = members.groupBy("key").agg(F.sum("times").alias("degree"))
    ranked = members.select("signature", "key").join(degree, "key")
    heads = ranked.groupBy("signature").agg(F.max(F.struct("degree", "key")).alias("head")).select("signature", F.col("head.key").alias("leader"))
    votes = members.select("signature", "key", "times").join(heads, "signature").where("key <> leader").groupBy("key", "leader").agg(F.sum("times").alias("n"))
    first = compared(votes.groupBy("key").agg(F.max_by("leader", F.struct("n", "leader")).alias("leader")).select(F.col("leader").alias("a"), F.col("key").alias("b")), sets, num, den)
    links = first.where("linked").select("a", "b")
    led = components(links)
    dealt = open_subsets(members, led, sets, block)
    more = local_links(dealt, sets, num, den)
    roots = components(links.unionByName(more))
    out = stage(sizes.join(roots, sizes["key"] == F.col("node"), "left").select("row", "mark", "id", "n_shingles", F.coalesce("root", "key").alias("root")), "labelled")
    for done in (first, led, dealt, more, members, sets, roots, sizes):
        drop(done)
    return out


def groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Per row of docs: id, n_shingles, component_id (the least id that links reach)."""
    rooted = labelled_rows(docs, k, num, den, id_col, text_col, bucket, hot, block)
    least = stage(rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("component_id")), "least")  # written, so that Spark can split the rows of a large group in the join
    found = rooted.where("root is not null").join(least, "root").select("id", "n_shingles", "component_id")
    alone = rooted.where("root is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return found.unionByName(alone).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that are first of their component: those of the least id (null last), one of them if rows are repeated.

    docs is read several times and must hold the same rows each time, in whatever order. Texts without a shingle are all kept."""
    text = F.col(text_col).cast("string")
    rooted = labelled_rows(docs, k, num, den, id_col, text_col)
    rows = rooted.where("root is not null").groupBy("root", "row", "mark").agg(F.any_value("id").alias("id"), F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row", "mark", "n")).alias("first")).select("first.row", "first.mark", "first.n")
    first = stage(first, "first")
    drop(rooted)
    empty = text.isNull() | ~text.rlike(r"[^ \t\n\x0B\f\r]")
    held = docs.where(~empty).select(F.struct(*docs.columns).alias("held"), F.col(id_col).alias("id"), text.alias("text"))
    numbered = held.select("held", *row_of("id", "text"))
    once = numbered.join(first.where("n = 1"), ["row", "mark"], "left_semi")
    repeated = numbered.join(first.where("n > 1"), ["row", "mark"], "left_semi").dropDuplicates(["row", "mark"])
    return once.unionByName(repeated).select("held.*").unionByName(docs.where(empty))
