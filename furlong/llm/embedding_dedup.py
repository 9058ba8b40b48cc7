"""Embedding near-duplicates by randomised-rotation binary codes.

Each vector is scaled to length one and turned by random rotations. Of the first rotation, the signs of the turned components are its
code, the inner product of the turned vector with its code's direction is the stored correction factor, and
the turned components themselves are kept in eight bits with randomised rounding. The code of one vector, the components of the
other and the factor give an unbiased estimate of their cosine with a known standard error, sqrt((1 - f^2) / f^2 / (d - 1)); the estimates
from either side are averaged. Pairs whose upper confidence bound lies below the threshold are dropped, all others are
recomputed exactly in double precision, and only that decides.

Candidates agree in one of several bands of sign bits (of as many rotations as the bands need). Bands have more bits the more
vectors there are, so buckets of unrelated vectors stay small; their number keeps the chance that a pair at the threshold
meets in none below MISSED (pairs above it are missed more rarely). A pair is looked at in the first band in which it agrees. Equal vectors are one
class with a weight. A bucket is cut into blocks, and each pair of blocks is a group of its own, so no task gets more than two blocks;
what leaves it is a count and a local root for each vector, never its pairs.

Vectors are compared with those of their own length alone, whatever lengths there are; lengths up to the same power of two are worked on together, filled with zeros.
A rotation takes the square of the largest length in memory. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Null ids and
repeated rows are kept; a null id never names a component unless all its ids are null, and is not `kept`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, row_numbers, runs, stage
from .components import components

#: Chance that a pair exactly at the threshold meets in no band, standard errors of the confidence bound, and rows of a block.
MISSED, SIGMAS, BLOCK = 0.005, 4.0, 1024


def rotations(dim: int, count: int) -> np.ndarray:
    """Random orthogonal matrices, the same in every task: dim x (count * dim), side by side."""
    rng = np.random.default_rng(7)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.normal(size=(dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out, 1)


def bands(n: int, dim: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and the number of bands, for n vectors."""
    bits = min(dim, max(4, math.ceil(math.log2(max(2, n))) - 4))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-agree)))


def unit_rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can link, and those scaled to length one in double precision."""
    good, rows = np.zeros(len(column), bool), []
    for i, v in enumerate(column.to_pylist()):
        if v is None or not 0 < len(v) <= dim or None in v:
            continue
        x = np.zeros(dim)
        x[: len(v)] = v
        most = np.abs(x).max()
        if np.isfinite(most) and most > 0:
            x = x / most
            rows.append(x / np.sqrt(x @ x))
            good[i] = True
    return good, np.array(rows).reshape(-1, dim)


def class_keys(units: np.ndarray, lengths: list[int]) -> list[int]:
    import hashlib

    made = zip(units + 0.0, lengths, strict=True)  # -0.0 becomes 0.0
    return [int.from_bytes(hashlib.blake2b(u.tobytes() + n.to_bytes(4, "little"), digest_size=8).digest(), "little", signed=True) for u, n in made]


def prepared(vectors: DataFrame, dim: int) -> DataFrame:
    """(row, id, key, unit, gap): key and unit (float64 bytes) are null where a vector links with nothing; gap: how much shorter it is than dim."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for batch in batches:
            good, units = unit_rows(batch.column(1), dim)
            keys, raw = np.full(len(batch), None, object), np.full(len(batch), None, object)
            lengths = [len(v) for v, ok in zip(batch.column(1), good, strict=True) if ok]
            keys[good], raw[good] = class_keys(units, lengths), [(u + 0.0).tobytes() for u in units]
            gaps = np.full(len(batch), None, object)
            gaps[good] = [dim - n for n in lengths]
            columns = [pa.array([next(numbers) for _ in good], pa.int64()), batch.column(0), pa.array(keys, pa.int64()), pa.array(raw, pa.binary()), pa.array(gaps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "key", "unit", "gap"])

    return stage(vectors.mapInArrow(work, f"row bigint, id {vectors.schema['id'].dataType.simpleString()}, key bigint, unit binary, gap bigint"), "vectors")


CODED = "bucket bigint, key bigint, weight bigint, signs binary, factor double, parts binary, step double"


def coded(classes: DataFrame, dim: int, bits: int, tables: int) -> DataFrame:
    """A row for each class and band: the bucket (of the band, its bits and the vector's length), the bits of all bands, and what the estimate needs."""
    per = max(1, dim // bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotations(dim, -(-tables // per))
        columns = np.array([[(t // per) * dim + (t % per) * bits + b for b in range(bits)] for t in range(tables)]).ravel()
        place = np.int64(1) << np.arange(bits, dtype=np.int64)
        rng = np.random.default_rng(11)
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                turned = np.frombuffer(b"".join(some.column(2).to_pylist())).reshape(-1, dim) @ turn
                signs = turned[:, columns] >= 0
                values = (signs.reshape(len(some), tables, bits) @ place) + (some.column(3).to_numpy()[:, None] << np.int64(bits))
                first = turned[:, :dim]
                factor = np.abs(first).sum(1) / math.sqrt(dim)
                step = np.abs(first).max(1) / 127
                parts = np.clip(np.floor(first / step[:, None] + rng.random(first.shape)), -127, 127).astype(np.int8)
                packed = np.packbits(np.concatenate([signs, first >= 0], 1), axis=1)
                each = lambda a: np.repeat(a, tables, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((np.arange(tables, dtype=np.int64)[None, :] + tables * values).ravel()), pa.array(each(some.column(0).to_numpy())), pa.array(each(some.column(1).to_numpy())),
                        pa.array(each(np.array([p.tobytes() for p in packed], object)), pa.binary()), pa.array(each(factor)), pa.array(each(np.array([p.tobytes() for p in parts], object)), pa.binary()), pa.array(each(step)),
                    ],
                    [c.split()[0] for c in CODED.split(", ")],
                )

    return classes.select("key", "weight", "unit", "gap").mapInArrow(work, CODED)


class Group:
    """The rows of two blocks of a bucket (or of one), and which of their pairs are looked at here."""

    def __init__(self, batch: pa.RecordBatch, dim: int, bits: int, tables: int):
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        self.batch, self.dim, self.key = batch, dim, get("key").to_numpy()
        n = len(self.key)
        signs = np.unpackbits(np.frombuffer(b"".join(get("signs").to_pylist()), np.uint8).reshape(n, -1), axis=1)
        band = int(get("bucket")[0].as_py() % tables)
        values = signs[:, : tables * bits].reshape(n, tables, bits)[:, :band] @ (np.int64(1) << np.arange(bits, dtype=np.int64))
        self.code = signs[:, tables * bits : tables * bits + dim].astype(np.float32) * 2 - 1
        home, i, j = (get(c).to_numpy() for c in ("home", "i", "j"))
        self.pair = self.key[:, None] != self.key[None, :]
        if i[0] != j[0]:
            self.pair &= home[:, None] != home[None, :]
        for t in range(band):  # pairs that an earlier band has
            self.pair &= values[:, None, t] != values[None, :, t]
        self.factor, self.step = get("factor").to_numpy(), get("step").to_numpy()
        self.parts = np.frombuffer(b"".join(get("parts").to_pylist()), np.int8).reshape(n, dim)

    def possible(self, threshold: float) -> np.ndarray:
        """The pairs whose upper confidence bound reaches the threshold."""
        inner = (self.code @ self.parts.astype(np.float32).T) * self.step[None, :] / math.sqrt(self.dim)
        estimate = inner / self.factor[:, None]
        f = np.minimum(self.factor, 1.0)
        error = np.sqrt((1 - f**2) / f**2 / max(1, self.dim - 1))
        bound = (estimate + estimate.T) / 2 + SIGMAS * (error[:, None] + error[None, :]) / 2 + 1e-3
        return self.pair & (bound >= threshold)


def local_roots(linked: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The least key that links within the group reach."""
    order = np.argsort(key)
    label = np.empty(len(key), np.int64)
    label[order] = np.arange(len(key))
    a, b = np.nonzero(linked)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        new = np.minimum(new, new[order][new])
        if (new == label).all():
            return key[order][label]
        label = new


def neighbours(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Per row of vectors: id, n_links (other vectors with a cosine of at least threshold), component_id (the least id reached), kept (it is that one)."""
    vectors = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    power = F.coalesce(F.when(F.size("v") > 0, F.ceil(F.log2(F.size("v").cast("double")))), F.lit(-1)).cast("int")
    placed = None
    for found in vectors.groupBy(power.alias("power")).agg(F.max(F.size("v")).alias("dim")).orderBy("power").collect():  # 33 rows at most
        some = placed_among(vectors.where(power == found["power"]), max(1, found["dim"] or 1), str(found["power"]), threshold, block)
        placed = some if placed is None else placed.unionByName(some)
    if placed is None:
        placed = placed_among(vectors, 1, "-1", threshold, block)
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    out = placed.join(least, "root")
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component_id").cast("long").alias("component_id"), F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def placed_among(vectors: DataFrame, dim: int, name: str, threshold: float, block: int) -> DataFrame:
    """(id, n_links, root) of vectors(id, v) with at most dim components: rows with one root are one component; name tells roots of different calls apart."""
    rows = prepared(vectors, dim)
    classes = stage(rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("weight"), F.any_value("unit").alias("unit"), F.any_value("gap").alias("gap")), "classes")
    bits, tables = bands(classes.count(), dim, threshold)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            group = Group(batch, dim, bits, tables)
            yield batch.filter(pa.array(group.possible(threshold).any(1)))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            group = Group(batch, dim, bits, tables)
            at = {c: batch.schema.get_field_index(c) for c in ("unit", "weight")}
            units, weight = np.frombuffer(b"".join(batch.column(at["unit"]).to_pylist())).reshape(-1, dim), batch.column(at["weight"]).to_numpy()
            linked = group.possible(threshold) & (units @ units.T >= threshold)
            some = linked.any(1)
            yield pa.RecordBatch.from_arrays([pa.array(group.key[some]), pa.array((linked @ weight)[some]), pa.array(local_roots(linked, group.key)[some])], ["key", "n", "root"])

    dealt = in_blocks(stage(coded(classes, dim, bits, tables), "codes"), block)
    by = ("bucket", "i", "j")
    groups = lambda df: df.repartition(*by).sortWithinPartitions(*by)
    found = stage(groups(dealt).mapInArrow(candidates, dealt.schema), "candidates")
    full = found.join(classes.select("key", "unit"), "key").select(*found.columns, "unit")
    counts = stage(groups(full).mapInArrow(exact, "key bigint, n bigint, root bigint"), "counts")
    roots = components(counts.select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = counts.groupBy("key").agg(F.sum("n").alias("n"))
    of_class = classes.select("key", "weight").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "key").alias("root"))
    root = F.concat(F.lit(f"{name}:"), F.coalesce(F.col("root").cast("string"), F.concat(F.lit("r"), F.col("row").cast("string"))))
    return rows.select("row", "id", "key").join(of_class, "key", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("root"))
