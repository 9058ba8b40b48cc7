"""Packing of token sequences by bin completion.

Each document is encoded, ended with an end id, and cut only where it is longer than a sequence. Pieces of one
length are interchangeable, so the search runs on the histogram of lengths (one count per length up to the
capacity, whatever the corpus size): around the largest piece left it enumerates undominated fillings of the gap,
tries the fullest first and repeats each as often as the counts allow. Best-fit decreasing is the first incumbent;
branches that cannot beat the incumbent by the waste they have left are pruned, and the search ends when the bins
reach the lower bound or MAX_NODES have been tried. The enumeration looks at a few lengths a level; where it finds no filling without
room, the fullest of all is found by sums of whole bitsets. What is still above the lower bound after that is repaired: some bins with
room and some without are emptied and searched again, up to REPAIRS times (the incumbent is then the answer, which need not be optimal).
Pieces are ranked among those of their length by counts per task, so no length is gathered in one task.

Null and empty texts are one piece that holds the end id alone. Null ids and repeated rows are packed like any
other row. An empty table gives an empty result.
"""

from __future__ import annotations

import array
import random
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_numbers, small_batches, stage
from .word_units import UnitEncoder, units_of

MAX_NODES = 20_000
#: Fillings that one node of the search compares, and steps that it may take to find them.
BRANCHES, STEPS = 4, 400
#: Times that some bins are searched again, bins with room and without room taken each time, and nodes tried for them.
REPAIRS, REOPENED, REPAIR_NODES = 3000, (4, 8), 60
#: Units whose ids are gathered in one step.
UNITS_AT_ONCE = 500_000

Pattern = tuple[tuple[int, ...], int]


def best_fit_decreasing(counts: Counter, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: bins with the same contents are handled together."""
    open_bins: dict[int, list[Pattern]] = {}
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = next((r for r in sorted(rooms) if r >= length), None)
            if at is None:
                each = capacity // length
                whole, part = divmod(left, each)
                made = [((length,) * each, whole)] * bool(whole) + [((length,) * part, 1)] * bool(part)
                left = 0
            else:
                contents, times = open_bins[at].pop()
                if not open_bins[at]:
                    rooms.remove(at)
                    del open_bins[at]
                used = min(times, left)
                made = [((*contents, length), used)] + [(contents, times - used)] * (times > used)
                left -= used
            for contents, times in made:
                room = capacity - sum(contents)
                if room not in open_bins:
                    open_bins[room] = []
                    rooms.append(room)
                open_bins[room].append((contents, times))
    return [p for group in open_bins.values() for p in group]


def fillings(counts: Counter, lengths: list[int], gap: int) -> list[tuple[int, ...]]:
    """Undominated fillings of a gap, fullest first. lengths: those with a count, ascending.

    A filling is dominated if some of its pieces can make way for one larger piece that is left and fits."""
    if not lengths or gap < lengths[0]:
        return [()]
    found: list[tuple[int, tuple[int, ...]]] = []
    stack: list[tuple[tuple[int, ...], int, int]] = [((), gap, len(lengths))]
    steps = perfect = 0
    while stack and steps < STEPS and perfect < BRANCHES:
        chosen, room, top = stack.pop()
        steps += 1
        high = bisect_right(lengths, room, 0, top) - 1
        if high < 0 or room == 0:
            found.append((room, chosen))
            perfect += room == 0
            continue
        deeper = []
        for at in range(high, max(-1, high - 6), -1):
            length = lengths[at]
            if counts[length] > chosen.count(length):
                deeper.append(((*chosen, length), room - length, at + 1))
        if room - lengths[high] >= lengths[0]:  # a pair that fills the room exactly
            for at in range(high, max(-1, high - 40), -1):
                rest = room - lengths[at]
                if rest <= lengths[at] and counts[rest] > chosen.count(rest) + (rest == lengths[at]) and counts[lengths[at]] > chosen.count(lengths[at]):
                    deeper.append(((*chosen, lengths[at], rest), 0, 0))
                    break
        if not deeper:
            lower = [x for x in lengths[max(0, high - 6) : high + 1] if counts[x] > chosen.count(x)]
            if not lower and high > 6:
                stack.append((chosen, room, high - 5))
            else:
                found.append((room, chosen))
        stack.extend(reversed(deeper))
    if not perfect:
        best = fullest(counts, lengths, gap)
        found.append((gap - sum(best), best))
    found = sorted(dict.fromkeys(found), key=lambda f: (f[0], len(f[1])))[: 3 * BRANCHES]
    kept = [f for room, f in found if not dominated(f, room, counts, lengths)]
    return kept[:BRANCHES] or [found[0][1]] if found else [()]


def fullest(counts: Counter, lengths: list[int], gap: int) -> tuple[int, ...]:
    """The filling of a gap that leaves the least room of all; of equally full ones that with the larger pieces. lengths ascend."""
    reach = [1]  # bit n: the lengths so far can sum to n
    for length in lengths[: bisect_right(lengths, gap)]:
        now, left, part = reach[-1], min(counts[length], gap // length), 1
        while left:
            part = min(part, left)
            now |= (now << (part * length)) & ((1 << (gap + 1)) - 1)
            left, part = left - part, 2 * part
        reach.append(now)
    at, chosen = reach[-1].bit_length() - 1, []
    for length, before in zip(lengths[len(reach) - 2 :: -1] if len(reach) > 1 else [], reach[-2::-1], strict=True):
        n = min(counts[length], at // length)
        while n and not before >> (at - n * length) & 1:
            n -= 1
        chosen += [length] * n
        at -= n * length
    return tuple(chosen)


def dominated(filling: tuple[int, ...], room: int, counts: Counter, lengths: list[int]) -> bool:
    for n in range(1, min(len(filling), 3) + 1):
        for some in set(combinations(filling, n)):
            low = sum(some) + (n == 1)
            at = bisect_right(lengths, sum(some) + room) - 1
            if at >= 0 and lengths[at] >= low and counts[lengths[at]] > filling.count(lengths[at]):
                return True
    return False


def pack_counts(counts: dict[int, int], capacity: int, max_nodes: int = MAX_NODES, repairs: int = REPAIRS) -> list[Pattern]:
    """Patterns (lengths of a bin, how many such bins) that hold all pieces in as few bins as the search finds."""
    counts = Counter({k: v for k, v in counts.items() if v})
    best, least = best_fit_decreasing(counts, capacity), lower_bound(counts, capacity)
    best = search(counts, capacity, max_nodes, least, n_bins(best)) or best
    return best if n_bins(best) <= least else repaired(best, capacity, least, repairs)


def n_bins(patterns: Iterable[Pattern]) -> int:
    return sum(t for _, t in patterns)


def search(counts: Counter, capacity: int, max_nodes: int, least: int, fewest: int) -> list[Pattern] | None:
    """The best packing into fewer than that many bins that is found within a number of nodes; None if none is."""
    best, total = None, sum(k * v for k, v in counts.items())
    # a node: counts left, their sum, bins used, patterns so far (linked), fillings not tried yet
    stack = [node(counts, total, 0, None, capacity)]
    tried = 0
    while stack and fewest > least and tried < max_nodes:
        left, weight, bins, path, options = stack[-1]
        if not options or bins + -(-weight // capacity) >= fewest:
            stack.pop()
            continue
        tried += 1
        largest, filling = options.pop(0)
        need = Counter((largest, *filling))
        times = min(left[k] // n for k, n in need.items())
        after = Counter({k: v for k, v in ((k, v - times * need.get(k, 0)) for k, v in left.items()) if v})
        weight, bins, path = weight - times * sum(k * n for k, n in need.items()), bins + times, (path, (largest, *filling), times)
        if not after:
            if bins < fewest:
                fewest, best = bins, unwind(path)
        elif bins + -(-weight // capacity) < fewest:
            stack.append(node(after, weight, bins, path, capacity))
    return best


def repaired(patterns: list[Pattern], capacity: int, least: int, repairs: int) -> list[Pattern]:
    """A packing with some bins searched again, over and over: fewer of them are taken, and as many if that evens out less of the room."""
    held, rng = Counter(), random.Random(5)
    for contents, times in patterns:
        held[tuple(sorted(contents))] += times
    loose = [c for c in held if sum(c) < capacity]
    tight = [c for c in held if sum(c) == capacity]
    total = sum(held.values())
    for _ in range(repairs):
        if total <= least:
            break
        taken = Counter(rng.sample(loose, min(len(loose), REOPENED[0])) + rng.sample(tight, min(len(tight), REOPENED[1])))
        inside = Counter()
        for contents, n in taken.items():
            for length in contents:
                inside[length] += n
        some = sum(taken.values())
        found = search(inside, capacity, REPAIR_NODES, -(-sum(k * v for k, v in inside.items()) // capacity), some + 1)
        if found is None or (n_bins(found) == some and sum(sum(c) ** 2 * t for c, t in found) < sum(sum(c) ** 2 * t for c, t in taken.items())):
            continue
        total += n_bins(found) - some
        held -= taken
        for contents, times in found:
            held[tuple(sorted(contents))] += times
        touched = [*taken, *(tuple(sorted(c)) for c, _ in found)]
        for group, full in ((loose, False), (tight, True)):
            gone = {c for c in touched if (sum(c) == capacity) == full}
            group[:] = [c for c in group if c not in gone] + sorted(c for c in gone if held[c])
    return list(held.items())


def node(left: Counter, weight: int, bins: int, path: tuple | None, capacity: int) -> tuple:
    lengths = sorted(left)
    if not lengths:
        return left, weight, bins, path, []
    largest = lengths[-1]
    left[largest] -= 1
    usable = lengths if left[largest] else lengths[:-1]
    options = [(largest, f) for f in fillings(left, usable, capacity - largest)]
    left[largest] += 1
    return left, weight, bins, path, options


def unwind(path: tuple | None) -> list[Pattern]:
    out = []
    while path:
        path, contents, times = path
        out.append((contents, times))
    return out


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The largest over thresholds k of: bins that pieces above half need, plus what the pieces from k on need beyond their room."""
    lengths = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        lengths[k] = v
    weights = np.arange(capacity + 1) * lengths
    best = -(-int(weights.sum()) // capacity)
    n_from, w_from = np.append(np.cumsum(lengths[::-1])[::-1], 0), np.append(np.cumsum(weights[::-1])[::-1], 0)
    for k in range(1, capacity // 2 + 1):
        large = int(n_from[capacity - k + 1])
        middle = int(n_from[capacity // 2 + 1]) - large
        room = middle * capacity - int(w_from[capacity // 2 + 1] - w_from[capacity - k + 1])
        small = int(w_from[k] - w_from[capacity // 2 + 1])
        best = max(best, large + middle + max(0, -(-(small - room) // capacity)))
    return best


def cut_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts one after the other, and where those of each text end; units may be empty."""
    texts = pc.fill_null(texts, "")
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():  # white space for Arrow as for Python, but not for the tokenizer
        lists = pa.array([units_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pc.utf8_split_whitespace(texts)
    return lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))


def ids_of(texts: pa.Array, encoder: UnitEncoder) -> Iterator[bytes]:
    """The ids of each text, four bytes each: distinct units are rendered, and their ids gathered by position, UNITS_AT_ONCE positions at a time."""
    units, ends = cut_units(texts)
    coded = units.dictionary_encode()
    names, places = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
    encoder.renew()
    known = encoder.units
    rendered = [known[u] if u else b"" for u in names]
    flat, sizes = np.frombuffer(b"".join(rendered), np.uint32), np.array([len(r) // 4 for r in rendered], np.int64)
    firsts = np.cumsum(sizes) - sizes
    blocks = []
    for at in range(0, len(places), UNITS_AT_ONCE):
        some = places[at : at + UNITS_AT_ONCE]
        n = sizes[some]
        blocks.append(flat[np.repeat(firsts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
    ids = np.concatenate(blocks) if blocks else flat
    until = np.append(0, np.cumsum(sizes[places]))[ends].tolist()
    for a, b in zip([0, *until], until, strict=False):
        yield ids[a:b].tobytes()


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, and the task that made it with the piece's rank among those of its length there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = UnitEncoder(path, lambda ids: array.array("I", ids).tobytes(), b"".join)
        part, seen, end = TaskContext.get().partitionId(), Counter(), array.array("I", [end_id]).tobytes()
        numbers = row_numbers()
        for batch in batches:
            rows = []
            for i, own in enumerate(ids_of(batch.column(1), encoder)):
                ids, row = own + end, next(numbers)
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    mine = ids[start : start + 4 * capacity]
                    rows.append((i, row, piece, start // 4, len(mine) // 4, zlib.crc32(mine), seen[len(mine) // 4]))
                    seen[len(mine) // 4] += 1
            where, row, piece, start, length, crc, local = (np.array(c) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where)), pa.array(row), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc), pa.array(np.full(len(where), part), pa.int64()), pa.array(local)],
                ["id", "row", "piece", "start", "length", "ids_crc32", "part", "local"],
            )

    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"id {id_type}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, local bigint")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(pieces_of(docs, path, capacity, end_id, id_col, text_col), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length, capacity at most
    plan = docs.sparkSession.sparkContext.broadcast(slots(pack_counts(counts, capacity)))
    before = by_task.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, blocks = plan.value
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            block = blocks[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
            turn, slot = np.divmod(rank - block[:, 0], block[:, 1]) if len(rank) else (rank, rank)
            columns = [*batch.columns[:5], pa.array(block[:, 2] + turn), pa.array(block[:, 3] + slot * length)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_col)


def slots(patterns: list[Pattern]) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of each length go by rank. keys: length and first rank of a block; blocks: first rank, pieces per bin, first bin, offset.

    Each pattern uses up some length or nearly so, so there are a few blocks for each length at most."""
    used, rows, first = Counter(), [], 0
    for contents, times in patterns:
        offset = 0
        for length, each in sorted(Counter(contents).items(), reverse=True):
            rows.append(((length << 48) | used[length], used[length], each, first, offset))
            used[length] += each * times
            offset += each * length
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return table[:, 0], table[:, 1:]
