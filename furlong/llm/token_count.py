"""Token counts of whole texts under a byte-level BPE tokenizer, without materialising ids.

Pieces are counted once per distinct pre-token: a first pass sums the frequency of every pre-token over the
corpus, the distinct ones are encoded, and a second pass joins each document's pre-token frequencies to those
counts and sums. The most frequent pre-tokens (at most HOT_PIECES) are joined by a broadcast table, all others by
a shuffled join; the threshold between the two comes from the frequencies of the whole corpus and changes no result.

Null and empty texts have 0 bytes and 0 tokens. Null ids and repeated rows are kept as they are, one result row
for each input row. Special tokens inside a text count as one token each, as the library handles them by default.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least_frequency, row_numbers, small_batches, stage, tokenizer

#: Bound of the broadcast table, in pre-tokens.
HOT_PIECES = 150_000
#: Entries that a worker's memo or counter may hold before it is emptied.
MEMO = 300_000

# White space and the pre-token pattern of byte-level BPE.
WHITE = r"\t-\r\x20\x85\xa0  -     　"
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Characters whose class may differ between Unicode versions; texts with them are split by the library.
EXOTIC = regex.compile(r"[՘֋֌࢏౜೜₏₝-₟Ꟁ-ꟿ꭬꭭\U00010000-\U0010ffff]")
#: A space before other white space, or at the end: the pieces around it depend on one another.
LOOSE_SPACE = regex.compile(rf" (?:[{WHITE}]|\Z)")


class PieceSplitter:
    """Pre-token frequencies of texts. Most texts are cut at single spaces first, and each unit's pre-tokens are remembered."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def pieces(self, text: str) -> list[str]:
        if EXOTIC.search(text):
            return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        return PIECE.findall(text)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """The number of special tokens, and the texts between them."""
        if self.at_special and any(s in text for s in self.special):
            cut = self.at_special.split(text)
            return len(cut) - 1, cut
        return 0, [text]

    def units(self, part: str) -> list[str] | None:
        """The text cut at its spaces, each but the first unit without the space that belongs to it; None if it can't be cut so."""
        return None if LOOSE_SPACE.search(part) or EXOTIC.search(part) else part.split(" ")


def piece_frequencies(docs: DataFrame, path: str) -> DataFrame:
    """(piece, freq) over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, units, counts = PieceSplitter(path), Counter(), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for unit, n in units.items():
                for piece in PIECE.findall(" " + unit):
                    counts[piece] += n
            units.clear()
            names, freqs = list(counts), list(counts.values())
            counts.clear()
            for at in range(0, len(names), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 50_000], pa.string()), pa.array(freqs[at : at + 50_000], pa.int64())], ["piece", "freq"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for part in split.parts(text)[1]:
                    cut = split.units(part)
                    counts.update(split.pieces(part if cut is None else cut[0]))
                    if cut:
                        units.update(cut[1:])
                if len(units) + len(counts) >= 2 * MEMO:
                    yield from out()
        yield from out()

    pieces = docs.select("text").where(F.length("text") > 0).mapInArrow(work, "piece string, freq bigint")
    return pieces.groupBy("piece").agg(F.sum("freq").alias("freq"))


def encoded_lengths(pieces: DataFrame, path: str) -> DataFrame:
    """(piece, freq, n_ids): every distinct pre-token encoded once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        tok.encode_special_tokens = True
        for batch in batches:
            lengths = [len(e.ids) for e in tok.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths, pa.int32())], ["piece", "freq", "n_ids"])
        tok.encode_special_tokens = False

    return pieces.mapInArrow(work, "piece string, freq bigint, n_ids int")


def hot_pieces(pieces: DataFrame, most: int) -> dict[str, int]:
    """n_ids of the most frequent pre-tokens: all those at or above the lowest frequency that keeps the table within `most`."""
    least = least_frequency(pieces.where("freq > 1"), "freq", most)
    if least is None:
        return {}
    return {r["piece"]: r["n_ids"] for r in pieces.where(F.col("freq") >= least).select("piece", "n_ids").collect()}


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT_PIECES) -> DataFrame:
    """Per row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = stage(encoded_lengths(piece_frequencies(docs, path), path), "pieces")
    table = docs.sparkSession.sparkContext.broadcast(hot_pieces(pieces, hot))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, hot, numbers = PieceSplitter(path), table.value, row_numbers()
        memo: dict[str, tuple[int, tuple[str, ...]]] = {}

        def looked_up(pieces: list[str]) -> tuple[int, tuple[str, ...]]:
            return sum([hot.get(p, 0) for p in pieces]), tuple([p for p in pieces if p not in hot])

        for batch in batches:
            sizes, known, cold, freqs, ends = [], [], [], [], [0]
            for text in batch.column(1).to_pylist():
                text = text or ""
                n_known, parts = split.parts(text)
                rest: dict[str, int] = {}
                for part in parts:
                    cut = split.units(part)
                    inside, outside = looked_up(split.pieces(part if cut is None else cut[0]))
                    n_known += inside
                    for piece in outside:
                        rest[piece] = rest.get(piece, 0) + 1
                    if not cut:
                        continue
                    units = Counter(cut)
                    units[cut[0]] -= 1
                    for unit, n in units.items():
                        found = memo.get(unit)
                        if found is None:
                            if len(memo) >= MEMO:
                                memo.clear()
                            found = memo[unit] = looked_up(PIECE.findall(" " + unit))
                        n_known += n * found[0]
                        if found[1] and n:
                            for piece in found[1]:
                                rest[piece] = rest.get(piece, 0) + n
                sizes.append(len(text.encode()))
                known.append(n_known)
                cold.extend(rest)
                freqs.extend(rest.values())
                ends.append(len(cold))
            rows = pa.array([next(numbers) for _ in sizes], pa.int64())
            structs = pa.StructArray.from_arrays([pa.array(cold, pa.string()), pa.array(freqs, pa.int64())], ["piece", "freq"])
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)], ["row", "id", "n_bytes", "known", "cold"])

    rows = docs.mapInArrow(work, f"row bigint, id {id_type}, n_bytes bigint, known bigint, cold array<struct<piece:string,freq:bigint>>")
    keyed = rows.select("row", "id", "n_bytes", "known", F.explode_outer("cold").alias("c")).select(
        "row", "id", "n_bytes", "known", F.coalesce("c.freq", F.lit(0)).alias("freq"), F.coalesce("c.piece", F.concat(F.lit("\0"), F.col("row").cast("string"))).alias("piece")
    )
    joined = keyed.join(pieces.select("piece", "n_ids"), "piece", "left")
    summed = joined.groupBy("row", "id", "n_bytes", "known").agg(F.sum(F.col("freq") * F.coalesce("n_ids", F.lit(0))).alias("others"))
    n_tokens = (F.col("known") + F.col("others")).alias("n_tokens")
    return summed.select(F.col("id").alias(id_col), "n_bytes", n_tokens).withColumn("over_limit", F.col("n_tokens") > limit)
