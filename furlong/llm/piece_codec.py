"""SentencePiece encoding and decoding of whole texts: exact encoding under a merge-type (BPE) model by backtracking.

The merges of such a model need not be replayed over a text. A sequence of pieces is its encoding exactly if each piece
re-merges to itself and each adjacent two re-merge to those two; so the encoder takes the longest piece that matches at a place (one
Aho-Corasick pass gives it for every place), goes on if it is compatible with the piece before, else tries the next shorter
prefix, and steps back where none is left. A bitfield marks places from which no encoding goes on, so none is tried twice and
the work is linear in the text. Compatibility is found by re-merging the characters of the two pieces, once for each pair.

No piece crosses two neighbouring characters that stand together in no piece. Texts are cut there and at their spaces, and each
worker process remembers what units and words it has encoded (a bounded number of short ones). Characters that no piece holds become bytes.

Null and empty texts have no ids and decode to the empty string. Null ids and repeated rows are kept, one result row
for each row. An empty table gives an empty result. Models must be of the merge type with byte fallback, a leading space mark and no other
normalisation; others raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SPACE = "▁"
#: Units, words and pairs that a worker remembers, in each of two generations; units and words of more characters than LONG are not kept.
MEMO, PAIRS, LONG = 300_000, 2_000_000, 64

class Merges:
    """The pieces of a model and exact encoding by them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.names[i][1:-1], 16) for i in range(size) if model.is_byte(i)}
        self.control = {i for i in range(size) if model.is_control(i)}
        self.unknown = model.unk_id()
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        if len(self.id_of_byte) < 256 or model.normalize(" a  　ﬁ ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}　ﬁ{SPACE}":
            raise ValueError(f"{path}: needs byte fallback, a leading space mark and no other normalisation")
        plain = [i for i in range(size) if not (i in self.byte_of or i in self.control or i == self.unknown or model.is_unused(i))]
        #: Pieces with higher scores merge first.
        self.rank = {self.names[i]: -model.get_score(i) for i in plain}
        self.pairs = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.by_space = not any(p[1] == SPACE != p[0] for p in self.pairs)
        self.ids = {self.names[i]: i for i in plain if self.merged(self.names[i]) == [self.names[i]]}
        if len(self.ids) < len(plain) // 2:
            raise ValueError(f"{path}: not a merge-type model")
        self.sizes = [len(n) for n in self.names]
        #: Of each piece the longest shorter piece that it begins with.
        self.shorter = [next((self.ids[n[:k]] for k in range(len(n) - 1, 0, -1) if n[:k] in self.ids), -1) for n in self.names]
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matcher.add_word(piece, (len(piece), i))
        self.matcher.make_automaton()
        self.compatible: dict[int, bool] = {}

    def merged(self, text: str, border: int = 0) -> list[str]:
        """The characters of a short text merged by rank, the leftmost first among equals. border: stop at the first merge across that place."""
        parts, rank, none = list(text), self.rank, float("inf")
        ranks = [rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            at = ranks.index(least)
            if border and at == border - 1:
                break
            border -= at < border
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank.get(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank.get(parts[at] + parts[at + 1], none)
        return parts

    def fit(self, a: int, b: int) -> bool:
        """Whether two pieces can stand side by side: their characters, merged again, give the two."""
        key = a * len(self.names) + b
        found = self.compatible.get(key)
        if found is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            left, right = self.names[a], self.names[b]
            found = self.compatible[key] = left + right not in self.rank and self.merged(left + right, len(left)) == [left, right]
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text in the model's spelling (marks for spaces). Characters in no piece, which merge with nothing, become bytes."""
        if text in self.ids:
            return [self.ids[text]]
        longest = [-1] * len(text)
        for end, (size, i) in self.matcher.iter(text):
            longest[end + 1 - size] = i  # matches come by their ends, so the longest from a place comes last
        if -1 not in longest:
            return self.backtracked(longest)
        out, done = [], 0
        while done < len(text):
            stop = longest.index(-1, done) if -1 in longest[done:] else len(text)
            out += self.backtracked(longest[done:stop])
            if stop < len(text):
                out += [self.id_of_byte[b] for b in text[stop].encode()]
            done = stop + 1
        return out

    def backtracked(self, longest: list[int]) -> list[int]:
        """The compatible sequence of pieces, by the longest piece from each place."""
        sizes, shorter, compatible, fit, n = self.sizes, self.shorter, self.compatible, self.fit, len(self.names)
        failed = bytearray(len(longest) // 8 + 1)
        out: list[int] = []
        at, last, stop = 0, -1, len(longest)
        piece = longest[0] if stop else -1
        while at < stop:
            end = at + sizes[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or compatible.get(last * n + piece) or fit(last, piece)):
                out.append(piece)
                at, last = end, piece
                piece = longest[at] if at < stop else -1
                continue
            piece = shorter[piece]
            if piece < 0:  # nothing goes on from here: back to the piece before, which is then tried shorter
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= sizes[piece]
                last = out[-1] if out else -1
        return out

    def decode(self, ids: Iterable[int], start: bool = True) -> str:
        """The text of ids. start: they begin the text, whose leading space mark goes. Bytes that are no UTF-8 give U+FFFD each."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(utf8(bytes(held)))
                held.clear()
                start = False
            if i in self.control:
                continue
            piece = " ⁇ " if i == self.unknown else self.names[i]
            out.append(piece[1:] if start and piece.startswith(SPACE) else piece)
            start = False
        return "".join([*out, utf8(bytes(held))]).replace(SPACE, " ")


def utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[: e.start].decode() + "�" + utf8(raw[e.start + 1 :])


def merges(path: str, cache: dict = {}) -> Merges:  # noqa: B006  one load for each worker process
    if path not in cache:
        cache[path] = Merges(path)
    return cache[path]


class Memo(dict):
    """Values made on demand and remembered, in two generations of MEMO each; those of keys longer than LONG are made anew each time."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> str:
        if len(key) > LONG:
            return self.make(key)
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Coder:
    """The ids of texts in decimal, by what this worker remembers. A unit is what follows a space mark up to the next word's, kept without that mark."""

    def __init__(self, path: str):
        self.model = merges(path)
        self.units, self.words = Memo(self.unit), Memo(self.word)

    def units_of(self, text: str) -> list[str]:
        """The units of a non-empty text without marks in it."""
        if not self.model.by_space:
            return [text]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, run = [], 0
        for part in parts:
            if part:
                out.append(" " * run + part)
                run = 0
            else:
                run += 1
        return [*out, " " * (run - 1)] if run else out

    def word(self, word: str) -> str:
        """A word's ids; it decodes to its own characters, or the codec would not be exact."""
        ids = self.model.encode(word)
        if "".join(map(self.model.names.__getitem__, ids)) != word and self.model.decode(ids, False) != word.replace(SPACE, " "):
            raise ValueError(f"the model does not give back {word!r}")
        return ",".join(map(str, ids))

    def unit(self, unit: str) -> str:
        """A unit's ids: it is cut where no piece crosses, so that its words are found among those of other units."""
        marked, pairs = SPACE + unit.replace(" ", SPACE), self.model.pairs
        if unit.isalpha():
            return self.words[marked]
        if unit[:-1].isalpha() and unit[-2:] not in pairs:
            return f"{self.words[marked[:-1]]},{self.words[unit[-1]]}"
        cuts = [i for i in range(1, len(marked)) if marked[i - 1 : i + 1] not in pairs]
        return ",".join([self.words[marked[a:b]] for a, b in zip([0, *cuts], [*cuts, len(marked)], strict=True)])

    def code(self, text: str | None) -> tuple[int, str, str]:
        """The number of a text's ids, the ids in decimal with commas, and the text they decode to: that of its words, each decoded when it was met."""
        if not text:
            return 0, "", ""
        text = text.replace(SPACE, " ")
        ids = ",".join(map(self.units.__getitem__, self.units_of(text)))
        return ids.count(",") + 1, ids, text


def coded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, str, str]]]]:
    """Each batch (its second column the text) with what code() gives for its rows."""
    coder = Coder(path)
    for batch in batches:
        yield batch, [coder.code(t) for t in batch.column(1).to_pylist()]


def selected(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), docs.schema[id_col].dataType.simpleString()


def code(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (of the decoded text in UTF-8)."""
    docs, id_type = selected(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in coded(batches, path):
            columns = [[r[0] for r in rows], *[[hashlib.sha256(r[k].encode()).hexdigest() for r in rows] for k in (1, 2)]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)]], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(work, f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id and ids array<int>."""
    docs, id_type = selected(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in coded(batches, path):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[int(i) for i in ids.split(",")] if n else [] for n, ids, _ in rows], pa.list_(pa.int32()))], ["id", "ids"])

    return docs.mapInArrow(work, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the text of its ids; null ids give the empty string."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(work, f"id {id_type}, text string").withColumnRenamed("id", id_col)
