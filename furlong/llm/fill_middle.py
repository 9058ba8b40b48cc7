"""Fill-in-middle transformation of whole texts by one repeated-capture match.

A text is a run of units, by default code points. One fullmatch of (unit)* keeps every repetition of its group, so the ends of
the group give the number of units and both cut offsets at once; nothing steps through the text. Which units the cuts
follow and which form a document takes come from four numbers of the digest of `seed:id`, so a document is cut alike in
every run, on every machine and in any order.

Forms: plain, the text as it is; psm, prefix, suffix, middle behind their marks; spm, suffix first. Texts that are empty, that hold
a mark, or that units do not tile (with a unit other than code points) stay plain; so output and form give the exact text back.
Null texts are empty; a null id counts as an empty decimal. Repeated rows give repeated results. A text takes
some 120 bytes a code point while it is matched, one text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
CODE_POINT = r"(?s:.)"
COLUMNS = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(seed: int, key: object) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    said = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(said[i : i + 8], 16) for i in (0, 8, 16, 24)]


def cut(text: str, units: regex.Pattern, numbers: list[int], plain: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle (None if plain), and output. plain, spm: per cent of all texts and of those that are cut."""
    match = units.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    if not n or numbers[2] % 100 >= 100 - plain or any(m in text for m in MARKS):
        return n, "plain", None, None, text
    first, second = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, second))
    p, s, m = MARKS
    if numbers[3] % 100 < spm:
        return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def transform(docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, unit: str = CODE_POINT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n units, form, prefix_chars, middle_chars (null if plain) and output."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        for batch in batches:
            rows = [cut(text or "", units, draws(seed, key), plain, spm) for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            n, form, before, middle, output = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"id {id_type}, {COLUMNS}").withColumnRenamed("id", id_col)


def restored(form: Column, output: Column) -> Column:
    """The text of an output. As no text that is cut holds a mark, the first of each mark is the one that was put there."""
    p, s, m = MARKS
    inner = F.substr(output, F.lit(len(p) + 1))
    first = lambda c, mark: F.substring_index(c, mark, 1)
    rest = lambda c, mark: F.substring_index(c, mark, -1)  # noqa: E731  each mark stands there once
    middle = rest(inner, m)
    psm, spm = F.concat(first(inner, s), middle, first(rest(inner, s), m)), F.concat(first(rest(inner, p), m), middle, first(inner, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(cuts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What transform() made, with digests in place of the output and of the text rebuilt from it."""
    sha = lambda c, name: F.sha2(c, 256).alias(name)
    return cuts.select(id_col, "n", "form", "prefix_chars", "middle_chars", sha(F.col("output"), "output_sha256"), sha(restored(F.col("form"), F.col("output")), "restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
k AS (SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain' WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, n, form, substring(t, 1, least(a, b)) AS pre, substring(t, least(a, b) + 1, abs(a - b)) AS mid, substring(t, greatest(a, b) + 1) AS suf FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
