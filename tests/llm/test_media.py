import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from furlong.llm import media as M


def payload_of(text):
    raw = (text or "").encode()
    return raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))


TEXTS = [None, "", "a", "é" * 288, "x" * 576, "x" * 577, "漢字 😀 \0 end", "long " * 60_000, "same", "same"]


def test_round_trip(spark):
    docs = spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, payload string").repartition(3)
    rows = M.text_media(docs).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id or 0]
        payload = payload_of(text)
        assert (r.n_bytes, r.payload_bytes) == (len((text or "").encode()), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        media = M.to_png(payload)
        assert (r.media_bytes, r.media_sha256, r.feature, r.error) == (len(media), hashlib.sha256(media).hexdigest(), M.feature(payload), None)


def test_ranges_cover_every_member_once_and_damage_stays_alone(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/a"
    M.store(spark.range(40).select(F.col("id"), M.padded(F.repeat(F.concat(F.lit("row "), F.col("id").cast("string")), 50)).alias("payload")).coalesce(1), path)
    monkeypatch.setattr(M, "SPLIT_BYTES", 900)
    reader = M.ArchiveReader(path)
    ranges = reader.partitions()
    assert len(ranges) > 3
    got = [r for part in ranges for batch in reader.read(part) for r in batch.to_pylist()]
    assert sorted(int(r["id"]) for r in got) == list(range(40)) and all(r["attempts"] == 1 for r in got)
    archive = next(tmp_path.glob("a/*.zip"))
    raw = bytearray(archive.read_bytes())
    raw[got[5]["offset"] + 60] ^= 255
    archive.write_bytes(raw)
    again = [r for part in ranges for batch in reader.read(part) for r in batch.to_pylist()]
    assert [(r["id"], r["attempts"]) for r in again if r["error"]] == [(got[5]["id"], M.RETRIES)]
    assert sum(r["payload"] is not None for r in again) == 39


def test_a_member_is_read_again_alone(monkeypatch):
    calls = []

    class Flaky(M.Members):
        def __init__(self):
            pass

        def once(self, info):
            calls.append(info)
            if len(calls) < 3:
                raise OSError("lost")
            return b"x"

    assert Flaky().read("m") == (3, None, b"x") and len(calls) == 3


def test_empty_table_and_bad_payload(spark):
    assert M.text_media(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        M.to_png(b"abc")
