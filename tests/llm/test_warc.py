import glob
import hashlib
import random
import struct
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftwell.llm import warc
from driftwell.llm.files import write_frames
from driftwell.session import scratch_path

LONG = "<p>" + "text of a page " * 20 + "</p>"
ROWS = [
    (1, "http://a/", LONG, "x"), (2, "http://b/\r\nX: y", LONG, "x"), (3, None, LONG + "é", None), (4, "u", None, "x"),
    (5, "u", "", "x"), (6, "u", "short", "x"), (7, "u", "short", "x"), (8, "u", "a" * 99, "x"), (9, "u", "a" * 99, "x"),
    (10, "u", "a" * 100, "x"), (11, "u", "a" * 100, "x"), (None, "u", LONG, "x"), (1, "http://a/", LONG, "x"),
    (12, "u", "<b>\0\n" + "ß" * 300_000, "x"), (None, None, None, None), (13, "u", LONG + "é", "x"),
]


def expected():
    first = {}
    for i, _, html, _ in ROWS:
        p = (html or "").encode()
        if i is not None and len(p) >= 100:
            first[p] = min(first.get(p, i), i)
    for i, _, html, _ in ROWS:
        p = (html or "").encode()
        ref = first.get(p)
        ref = ref if ref is not None and ref != i else None
        yield i, len(p), hashlib.sha256(p).hexdigest(), "response" if ref is None else "revisit", ref, b"" if ref else p


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, payload string").repartition(2)
    path = scratch_path(spark, "archives")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    assert Counter((*(r[f] for f in fields[:5]), bytes(r["payload"])) for r in got) == Counter(expected())
    assert {r["url"] for r in got} == {"http://a/", "http://b/%0D%0AX:%20y", "u", None}
    for name in glob.glob(f"{path}/part-*"):
        with open(name, "rb") as f:
            head = f.read(8)
        if head:
            magic, size = struct.unpack("<II", head)
            assert magic == warc.DICTIONARY_MAGIC and size > 0


def test_archives_are_bounded(spark, monkeypatch):
    pages = [(i, f"http://x/{i}", f"<p>{i * 7919}</p>" * (5 + i % 7)) for i in range(400)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 8000)  # read by the driver's own calls only
    items = [(f"{i:064x}", warc.record(i, u, h.encode(), f"{i:064x}", None)) for i, u, h in pages]
    batch = pa.RecordBatch.from_pylist(
        [{"page_id": i, "url": u, "payload": h.encode(), "payload_digest": f"{i:064x}", "refers_to": None} for i, u, h in pages],
        schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]),
    )
    made = [bytes(x) for b in warc._archives(iter([batch])) for x in b.column("frame").to_pylist()]
    assert len(made) > 10
    read = [list(warc.records(a)) for a in made]
    assert [r for a in read for r in a] == [raw for _, raw in items]
    assert all(sum(map(len, a[:-1])) < 8000 for a in read)


def test_a_file_for_each_archive(spark):
    pages = spark.createDataFrame([(i, "u", "x" * 1000 + str(i)) for i in range(50)], "page_id long, url string, html string")
    path = scratch_path(spark, "archives")
    frames = pages.select(F.encode(F.col("html"), "UTF-8").alias("frame")).coalesce(1)
    write_frames(frames, path, warc.SEPARATOR, rows_per_file=20)
    assert len(glob.glob(f"{path}/part-*")) == 3


def test_frames_without_lengths_are_read(monkeypatch):
    import zstandard as zstd

    raw = [b"abc" * k for k in (1, 50_000, 7)]
    plain = b"".join(zstd.ZstdCompressor().compress(x) + warc.SEPARATOR.encode() for x in raw)
    assert list(warc.records(plain)) == raw
    whole = warc.archive([("f" * 64, b"some record " * 100)])
    for cut in (whole[:-1], whole[:-30], plain[:-9], plain[:3]):
        with pytest.raises(ValueError):
            list(warc.records(cut))


def test_reading_time_follows_the_archive():
    rng = random.Random(2)
    items = [(f"{k:064x}", rng.randbytes(1500)) for k in range(8000)]

    def seconds(n):
        whole = warc.archive(items[:n])
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            assert sum(1 for _ in warc.records(whole)) == n
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(8000) < 3 * seconds(4000)


def test_empty_table(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).collect() == []


def test_dictionary_shrinks_small_records():
    import zstandard as zstd

    samples = [warc.record(i, f"http://x/{i}", f"<html><p>page {i * 7919 % 1000}</p></html>".encode(), "0" * 64, None) for i in range(500)]
    d = warc.build_dictionary(samples)
    plain = sum(len(zstd.ZstdCompressor(level=3).compress(s)) for s in samples)
    with_it = sum(len(zstd.ZstdCompressor(level=3, dict_data=d).compress(s)) for s in samples)
    assert with_it < plain / 2
    assert warc.build_dictionary([]) is None
    assert warc.build_dictionary([b"x"]) is not None


def test_changed_records_are_noticed():
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse(raw)[1] == b"payload"
    for bad in (raw.replace(b"payload", b"paylOad"), raw[:-1], raw.replace(b"WARC/1.1", b"WARC/0.9")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.records(b"\x00" * 16))
