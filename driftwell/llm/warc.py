"""WARC archives whose records are compressed one by one with a shared dictionary.

Each archive starts with a skippable Zstandard frame that holds a dictionary built from
the archive's own records; every record is a frame of its own, compressed with it. So a
record can be read alone, and small records compress as well as large ones. Before each
record a small skippable frame tells its length, so a reader goes from one to the next
without looking for their ends. An archive is a file of bounded size.

Of records with equal payloads one keeps the payload, the others revisit it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm.files import read_files, write_frames

#: Skippable frames: the dictionary's, one before every record with its length, and an
#: empty one that ends a file.
DICTIONARY_MAGIC = 0x184D2A5D
LENGTH_MAGIC = 0x184D2A5C
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
FRAME_MAGIC = 0xFD2FB528
#: Payloads below this many bytes are always stored.
REVISIT_FROM = 100
#: Bytes of records, before compression, after which a task starts the next archive.
ARCHIVE_BYTES = 48 << 20
#: A dictionary is built from about so many bytes of an archive's records, chosen over the
#: whole archive by their digests.
SAMPLE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """Rows page_id, url, payload, payload_digest, refers_to (null for responses)."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    keys = rows.where(F.octet_length("payload") >= REVISIT_FROM).select("page_id", "payload_digest")
    # Counted before they are shuffled; a payload that a third of the pages share is one row.
    groups = (
        keys.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    revisits = (
        keys.join(groups, "payload_digest")
        .where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), F.col("first").alias("refers_to"))
        .distinct()
    )
    return rows.join(
        revisits,
        F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")),
        "left",
    ).drop("_id", "_digest")


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. Control characters and blanks of the URL are percent-encoded."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    if page_id is not None:
        lines += [f"WARC-Record-ID: <urn:page:{page_id}>", f"X-Page-Id: {page_id}"]
    if url:
        lines.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~-._", encoding="utf-8", errors="replace"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
        lines.append("Content-Type: application/http; msgtype=response")
    else:
        block = b""
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Refers-To-Page: {refers_to}"]
    lines += [f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload; raises if lengths or the digest don't agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4:
        raise ValueError("a record's length is wrong")
    payload = rest[:size].partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and (
        "sha256:" + hashlib.sha256(payload).hexdigest() != fields["WARC-Payload-Digest"]
        or len(payload) != int(fields["X-Payload-Length"])
    ):
        raise ValueError("a payload differs from its digest")
    return fields, payload


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES):
    """A trained dictionary; of too few or too small samples, their own bytes."""
    import zstandard as zstd

    total = sum(map(len, samples))
    if not total:
        return None
    try:
        return zstd.train_dictionary(min(size, max(1024, total // 10)), samples, level=LEVEL)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive(items: list[tuple[str, bytes]]) -> bytes:
    """One archive of (payload digest, record)."""
    import zstandard as zstd

    share = SAMPLE_BYTES / max(1, sum(len(raw) for _, raw in items))
    chosen = [raw for digest, raw in items if int(digest[-8:], 16) < share * (1 << 32)]
    dictionary = build_dictionary(chosen or [raw for _, raw in items[:1]])
    packer = zstd.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_dict_id=False)
    raw = dictionary.as_bytes() if dictionary else b""
    out = [struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw]
    for _, record_ in items:
        frame = packer.compress(record_)
        out += [struct.pack("<IIQ", LENGTH_MAGIC, 8, len(frame)), frame]
    return b"".join(out)


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per archive."""

    def row(items):
        return pa.RecordBatch.from_arrays([pa.array([archive(items)], pa.binary())], ["frame"])

    waiting, size = [], 0
    names = ("page_id", "url", "payload", "payload_digest", "refers_to")
    for b in batches:
        for values in zip(*(b.column(n).to_pylist() for n in names), strict=True):
            waiting.append((values[3], record(*values)))
            size += len(waiting[-1][1])
            if size >= ARCHIVE_BYTES:
                yield row(waiting)
                waiting, size = [], 0
    if waiting:
        yield row(waiting)


def write_archives(pages: DataFrame, path: str, page_id="page_id", url="url", html="html") -> None:
    """One record per row, in archives of about ARCHIVE_BYTES before compression.

    A null html is an empty payload, a null id or url leaves its header out. Of equal
    payloads of 100 bytes or more the row with the smallest id is the response; rows that
    repeat that id are responses too, as nothing tells them apart. Other columns are not
    read; an empty table writes archives without records.
    """
    rows = with_revisits(pages, page_id, url, html)
    write_frames(rows.mapInArrow(_archives, "frame binary"), path, SEPARATOR, rows_per_file=1)


def records(content: bytes) -> Iterator[bytes]:
    """The records of one archive, decompressed with the dictionary it starts with.

    Frames without a length before them are found by their own ends, a chunk at a time.
    """
    import zstandard as zstd

    view, at, reader, size = memoryview(content), 0, zstd.ZstdDecompressor(), None
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError("an archive is cut off")
        magic, length = struct.unpack_from("<II", view, at)
        if magic == FRAME_MAGIC:
            if size is None:
                out, size = _one_frame(reader, view[at:])
            elif at + size > len(view):
                raise ValueError("an archive is cut off")
            else:
                out = reader.decompress(view[at : at + size])
            at, size = at + size, None
            yield out
        elif magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8
            if at + length > len(view):
                raise ValueError("an archive is cut off")
            if magic == DICTIONARY_MAGIC and length:
                reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(bytes(view[at : at + length])))
            elif magic == LENGTH_MAGIC:
                (size,) = struct.unpack_from("<Q", view, at)
            at += length
        else:
            raise ValueError("not a Zstandard frame")


def _one_frame(reader, view: memoryview, chunk: int = 1 << 16) -> tuple[bytes, int]:
    """The first frame's content and its length."""
    d, out = reader.decompressobj(), []
    for at in range(0, len(view), chunk):
        part = view[at : at + chunk]
        out.append(d.decompress(part))
        if d.eof:
            return b"".join(out), at + len(part) - len(d.unused_data)
    raise ValueError("an archive is cut off")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows page_id, url, payload_bytes, payload_digest, record_type, refers_to and, on
    request, payload (empty for revisits): one per record, repeated ones each.

    Ids and URLs that were null are null; a folder without records gives an empty table.
    The columns are those of the records, whatever the pages' table had.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held):
            ids, urls, sizes, digests, kinds, refs, bodies = map(list, zip(*held, strict=True))
            columns = [
                pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(sizes, pa.int64()),
                pa.array(digests, pa.string()), pa.array(kinds, pa.string()), pa.array(refs, pa.int64()),
            ]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            if with_payload:
                columns, names = [*columns, pa.array(bodies, pa.binary())], [*names, "payload"]
            return pa.RecordBatch.from_arrays(columns, names)

        for b in batches:
            for content in b.column("content"):
                held, size = [], 0
                for raw in records(content.as_buffer().to_pybytes()):
                    f, payload = parse(raw)
                    number = lambda k, f=f: int(f[k]) if k in f else None
                    held.append((
                        number("X-Page-Id"), f.get("WARC-Target-URI"), number("X-Payload-Length"),
                        f["WARC-Payload-Digest"].removeprefix("sha256:"), f["WARC-Type"],
                        number("X-Refers-To-Page"), payload if with_payload else b"",
                    ))
                    size += len(raw)
                    if size >= 8 << 20:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return read_files(spark, path).mapInArrow(run, kinds + (", payload binary" if with_payload else ""))
