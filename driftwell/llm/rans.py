"""Token ids in files coded by a static range asymmetric numeral system.

A file is a run of sections. A section has whole documents, about SECTION ids, and one
frequency table that all its blocks share. A block has BLOCK ids dealt over LANES
interleaved coder states that write into one stream of 32-bit words. Every CHECKPOINT ids
the section notes each lane's state, the place in the stream and the ids' crc32, so that
a reader can start at any checkpoint; the reader here decodes all of a section's
checkpoints side by side.

Section: magic, length, crc32, then a header of seven numbers and the parts it gives the
lengths of: table, document index, block lengths, checkpoint states, checkpoint places,
checksums, words. Files hold consecutive documents in ascending order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwell.llm.files import read_files, write_frames
from driftwell.llm.tokens import encoder, in_steps

MAGIC = b"RANS\x01"
SCALE = 20  # frequencies sum to 2 ** SCALE
LOW = 1 << 31  # states lie in [LOW, LOW << 32)
LANES = 32
BLOCK = 1 << 15
CHECKPOINT = 1 << 13
SECTION = 1 << 21
#: Text bytes per file.
FILE_BYTES = 24 << 20
SEPARATOR = "\n"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts (none zero) as integers of at least 1 that sum to 2 ** SCALE."""
    total = 1 << SCALE
    if len(counts) > total:
        raise ValueError("more symbols than the table can tell apart")
    free = total - len(counts)
    share = counts.astype(np.float64) / counts.sum() * free
    freq = np.floor(share).astype(np.int64)
    rest = free - int(freq.sum())
    freq[np.argsort(freq - share, kind="stable")[:rest]] += 1
    return freq + 1


def _encode_blocks(sym: np.ndarray, freq: np.ndarray, start: np.ndarray):
    """sym: blocks x steps x lanes. Returns words and their mask (same shape), and the
    states that a decoder has before every step that is a checkpoint."""
    blocks, steps, lanes = sym.shape
    x = np.full((blocks, lanes), LOW, np.uint64)
    words, mask = np.empty(sym.shape, np.uint32), np.empty(sym.shape, bool)
    every = CHECKPOINT // LANES
    states = np.empty((blocks, -(-steps // every), lanes), np.uint64)
    shift, scale = np.uint64(32), np.uint64(SCALE)
    limit = freq << np.uint64(31 - SCALE + 32)
    for s in range(steps - 1, -1, -1):
        now = sym[:, s]
        f = freq[now]
        out = x >= limit[now]
        words[:, s] = x  # the low 32 bits
        mask[:, s] = out
        x = np.where(out, x >> shift, x)
        q, r = np.divmod(x, f)
        x = (q << scale) + r + start[now]
        if s % every == 0:
            states[:, s // every] = x
    return words, mask, states


def encode_section(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    symbols, at, counts = np.unique(ids, return_inverse=True, return_counts=True)
    freq = frequencies(counts) if len(counts) else np.empty(0, np.int64)
    start = np.cumsum(freq) - freq
    f64, s64 = freq.astype(np.uint64), start.astype(np.uint64)
    full = len(ids) // BLOCK
    parts = []
    if full:
        parts.append(at[: full * BLOCK].reshape(full, BLOCK // LANES, LANES))
    tail = at[full * BLOCK :]
    if len(tail):
        # The last step is filled up; the reader knows how many ids are real.
        padded = np.concatenate([tail, np.zeros(-len(tail) % LANES, tail.dtype)])
        parts.append(padded.reshape(1, -1, LANES))
    block_words, states, places, streams = [], [], [], []
    every = CHECKPOINT // LANES
    for sym in parts:
        words, mask, state = _encode_blocks(sym, f64, s64)
        for b in range(len(sym)):
            stream = words[b][mask[b]]
            per_step = mask[b].sum(1)
            before = np.cumsum(per_step) - per_step
            streams.append(stream)
            block_words.append(len(stream))
            states.append(state[b].ravel())
            places.append(before[::every])
    cat = lambda xs, kind: np.concatenate(xs).astype(kind).tobytes() if xs else b""
    raw = ids.astype("<u4")
    sums = np.array(
        [zlib.crc32(raw[i : i + CHECKPOINT]) for i in range(0, len(raw), CHECKPOINT)], "<u4"
    )
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    index = (
        nulls.tobytes()
        + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + np.asarray(lengths, "<i8").tobytes()
    )
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes())
    pieces = [
        table,
        zlib.compress(index),
        np.array(block_words, "<u4").tobytes(),
        cat(states, "<u8"),
        cat(places, "<u4"),
        sums.tobytes(),
        cat(streams, "<u4"),
    ]
    head = struct.pack("<QQQ7Q", len(ids), len(doc_ids), len(symbols), *map(len, pieces))
    body = head + b"".join(pieces)
    return MAGIC + struct.pack("<QI", len(body), zlib.crc32(body)) + body


def decode_section(body: bytes, wanted: np.ndarray | None = None):
    """ids, doc_ids, lengths. ``wanted``: the checkpoints to decode, all if None."""
    size = struct.calcsize("<QQQ7Q")
    n, docs, kinds, *lens = struct.unpack_from("<QQQ7Q", body)
    parts, at = [], size
    for k in lens:
        parts.append(body[at : at + k])
        at += k
    table = np.frombuffer(zlib.decompress(parts[0]), "<u4")
    symbols = np.cumsum(table[:kinds].astype(np.int64)).astype(np.uint32)
    freq = table[kinds:].astype(np.uint64)
    index = zlib.decompress(parts[1])
    nulls = np.frombuffer(index, np.uint8, docs)
    held = np.frombuffer(index, "<i8", docs, docs)
    lengths = np.frombuffer(index, "<i8", docs, docs * 9)
    doc_ids = [None if z else int(d) for z, d in zip(nulls, held, strict=True)]
    block_words = np.frombuffer(parts[2], "<u4").astype(np.int64)
    states = np.frombuffer(parts[3], "<u8").reshape(-1, LANES)
    sums = np.frombuffer(parts[5], "<u4")
    words = np.frombuffer(parts[6], "<u4").astype(np.uint64)
    per_block = BLOCK // CHECKPOINT
    block_of = np.arange(len(states)) // per_block
    places = np.frombuffer(parts[4], "<u4").astype(np.int64) + (np.cumsum(block_words) - block_words)[block_of]
    chosen = np.arange(len(states)) if wanted is None else wanted
    ids = _decode(chosen, states, places, words, symbols, freq, n)
    for c, got in zip(chosen, ids, strict=True):
        if zlib.crc32(got) != sums[c]:
            raise ValueError(f"checkpoint {c} of a section fails its checksum")
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    return flat, doc_ids, lengths


def _decode(chosen, states, places, words, symbols, freq, n) -> list[np.ndarray]:
    if not len(chosen):
        return []
    start = np.cumsum(freq) - freq
    slot_of = np.repeat(np.arange(len(freq), dtype=np.int32), freq.astype(np.int64))
    counts = np.minimum(CHECKPOINT, n - chosen * CHECKPOINT)
    steps = -(-counts // LANES)
    x, pos = states[chosen].astype(np.uint64), places[chosen].copy()
    words = np.concatenate([words, np.zeros(LANES, np.uint64)])
    out = np.empty((len(chosen), int(steps.max()), LANES), np.uint32)
    low, mask, scale, shift = np.uint64(LOW), np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for s in range(out.shape[1]):
        slot = x & mask
        sym = slot_of[slot.astype(np.int64)]
        out[:, s] = symbols[sym]
        x = freq[sym] * (x >> scale) + slot - start[sym]
        # A checkpoint that has ended goes on reading nothing.
        need = (x < low) & (s < steps)[:, None]
        order = np.cumsum(need, 1)
        at = np.minimum(pos[:, None] + order - 1, len(words) - 1)
        x = np.where(need, (x << shift) | words[at], x)
        pos += order[:, -1]
    return [np.ascontiguousarray(o.reshape(-1)[:c]) for o, c in zip(out, counts, strict=True)]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, blank_joins: bool, lower: bool, end: int,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode every whole text, append id ``end``, write files in ascending doc_id order.

    A null text is empty: its end alone. Null ids come first, equal ids in the order of
    their texts. Other columns of ``docs`` are not read. An empty table writes no section.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(int(max(1, -(-size // FILE_BYTES))), F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, mark = encoder(tokenizer, blank_joins, lower), np.array([end], "<u4").tobytes()
        file_no = TaskContext.get().partitionId()
        head = b"FILE" + struct.pack("<Q", file_no)
        ids, held, lengths, size = [], [], [], 0

        def section() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            frame = head + encode_section(flat, held, np.array(lengths, np.int64))
            return pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["frame"])

        for b in batches:
            keys, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            done = 0
            for some in in_steps(texts):
                for key, raw in zip(keys[done : done + len(some)], encode(some), strict=True):
                    ids += [raw, mark]
                    held.append(key)
                    lengths.append(len(raw) // 4 + 1)
                    size += lengths[-1]
                    if size >= SECTION:
                        yield section()
                        ids, held, lengths, size = [], [], [], 0
                done += len(some)
        if held:
            yield section()

    write_frames(rows.mapInArrow(run, "frame binary"), path, SEPARATOR)


def sections(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(file number, body) of each section; raises on a broken one."""
    at, skip = 0, len(MAGIC)
    view = memoryview(content)
    while at < len(view):
        (file_no,) = struct.unpack_from("<Q", view, at + 4)
        if bytes(view[at : at + 4]) != b"FILE" or bytes(view[at + 12 : at + 12 + skip]) != MAGIC:
            raise ValueError("no section starts here")
        at += 12 + skip
        size, crc = struct.unpack_from("<QI", view, at)
        at += 12
        body = bytes(view[at : at + size])
        if len(body) != size or zlib.crc32(body) != crc:
            raise ValueError("a section is cut off or changed")
        yield file_no, body
        at += size + len(SEPARATOR)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Rows doc_id, start, n_tokens, ids_crc32 and, on request, ids (array of long).

    ``start`` counts the ids of all documents before, over all files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                first = 0
                for file_no, body in sections(content.as_buffer().to_pybytes()):
                    ids, doc_ids, lengths = decode_section(body)
                    ends = np.cumsum(lengths)
                    starts = ends - lengths
                    raw = ids.astype("<u4")
                    crc = [zlib.crc32(raw[s:e]) for s, e in zip(starts, ends, strict=True)]
                    columns = [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(np.full(len(doc_ids), file_no, np.int64)),
                        pa.array(starts + first),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ]
                    names = ["doc_id", "file_no", "inside", "n_tokens", "ids_crc32"]
                    if with_ids:
                        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int64))
                        columns.append(pa.LargeListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64())))
                        names.append("ids")
                    first += int(lengths.sum())
                    yield pa.RecordBatch.from_arrays(columns, names)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From the sections' headers alone."""
        for b in batches:
            held = [
                (file_no, struct.unpack_from("<Q", body)[0])
                for content in b.column("content")
                for file_no, body in sections(content.as_buffer().to_pybytes())
            ]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], ["file_no", "n"])

    kinds = "doc_id long, file_no long, inside long, n_tokens long, ids_crc32 long"
    got = read_files(spark, path).mapInArrow(run, kinds + (", ids array<long>" if with_ids else ""))
    sizes = read_files(spark, path).mapInArrow(totals, "file_no long, n long")
    sizes = sizes.groupBy("file_no").agg(F.sum("n").alias("n"))
    before = Window.partitionBy().orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return got.join(offsets, "file_no").select(
        "doc_id",
        (F.col("offset") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
