"""Benchmark passages in documents, found through an FM-index of each training shard.

A word is a run of ASCII letters and digits in lower case or of characters beyond ASCII.
A task cuts its documents into shards of about SHARD_WORDS words. A shard's words become
numbers, its suffixes are sorted (each document ends with a mark of its own, so no match
runs across two), and the words before the sorted suffixes go into a wavelet matrix with
rank counts. All phrases are searched backwards at once: a word narrows each phrase's
range of suffixes by two ranks. Occurrences are located by stepping back to the next
sampled suffix; their words are merged into spans.

Phrases go to the tasks in blocks of bounded size, each block against all documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.text import LOWER, UPPER, ascii_lower, stored

#: Words of a window.
WINDOW = 10
SHARD_WORDS = 1 << 20
#: Every so many words a suffix position is kept, besides the starts of documents.
SAMPLE = 16
#: Bytes of phrases that go to every task at once.
BLOCK_BYTES = 16 << 20
#: Occurrences located at once.
LOCATED = 1 << 19
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256)).translate(
    bytes.maketrans(UPPER.encode(), LOWER.encode())
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_SPACED).split()


def suffix_order(keys: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes. The last key occurs once, and so does
    some key in any stretch that two suffixes are compared over."""
    n, bits = len(keys), max(1, int(keys.max()).bit_length())
    step = max(1, 62 // bits)
    code = np.zeros(n, np.int64)
    padded = np.concatenate([keys.astype(np.int64), np.zeros(step, np.int64)])
    for k in range(step):
        code = (code << bits) | padded[k : k + n]
    at = np.argsort(code)
    code = code[at]
    rank = np.empty(n, np.int64)
    base = np.zeros(n, np.int64)
    # Rank: the first place of a group of suffixes not told apart yet. Only those go on.
    while len(at):
        first = np.empty(len(at), bool)
        first[0] = True
        np.not_equal(code[1:], code[:-1], out=first[1:])
        group = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        # Within its old group a suffix moves on by its new group's place there.
        rank[at] = base + group
        last = np.append(first[1:], True)
        tied = ~(first & last)
        at = at[tied]
        code = rank[at] * n + rank[np.minimum(at + step, n - 1)]
        new = np.argsort(code)
        at, code = at[new], code[new]
        old = rank[at]
        head = np.empty(len(at), bool)
        if len(at):
            head[0] = True
            np.not_equal(old[1:], old[:-1], out=head[1:])
        # base + group must be the old rank plus the place inside the old group.
        base = old - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.cumsum(np.bitwise_count(self.words), dtype=np.int32)
        self.before = np.concatenate([np.zeros(1, np.int32), ones[:-1]])
        self.ones = int(ones[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class Index:
    """FM-index over documents given as arrays of word numbers from 1 on."""

    def __init__(self, docs: list[np.ndarray], symbols: int):
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        ends = np.cumsum(lengths + 1) - 1
        self.starts, self.size = ends - lengths, int(ends[-1]) + 1
        text = np.zeros(self.size, np.int64)  # 0: a document's end
        keys = np.empty(self.size, np.int64)
        inside = np.ones(self.size, bool)
        inside[ends] = False
        text[inside] = np.concatenate(docs)
        keys[inside] = text[inside] + len(docs)
        keys[ends] = np.arange(len(docs))
        order = suffix_order(keys)
        del keys
        before = text[order - 1]
        starting = np.zeros(self.size, bool)
        starting[self.starts] = True
        before[starting[order]] = 0
        kept = (order % SAMPLE == 0) | starting[order]
        self.marks, self.samples = Bits(kept), order[kept]
        del order
        counts = np.bincount(text, minlength=symbols)
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            one = (before >> shift) & 1 > 0
            bits = Bits(one)
            self.levels.append((shift, bits, self.size - bits.ones))
            before = np.concatenate([before[~one], before[one]])
        # Suffixes that start with a smaller symbol, less where the symbol's own part of
        # the last level starts.
        every = np.arange(symbols)
        self.base = np.zeros(symbols, np.int64)
        self.base = np.cumsum(counts) - counts - self.preceded(every, np.zeros(symbols, np.int64))

    def preceded(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Suffixes that start with ``symbol`` followed by one of the first ``at``."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1 > 0, zeros + ones, at - ones)
        return self.base[symbol] + at

    def back(self, at: np.ndarray) -> np.ndarray:
        """Place of the suffix that is one word longer."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            ones, one = bits.rank(at), bits.get(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return self.base[symbol] + at

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that start with each phrase (rows of symbols)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        left = np.arange(len(phrases))
        for back in range(1, phrases.shape[1] + 1):
            left = left[(lengths[left] >= back) & (high[left] > low[left])]
            if not len(left):
                break
            symbol = phrases[left, lengths[left] - back]
            low[left], high[left] = self.preceded(symbol, low[left]), self.preceded(symbol, high[left])
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by stepping back to sampled ones."""
        out, steps, left = np.empty(len(at), np.int64), 0, np.arange(len(at))
        while len(left):
            there = self.marks.get(at)
            out[left[there]] = self.samples[self.marks.rank(at[there])] + steps
            left, at = left[~there], at[~there]
            at = self.back(at) if len(at) else at
            steps += 1
        return out


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases as rows of places in ``words`` (-1: none), and who owns them:
    ``names[owners[first[k] : first[k + 1]]]`` for phrase k."""

    words: list[bytes]
    rows: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    owners: np.ndarray
    names: list[str]


def pack_phrases(pairs: list[tuple[str, str]]) -> Phrases:
    """From (phrase, owner), the phrase's words joined by blanks."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    names = sorted({owner for _, owner in pairs})
    name_at = {s: k for k, s in enumerate(names)}
    pairs = sorted(pairs)
    texts, first, owners = [], [], []
    for phrase, owner in pairs:
        if not texts or texts[-1] != phrase:
            texts.append(phrase)
            first.append(len(owners))
        owners.append(name_at[owner])
    cut = [t.encode().split(b" ") for t in texts]
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    rows = np.full((len(cut), int(lengths.max(initial=1))), -1, np.int64)
    for k, ws in enumerate(cut):
        rows[k, : len(ws)] = [numbers[w] for w in ws]
    return Phrases(list(numbers), rows, lengths, np.array([*first, len(owners)]), np.array(owners, np.int64), names)


def hits(docs: list[np.ndarray], numbers: dict[bytes, int], phrases: Phrases):
    """Of a shard: which words lie in an occurrence (documents one after the other, each
    with its end), documents' starts, and sorted (document, owner) pairs."""
    index = Index(docs, len(numbers) + 1)
    known = np.array([numbers.get(w, -1) for w in phrases.words] + [-1], np.int64)
    rows = known[phrases.rows]
    real = np.arange(rows.shape[1])[None, :] < phrases.lengths[:, None]
    there = np.nonzero(((rows >= 0) | ~real).all(1))[0]
    low, high = index.search(rows[there], phrases.lengths[there])
    edges, pairs = np.zeros(index.size + 1, np.int64), [np.empty(0, np.int64)]
    count = high - low
    there, low, count = there[count > 0], low[count > 0], count[count > 0]
    upto, names = np.cumsum(count), len(phrases.names)
    for start in range(0, int(count.sum()), LOCATED):
        # Occurrences number ``start`` and on, over all phrases.
        number = np.arange(start, min(start + LOCATED, int(upto[-1])))
        k = np.searchsorted(upto, number, side="right")
        at = index.locate(low[k] + number - (upto[k] - count[k]))
        length = phrases.lengths[there[k]]
        edges += np.bincount(at, minlength=len(edges)) - np.bincount(at + length, minlength=len(edges))
        doc = np.searchsorted(index.starts, at, side="right") - 1
        met = np.unique(doc * len(phrases.lengths) + there[k])
        doc, phrase = met // len(phrases.lengths), met % len(phrases.lengths)
        owned = phrases.first[phrase + 1] - phrases.first[phrase]
        spot = np.arange(int(owned.sum())) - np.repeat(np.cumsum(owned) - owned, owned) + np.repeat(phrases.first[phrase], owned)
        pairs.append(np.unique(np.repeat(doc, owned) * names + phrases.owners[spot]))
    pairs = np.unique(np.concatenate(pairs))
    return np.cumsum(edges)[:-1] > 0, index.starts, np.stack([pairs // max(names, 1), pairs % max(names, 1)])


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


SPAN = "struct<first: bigint, n: bigint>"


def _shard(ids, texts, docs, numbers, before, phrases: Phrases, names: list[str]) -> pa.RecordBatch:
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    cover, starts, pairs = hits(docs, numbers, phrases)
    found = [[phrases.names[o] for o in part] for part in np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, len(docs))))]
    for k, (spans, items) in enumerate(before):  # of the blocks of phrases before this one
        for s in spans:
            cover[starts[k] + s["first"] : starts[k] + s["first"] + s["n"]] = True
        if items:
            found[k] = sorted({*items, *found[k]})
    edge = np.diff(np.concatenate([[0], cover.astype(np.int8), [0]]))
    first, end = np.nonzero(edge > 0)[0], np.nonzero(edge < 0)[0]
    doc = np.searchsorted(starts, first, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(first - starts[doc]), pa.array(end - first)], ["first", "n"])
    items = pa.array(found, pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays(
        [ids, texts, pa.array(lengths), _lists(np.bincount(doc, minlength=len(docs)), spans), items], names
    )


def _search(share, keep: bool):
    """``keep``: pass texts on, for later blocks or the result."""
    names = ["doc_id", "text", "n_words", "spans", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = share.value
        held: list[tuple[pa.RecordBatch, int, int]] = []
        docs, before, numbers, size = [], [], None, 0

        def shard() -> pa.RecordBatch:
            parts = pa.Table.from_batches([b.slice(lo, hi - lo) for b, lo, hi in held]).combine_chunks()
            ids = parts.column(0).combine_chunks()
            texts = parts.column(1).combine_chunks() if keep else pa.nulls(len(ids), pa.string())
            return _shard(ids, texts, docs, numbers, before, phrases, names)

        for b in batches:
            lo, texts = 0, b.column(1).cast(pa.binary())
            # What blocks of phrases before this one have found.
            earlier = [b.column(k).to_pylist() for k in (3, 4)] if b.num_columns > 2 else None
            for k in range(b.num_rows):
                if numbers is None:
                    numbers = defaultdict()
                    numbers.default_factory = lambda d=numbers: len(d) + 1
                docs.append(np.array(list(map(numbers.__getitem__, words_of(texts[k].as_py()))), np.int64))
                before.append((earlier[0][k], earlier[1][k]) if earlier else ((), ()))
                size += len(docs[-1]) + 1
                if size >= SHARD_WORDS:
                    held.append((b, lo, k + 1))
                    yield shard()
                    held, docs, before, numbers, size, lo = [], [], [], None, 0, k + 1
            if lo < b.num_rows:
                held.append((b, lo, b.num_rows))
        if docs:
            yield shard()

    return run


def windows(items: DataFrame, item_id: str, text: str, size: int = WINDOW) -> DataFrame:
    """Distinct rows phrase, owner: every ``size`` consecutive words of a text; of a
    shorter text all its words."""
    words = F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BREAK), lambda w: w != "")
    cut = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("owner"), words.alias("words"))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    phrases = F.transform(starts, lambda i: F.array_join(F.slice("words", i, size), " "))
    return cut.where(n > 0).select("owner", F.explode(phrases).alias("phrase")).distinct()


def find_overlaps(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, with_text: bool = False,
) -> DataFrame:
    """Rows ``doc_id``, n_words, spans (array of first word and number of words, merged and
    ascending), items (ids as sorted texts) and, on request, ``text``: one per document.

    Null texts have no words; items without words own no window; a null item id is the
    empty text. Repeated items count once, repeated rows and ids are searched each by
    itself, and no row depends on the shard that it falls into. Empty tables give no rows,
    or rows without spans. Other columns are not read.
    """
    spark = docs.sparkSession
    pairs = stored(windows(items, item_id, item_text, size), "fm-phrases")
    bytes_ = pairs.agg(F.sum(F.octet_length("phrase") + F.octet_length("owner"))).first()[0] or 0
    blocks = max(1, -(-bytes_ // BLOCK_BYTES))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {kind}, text string, n_words long, spans array<{SPAN}>, items array<string>"
    for b in range(blocks):
        part = F.pmod(F.xxhash64("phrase", "owner"), F.lit(blocks)) == b
        table = pairs.where(part).toArrow()  # about BLOCK_BYTES
        phrases = pack_phrases(list(zip(*(table.column(c).to_pylist() for c in ("phrase", "owner")), strict=True)))
        rows = rows.mapInArrow(_search(spark.sparkContext.broadcast(phrases), with_text or b < blocks - 1), kinds)
        if b < blocks - 1:
            rows = stored(rows, "fm-overlaps")
    return rows.select(F.col("doc_id").alias(doc_id), *([F.col("text").alias(text)] if with_text else []), "n_words", "spans", "items")


def covered(spans: Column) -> Column:
    """Words in all spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["n"])


def cut_overlaps(found: DataFrame, text: str = "text") -> DataFrame:
    """Rows of `find_overlaps` (with their text), where the text has lost its spans: from
    the first character of a span's first word to the last of its last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, spans in zip(b.column(text).cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
                if spans:
                    places, at, plain = [], 0, raw.translate(_SPACED)
                    for w in plain.split():
                        at = plain.index(w, at)
                        places.append((at, at + len(w)))
                        at += len(w)
                    kept, at = [], 0
                    for s in spans:
                        kept.append(raw[at : places[s["first"]][0]])
                        at = places[s["first"] + s["n"] - 1][1]
                    raw = b"".join([*kept, raw[at:]])
                out.append(raw)
            columns = [pa.array(out, pa.binary()).cast(pa.string()) if n == text else b.column(n) for n in b.schema.names]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return found.mapInArrow(run, found.schema)
