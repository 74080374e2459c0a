"""Runs of repeated word sequences in texts, and texts without the repetitions.

A run is a stretch of consecutive words with smallest period q that is at least LEAST
words and TIMES periods long and that no neighbouring word extends. Words of a block of
texts become numbers. For every period, places on a grid whose mesh is below the least
stretch of equal pairs are compared with the words one period on; where they agree, the
longest common extension (LCE) to both sides gives the whole stretch.

An LCE query compares less than COVER words, up to the place where both positions are
samples, and then takes the least common prefix between the ranks of the two sampled
suffixes from a sparse table. Samples are the positions whose remainders modulo COVER lie
in a difference cover, so for any two positions such a place exists; only their suffixes
are sorted, each text's by itself.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24
TIMES = 3
#: Modulus of the difference cover: the powers of 2 modulo 73 are nine residues, of which
#: every difference but 0 occurs exactly once.
COVER = 73
#: Words of a block of texts; a longer text is a block of its own.
BLOCK_WORDS = 1 << 19
#: Grid places looked at at once.
PLACES = 1 << 20

RESIDUES = np.array(sorted({pow(2, k, COVER) for k in range(COVER)}))
_SLOT = np.full(COVER, -1)
_SLOT[RESIDUES] = np.arange(len(RESIDUES))
#: Residue a with a + d in the cover too, by difference d.
_FROM = np.zeros(COVER, np.int64)
for _a in RESIDUES:
    _FROM[(RESIDUES - _a) % COVER] = _a


class Lce:
    """Longest common extensions to the right in ``text``: words of documents from 1 on,
    each document followed by 0; ``doc``: the document of each place."""

    def __init__(self, text: np.ndarray, doc: np.ndarray):
        n = len(text)
        blocks = -(-n // COVER) + 1
        fill = blocks * COVER - n
        # What follows the last document is one that repeats nothing.
        top = int(text.max(initial=0)) + 1
        self.text = np.concatenate([text, np.arange(top, top + fill + COVER)])
        doc = np.concatenate([doc, np.full(fill, int(doc.max(initial=0)) + 1)])
        at = (np.arange(blocks)[:, None] * COVER + RESIDUES).ravel()
        rounds = self._sort(at, doc[at])
        self._prefixes(at, rounds)

    def _sort(self, at: np.ndarray, doc: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Ranks of sampled suffixes; ranks by their first COVER, 2 COVER, ... words."""
        text, n = self.text, len(at)
        bits = int(text.max()).bit_length()
        pack = max(1, min(COVER, 62 // bits))
        rank, left, code, seen = np.zeros(n, np.int64), np.arange(n), doc, 0
        rounds = []
        first_round = True
        while len(left):
            order = np.lexsort((code, rank[left]))
            left, code = left[order], code[order]
            old = rank[left]
            place = np.arange(len(left))
            new = np.append(True, (old[1:] != old[:-1]) | (code[1:] != code[:-1]))
            if first_round:
                head, first_round = 0, False
            else:
                head = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
            rank[left] = old - head + np.maximum.accumulate(np.where(new, place, 0))
            tied = ~(new & np.append(new[1:], True))
            left = left[tied]
            if seen < COVER:
                # Words one after the other, several in a number.
                take = min(pack, COVER - seen)
                code = np.zeros(len(left), np.int64)
                for k in range(take):
                    code = (code << bits) | text[at[left] + seen + k]
                seen += take
            else:
                # Place ``seen`` words on is a sample too.
                rounds.append((seen, rank.copy()))
                step = seen // COVER * len(RESIDUES)
                code = rank[np.minimum(left + step, n - 1)]
                seen *= 2
        self.rank = rank
        return rounds

    def _prefixes(self, at: np.ndarray, rounds: list[tuple[int, np.ndarray]]) -> None:
        """Sparse table of the common prefixes of neighbours in suffix order."""
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for words, rank in reversed(rounds):
            same = rank[a] == rank[b]
            common[same] += words
            step = words // COVER * len(RESIDUES)
            a[same] += step
            b[same] += step
        left = np.arange(len(a))
        p, q = at[a], at[b]
        for k in range(COVER):
            left = left[self.text[p[left] + k] == self.text[q[left] + k]]
            if not len(left):
                break
            common[left] += 1
        self.table = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2
        self.log = np.zeros(len(common) + 2, np.int8)
        for k in range(1, len(self.table)):
            self.log[1 << k :] = k

    def query(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from ``i`` and from ``j`` on that agree; i and j differ and lie in the
        same document."""
        apart = (j - i) % COVER
        ahead = (_FROM[apart] - i) % COVER
        out, left, k = np.zeros(len(i), np.int64), np.arange(len(i)), 0
        while True:
            there = ahead[left] == k
            met = left[there]
            if len(met):
                out[met] = k + self._sampled(i[met] + k, j[met] + k)
            left = left[~there]
            if not len(left):
                return out
            same = self.text[i[left] + k] == self.text[j[left] + k]
            out[left[~same]] = k
            left, k = left[same], k + 1

    def _sampled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = (self.rank[p // COVER * len(RESIDUES) + _SLOT[p % COVER]] for p in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = self.log[high - low]
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            mine = level == k
            t = self.table[k]
            out[mine] = np.minimum(t[low[mine]], t[high[mine] - (1 << int(k))])
        return out


def _laid_out(docs: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    end = np.zeros(1, np.int64)
    text = np.concatenate([x for d in docs for x in (d, end)])
    return text, np.repeat(np.arange(len(docs)), lengths + 1)


def find_runs(docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """doc, start, length, period of all runs, in this order; words are numbers from 1."""
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    text, of = _laid_out(docs, lengths)
    starts = np.cumsum(lengths + 1) - lengths - 1
    right = Lce(text, of)
    left = Lce(_laid_out([d[::-1] for d in docs], lengths)[0], of)
    most = np.where(lengths >= LEAST, lengths // TIMES, 0)  # the largest period
    found = [np.empty((3, 0), np.int64)]
    for doc, period in _periods(lengths, most):
        mesh = np.maximum(LEAST, TIMES * period) - period
        count = -(-(lengths[doc] - period) // mesh)
        k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        period, mesh, doc = (np.repeat(x, count) for x in (period, mesh, doc))
        at = starts[doc] + k * mesh
        same = text[at] == text[at + period]
        at, period, mesh, doc = at[same], period[same], mesh[same], doc[same]
        # Equal words before: the same query in the text read backwards.
        mirror = 2 * starts[doc] + lengths[doc]
        back = np.zeros(len(at), np.int64)
        inner = at > starts[doc]
        back[inner] = left.query((mirror - at - period)[inner], (mirror - at)[inner])
        # A stretch is taken at the first grid place in it.
        first = back < mesh
        at, period, mesh, back = at[first], period[first], mesh[first], back[first]
        equal = back + right.query(at, at + period)
        whole = equal >= mesh
        found.append(np.stack([at - back, equal + period, period])[:, whole])
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # Of the periods of one stretch the smallest.
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    doc = np.searchsorted(starts, start, side="right") - 1
    return doc, start - starts[doc], length, period


def _periods(lengths: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (document, period), in portions of about PLACES grid places."""
    for part in _portions(most):
        doc = np.repeat(part, most[part])
        period = np.arange(len(doc)) - np.repeat(np.cumsum(most[part]) - most[part], most[part]) + 1
        places = (lengths[doc] - period) // np.maximum(LEAST - period, (TIMES - 1) * period) + 1
        cuts = np.searchsorted(np.cumsum(places), np.arange(PLACES, int(places.sum()) + PLACES, PLACES))
        for lo, hi in zip([0, *cuts[:-1]], [*cuts[:-1], len(doc)], strict=True):
            if hi > lo:
                yield doc[lo:hi], period[lo:hi]


def _portions(most: np.ndarray) -> Iterator[np.ndarray]:
    held = np.nonzero(most)[0]
    if len(held):
        yield from np.split(held, np.searchsorted(np.cumsum(most[held]), np.arange(PLACES, int(most.sum()), PLACES)))


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _block(ids: pa.Array, texts: list[list[bytes]], docs: list[np.ndarray]) -> pa.RecordBatch:
    doc, start, length, period = find_runs(docs)
    edges = np.searchsorted(doc, np.arange(len(docs) + 1))
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    kept = []
    for k, words in enumerate(texts):
        lo, hi = edges[k], edges[k + 1]
        if lo < hi:
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start[lo:hi] + period[lo:hi], 1)
            np.add.at(change, start[lo:hi] + length[lo:hi], -1)
            keep = np.cumsum(change)[:-1] == 0
            words = [w for w, stays in zip(words, keep.tolist(), strict=True) if stays]
        kept.append(b" ".join(words))
    columns = [
        ids,
        pa.array([len(d) for d in docs], pa.int64()),
        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs),
        pa.array(kept, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = b.column("text").cast(pa.binary())
        texts, docs, numbers, size, lo = [], [], None, 0, 0
        for k in range(b.num_rows):
            if numbers is None:
                numbers = defaultdict()
                numbers.default_factory = lambda d=numbers: len(d) + 1
            # bytes.split() parts at the six ASCII white-space characters.
            texts.append((raw[k].as_py() or b"").split())
            docs.append(np.array(list(map(numbers.__getitem__, texts[-1])), np.int64))
            size += len(docs[-1])
            if size >= BLOCK_WORDS or k == b.num_rows - 1:
                yield _block(b.column("doc_id").slice(lo, k + 1 - lo), texts, docs)
                texts, docs, numbers, size, lo = [], [], None, 0, k + 1


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc_id``, n_words, runs (array of start, length, period, by start and
    period; words counted from 0), collapsed (the text's words joined by single blanks,
    without those that a run contains after its first period): one per row of ``docs``.

    Null, empty and blank texts have no words, no run and an empty collapsed text. Rows
    are looked at one by one, so repeated rows and ids, ties and an empty table make no
    difference. A text is always looked at whole, in one task. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_runs, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")
    return found.withColumnRenamed("doc_id", doc_id)
