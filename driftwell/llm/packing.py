"""Best-fit packing of documents into sequences of a fixed length.

The histogram of piece lengths (at most ``capacity`` rows) makes a configuration linear
program: how often is each pattern of lengths used, so that all pieces are covered by as
few sequences as possible? Multiplicative weights solve it: a length's price falls as its
coverage grows, and a knapsack dynamic program prices the patterns. The solution is
rounded at random to whole numbers; what it leaves is packed by best fit, whole runs of
equal sequences at a time. The pieces themselves never leave the tasks: a piece's place
follows from its number among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.text import stored
from driftwell.llm.tokens import encoder, in_steps

CAPACITY = 4096
#: Rounds of the weights, how fast prices fall, how near the best a pattern has to be.
ROUNDS, RATE, NEAR = 12, 1.0, 2e-3


def _knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """best[c]: the highest price of pieces that fit in c, each length as often as liked."""
    best = np.zeros(capacity + 1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = upto[c]
        if k:
            best[c] = max(best[c - 1], (price[:k] + best[c - lengths[:k]]).max())
    return best


def _patterns(price, best, lengths, counts, capacity, rng, rows=256) -> list[Counter]:
    """For each length a pattern that has it and is else filled near the best price.

    Of the pieces that keep the price near the best, one is drawn by how many there are,
    again and again, so that patterns share the pieces out.
    """
    out: list[Counter] = []
    weight = counts.astype(float)
    for lo in range(0, len(lengths), rows):
        mine = np.arange(lo, min(lo + rows, len(lengths)))
        room = capacity - lengths[mine]
        found = [Counter({int(lengths[i]): 1}) for i in mine]
        active = np.arange(len(mine))
        while len(active):
            r = room[active]
            left = r[:, None] - lengths[None, :]
            value = np.where(left >= 0, price[None, :] + best[np.maximum(left, 0)], -1.0)
            good = value >= (best[r] * (1 - NEAR))[:, None]
            good &= left >= 0
            score = np.where(good, weight[None, :], 0.0)
            total = np.cumsum(score, 1)
            has = total[:, -1] > 0
            pick = (total < (rng.random(len(active)) * total[:, -1])[:, None]).sum(1)
            pick = np.minimum(pick, len(lengths) - 1)
            for a, k in zip(active[has], pick[has], strict=True):
                found[a][int(lengths[k])] += 1
            room[active[has]] -= lengths[pick[has]]
            active = active[has]
        out += found
    return out


def solve(counts: np.ndarray, capacity: int = CAPACITY, seed: int = 5) -> list[tuple[int, Counter]]:
    """(how often, pattern) for ``counts[length]``; patterns cover the counts exactly."""
    left = counts.astype(np.int64).copy()
    rng = np.random.default_rng(seed)
    plan: list[tuple[int, Counter]] = []

    def use(pattern: Counter, times: int) -> None:
        times = min([times, *(int(left[n]) // k for n, k in pattern.items())])
        if times > 0:
            plan.append((times, pattern))
            for n, k in pattern.items():
                left[n] -= times * k

    lengths = np.nonzero(left)[0]
    have = left[lengths]
    if len(lengths) > 1:
        covered = np.zeros(len(lengths))
        at = {int(n): i for i, n in enumerate(lengths)}
        chosen: list[tuple[float, Counter]] = []
        for _ in range(ROUNDS):
            price = lengths / capacity * np.exp(-RATE * (covered - covered.min()))
            best = _knapsack(price, lengths, capacity)
            value = price + best[capacity - lengths]
            patterns = _patterns(price, best, lengths, have, capacity, rng)
            # Each length asks for what it still lacks; the round is scaled so that no
            # length is covered by more than its part of the rounds.
            ask = have * np.maximum(0.0, 1 - covered) * (value >= (1 - 0.1) * best[capacity])
            gain = np.zeros(len(lengths))
            for a, p in zip(ask, patterns, strict=True):
                for n, k in p.items():
                    gain[at[n]] += a * k
            spent = float((gain / have).max())
            if spent <= 0:
                break
            typical = float((gain * lengths).sum() / (have * lengths).sum())
            step = 1.0 / ROUNDS / typical
            covered += step * gain / have
            chosen += [(step * a, p) for a, p in zip(ask, patterns, strict=True) if a > 0]
        # Full patterns first, so that what is left over is left to the best fit.
        chosen.sort(key=lambda c: -sum(n * k for n, k in c[1].items()))
        for x, p in chosen:
            if sum(n * k for n, k in p.items()) >= (1 - NEAR) * capacity:
                use(p, int(x + rng.random()))
    # Best fit of the rest: the longest piece, then always the longest that fits.
    while left.any():
        room, pattern = capacity, Counter()
        top = int(np.nonzero(left)[0][-1])
        while True:
            fits = np.nonzero(left[: min(room, top) + 1])[0]
            if not len(fits):
                break
            n = int(fits[-1])
            k = min(int(left[n]), room // n)
            pattern[n] += k
            room -= n * k
            top = n - 1
        use(pattern, int(left.max()))
    return plan


@dataclass(frozen=True)
class Places:
    """Runs of pieces by length: piece number ``key - first`` of a run goes to sequence
    ``sequence + number // each``, at ``offset + number % each * length``."""

    key: np.ndarray
    first_sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(plan: list[tuple[int, Counter]]) -> Places:
        used: Counter = Counter()
        rows, sequence = [], 0
        for times, pattern in plan:
            offset = 0
            for n, k in sorted(pattern.items(), reverse=True):
                rows.append(((n << 44) + used[n], sequence, k, offset))
                used[n] += times * k
                offset += n * k
            sequence += times
        rows.sort()
        return Places(*(np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4)))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length << 44) + number
        run = np.searchsorted(self.key, key, side="right") - 1
        inside = key - self.key[run]
        each = self.each[run]
        return self.first_sequence[run] + inside // each, self.offset[run] + inside % each * length


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to every row of a written table of pieces.

    ``pieces`` needs the columns part and nth: nth numbers the rows of one part and
    length from 0. Lengths are 1 to ``capacity``. An empty table stays empty; repeated
    rows are pieces of their own.
    """
    sizes = pieces.groupBy("part", length).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"))
    histogram = sizes.groupBy(length).agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        counts[r[length]] = r["n"]
    places = pieces.sparkSession.sparkContext.broadcast(Places.of(solve(counts, capacity)))
    names = [c for c in pieces.columns if c not in ("part", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = b.column("nth").to_numpy() + b.column("_before").to_numpy()
            sequence, offset = places.value.find(b.column(length).to_numpy(), number)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in names)
    joined = pieces.join(offsets.drop("_n"), ["part", length])
    return joined.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, blank_joins: bool, lower: bool, end: int, capacity: int = CAPACITY,
    doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32 (and ids), part, nth; written down.

    A document is its ids and ``end``; a null text is ``end`` alone. Only documents longer
    than ``capacity`` are cut, into pieces of that length and a rest. Other columns of
    ``docs`` are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, mark = encoder(tokenizer, blank_joins, lower), np.array([end], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for b in batches:
            done = 0
            keys = b.column("doc_id")
            for some in in_steps(b.column("text").to_pylist()):
                at, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
                for i, raw in enumerate(encode(some), done):
                    raw += mark
                    n = len(raw) // 4
                    for p, s in enumerate(range(0, n, capacity)):
                        cut = raw[4 * s : 4 * (s + capacity)]
                        size = len(cut) // 4
                        at.append(i)
                        piece.append(p)
                        start.append(s)
                        length.append(size)
                        crc.append(zlib.crc32(cut))
                        nth.append(seen[size])
                        seen[size] += 1
                        if with_ids:
                            ids.append(np.frombuffer(cut, "<u4").astype(np.int64))
                done += len(some)
                long = lambda v: pa.array(v, pa.int64())
                columns = [keys.take(pa.array(at)), pa.array(piece, pa.int32()), long(start), long(length), long(crc)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                columns += [long([part] * len(at)), long(nth)]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", ids array<long>" if with_ids else ""
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long{more}, part long, nth long"
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return stored(rows.mapInArrow(run, schema), "pieces")
