"""Quality classifier: Naive Bayes support vectors.

Indicators of hashed byte n-grams (and of how much a text repeats itself) are scaled by
their class log-count ratio; a linear hinge-loss model over them is fitted by dual
coordinate descent and calibrated to a probability. It is fitted on a bounded sample of
the labelled rows and scores every document, in its own task, from the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from driftwell.llm.text import stored

#: Hash buckets of n-grams, as a power of two, and the n-gram lengths in bytes.
BITS = 18
ORDERS = (2, 3, 5)
#: The fit's sample: at most about so many labelled rows, in shards of about so many.
FIT_ROWS = 40_000
SHARD_ROWS = 4_000
#: One row in so many of the sample calibrates instead of being fitted.
CALIBRATE = 5
EPOCHS, COST = 12, 1.0

_MULTIPLIERS = {2: 0x9E3779B97F4A7C15, 3: 0xC2B2AE3D27D4EB4F, 5: 0x165667B19E3779F9}


class Features:
    """Distinct bucket numbers of a text; reuses one buffer from text to text."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.size = (1 << bits) + 64
        self._last = np.zeros(1 << bits, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint64)
        found = []
        for n in ORDERS:
            if len(raw) >= n:
                code = raw[: len(raw) - n + 1].copy()
                for k in range(1, n):
                    code <<= np.uint64(8)
                    code |= raw[k : len(raw) - n + 1 + k]
                code *= np.uint64(_MULTIPLIERS[n])
                code >>= np.uint64(64 - self.bits)
                found.append(code.astype(np.int32))
        words = text.split()
        n = max(1, len(words))
        same = sum(map(eq, words, words[1:])) / n
        kinds = len(set(words)) / n
        marks = [0 if not words else 1 + min(9, math.ceil(20 * same)), 16 + int(15 * kinds), 40]
        own = np.array(marks, np.int32) + np.int32(1 << self.bits)
        if not found:
            return own
        grams = np.concatenate(found)
        at = np.arange(len(grams), dtype=np.int32)
        self._last[grams] = at  # of equal numbers the last one written stays
        return np.concatenate([grams[self._last[grams] == at], own])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # class log-count ratio times the fitted weight, by bucket
    squares: np.ndarray  # of the ratios, for the length of a text's vector
    slope: float
    offset: float

    def margin(self, idx: np.ndarray) -> float:
        length = math.sqrt(float(self.squares[idx].sum())) or 1.0
        return float(self.weights[idx].sum()) / length

    def probability(self, margin: float) -> float:
        z = self.slope * margin + self.offset
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, counts = Features(), np.zeros((2, (1 << BITS) + 64), np.int64)
    for b in batches:
        for y, t in zip(b.column("label").to_pylist(), b.column("text").to_pylist(), strict=True):
            counts[y][features(t)] += 1
    at = np.nonzero(counts.any(0))[0]
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int64()), pa.array(counts[0][at]), pa.array(counts[1][at])], ["bucket", "bad", "good"]
    )


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, seed: int) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; rows are bucket numbers, y is -1 or 1.

    Returns the weight vector. Each row's vector is its ratios, scaled to length 1.
    """
    w, alpha = np.zeros(len(ratio)), np.zeros(len(rows))
    values = []
    for idx in rows:
        x = ratio[idx]
        values.append((x / (math.sqrt(float(x @ x)) or 1.0)).astype(np.float32))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            idx, x = rows[i], values[i]
            step = alpha[i] - (y[i] * float(w[idx] @ x) - 1)  # the vector's own length is 1
            new = min(max(step, 0.0), cost[i])
            if new != alpha[i]:
                w[idx] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "label", fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most about ``fit_rows`` rows of ``labels`` (doc_id, label 0 or 1).

    Rows with a null id or label, or with an id that ``docs`` doesn't have, are not used;
    repeated rows count as often as they are there. Without labelled rows of both classes,
    as with empty tables, the model scores the one class's share, or 0.5. Other columns are
    not read, whatever their names.
    """
    held = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
    n = held.count()
    mix = F.pmod(F.xxhash64(F.lit(11), doc_id), F.lit(1 << 30))
    share = min(1.0, fit_rows / max(n, 1))
    picked = held.where(mix < int(share * (1 << 30))).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label")
    )
    shards = max(1, round(min(n, fit_rows) / SHARD_ROWS))
    # The sample is bounded by fit_rows, whatever the size of the tables.
    texts = docs.select(F.col(doc_id).alias("_doc_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(picked), F.col("_doc_id") == F.col("_id")).select(
        "text",
        "label",
        F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(CALIBRATE * shards)).cast("int").alias("shard"),
    )
    rows = stored(rows, "nbsvm-rows")
    counts = (
        rows.mapInArrow(_class_counts, "bucket long, bad long, good long")
        .groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas()
    )
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    size = (1 << BITS) + 64
    if not (totals.get(0) and totals.get(1)):
        p = 1.0 if totals.get(1) else 0.0 if totals.get(0) else 0.5
        z = math.log((p + 1e-3) / (1 - p + 1e-3))
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, z)
    good, bad = np.ones(size), np.ones(size)
    good[counts["bucket"]] += counts["good"]
    bad[counts["bucket"]] += counts["bad"]
    ratio = np.log(good / (totals[1] + 2)) - np.log(bad / (totals[0] + 2))
    ratio[np.isin(np.arange(size), counts["bucket"], invert=True)] = 0.0
    even = {y: sum(totals.values()) / (2 * t) * COST for y, t in totals.items()}

    def solve(key, pdf):
        import pandas as pd

        features, y = Features(), np.where(pdf["label"].to_numpy() == 1, 1.0, -1.0)
        idx = [features(t) for t in pdf["text"]]
        cost = np.array([even[v] for v in pdf["label"]])
        w = descend(idx, y, ratio, cost, int(key[0]))
        return pd.DataFrame({"n": [len(y)], "w": [w.astype("<f4").tobytes()]})

    fitted = rows.where(F.pmod("shard", F.lit(CALIBRATE)) != 0).withColumn(
        "part", F.floor(F.col("shard") / CALIBRATE).cast("int")
    )
    parts = fitted.groupBy("part").applyInPandas(solve, "n long, w binary").collect()  # one row a shard
    w = sum(r["n"] * np.frombuffer(r["w"], "<f4").astype(float) for r in parts) / max(
        1, sum(r["n"] for r in parts)
    )
    model = Model((w * ratio).astype(np.float32), (ratio**2).astype(np.float32), 1.0, 0.0)

    def margins(batches):
        features = Features()
        for b in batches:
            m = [model.margin(features(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(m, pa.float64())], ["label", "m"])

    spare = rows.where(F.pmod("shard", F.lit(CALIBRATE)) == 0).mapInArrow(margins, "label int, m double")
    spare = spare.toPandas()
    if spare["label"].nunique() < 2:
        spare = rows.mapInArrow(margins, "label int, m double").toPandas()
    slope, offset = calibrate(spare["m"].to_numpy(), spare["label"].to_numpy())
    return Model(model.weights, model.squares, slope, offset)


def calibrate(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, with targets drawn in from 0 and 1."""
    good, bad = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - t) * m).sum() + 1e-6 * a, (p - t).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * m * m).sum() + 1e-6, (v * m).sum()], [(v * m).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; all columns of ``docs`` stay.

    Null texts score as empty ones do. Each row is scored by itself, so repeated rows and
    ids, an empty table and other columns make no difference. ``out`` must be a new name.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), held.value
        for b in batches:
            p = [model.probability(model.margin(features(t))) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], [*b.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
