"""Forests grown from counted cells, a tree in one task.

A tree chooses among 32 bins of a feature, as MLlib's do. Rows whose features lie in the
same bins are one cell, and a cell of n rows of a class is in a tree's bag as often as n
draws say, which is one Poisson draw of mean n. So cells with their counts stand for all
rows, and their number depends on the bins, not on the rows.

Each fold has bins of its own, cut at order statistics of the rows it is fitted on. Levels
are cut at the bins of all folds together: a cell of levels lies in one bin of every fold.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import __version__ as spark_version
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.session import range_buckets, scratch_path

#: Bins of a feature, MLlib's default.
BINS = 32
#: Values of a range that one task puts in order.
RANGE_VALUES = 1_000_000
#: Cells of levels that go to every task, about 100 bytes each.
MAX_CELLS = 1_000_000
#: Classes that the counts are kept for.
MAX_CLASSES = 10
#: Trees that a task grows, of a grid and of the forest that is kept.
JOB_TREES, KEPT_TREES = 50, 10
#: Cells that trees are grown from at once, unless a tree has more.
GROWN_CELLS = 400_000
#: Cells of a fold that are summed up together.
CHUNK = 1_000

X, CELL = "x__", "cell__"
#: Parameters that MLlib's trees don't have.
FOREST_ONLY = {"numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate"}


# --------------------------------------------------------------------------
# cells
# --------------------------------------------------------------------------


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b.column(X).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)


def bin_cuts(view: DataFrame, width: int, folds: int) -> list[list[np.ndarray]]:
    """Cuts by fold left out (the last: none) and feature; a value lies in the bin of the
    number of cuts below it.

    Up to BINS values are parted halfway between neighbours, more of them at the order
    statistics that make BINS parts. These are exact: all rows are counted by value, and
    the values are put in order range by range.
    """
    spark, path, by_fold = view.sparkSession, scratch_path(view.sparkSession, "values"), [f"n{k}" for k in range(folds)]
    sizes = {r["fold"]: r["count"] for r in view.groupBy("fold").count().collect()}
    counts = [F.count(F.when(F.col("fold") == k, 1)).alias(n) for k, n in enumerate(by_fold)]
    values = view.select("fold", F.posexplode(X).alias("j", "v")).groupBy("j", "v").agg(*counts)
    ranges = max(range_buckets(spark), -(-sum(sizes.values()) * width // RANGE_VALUES))
    values.repartitionByRange(ranges, "j", "v").withColumn("range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    totals: dict[int, list] = {}
    for r in placed.groupBy("j", "range").agg(F.count("*").alias("held"), *[F.sum(n).alias(n) for n in by_fold]).collect():
        totals.setdefault(r["j"], []).append((r["range"], r["held"], [r[n] for n in by_fold]))
    few = [j for j, held in totals.items() if sum(h for _, h, _ in held) <= BINS]
    seen: dict[int, list] = {j: [] for j in few}
    for r in placed.where(F.col("j").isin(few)).collect() if few else ():
        seen[r["j"]].append((r["v"], [r[n] for n in by_fold]))
    # Of each wanted rank the range that holds it, and its place there.
    wanted: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    ranks = {g: [] for g in range(folds + 1)}
    for g in ranks:
        rows = sum(n for k, n in sizes.items() if k != g)
        ranks[g] = [max(1, rows * i // BINS) for i in range(1, BINS)] if rows else []
        for j in set(totals) - set(few):
            held = sorted(totals[j])
            ends = np.cumsum([sum(n for k, n in enumerate(by) if k != g) for _, _, by in held])
            for rank in sorted({min(r + d, rows) for r in ranks[g] for d in (0, 1)}):
                i = int(np.searchsorted(ends, rank))
                wanted.setdefault((j, held[i][0]), []).append((g, rank, int(rank - (ends[i - 1] if i else 0))))

    def pick(part: pa.Table) -> pa.Table:
        part = part.sort_by("v")
        mine = wanted.get((part.column("j")[0].as_py(), part.column("range")[0].as_py()), [])
        v, n = part.column("v").to_numpy(), np.stack([part.column(c).to_numpy() for c in by_fold])
        before = {g: (n.sum(0) - (n[g] if g < folds else 0)).cumsum() for g in {g for g, _, _ in mine}}
        out = [(part.column("j")[0].as_py(), g, rank, v[np.searchsorted(before[g], place)]) for g, rank, place in mine]
        schema = pa.schema([("j", pa.int32()), ("g", pa.int32()), ("rank", pa.int64()), ("v", pa.float64())])
        return pa.Table.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema)

    found = {}
    if wanted:
        many = placed.where(~F.col("j").isin(few)) if few else placed
        for r in many.groupBy("j", "range").applyInArrow(pick, "j int, g int, rank long, v double").collect():
            found[r["j"], r["g"], r["rank"]] = r["v"]
    cuts = []
    for g in range(folds + 1):
        mine = []
        for j in range(width):
            if j in seen:
                v = np.unique([v for v, n in seen[j] if sum(n) > (n[g] if g < folds else 0)])
                mine.append((v[:-1] + v[1:]) / 2)
            else:
                ends = [(found[j, g, r], found.get((j, g, r + 1))) for r in ranks[g]]
                mine.append(np.unique([a if a == b else (a + b) / 2 for a, b in ends if b is not None]))
        cuts.append(mine)
    return cuts


@dataclass(frozen=True)
class Cells:
    """``levels``: features x cells. ``counts``: folds x classes x cells, of the rows that
    are fitted on. ``seen``: folds x cells, whether a fold has rows to predict there.
    ``bin_of``: by fold left out and feature the bin of each level."""

    levels: np.ndarray
    counts: np.ndarray
    seen: np.ndarray
    bin_of: list[list[np.ndarray]]
    weights: np.ndarray
    name: str

    def group(self, g: int) -> Group:
        """What a forest that leaves out fold ``g`` is grown from; kept for the next task."""
        if (self.name, g) not in _groups:
            _groups.clear()
            _groups[self.name, g] = self._group(g)
        return _groups[self.name, g]

    def places(self, g: int) -> np.ndarray:
        """`Group.places` of fold ``g``; kept for the next task, of all folds."""
        if (self.name, g) not in _places:
            for other in [k for k in _places if k[0] != self.name]:
                del _places[other]
            _places[self.name, g] = self._group(g).places
        return _places[self.name, g]

    def _group(self, g: int) -> Group:
        bins = np.stack([of[level] for of, level in zip(self.bin_of[g], self.levels, strict=True)]).astype(np.uint8)
        sizes = [int(of.max()) + 1 for of in self.bin_of[g]]
        counts = self.counts.sum(0) - (self.counts[g] if g < len(self.counts) else 0)
        seen = self.seen[g] if g < len(self.counts) else np.zeros(bins.shape[1], bool)
        # Cells that this fold's bins can't tell apart are one.
        code = np.zeros(bins.shape[1], np.int64)
        for size, line in zip(sizes, bins, strict=True):
            if code.max(initial=0) > (1 << 62) // BINS:
                code = np.unique(code, return_inverse=True)[1]
            code = code * size + line
        _, first, cell = np.unique(code, return_index=True, return_inverse=True)
        total = np.stack([np.bincount(cell, c, len(first)) for c in counts])
        tested = np.bincount(cell, seen, len(first)) > 0
        place = np.where(tested, np.cumsum(tested) - 1, -1)
        return Group(np.ascontiguousarray(bins[:, first]), sizes, total, place, np.where(seen, place[cell], -1))


@dataclass(frozen=True)
class Group:
    """``place``: a cell's number among those to predict, or -1; ``places``: the same by
    cell of levels. ``trees``: how often all cells stand one after the other, to be grown
    into so many trees at once."""

    bins: np.ndarray
    sizes: list[int]
    counts: np.ndarray
    place: np.ndarray
    places: np.ndarray
    trees: int = 1

    def times(self, trees: int) -> Group:
        many = [np.tile(a, trees) for a in (self.bins, self.counts, self.place)]
        return Group(many[0], self.sizes, many[1], many[2], self.places, trees)


_groups: dict[tuple[str, int], Group] = {}
_places: dict[tuple[str, int], np.ndarray] = {}


def add_cells(view: DataFrame, union: Sequence[np.ndarray]) -> DataFrame:
    """Replace the features by a row's cell of levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b)
            codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(union)], axis=1).astype("<u2")
            offsets = pa.py_buffer(np.arange(b.num_rows + 1, dtype=np.int32) * np.int32(2 * len(union)))
            cell = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, offsets, pa.py_buffer(np.ascontiguousarray(codes))])
            kept = [n for n in b.schema.names if n != X]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), cell], [*kept, CELL])

    fields = [f for f in view.schema.fields if f.name != X]
    return view.mapInArrow(run, T.StructType([*fields, T.StructField(CELL, T.BinaryType())]))


@dataclass(frozen=True)
class Counted:
    """``rows``: the rows with their cells. ``cuts``: see `bin_cuts`."""

    rows: DataFrame
    cells: Cells
    cuts: list[list[np.ndarray]]


def counted_cells(
    ready: DataFrame, features: str, label: str, weight: str, folds: int, fitted: Column, keep: Sequence[str]
) -> Counted | None:
    """All rows counted by cell, class and fold; None where forests can't be grown from
    cells: categories that are no numbers, labels that are no classes, more than MAX_CELLS
    cells. ``fitted``: the rows that forests are fitted on, all are predicted."""
    attributes = ready.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if any(len(a.get("vals", ())) != 2 for a in attributes.get("nominal", ())):
        return None
    classes = {r[0]: r[1] for r in ready.groupBy(label).agg(F.max(weight)).limit(MAX_CLASSES + 1).collect()}
    if not classes or not set(classes) <= set(range(MAX_CLASSES)) or any(isinstance(k, bool) for k in classes):
        return None
    view = ready.select(*keep, "fold", label, fitted.alias("fitted__"), vector_to_array(features).alias(X))
    width = len(view.select(X).first()[0])
    if not width:
        return None
    cuts = bin_cuts(view.where("fitted__"), width, folds)
    union = [np.unique(np.concatenate([mine[j] for mine in cuts])) for j in range(width)]
    rows = add_cells(view, union)
    kinds = range(int(max(classes)) + 1)
    tally = lambda c: F.count(F.when(c, 1)).cast("int")
    by_fold = [tally(F.col("fitted__") & (F.col("fold") == g) & (F.col(label) == k)) for g in range(folds) for k in kinds]
    by_fold += [tally(F.col("fold") == g) for g in range(folds)]
    spark, path = ready.sparkSession, scratch_path(ready.sparkSession, "cells")
    rows.groupBy(CELL).agg(*[c.alias(f"n{i}") for i, c in enumerate(by_fold)]).write.parquet(path)
    table = spark.read.parquet(path)
    if table.count() > MAX_CELLS:
        return None
    held = table.toArrow().sort_by(CELL)
    levels = np.frombuffer(b"".join(held.column(CELL).to_pylist()), "<u2").reshape(-1, width).T
    numbers = np.stack([held.column(f"n{i}").to_numpy() for i in range(len(by_fold))])
    split = folds * len(kinds)
    bin_of = [[np.append(0, np.searchsorted(c, u, side="right")) for c, u in zip(mine, union, strict=True)] for mine in cuts]
    cells = Cells(
        np.ascontiguousarray(levels),
        numbers[:split].reshape(folds, len(kinds), -1),
        numbers[split:] > 0,
        bin_of,
        np.array([float(classes.get(k, 0.0)) for k in kinds]),
        uuid.uuid4().hex,
    )
    return Counted(rows.drop("fitted__"), cells, cuts)


# --------------------------------------------------------------------------
# trees
# --------------------------------------------------------------------------


def _best_splits(group: Group, bag, weights, u, at, stats, mask, leasts, pick):
    """Of each node and least size the best split by gini: feature (-1: none), last bin of
    the left side, class counts of the left side."""
    kinds, nodes = stats.shape
    whole = weights[:, None] * stats
    total, rows = whole.sum(0), stats.sum(0)
    # A split has to gain something; rounding is no gain.
    best = np.repeat(((whole**2).sum(0) / total * (1 + 1e-12))[None], len(leasts), axis=0)
    feature, cut = np.full(best.shape, -1), np.zeros(best.shape, np.int64)
    left = np.zeros((len(leasts), kinds, nodes))
    for f, size in enumerate(group.sizes):
        chosen = np.flatnonzero(pick[f])
        if size < 2 or not len(chosen):
            continue
        number = np.cumsum(pick[f]) - 1
        mine = np.flatnonzero(pick[f][at])
        units = u[mine]
        key = number[at[mine]] * size + group.bins[f][units]
        side = [
            np.bincount(key, b[units], len(chosen) * size).reshape(-1, size).cumsum(1)[:, :-1] for b in bag
        ]
        n = sum(side)
        smaller = np.minimum(n, rows[chosen, None] - n)
        heavy = [w * s for w, s in zip(weights, side, strict=True)]
        weight = sum(heavy)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = sum(h * h for h in heavy) / weight
            score += sum((whole[k, chosen, None] - h) ** 2 for k, h in enumerate(heavy)) / (total[chosen, None] - weight)
        line = np.arange(len(chosen))
        for i, least in enumerate(leasts):
            score[smaller < least] = -1.0  # ascending: what is too small for one is for the next
            place = score.argmax(1)
            value = score[line, place]
            better = np.flatnonzero((value > best[i, chosen]) & mask[i, chosen])
            if len(better):
                to, place = chosen[better], place[better]
                best[i, to], feature[i, to], cut[i, to] = value[better], f, place
                for k in range(kinds):
                    left[i, k, to] = side[k][better, place]
    return feature, cut, left


def grow(
    group: Group,
    weights: np.ndarray,
    rng: np.random.Generator,
    depths: Sequence[int],
    leasts: Sequence[int],
    take: int,
    shares: np.ndarray | None = None,
) -> list[tuple]:
    """Grow one bagged tree (``group.trees`` of them) for each least size of a leaf
    (ascending) down to the greatest depth; the trees of a bag are one as far as they split
    alike.

    Adds to ``shares`` (leasts x depths x cells to predict) what the trees, cut at each
    depth, say of class 1. Returns by level: class counts, feature (-1: a leaf) and cut of
    the first least size's nodes, and the number of their left child in the next level.
    """
    width, cells = group.bins.shape
    flat = group.bins.ravel()
    bag = rng.poisson(group.counts).astype(float)
    bagged = bag.sum(0) > 0
    u = np.flatnonzero(bagged | (group.place >= 0) if shares is not None else bagged)
    at = u // (cells // group.trees)
    stats, mask = bag.reshape(len(bag), group.trees, -1).sum(2), np.ones((len(leasts), group.trees), bool)
    leasts_, levels = np.asarray(leasts), []
    for depth in range(depths[-1] + 1):
        nodes = stats.shape[1]
        feature, cut = np.full((len(leasts), nodes), -1), np.zeros((len(leasts), nodes), np.int64)
        left = np.zeros((len(leasts), len(stats), nodes))
        if depth < depths[-1]:
            need = np.where(mask, leasts_[:, None], np.iinfo(np.int64).max // 2).min(0)
            able = ((stats > 0).sum(0) > 1) & (stats.sum(0) >= 2 * need)
            some = np.flatnonzero(able)
            if len(some):
                draws = rng.random((width, len(some)))
                pick = draws <= np.partition(draws, take - 1, axis=0)[take - 1]
                number = np.cumsum(able) - 1
                mine = np.flatnonzero(able[at] & bagged[u])
                found = _best_splits(
                    group, bag, weights, u[mine], number[at[mine]], stats[:, some], mask[:, some], leasts, pick
                )
                feature[:, some], cut[:, some], left[:, :, some] = found
        if shares is not None:
            whole = weights[:, None] * stats
            total = whole.sum(0)
            share = np.divide(whole[1] if len(whole) > 1 else 0 * total, total, out=np.zeros(nodes), where=total > 0)
            place = group.place[u]
            tested = np.flatnonzero(place >= 0)
            place, where = place[tested], at[tested]
            j = int(np.searchsorted(depths, depth))
            for i in range(len(leasts)):
                ends = np.flatnonzero((mask[i] & (feature[i] < 0))[where])
                if len(ends):
                    shares[i, j:] += np.bincount(place[ends], share[where[ends]], shares.shape[2])
                if depths[j] == depth:
                    goes_on = np.flatnonzero((feature[i] >= 0)[where])
                    shares[i, j] += np.bincount(place[goes_on], share[where[goes_on]], shares.shape[2])
        fresh, units, ats, below, masks, base = feature >= 0, [], [], [], [], 0
        child = np.full(nodes, -1)
        for i in range(len(leasts)):
            split = np.flatnonzero(fresh[i])
            if not len(split):
                continue
            # Least sizes that split a node alike go on together.
            alike = fresh[:, split] & (feature[:, split] == feature[i, split]) & (cut[:, split] == cut[i, split])
            mine = np.flatnonzero(fresh[i][at])
            first = np.full(nodes, -1)
            first[split] = base + 2 * np.arange(len(split))
            if i == 0:
                child = first
            here, unit = at[mine], u[mine]
            units.append(unit)
            ats.append(first[here] + (flat[feature[i][here] * cells + unit] > cut[i][here]))
            pair = np.stack([left[i][:, split], stats[:, split] - left[i][:, split]], axis=2)
            below.append(pair.reshape(len(stats), -1))
            masks.append(np.repeat(alike, 2, axis=1))
            fresh[:, split] &= ~alike
            base += 2 * len(split)
        levels.append((stats, feature[0], cut[0], child))
        if not base:
            break
        u, at = np.concatenate(units), np.concatenate(ats)
        stats, mask = np.concatenate(below, axis=1), np.concatenate(masks, axis=1)
    return levels


def features_taken(width: int, trees: int) -> int:
    """Features that a node chooses among: MLlib's rule for classes."""
    return width if trees == 1 else math.ceil(math.sqrt(width))


# --------------------------------------------------------------------------
# forests
# --------------------------------------------------------------------------


def out_of_fold(
    spark: SparkSession, counted: Counted, folds: int, points: Sequence[Mapping[str, int]], seed: int
) -> DataFrame:
    """fold, cell, given: what a forest that hasn't seen the fold says of the cell, 0 or 1
    by point (numTrees, maxDepth, minInstancesPerNode).

    The first trees of a forest are a smaller forest, and a tree cut at a depth is the tree
    that was allowed no more. Cells to predict go down the trees while these are grown.
    """
    held = spark.sparkContext.broadcast(counted.cells)
    depths = sorted({p["maxDepth"] for p in points})
    leasts = sorted({p["minInstancesPerNode"] for p in points})
    trees = sorted({p["numTrees"] for p in points})
    take = features_taken(len(counted.cells.levels), trees[-1])
    jobs = [
        (g, lo, min(lo + JOB_TREES, end))
        for g in range(folds)
        for start, end in zip([0, *trees[:-1]], trees, strict=True)
        for lo in range(start, end, JOB_TREES)
    ]
    if not (counted.cells.counts.sum(0) - counted.cells.counts).any(axis=(1, 2))[counted.cells.seen.any(1)].all():
        raise ValueError("a fold leaves no rows to fit a forest on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for job in b.column("id").to_pylist():
                g, lo, hi = jobs[job]
                group = held.value.group(g)
                shares = np.zeros((len(leasts), len(depths), int(group.place.max(initial=-1)) + 1))
                at_once = max(1, min(hi - lo, GROWN_CELLS // len(group.place)))
                for t in range(lo, hi, at_once):
                    rng = np.random.default_rng([seed, g, t])
                    grow(group.times(min(at_once, hi - t)), held.value.weights, rng, depths, leasts, take, shares)
                for k, at in enumerate(range(0, shares.shape[2], CHUNK)):
                    part = np.ascontiguousarray(shares[:, :, at : at + CHUNK])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g], pa.int32()), pa.array([k], pa.int32()), pa.array([lo], pa.int32()), pa.array([part.tobytes()])],
                        ["fold", "chunk", "lo", "shares"],
                    )

    def summed(part: pa.Table) -> pa.Table:
        part = part.sort_by("lo")
        g, k = part.column("fold")[0].as_py(), part.column("chunk")[0].as_py()
        places, sums, so_far = held.value.places(g), {}, 0.0
        starts = part.column("lo").to_pylist()
        for n, (lo, blob) in enumerate(zip(starts, part.column("shares").to_pylist(), strict=True)):
            so_far = so_far + np.frombuffer(blob).reshape(len(leasts), len(depths), -1)
            end = starts[n + 1] if n + 1 < len(starts) else trees[-1]
            if end in trees:
                sums[end] = so_far
        given = np.stack(
            [
                sums[p["numTrees"]][leasts.index(p["minInstancesPerNode"]), depths.index(p["maxDepth"])] / p["numTrees"] > 0.5
                for p in points
            ],
            axis=1,
        ).astype(np.int32)
        mine = np.flatnonzero((places >= k * CHUNK) & (places < (k + 1) * CHUNK))
        said = given[places[mine] - k * CHUNK]
        cells = [c.tobytes() for c in np.ascontiguousarray(held.value.levels[:, mine].T)]
        offsets = pa.array(np.arange(len(mine) + 1) * len(points), pa.int32())
        return pa.Table.from_arrays(
            [
                pa.array(np.full(len(mine), g), pa.int32()),
                pa.array(cells, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(said.ravel())),
            ],
            ["fold", CELL, "given__"],
        )

    # A partition for each job.
    grown = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, "fold int, chunk int, lo int, shares binary")
    return grown.groupBy("fold", "chunk").applyInArrow(summed, f"fold int, {CELL} binary, given__ array<int>")


def write_forest(
    spark: SparkSession, counted: Counted, folds: int, point: Mapping[str, int], seed: int, params: Mapping, defaults: Mapping
) -> str:
    """Fit one point on all folds and save it as MLlib saves a forest; the path. Trees are
    written by the tasks that grow them."""
    held, cuts = spark.sparkContext.broadcast(counted.cells), counted.cuts[folds]
    trees, kinds = point["numTrees"], len(counted.cells.weights)
    take = features_taken(len(counted.cells.levels), trees)
    split = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])

    def nodes_of(tree: int) -> pa.RecordBatch:
        weights = held.value.weights
        levels = grow(
            held.value.group(folds), weights, np.random.default_rng([seed, folds, tree]),
            [point["maxDepth"]], [point["minInstancesPerNode"]], take,
        )
        offsets = np.cumsum([0, *(len(feature) for _, feature, _, _ in levels)])
        raw = np.concatenate([s for s, _, _, _ in levels], axis=1)
        feature, cut = (np.concatenate([level[c] for level in levels]) for c in (1, 2))
        left = np.concatenate([np.where(f >= 0, c + o, -1) for (_, f, _, c), o in zip(levels, offsets[1:], strict=True)])
        stats = weights[:, None] * raw
        total = stats.sum(0)
        impurity = 1 - np.divide((stats**2).sum(0), total**2, out=np.ones(len(left)), where=total > 0)
        inner = np.flatnonzero(left >= 0)
        gain, right = np.full(len(left), -1.0), np.where(left >= 0, left + 1, -1)
        part = sum(total[side[inner]] * impurity[side[inner]] for side in (left, right))
        gain[inner] = impurity[inner] - part / total[inner]
        places = np.where(left >= 0, feature, -1).astype(np.int32)
        thresholds = np.array([cuts[f][c] for f, c in zip(feature[inner], cut[inner], strict=True)], float)
        splits = pa.StructArray.from_arrays(
            [
                pa.array(places),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(left >= 0)), pa.int32()), pa.array(thresholds)),
                pa.array(np.full(len(left), -1, np.int32)),
            ],
            fields=list(split),
        )
        columns = {
            "id": pa.array(np.arange(len(left), dtype=np.int32)),
            "prediction": pa.array(stats.argmax(0).astype(float)),
            "impurity": pa.array(impurity),
            "impurityStats": pa.ListArray.from_arrays(
                pa.array(np.arange(len(left) + 1) * kinds, pa.int32()), pa.array(np.ascontiguousarray(stats.T).ravel())
            ),
            "rawCount": pa.array(np.rint(raw.sum(0)).astype(np.int64)),
            "gain": pa.array(gain),
            "leftChild": pa.array(left.astype(np.int32)),
            "rightChild": pa.array(right.astype(np.int32)),
            "split": splits,
        }
        node = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(left), tree, np.int32)), node], ["treeID", "nodeData"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree in b.column("id").to_pylist():
                yield nodes_of(tree)

    path = scratch_path(spark, "forest")
    schema = """treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>,
        rawCount bigint, gain double, leftChild int, rightChild int,
        split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"""
    spark.range(0, trees, 1, -(-trees // KEPT_TREES)).mapInArrow(run, schema).write.parquet(f"{path}/data")

    def about(kind: str, named: Mapping, more: Mapping) -> str:
        of_tree = lambda values: {k: v for k, v in values.items() if more or k not in FOREST_ONLY}
        return json.dumps(
            {
                "class": f"org.apache.spark.ml.classification.{kind}",
                "timestamp": int(time.time() * 1000),
                "sparkVersion": spark_version,
                "uid": f"{kind}_{uuid.uuid4().hex[:12]}",
                "paramMap": of_tree(named),
                "defaultParamMap": of_tree(defaults),
                **more,
            }
        )

    forest = about(
        "RandomForestClassificationModel", {**params, **point},
        {"numFeatures": len(counted.cells.levels), "numClasses": kinds, "numTrees": trees},
    )
    each = [(t, about("DecisionTreeClassificationModel", {**params, **point}, {}), 1.0) for t in range(trees)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return path
