"""Forests as arrays, and whole grids of forests from few fits.

The first trees of a forest are a smaller forest, and a tree cut at a depth is the tree
that was allowed no more: its inner nodes keep their class counts. So one fit with the
most trees and the greatest depth stands for every point of a grid that differs in these
two only.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.session import scratch_path

#: Nodes that go to every task, 40 bytes each.
MAX_NODES = 5_000_000
#: Rows walked through a forest at once.
WALK = 512


def node_table(spark: SparkSession, model) -> DataFrame:
    """(tree, id, left, right, feature, left_values, categories, value, stats, cover) of an
    ensemble.

    Reads the table that a saved MLlib tree ensemble consists of.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    # Of rows that stand for several, the weights count: the first statistic of boosted trees.
    boosted = isinstance(model, GBTClassificationModel)
    cover = F.col("nodeData.impurityStats")[0] if boosted else F.col("nodeData.rawCount").cast("double")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("left_values"),
        F.col("nodeData.split.numCategories").alias("categories"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.impurityStats").alias("stats"),
        cover.alias("cover"),
    )


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees one after the other; children are places in the arrays, a leaf is
    its own child. ``coded``: where a coded split's answers by code start in ``answers``,
    -1 for a threshold."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    coded: np.ndarray
    answers: np.ndarray
    share: np.ndarray  # of class 1 among the node's training rows

    def shares(self, x: np.ndarray, depths: Sequence[int], trees: Sequence[int]) -> np.ndarray:
        """rows x depths x trees: mean share of class 1 over the first trees, each cut at
        the depth. ``depths`` ascend."""
        out = np.empty((len(x), len(depths), len(trees)))
        for lo in range(0, len(x), WALK):
            out[lo : lo + WALK] = self._shares(x[lo : lo + WALK], depths, trees)
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        """rows x features that the forest asks for: how many of the feature's thresholds a
        value passes, or its code. Rows of equal cells end in the same leaves."""
        inner = (self.left != np.arange(len(self.left))) | (self.right != np.arange(len(self.right)))
        out = []
        for j in np.unique(self.feature[inner]):
            mine = inner & (self.feature == j)
            if (self.coded[mine] >= 0).any():
                out.append(x[:, j].astype(np.int32))
            cuts = np.unique(self.threshold[mine & (self.coded < 0)])
            if len(cuts):
                out.append(np.searchsorted(cuts, x[:, j], side="left").astype(np.int32))
        return np.stack(out, axis=1) if out else np.zeros((len(x), 1), np.int32)

    def _shares(self, x: np.ndarray, depths: Sequence[int], trees: Sequence[int]) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        out, depth = np.empty((len(x), len(depths), len(trees))), 0
        ends = np.asarray(trees)
        for k, limit in enumerate(depths):
            while depth < limit:
                value = x[row, self.feature[at]]
                coded = self.coded[at]
                goes_left = value <= self.threshold[at]
                by_code = coded >= 0
                if by_code.any():
                    goes_left[by_code] = self.answers[coded[by_code] + value[by_code].astype(np.int64)]
                new = np.where(goes_left, self.left[at], self.right[at])
                if (new == at).all():
                    break
                at, depth = new, depth + 1
            out[:, k] = np.cumsum(self.share[at], axis=1)[:, ends - 1] / ends
        return out


def forest_arrays(nodes: DataFrame) -> Forest:
    """The driver's copy of a fitted forest; refuses one of more than MAX_NODES nodes."""
    table = nodes.limit(MAX_NODES + 1).toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
    if table.num_rows > MAX_NODES:
        raise ValueError(f"the forest has more than {MAX_NODES} nodes")
    tree, number, left, right = (table.column(c).to_numpy().astype(np.int64) for c in ("tree", "id", "left", "right"))
    roots = np.nonzero(np.append(True, tree[1:] != tree[:-1]))[0] if len(tree) else np.empty(0, np.int64)
    base = np.repeat(roots, np.diff(np.append(roots, len(tree))))
    if (number != np.arange(len(tree)) - base).any():
        raise ValueError("a tree's nodes are not numbered from its root on")
    leaf = left < 0
    own = np.arange(len(tree))
    feature = np.maximum(table.column("feature").to_numpy(), 0)
    coded, threshold, answers, used = np.full(len(tree), -1), np.zeros(len(tree)), [], 0
    categories = table.column("categories").to_numpy()
    for k in np.nonzero(~leaf)[0]:
        values = table.column("left_values")[k].as_py()
        if categories[k] < 0:
            threshold[k] = values[0]
        else:
            row = np.zeros(categories[k], bool)
            row[np.asarray(values, np.int64)] = True
            coded[k], used = used, used + len(row)
            answers.append(row)
    stats = np.array(table.column("stats").to_pylist(), float).reshape(len(tree), -1)
    total = stats.sum(1)
    share = np.divide(stats[:, 1] if stats.shape[1] > 1 else 0 * total, total, out=np.zeros(len(tree)), where=total > 0)
    flat = np.concatenate(answers) if answers else np.zeros(1, bool)
    return Forest(
        roots, np.where(leaf, own, base + left), np.where(leaf, own, base + right), feature, threshold, coded, flat, share
    )


def nested_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """All points of a grid, in the order of its lists."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def nested_fits(grid: Mapping[str, Sequence]) -> tuple[dict, list[dict]]:
    """The settings that all fits share (most trees, greatest depth) and one dict of the
    others for each fit."""
    top = {name: max(grid[name]) for name in ("numTrees", "maxDepth") if name in grid}
    return top, nested_points({k: v for k, v in grid.items() if k not in top})


def nested_scores(
    ready: DataFrame, features: str, forest: Forest, points: Sequence[Mapping[str, int]], keep: Sequence[str]
) -> DataFrame:
    """``keep`` columns and shares: the share of class 1 for each point (numTrees, maxDepth)
    that the forest holds. The forest goes to every task; rows that it can't tell apart are
    walked through it once."""
    held = ready.sparkSession.sparkContext.broadcast(forest)
    depths = sorted({p["maxDepth"] for p in points})
    trees = sorted({p["numTrees"] for p in points})
    place = [(depths.index(p["maxDepth"]), trees.index(p["numTrees"])) for p in points]

    def matrix(b: pa.RecordBatch) -> np.ndarray:
        return b.column("x__").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)

    def name_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = np.ascontiguousarray(held.value.cells(matrix(b)))
                width = codes.shape[1] * codes.itemsize
                offsets = pa.py_buffer(np.arange(b.num_rows + 1, dtype=np.int32) * np.int32(width))
                cell = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, offsets, pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([*b.columns, cell], [*b.schema.names, "cell__"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            all_shares = held.value.shares(matrix(b), depths, trees)
            shares = np.stack([all_shares[:, d, t] for d, t in place], axis=1)
            offsets = pa.array(np.arange(b.num_rows + 1) * len(place), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(shares.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("cell__"), lists], ["cell__", "shares"])

    source = ready.select(*keep, vector_to_array(features).alias("x__"))
    named = source.mapInArrow(name_cells, T.StructType([*source.schema.fields, T.StructField("cell__", T.BinaryType())]))
    cells = named.groupBy("cell__").agg(F.first("x__").alias("x__"))
    walked = cells.mapInArrow(walk, "cell__ binary, shares array<double>")
    return named.drop("x__").join(walked, "cell__").select(*keep, "shares")
