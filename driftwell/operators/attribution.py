"""Which features move the score: permutation importance and tree attributions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.operators.forests import node_table
from driftwell.operators.perturb import numbered_rows, numbered_values, slices
from driftwell.operators.prep import FEATURES
from driftwell.operators.quality import attribution_importance, auc
from driftwell.session import scratch_path

# MLlib's boosted margin is half the log-odds of the positive class.
LOG_ODDS_PER_MARGIN = 2.0
# What goes to every task: an ensemble of at most this many nodes.
MAX_NODES = 5_000_000


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    scorer: Callable[[DataFrame], DataFrame],
    label: str,
    score: str,
    key: Sequence[str],
    seed: str = "importance",
) -> DataFrame:
    """(feature, importance): AUC lost when the feature's values change rows.

    One job per feature, each as wide as the cluster. The key is checked and the rows are
    numbered once for all features, and written.
    """
    rows = None
    base = auc(scorer(df), label, score).select(F.col("auc").alias("base"))
    buckets = slices(df, key)
    path = scratch_path(df.sparkSession, "numbered")
    numbered_rows(df, key, seed, buckets).write.parquet(path)
    numbered = df.sparkSession.read.parquet(path)
    for c in features:
        values = numbered_values(numbered.drop("row__"), c, key, seed, buckets)
        shuffled = scorer(numbered.drop(c).join(values, "row__").select(*df.columns))
        part = auc(shuffled, label, score).select(F.lit(c).alias("feature"), "auc")
        rows = part if rows is None else rows.unionByName(part)
    start = base.first()["base"]
    return rows.select("feature", (F.lit(start) - F.col("auc")).alias("importance"))


# --------------------------------------------------------------------------
# tree attributions
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Leaf:
    """One path: per feature the values that stay on it, and its share of the cover.

    A numeric feature stays while low < x <= high, a coded one (``codes`` by path
    position) while x is listed.
    """

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    codes: dict[int, np.ndarray]
    shares: np.ndarray
    value: float

    @property
    def expected(self) -> float:
        return self.value * math.prod(self.shares)


def leaves_of(nodes: DataFrame, weights: Sequence[float], scale: float = LOG_ODDS_PER_MARGIN, of_class: bool = False) -> list[Leaf]:
    """Walk the node table, whose size the model's settings bound, into leaf paths.

    ``of_class``: a leaf's value is its share of class 1 instead of its prediction.
    """
    rows = nodes.limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"the ensemble has more than {MAX_NODES} nodes")
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["id"]] = r
    out: list[Leaf] = []
    for number, tree in trees.items():
        factor = scale * weights[number]
        stack = [(tree[0], {}, {})]
        while stack:
            node, span, kept = stack.pop()
            if node["left"] < 0:
                value = node["stats"][1] / sum(node["stats"]) if of_class else node["value"]
                out.append(_leaf(factor * value, span, kept))
                continue
            f = node["feature"]
            for side in ("left", "right"):
                child = tree[node[side]]
                share = child["cover"] / node["cover"]
                stay = _narrowed(span.get(f), node, side == "left")
                stack.append((child, {**span, f: stay}, {**kept, f: kept.get(f, 1.0) * share}))
    return out


def _narrowed(stay, node, left: bool):
    """Values that stay on the path after one more split on the same feature."""
    if node["categories"] >= 0:
        listed = frozenset(node["left_values"])
        before = stay or frozenset(float(i) for i in range(node["categories"]))
        return before & listed if left else before - listed
    low, high = stay or (-math.inf, math.inf)
    t = node["left_values"][0]
    return (low, min(high, t)) if left else (max(low, t), high)


def _leaf(value: float, span: dict, kept: dict) -> Leaf:
    names = list(span)
    return Leaf(
        np.array(names, dtype=np.int64),
        np.array([s[0] if isinstance(s, tuple) else math.nan for s in span.values()]),
        np.array([s[1] if isinstance(s, tuple) else math.nan for s in span.values()]),
        {
            j: np.array(sorted(s))
            for j, s in enumerate(span.values())
            if isinstance(s, frozenset)
        },
        np.array([kept[f] for f in names], dtype=float),
        value,
    )


@lru_cache(maxsize=None)
def _nodes(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre places and weights on [0, 1], exact for polynomials below degree m."""
    t, w = np.polynomial.legendre.leggauss(max(1, -(-m // 2)))
    return (t + 1) / 2, w / 2


def path_values(hits: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of one leaf for rows of on/off patterns (rows x features).

    The leaf is worth value * prod(in S: hit) * prod(not in S: share). The weight of a set
    of s others among m features, s! (m - s - 1)! / m!, is the integral of
    t^s (1 - t)^(m - s - 1) over [0, 1], so the sum over all sets is that of the polynomial
    prod(hit * t + share * (1 - t)) over the others: m products at m / 2 places, exactly,
    where there are 2^m sets. Products without one factor come from those before and after
    it, so nothing is divided by a small share.
    """
    rows, m = hits.shape
    out = np.zeros((rows, m))
    for t, w in zip(*_nodes(m), strict=True):
        factor = np.where(hits, t, 0.0) + shares * (1 - t)
        before = np.ones((rows, m + 1))
        np.cumprod(factor, axis=1, out=before[:, 1:])
        after = np.ones((rows, m + 1))
        after[:, :-1] = np.cumprod(factor[:, ::-1], axis=1)[:, ::-1]
        out += w * before[:, :-1] * after[:, 1:]
    return value * (hits - shares) * out


def attribute(matrix: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Attributions of a block of rows, leaf by leaf; patterns that rows share are worked
    out once."""
    out = np.zeros_like(matrix)
    for leaf in leaves:
        m = len(leaf.features)
        if not m:
            continue
        x = matrix[:, leaf.features]
        hits = (x > leaf.low) & (x <= leaf.high)
        for j, codes in leaf.codes.items():
            hits[:, j] = np.isin(x[:, j], codes)
        if m < 20 and 1 << m <= len(matrix):
            every = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1 > 0
            values = path_values(every, leaf.shares, leaf.value)[hits @ (1 << np.arange(m))]
        else:
            values = path_values(hits, leaf.shares, leaf.value)
        out[:, leaf.features] += values
    return out


def tree_attributions(
    prepared: DataFrame, model, names: Sequence[str], keep: Sequence[str] = ()
) -> tuple[DataFrame, float]:
    """Path-dependent Shapley values of a boosted model's log-odds, or of a forest's or a
    tree's probability of class 1, per row; trees may have any depth.

    Returns the table (``keep`` columns and one column per feature) and the base
    value; base plus the row's attributions is the row's value. Rows are independent,
    so this is one map over the partitions with the leaves sent along.
    """
    spark = prepared.sparkSession
    if isinstance(model, GBTClassificationModel):
        leaves = leaves_of(node_table(spark, model), model.treeWeights)
    else:
        trees = getattr(model, "getNumTrees", 1)
        leaves = leaves_of(node_table(spark, model), [1.0] * trees, 1.0 / trees, of_class=True)
    base = float(sum(leaf.expected for leaf in leaves))
    shared = spark.sparkContext.broadcast(leaves)
    fields = [prepared.schema[c] for c in keep]
    schema = T.StructType([*fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = np.vstack(batch["x__"].to_numpy())
            values = pd.DataFrame(attribute(matrix, shared.value), columns=list(names))
            yield pd.concat([batch[list(keep)].reset_index(drop=True), values], axis=1)

    source = prepared.select(*keep, vector_to_array(FEATURES).alias("x__"))
    return source.mapInPandas(run, schema), base


def global_attribution(prepared: DataFrame, model, names: Sequence[str]) -> DataFrame:
    """(feature, importance): mean absolute attribution."""
    values, _ = tree_attributions(prepared, model, names)
    return attribution_importance(values, {f"`{n}`": n for n in names})
