from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.catalog import learning
from driftwell.operators import cell_forests, forests, models, prep
from driftwell.spec import CREDIT


def test_grid_search_query_fits_all_rows(spark, tmp_path, monkeypatch):
    day = "cast(timestamp'1995-01-01' + make_dt_interval(cast(id % 700 as int)) as timestamp_ntz)"
    spark.range(2000).selectExpr(
        "id o_orderkey", "1000.0 + (id * 7919) % 450000 o_totalprice", f"{day} o_orderdate",
        "concat(cast(1 + id % 5 as string), '-LEVEL') o_orderpriority", "'O' o_orderstatus", "id o_custkey",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    found, search = [], models.grid_search
    grid = {"numTrees": (5, 10), "maxDepth": (4, 8), "minInstancesPerNode": (1, 3)}
    monkeypatch.setattr(models, "grid_search", lambda *a, **k: found.append(search(*a, **{**k, "grid": grid})) or found[0])
    rows = learning.grid_search(spark, str(tmp_path)).collect()
    assert len(rows) == 8 and {tuple(r)[1:] for r in rows} == {(1600, 5, True, True)}
    # Each tree's bag holds about as many rows as there are, not as a sample has.
    roots = forests.node_table(spark, found[0].model.stages[-1]).where("id = 0").select("cover").collect()
    assert abs(np.mean([r[0] for r in roots]) - 1600) < 100


def test_cuts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(cell_forests, "RANGE_VALUES", 500)
    rng, n = np.random.default_rng(1), 3000
    columns = [
        rng.gamma(2, 100, n).round(),
        rng.integers(0, 7, n).astype(float),
        np.where(rng.random(n) < 0.4, 5.0, rng.random(n) * 10),
        np.zeros(n),
    ]
    fold = rng.integers(0, 3, n)
    rows = [(int(k), [float(c[i]) for c in columns]) for i, k in enumerate(fold)]
    got = cell_forests.bin_cuts(spark.createDataFrame(rows, "fold int, x__ array<double>"), 4, 3)
    for g in range(4):
        for j, c in enumerate(columns):
            v = np.sort(c[fold != g])
            one = np.unique(v)
            if len(one) <= 32:
                want = (one[:-1] + one[1:]) / 2
            else:
                at = np.array([len(v) * i // 32 for i in range(1, 32)])
                want = np.unique(np.where(v[at - 1] == v[at], v[at], (v[at - 1] + v[at]) / 2))
            assert np.array_equal(got[g][j], want)


class Unbagged:
    """Draws every row once."""

    def __init__(self, rng):
        self.random = rng.random

    def poisson(self, counts):
        return counts


def a_group(seed=0, kinds=2, cells=300):
    rng = np.random.default_rng(seed)
    sizes = [6, 4, 2]
    code = rng.permutation(6 * 4 * 2)[: min(cells, 48)]
    bins = np.stack([code // 8, code // 2 % 4, code % 2]).astype(np.uint8)
    counts = rng.integers(1, 60, (kinds, len(code)))  # so that no two splits gain the same
    place = np.where(rng.random(len(code)) < 0.7, 0, -1)
    place[place == 0] = np.arange((place == 0).sum())
    return cell_forests.Group(bins, sizes, counts, place, place), np.array([0.7, 1.9, 1.1][:kinds])


def walked(group, weights, cell, least, deepest):
    """Share of class 1 for a cell by depth, from the definition: all splits of a node are
    tried on its cells."""
    inside, out = np.ones(group.bins.shape[1], bool), {}
    gini = lambda n: (weights * n).sum() - ((weights * n) ** 2).sum() / (weights * n).sum()
    for depth in range(deepest + 1):
        n = group.counts[:, inside].sum(1)
        out[depth] = (weights * n)[1] / (weights * n).sum()
        best = None
        for f, size in enumerate(group.sizes):
            for cut in range(size - 1):
                side = inside & (group.bins[f] <= cut)
                a, b = group.counts[:, side].sum(1), group.counts[:, inside & ~side].sum(1)
                if min(a.sum(), b.sum()) >= least:
                    gain = gini(n) - gini(a) - gini(b)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, side if side[cell] else inside & ~side
        if best is None:
            return {**out, **{d: out[depth] for d in range(depth, deepest + 1)}}
        inside = best[1]
    return out


@pytest.mark.parametrize(("seed", "kinds"), [(0, 2), (1, 2), (2, 3)])
def test_trees_against_all_splits(seed, kinds):
    group, weights = a_group(seed, kinds)
    depths, leasts, tested = [0, 2, 5], [1, 60, 200], int(group.place.max()) + 1
    shares = np.zeros((3, 3, tested))
    cell_forests.grow(group, weights, Unbagged(np.random.default_rng(0)), depths, leasts, 3, shares)
    for cell in np.flatnonzero(group.place >= 0):
        for i, least in enumerate(leasts):
            want = walked(group, weights, cell, least, 5)
            assert np.allclose(shares[i, :, group.place[cell]], [want[d] for d in depths])
    # Trees that are grown at once are the same trees.
    thrice = np.zeros_like(shares)
    cell_forests.grow(group.times(3), weights, Unbagged(np.random.default_rng(0)), depths, leasts, 3, thrice)
    assert np.allclose(thrice, 3 * shares)


def test_cells_and_mllib_agree(spark, monkeypatch):
    """Both ways fit all rows: scores are near, and each row is predicted once a point."""
    u = [F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1000)) / 1000 for k in range(4)]
    df = spark.range(1500).select("id", u[0].alias("a"), u[1].alias("b"), F.floor(u[2] * 5).alias("c"),
        ((u[0] + u[1] * 0.7 + u[3] * 0.4) > 1.0).cast("int").alias("y"))
    df = df.union(df.where("id < 100"))  # keys may repeat
    prepared = prep.fit_preprocessor(df, ["a", "b", "c"])
    grid = {"numTrees": (10, 30), "maxDepth": (3, 8), "minInstancesPerNode": (1, 4)}
    scores = []
    for most in (cell_forests.MAX_CELLS, 0):
        monkeypatch.setattr(cell_forests, "MAX_CELLS", most)
        found = models.grid_search(df, prepared, "y", ["id"], grid, folds=3)
        assert found.predictions.count() == 1600 * 8
        assert {r[0] for r in found.predictions.groupBy("id", "params").count().select("count").distinct().collect()} == {1, 2}
        scores.append({r["params"]: r["f1"] for r in found.results.collect()})
        again = models.add_predictions(df, found.model)
        right = again.where("prediction = y").count() / 1600
        assert right > 0.85
    assert list(scores[0]) == list(scores[1])
    assert all(abs(scores[0][p] - scores[1][p]) < 0.03 for p in scores[0])


def test_kept_forest(spark, credit, monkeypatch):
    """The model is read from tables that tasks wrote; its nodes add up."""
    df = credit.withColumn("credit_risk", (F.col("status") + F.col("age") / 20 > 4).cast("int"))
    prepared = prep.fit_preprocessor(df, CREDIT.features)
    grid = {"numTrees": (4,), "maxDepth": (30,), "minInstancesPerNode": (3,)}
    forest = models.grid_search(df, prepared, "credit_risk", ["row_key"], grid, folds=2).model.stages[-1]
    assert forest.numFeatures == len(CREDIT.features) and forest.numClasses == 2 and forest.getNumTrees == 4
    nodes = forests.node_table(spark, forest).toPandas()
    for _, tree in nodes.groupby("tree"):
        tree = tree.set_index("id")
        for _, node in tree[tree["left"] >= 0].iterrows():
            left, right = tree.loc[node["left"]], tree.loc[node["right"]]
            assert node["cover"] == left["cover"] + right["cover"] and min(left["cover"], right["cover"]) >= 3
            assert np.allclose(node["stats"], np.add(left["stats"], right["stats"]))
