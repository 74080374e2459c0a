"""Training and scoring with MLlib."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions import keyed_uniform, risk_band, verdict
from driftwell.operators.cell_forests import CELL, counted_cells, out_of_fold, write_forest
from driftwell.operators.clean import align_columns, fill_defaults
from driftwell.operators.forests import forest_arrays, nested_fits, nested_points, nested_scores, node_table
from driftwell.operators.prep import FEATURES, drop_helpers
from driftwell.operators.split import class_sizes, stratified_folds
from driftwell.session import scratch_path, use_shared_checkpoints

# Settings of the boosted model and of the baselines.
BOOSTED = {"maxIter": 150, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
BOOSTED_COLUMN_SHARE = "0.8"
FOREST_TREES = 300
SEED = 42
# Memory of a task for the nodes that a forest splits in one pass.
FOREST_MEMORY_MB = 1024
FOREST_GRID = {
    "numTrees": (200, 400, 600),
    "maxDepth": (30, 8, 12),
    "minInstancesPerNode": (1, 2, 4),
}

PROBABILITY_GOOD, PROBABILITY_BAD = "probability_good", "probability_bad"
WEIGHT, DRAW = "weight__", "draw__"


def boosted_trees(label: str, **settings) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label,
        featuresCol=FEATURES,
        featureSubsetStrategy=BOOSTED_COLUMN_SHARE,
        seed=SEED,
        **{**BOOSTED, **settings},
    )


def balanced_weights(df: DataFrame, label: str, name: str = WEIGHT) -> DataFrame:
    """Add n / (classes * n of the row's class); a missing label is no class, its weight null."""
    sizes = class_sizes(df.where(F.col(label).isNotNull()), label)
    rows = sum(sizes.values())
    out: Column | None = None
    for k, n in sizes.items():
        weight = F.lit(rows / (len(sizes) * n))
        out = (F if out is None else out).when(F.col(label) == F.lit(k), weight)
    return df.withColumn(name, F.lit(None).cast("double") if out is None else out)


def baseline_models(label: str, forest_trees: int = FOREST_TREES) -> dict[str, object]:
    """Estimators by name; all but boosting take balanced weights.

    Forest trees stop at MLlib's deepest level, 30.
    """
    common = {"labelCol": label, "featuresCol": FEATURES}
    return {
        "DecisionTree": DecisionTreeClassifier(**common, weightCol=WEIGHT, maxDepth=30, seed=SEED),
        "RandomForest": RandomForestClassifier(
            **common, weightCol=WEIGHT, numTrees=forest_trees, maxDepth=30, seed=SEED
        ),
        "GradientBoosting": GBTClassifier(
            **common, maxIter=100, maxDepth=3, stepSize=0.1, seed=SEED
        ),
        "LogisticRegression": LogisticRegression(
            **common, weightCol=WEIGHT, maxIter=1000, regParam=1e-4
        ),
    }


#: Rows of one part of the training data.
PART_ROWS = 50_000
PART_HASH = "part_hash__"


def _content(df: DataFrame) -> Column:
    """Hash of a row's columns, missing ones told apart."""
    names = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*names, *[c.isNull() for c in names])


def spread(ready: DataFrame, rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Deal ``rows`` rows to parts of about ``part_rows`` by the column PART_HASH, in a
    fixed order.

    MLlib's samples are seeded per part. Parts follow from the rows' content and number
    only, so the fitted model doesn't depend on how many files or cores there are, and no
    part grows with the table.
    """
    parts = max(1, -(-rows // part_rows))
    return ready.repartition(parts, PART_HASH).sortWithinPartitions(PART_HASH).drop(PART_HASH)


def fit_model(
    train: DataFrame, prep: PipelineModel, estimator, label: str, part_rows: int = PART_ROWS
) -> PipelineModel:
    """Preparation and classifier as one fitted pipeline; ``part_rows``: see `spread`.

    Rows without a label don't take part. What the classifier reads is written once.
    """
    use_shared_checkpoints(train.sparkSession)
    train = train.where(F.col(label).isNotNull())
    weighted = estimator.hasParam("weightCol") and estimator.isDefined("weightCol")
    ready = _ready(balanced_weights(train, label) if weighted else train, prep, label)
    rows = ready.count()
    if isinstance(estimator, GBTClassifier) and rows > CELL_ROWS and estimator.getMinInstancesPerNode() == 1:
        ready = weighted_cells(ready, label, rows)
        rows = ready.count()
        estimator = estimator.copy({estimator.weightCol: WEIGHT})
    model = estimator.fit(spread(ready, rows, part_rows))
    return PipelineModel([*prep.stages, model])


#: Boosting reads a table 150 times and more; one of more rows than this is counted into
#: cells first.
CELL_ROWS = 500_000
#: Levels of a numeric feature with more values; MLlib's trees choose among 32 bins of them.
LEVELS = 128
#: Rows that the levels are placed by; MLlib places its bins by about 10,000.
LEVEL_ROWS = 20_000


def weighted_cells(ready: DataFrame, label: str, rows: int) -> DataFrame:
    """Label, features, weight and content hash: rows of one label and one cell of the
    features stand together, weighted by their number (or sum of weights).

    A feature of more than LEVELS values takes the nearest of LEVELS of them. The cuts lie
    halfway between levels, where MLlib puts its thresholds, so a fitted tree parts rows as
    it parts their cells. Cells that hold many rows are dealt into pieces, as boosting
    samples rows; all rows are counted.
    """
    attributes = ready.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    codes = {a["idx"] for a in attributes.get("nominal", [])}
    draw = F.pmod(F.col(PART_HASH), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, LEVEL_ROWS / rows)))
    drawn = ready.where(draw).groupBy(PART_HASH).agg(F.first(FEATURES).alias("v"))
    sample = [r[0].toArray() for r in drawn.orderBy(PART_HASH).select("v").collect()]
    levels: dict[int, np.ndarray] = {}
    for j, values in enumerate(np.sort(np.array(sample), axis=0).T if sample else ()):
        if j not in codes and len(np.unique(values)) > LEVELS:
            levels[j] = np.unique(values[((np.arange(LEVELS) + 0.5) * len(values) / LEVELS).astype(int)])
    cuts = {j: (v[:-1] + v[1:]) / 2 for j, v in levels.items()}
    keep = [c for c in (label, WEIGHT) if c in ready.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("x__")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).copy()
            for j, v in levels.items():
                x[:, j] = v[np.searchsorted(cuts[j], x[:, j], side="left")]
            offsets = pa.array(np.arange(b.num_rows + 1) * x.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], [*keep, "x__"]
            )

    source = ready.select(*keep, vector_to_array(FEATURES).alias("x__"))
    total = F.sum(WEIGHT) if WEIGHT in keep else F.count("*").cast("double")
    cells = written(
        source.mapInArrow(run, source.schema).groupBy(label, "x__").agg(F.count("*").alias("n__"), total.alias(WEIGHT)),
        "cells",
    )
    pieces = F.least("n__", F.lit(max(1, CELL_ROWS // max(1, cells.count())))).cast("int")
    dealt = cells.select(
        label, "x__", (F.col(WEIGHT) / pieces).alias(WEIGHT), F.explode(F.sequence(F.lit(1), pieces)).alias("piece__")
    )
    return written(
        dealt.select(
            label,
            array_to_vector("x__").alias(FEATURES, metadata=ready.schema[FEATURES].metadata),
            WEIGHT,
            F.xxhash64(label, "x__", "piece__").alias(PART_HASH),
        ),
        "pieces",
    )


def _ready(train: DataFrame, prep: PipelineModel, label: str, *more: str) -> DataFrame:
    """Label, features, weight if there is one, content hash and ``more``, written once."""
    hashed = prep.transform(train.withColumn(PART_HASH, _content(train)))
    wanted = (label, FEATURES, WEIGHT, PART_HASH, *more)
    return written(hashed.select(*[c for c in wanted if c in hashed.columns]), "ready")


def written(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: passes over it don't repeat the work."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_rows(train: DataFrame, key: Sequence[str], fit_rows: int, salt: str = "fit-rows") -> DataFrame:
    """At most about ``fit_rows`` rows, by a keyed draw."""
    share = min(1.0, fit_rows / max(1, train.count()))
    return train.where(keyed_uniform(key, salt) < F.lit(share))


@dataclass(frozen=True)
class GridSearch:
    """``results``: params, f1, one row per point in grid order. ``predictions``: key,
    label, fold, params, prediction, one row per point and labelled row, each predicted by
    a forest that hasn't seen its fold. ``model``: the best point, fitted on all folds and
    saved at ``path``; read when it is asked for, as a deep forest of MLlib's fills a driver."""

    prep: PipelineModel
    path: str
    results: DataFrame
    predictions: DataFrame

    @cached_property
    def model(self) -> PipelineModel:
        return PipelineModel([*self.prep.stages, RandomForestClassificationModel.load(self.path)])


def point_name(point: Mapping[str, object]) -> str:
    return ", ".join(f"{k}={point[k]}" for k in sorted(point))


def grid_search(
    train: DataFrame,
    prep: PipelineModel,
    label: str,
    key: Sequence[str],
    grid: Mapping[str, Sequence] = FOREST_GRID,
    folds: int = 5,
    parallelism: int = 3,
    fit_rows: int | None = None,
    part_rows: int = PART_ROWS,
) -> GridSearch:
    """Forest grid by F1 of class 1, averaged over stratified folds.

    Forests are fitted on all labelled rows outside a fold, which are counted into cells
    (see `cell_forests`); where that can't be, by MLlib (``parallelism`` and ``part_rows``
    are for this). Points that differ in the number of trees or the depth only share a
    forest. ``fit_rows`` bounds the labelled rows that a forest is fitted on, by a keyed
    draw; all rows are predicted. Unlabelled rows don't take part.
    """
    train = train.where(F.col(label).isNotNull())
    spark = train.sparkSession
    use_shared_checkpoints(spark)
    folded = stratified_folds(balanced_weights(train, label), label, key, folds)
    drawn = folded.withColumn(DRAW, keyed_uniform(key, "fit-rows"))
    ready = _ready(drawn, prep, label, "fold", DRAW, *key)
    rows = ready.count()
    share = 1.0 if fit_rows is None else min(1.0, fit_rows / max(1, rows))
    taken = F.lit(True) if share == 1.0 else F.col(DRAW) < F.lit(share)
    points = nested_points(grid)
    forest = RandomForestClassifier(
        labelCol=label, featuresCol=FEATURES, weightCol=WEIGHT, seed=SEED, maxMemoryInMB=FOREST_MEMORY_MB
    )
    shape = {k: forest.getOrDefault(k) for k in ("numTrees", "maxDepth", "minInstancesPerNode")}
    full = [{**shape, **p} for p in points]
    plain = set(grid) <= set(shape) and all(p["maxDepth"] <= 30 for p in full)  # MLlib refuses deeper ones
    counted = counted_cells(ready, FEATURES, label, WEIGHT, folds, taken, key) if plain else None
    if counted is not None:
        given = out_of_fold(spark, counted, folds, full, SEED)
        joined = counted.rows.join(given, ["fold", CELL]).select(*key, label, "fold", F.lit(0).alias("fit__"), "given__")
        out, names = written(joined, "out-of-fold"), [[point_name(p) for p in points]]
    else:
        sample = ready.where(taken).drop(DRAW)

        def fitted(estimator, fold: int | None = None):
            part = sample if fold is None else sample.where(F.col("fold") != fold)
            return estimator.fit(spread(part.select(label, FEATURES, WEIGHT, PART_HASH), round(rows * share), part_rows))

        out, names = _nested_folds(ready, forest, fitted, grid, label, key, folds, parallelism)
    # One row per point of a fit is made on reading only.
    named = F.element_at(F.array(*[F.array(*map(F.lit, n)) for n in names]), F.col("fit__") + 1)
    each = F.explode(F.arrays_zip(named.alias("params"), F.col("given__").alias("prediction")))
    predictions = out.select(*key, label, "fold", each.alias("p")).select(*key, label, "fold", "p.params", "p.prediction")
    hit, said = (F.col(label) == 1), (F.col("prediction") == 1)
    count = lambda c: F.sum(c.cast("long"))
    by_fold = predictions.groupBy("params", "fold").agg(
        (2 * count(hit & said) / F.greatest(count(hit) + count(said), F.lit(1))).alias("f1")
    )
    scores = {r["params"]: r["f1"] for r in by_fold.groupBy("params").agg(F.avg("f1").alias("f1")).collect()}
    rows_ = [(point_name(p), float(scores.get(point_name(p), 0.0))) for p in points]
    best = max(range(len(points)), key=lambda k: rows_[k][1])
    if counted is not None:
        params = {p.name: v for p, v in forest._paramMap.items()}
        defaults = {p.name: v for p, v in forest._defaultParamMap.items()}
        path = write_forest(spark, counted, folds, full[best], SEED, params, defaults)
    else:
        path = scratch_path(spark, "forest")
        fitted(forest.copy({forest.getParam(k): v for k, v in points[best].items()})).write().save(path)
    return GridSearch(prep, path, spark.createDataFrame(rows_, "params string, f1 double"), predictions)


def _nested_folds(
    ready: DataFrame, forest: RandomForestClassifier, fitted, grid, label: str, key: Sequence[str], folds: int, parallelism: int
) -> tuple[DataFrame, list[list[str]]]:
    """Key, label, fold, fit__ and given__ (the prediction at each point of the fit), by
    MLlib's forests, one for all points that differ in number of trees and depth only (see
    `forests`); the points' names by fit."""
    spark = ready.sparkSession
    points, (top, fits) = nested_points(grid), nested_fits(grid)

    def predict(job: tuple[int, dict]) -> str:
        fold, others = job
        model = fitted(forest.copy({forest.getParam(k): v for k, v in {**top, **others}.items()}), fold)
        mine = [p for p in points if all(p[k] == v for k, v in others.items())]
        shape = {"numTrees": model.getNumTrees, "maxDepth": model.getOrDefault("maxDepth")}
        shares = nested_scores(
            ready.where(F.col("fold") == fold),
            FEATURES,
            forest_arrays(node_table(spark, model)),
            [{**shape, **{k: p[k] for k in shape if k in p}} for p in mine],
            [*key, label, "fold"],
        )
        names[fits.index(others)] = [point_name(p) for p in mine]
        path = scratch_path(spark, "out-of-fold")
        given = F.transform("shares", lambda share: (share > 0.5).cast("int"))
        shares.select(
            *key, label, "fold", F.lit(fits.index(others)).alias("fit__"), given.alias("given__")
        ).write.parquet(path)
        return path

    names: dict[int, list[str]] = {}
    with ThreadPool(max(1, parallelism)) as pool:
        paths = pool.map(predict, [(fold, others) for fold in range(folds) for others in fits], chunksize=1)
    return spark.read.parquet(*paths), [names[i] for i in range(len(fits))]


# --------------------------------------------------------------------------
# scoring
# --------------------------------------------------------------------------


def add_predictions(df: DataFrame, model) -> DataFrame:
    """Append ``prediction`` (int) and both probabilities; rows keep their columns.

    Works on streams too: no shuffle, no action.
    """
    scored = model.transform(df)
    p = vector_to_array("probability")
    return drop_helpers(
        scored.withColumn(PROBABILITY_BAD, p[0])
        .withColumn(PROBABILITY_GOOD, p[1])
        .withColumn("prediction", F.col("prediction").cast("int"))
    )


def score_records(df: DataFrame, model) -> DataFrame:
    """Predictions with risk band, and the time of scoring."""
    return (
        add_predictions(df, model)
        .withColumn("risk_level", risk_band(F.col(PROBABILITY_GOOD)))
        .withColumn("scored_at", F.current_timestamp())
    )


def score_forms(df: DataFrame, model, defaults: Mapping[str, float], expected: Sequence[str]) -> DataFrame:
    """Forms that leave fields out: defaults, expected order, verdict.

    Columns outside ``expected`` (a form id, say) are carried along.
    """
    carried = [c for c in df.columns if c not in expected]
    filled = align_columns(fill_defaults(df, defaults), [*carried, *expected])
    return add_predictions(filled, model).withColumn("verdict", verdict(F.col("prediction")))


def scorecard(
    df: DataFrame, intercept: float, weights: Mapping[str, float], name: str = "score"
) -> DataFrame:
    """Logistic score from fixed coefficients."""
    margin = F.lit(float(intercept))
    for c, w in weights.items():
        margin = margin + F.lit(float(w)) * F.col(c)
    return df.withColumn(name, 1.0 / (1.0 + F.exp(-margin)))
