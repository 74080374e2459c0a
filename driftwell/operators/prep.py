"""Feature preparation as a fitted MLlib pipeline.

Fills and scales are learned exactly (MLlib's own imputer approximates the median
and its scaler uses the sample deviation) and stored in SQL stages, so the fitted
pipeline saves, loads and runs on streams like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions import no_nan
from driftwell.operators.clean import medians, modes

NUM, CAT, INDEX, HOT = "num__", "cat__", "idx__", "hot__"
FEATURES = "features"
# A category column may take at most this many levels as separate columns.
MAX_LEVELS = 1000


def moments(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column in one pass; a constant gets deviation 1."""
    row = df.agg(
        *[F.avg(c).alias(f"{n}__m") for n, c in columns.items()],
        *[F.stddev_pop(c).alias(f"{n}__s") for n, c in columns.items()],
    ).first()
    return {n: (row[f"{n}__m"] or 0.0, row[f"{n}__s"] or 1.0) for n in columns}


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation, in place."""
    stats = moments(df, {c: no_nan(F.col(c)) for c in columns})
    return df.withColumns(
        {c: (no_nan(F.col(c)) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}
    )


def levels_of(df: DataFrame, column: str) -> list:
    """Sorted non-missing levels; refuses a column with too many."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} levels")
    return sorted(r[0] for r in rows)


def dummy_columns(df: DataFrame, column: str, drop_first: bool = True, levels=None) -> DataFrame:
    """Replace a category by 0/1 columns ``<column>_<level>``, the first level dropped."""
    levels = levels if levels is not None else levels_of(df, column)
    kept = levels[1:] if drop_first else levels
    hits = [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}")
        for v in kept
    ]
    return df.select(*[c for c in df.columns if c != column], *hits)


def one_hot(df: DataFrame, column: str, levels: Sequence) -> DataFrame:
    """0/1 columns for known levels; an unseen or missing value is all zeros."""
    return dummy_columns(df, column, drop_first=False, levels=list(levels))


def fit_preprocessor(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    scale: bool = False,
) -> PipelineModel:
    """Median and mode fill, optional scaling, one-hot, one feature vector.

    Columns in neither list do not reach the vector.
    """
    stages = []
    selects = ["*"]
    centre = medians(df, numeric) if numeric else {}
    fills = {c: 0.0 if v is None else v for c, v in centre.items()}
    scaling = (
        moments(df, {c: F.coalesce(no_nan(F.col(c)), F.lit(fills[c])) for c in numeric})
        if scale and numeric
        else {}
    )
    for c in numeric:
        value = f"CAST(`{c}` AS DOUBLE)"
        filled = f"COALESCE(CASE WHEN NOT ISNAN({value}) THEN {value} END, {fills[c]!r}D)"
        if c in scaling:
            mean, std = scaling[c]
            filled = f"({filled} - ({mean!r}D)) / {std!r}D"
        selects.append(f"{filled} AS `{NUM}{c}`")
    common = modes(df.select(*[F.col(c).cast("string").alias(c) for c in categorical]), categorical)
    for c in categorical:
        fill = str(common.get(c, "")).replace("\\", "\\\\").replace("'", "\\'")
        selects.append(f"COALESCE(CAST(`{c}` AS STRING), '{fill}') AS `{CAT}{c}`")
    stages.append(SQLTransformer(statement=f"SELECT {', '.join(selects)} FROM __THIS__"))
    if categorical:
        filled = stages[0].transform(df)
        indexer = StringIndexer(
            inputCols=[CAT + c for c in categorical],
            outputCols=[INDEX + c for c in categorical],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(filled)
        # The extra index of unseen values is the dropped last one: all zeros.
        encoder = OneHotEncoder(
            inputCols=[INDEX + c for c in categorical],
            outputCols=[HOT + c for c in categorical],
            dropLast=True,
        ).fit(indexer.transform(filled))
        stages += [indexer, encoder]
    stages.append(
        VectorAssembler(
            inputCols=[NUM + c for c in numeric] + [HOT + c for c in categorical],
            outputCol=FEATURES,
            handleInvalid="error",
        )
    )
    return PipelineModel(stages)


def feature_names(prep: PipelineModel) -> list[str]:
    """Names of the vector's positions."""
    out = []
    levels: list[list[str]] = []
    for stage in prep.stages:
        if isinstance(stage, StringIndexerModel):
            levels = [list(v) for v in stage.labelsArray]
    for stage in prep.stages:
        if isinstance(stage, VectorAssembler):
            names = stage.getInputCols()
            out += [n for n in names if n.startswith(NUM)]
            hot = [n[len(HOT) :] for n in names if n.startswith(HOT)]
            for c, values in zip(hot, levels):
                out += [f"{CAT}{c}_{v}" for v in values]
    return out


def drop_helpers(df: DataFrame) -> DataFrame:
    """Remove the columns preparation and models add on the way."""
    helpers = (NUM, CAT, INDEX, HOT)
    extra = (FEATURES, "rawPrediction", "probability")
    return df.drop(*[c for c in df.columns if c.startswith(helpers) or c in extra])
