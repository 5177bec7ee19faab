"""Regression on prepared trips: features, estimators, tuning, scores."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions import key_bucket
from fareloom.operators.topk import top_rows


@dataclass(frozen=True)
class FeatureSet:
    """Numeric inputs and integer codes that are one-hot encoded."""

    numeric: tuple[str, ...]
    codes: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.codes


# The feature sets.
CLEAN = FeatureSet(
    ("trip_distance", "passenger_count", "hour", "day_of_week"),
    ("PULocationID", "DOLocationID", "VendorID", "payment_type"),
)
# Holds parts of the total amount, so its scores on that label flatter.
LEAKY = FeatureSet(
    (
        "trip_distance",
        "hour",
        "day_of_week",
        "extras",
        "fare_amount",
        "tip_amount",
        "passenger_count",
        "payment_type",
    )
)
DISTANCE = FeatureSet(("total_amount", "triptime", "extras", "payment_type", "passenger_count"))

FEATURE_SETS = {"clean": CLEAN, "leaky": LEAKY, "distance": DISTANCE}

# Estimator settings and tuning grids.
ESTIMATORS = {
    "linear": (
        GeneralizedLinearRegression,
        {"family": "gaussian", "link": "identity", "maxIter": 10, "regParam": 0.1},
    ),
    "tree": (DecisionTreeRegressor, {"maxDepth": 5}),
    "forest": (RandomForestRegressor, {"numTrees": 15, "maxDepth": 5, "seed": 42}),
    "boosted": (GBTRegressor, {"maxIter": 10, "seed": 42}),
}
GRIDS = {
    "forest": {"numTrees": [10, 20, 30], "maxDepth": [5, 10, 15]},
    "boosted": {"maxDepth": [5, 10], "maxIter": [10, 20]},
}
FOLDS = {"forest": 3, "boosted": 5}


# Rows that a task of a training job reads, about. Forests and sums of doubles follow the
# partitioning of their input, so it follows from the data and not from the cores. Each
# pass of a fit starts a task, and sends statistics of all open nodes, per bucket.
ROWS_PER_BUCKET = 100_000


def buckets_of(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // rows_per_bucket))


def training_table(
    rows: DataFrame,
    keys: Sequence[str],
    path: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    partition_by: Sequence[str] = (),
    parted: tuple[int, str] | None = None,
) -> DataFrame:
    """``rows`` written as a table of buckets of their key, sorted within each.

    The number of buckets grows with the rows. A reader gets one partition per bucket,
    whatever the machine, without a shuffle. ``parted`` says that the rows already lie in
    that many partitions by hash of one column, as after a join; they stay there. With
    ``partition_by`` each value has files of its own in every bucket.
    """
    spark = rows.sparkSession
    if parted:
        buckets, by = parted[0], [parted[1]]
    else:
        buckets, by = buckets_of(rows.count(), rows_per_bucket), list(keys)
        rows = rows.repartition(buckets, *by)
    name = f"training_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(buckets, *by).sortBy(*keys).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    # Else Spark reads buckets as plain files where no join asks for them, and where the
    # key is not read. The filter keeps all rows and the key.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return spark.table(name).filter(F.hash(*by) >= -(1 << 31))


def onehot(codes: Sequence[str], handle_invalid: str = "keep") -> OneHotEncoder:
    """Encoder of integer codes into ``<code>_ohe``.

    With "keep" a code beyond the training maximum becomes a vector of zeros;
    with "error" it stops the job.
    """
    return OneHotEncoder(
        inputCols=list(codes),
        outputCols=[f"{code}_ohe" for code in codes],
        handleInvalid=handle_invalid,
    )


def used_slots(df: DataFrame, features: FeatureSet, on_new: str = "keep") -> list[int]:
    """Places of the assembled vector that are not zero in all rows of ``df``: numbers, and
    slots of codes that occur. One pass; a code of few values, the largest of them 264,
    has 265 slots."""
    codes = features.codes
    seen = df.select(*(F.collect_set(code).alias(code) for code in codes)).head()
    places, first = list(range(len(features.numeric))), len(features.numeric)
    for code in codes:
        size = max(map(int, seen[code]), default=0) + (on_new == "keep")
        places += [first + c for c in sorted(map(int, seen[code])) if c < size]
        first += size
    return places


def feature_stages(
    features: FeatureSet,
    on_null: str = "skip",
    scale: bool = False,
    on_new: str = "keep",
    slots: Sequence[int] | None = None,
) -> list:
    """Stages that put ``features`` into one vector; ``on_null`` is "skip" or "error",
    ``on_new`` what the encoder does with a code it has not seen, "keep" or "error".
    With "error" each code has one slot less. ``slots`` are the places of the vector to
    keep, all by default."""
    assembled = [*features.numeric, *(f"{code}_ohe" for code in features.codes)]
    steps = [onehot(features.codes, on_new)] if features.codes else []
    names = ["assembled"] * (slots is not None) + ["unscaled"] * scale + ["features"]
    steps.append(
        VectorAssembler(inputCols=assembled, outputCol=names[0], handleInvalid=on_null)
    )
    if slots is not None:
        steps.append(VectorSlicer(inputCol=names[0], outputCol=names[1], indices=list(slots)))
    if scale:
        steps.append(
            StandardScaler(
                inputCol=names[-2], outputCol="features", withMean=True, withStd=True
            )
        )
    return steps


def estimator(kind: str, label: str, **overrides) -> Estimator:
    build, settings = ESTIMATORS[kind]
    return build(labelCol=label, featuresCol="features", **{**settings, **overrides})


def complete_rows(df: DataFrame, features: FeatureSet, label: str) -> DataFrame:
    """Rows in which the label and every feature are present."""
    return df.na.drop(subset=[*features.columns, label])


def fit(
    train: DataFrame,
    kind: str,
    label: str,
    features: FeatureSet,
    scale: bool = False,
    on_new: str = "keep",
    **overrides,
) -> PipelineModel:
    """Encoder, assembler and estimator fitted as one pipeline. Slots of codes that do not
    occur in ``train`` are left out: they are zero in all rows, so no split or coefficient
    falls on them, but a row of a tree's or a scaler's input holds every slot."""
    learner = estimator(kind, label, **overrides)
    rows = complete_rows(train, features, label)
    slots = used_slots(rows, features, on_new) if features.codes else None
    stages = [*feature_stages(features, "error", scale, on_new, slots), learner]
    return Pipeline(stages=stages).fit(rows)


def predict(model, test: DataFrame, features: FeatureSet, label: str) -> DataFrame:
    return model.transform(complete_rows(test, features, label))


def metrics(predictions: DataFrame, label: str, digits: int | None = None) -> DataFrame:
    """Rows, RMSE, MAE and R2 from a single pass over the predictions."""
    pairs = predictions.select(
        F.col(label).cast("double").alias("actual"),
        (F.col(label) - F.col("prediction")).alias("error"),
    )
    sums = pairs.agg(
        F.count("error").alias("rows"),
        F.avg(F.col("error") * F.col("error")).alias("mse"),
        F.avg(F.abs("error")).alias("mae"),
        F.var_pop("actual").alias("variance"),
    )
    scores = {
        "rmse": F.sqrt("mse"),
        "mae": F.col("mae"),
        "r2": 1 - F.try_divide(F.col("mse"), F.col("variance")),
    }
    if digits is not None:
        scores = {name: F.round(score, digits) for name, score in scores.items()}
    return sums.select("rows", *(score.alias(name) for name, score in scores.items()))


def cross_validate(
    train: DataFrame,
    kind: str,
    label: str,
    features: FeatureSet,
    fold_weights: Mapping[str, int] | None = None,
    grid: Mapping[str, Sequence] | None = None,
    folds: int | None = None,
    parallelism: int | None = None,
    encoder: PipelineModel | None = None,
    **overrides,
) -> CrossValidatorModel:
    """Best model of ``grid`` by mean RMSE over ``folds``.

    Features are assembled once, outside the folds, by ``encoder``, the fitted
    feature stages. With ``fold_weights`` the
    fold of a row follows from its key, so a retried task cannot move rows
    between folds; without, Spark draws the folds at random. Every grid point is
    fitted on its own, ``parallelism`` at a time (by default one for every two cores);
    ``tuning.tune`` takes fewer fits for forests and boosted trees.
    """
    parallelism = parallelism or max(1, train.sparkSession.sparkContext.defaultParallelism // 2)
    folds = folds or FOLDS[kind]
    encoder = encoder or fit_features(train, features)
    data = encoder.transform(train).select(
        "features",
        label,
        *([key_bucket(fold_weights, folds, shift=10).alias("fold")] if fold_weights else []),
    )
    learner = estimator(kind, label, **overrides)
    builder = ParamGridBuilder()
    for name, values in (grid or GRIDS[kind]).items():
        builder.addGrid(learner.getParam(name), list(values))
    return CrossValidator(
        estimator=learner,
        estimatorParamMaps=builder.build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=folds,
        foldCol="fold" if fold_weights else "",
        seed=42,
        parallelism=parallelism,
    ).fit(data)


def fit_features(train: DataFrame, features: FeatureSet, scale: bool = False) -> PipelineModel:
    return Pipeline(stages=feature_stages(features, scale=scale)).fit(train)


def whole_model(encoder: PipelineModel, tuned: CrossValidatorModel) -> PipelineModel:
    """The best model with the feature stages it needs to score a prepared table."""
    return PipelineModel(stages=[*encoder.stages, tuned.bestModel])


def grid_scores(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """One row per grid point: its parameters, mean and deviation of RMSE over the folds."""
    rows = [
        ({param.name: float(value) for param, value in point.items()}, float(mean), float(spread))
        for point, mean, spread in zip(
            model.getEstimatorParamMaps(), model.avgMetrics, model.stdMetrics
        )
    ]
    schema = "params MAP<STRING, DOUBLE>, avg_rmse DOUBLE, std_rmse DOUBLE"
    return df.sparkSession.createDataFrame(rows, schema)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_tuned(path: str) -> CrossValidatorModel:
    return CrossValidatorModel.load(path)


def top_predictions(
    predictions: DataFrame, label: str, ties: Sequence[str], k: int = 100
) -> DataFrame:
    """The k largest labels with their predictions, numbered from 0.

    The limit comes first, so only k rows reach the task that numbers them.
    """
    largest = top_rows(predictions.select(label, "prediction", *ties), label, ties, k)
    order = [F.desc_nulls_last(label), *map(F.asc_nulls_last, ties)]
    return largest.select(
        (F.row_number().over(W.orderBy(*order)) - 1).alias("index"), label, "prediction", *ties
    )


def feature_columns(assembled: DataFrame, names: Sequence[str], vector: str = "features"):
    """The vector taken apart again, one column per name."""
    values = vector_to_array(vector)
    return [values[i].alias(name) for i, name in enumerate(names)]


def onehot_positions(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One-hot vectors as positions: ``<code>_size`` and ``<code>_at``.

    The position is null for the last category, whose vector is all zeros.
    """
    encoder = onehot(codes, "error").fit(df)
    encoded = encoder.transform(df)
    # The last category has no slot of its own.
    slots = {code: size - 1 for code, size in zip(codes, encoder.categorySizes)}
    at = {
        f"{code}_at": F.nullif(
            F.get(F.unwrap_udt(f"{code}_ohe")["indices"], 0).cast("long"), F.lit(-1).cast("long")
        )
        for code in codes
    }
    sizes = {f"{code}_size": F.lit(size) for code, size in slots.items()}
    return encoded.withColumns({**at, **sizes}).drop(*(f"{code}_ohe" for code in codes))
