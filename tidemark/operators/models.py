"""Sampling, splitting, fare regression, batch prediction and attributions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import bucket
from tidemark.session import checkpointed

# Sampling and training defaults.
SAMPLE_SHARE = 0.05
SAMPLE_ROWS = 50_000
TRAIN_PERCENT = 80
LINEAR_TRAIN_PERCENT = 75
SEED = 42
TREES = 100
LEARNING_RATE = 0.1
TREE_DEPTH = 5
LABEL = "target"
NUMERIC = ("trip_miles", "trip_seconds", "trip_start_hour", "trip_day_of_week")
CATEGORICAL = ("payment_type", "company")


def random_sample(df: DataFrame, share: float = SAMPLE_SHARE, rows: int | None = SAMPLE_ROWS,
                  seed: int = SEED) -> DataFrame:
    """A random share of the rows, capped at a row count (the sampling feature itself).

    Each row draws a number, and the rows with the smallest ones stay: as many as are asked for, or all below ``share`` if those are
    fewer, evenly over all partitions. A capped sample first keeps what lies below a bound that leaves some more than ``rows``;
    only those are ranked, so no task holds more.
    """
    if rows is None:
        return df.sample(share, seed)
    drawn = df.withColumn("_drawn", F.rand(seed))
    bound = min(share, (rows + 6 * math.sqrt(rows) + 10) / max(1, df.count()))
    while True:
        some = checkpointed(drawn.filter(F.col("_drawn") < bound))
        if some.count() >= rows:
            return some.orderBy("_drawn").limit(rows).drop("_drawn")
        if bound >= share:
            return some.drop("_drawn")
        bound = min(share, 2 * bound)


def hash_sample(df: DataFrame, key: str, buckets: int = 100, chosen: int = 1) -> DataFrame:
    """Repeatable sample: the rows whose key falls into one hash bucket."""
    return df.filter(bucket(F.col(key), buckets) == chosen)


def hash_split(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Add ``split`` = train or test by hash bucket; does not depend on partitioning."""
    part = F.when(bucket(F.col(key)) < train_percent, F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn("split", part)


def random_split(df: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Random split; depends on how the rows are partitioned, so prefer :func:`hash_split`."""
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
    return train, test


def feature_stages(numeric: Sequence[str] = NUMERIC, categorical: Sequence[str] = CATEGORICAL) -> list:
    """Index and one-hot encode the categories, then assemble one vector. The label is no input.

    A level not seen in training gets no column of its own (all zeros).
    """
    stages: list = []
    encoded = [f"{c}_onehot" for c in categorical]
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
    stages.append(VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features", handleInvalid="skip"))
    return stages


def reference_coded_stages(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Like :func:`feature_stages`, without the column of each category's most frequent level.

    Least squares needs this: with all levels present the columns would add up
    to the intercept. Unseen levels count as the most frequent one.
    """
    if not categorical:
        return feature_stages(numeric, [])
    indexer, encoder, _ = feature_stages(numeric, categorical)
    fitted = indexer.fit(train)
    stages, inputs = [fitted, encoder], list(numeric)
    for name, labels in zip(categorical, fitted.labelsArray):
        if len(labels) > 1:
            stages.append(VectorSlicer(inputCol=f"{name}_onehot", outputCol=f"{name}_levels", indices=list(range(1, len(labels)))))
            inputs.append(f"{name}_levels")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")]


def fit_boosted_trees(train: DataFrame, label: str = LABEL, numeric: Sequence[str] = NUMERIC,
                      categorical: Sequence[str] = CATEGORICAL, trees: int = TREES, rate: float = LEARNING_RATE,
                      depth: int = TREE_DEPTH, seed: int = SEED) -> PipelineModel:
    """Gradient-boosted trees with squared error.

    MLlib checkpoints the residuals every ten trees in the shared folder, so the
    lineage stays short. The training rows are written once, dealt evenly to as many parts as
    there are cores: each level of a tree is a pass over them, in as many tasks as they have parts.
    """
    width = train.sparkSession.sparkContext.defaultParallelism
    dealt = checkpointed(train.select(*dict.fromkeys([label, *numeric, *categorical])).repartition(width))
    trees_stage = GBTRegressor(labelCol=label, featuresCol="features", maxIter=trees, stepSize=rate, maxDepth=depth,
                               lossType="squared", seed=seed, checkpointInterval=10)
    return Pipeline(stages=[*feature_stages(numeric, categorical), trees_stage]).fit(dealt)


def fit_linear(train: DataFrame, label: str = LABEL, numeric: Sequence[str] = NUMERIC,
               categorical: Sequence[str] = CATEGORICAL) -> PipelineModel:
    """Ordinary least squares; one pass over the rows while there are few features."""
    line = LinearRegression(labelCol=label, featuresCol="features", regParam=0.0, solver="auto")
    return Pipeline(stages=[*reference_coded_stages(train, numeric, categorical), line]).fit(train)


def predict(model: PipelineModel, instances: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Batch prediction over instance rows."""
    scored = model.transform(instances)
    return scored.select(*(keep if keep is not None else instances.columns), "prediction")


def regression_metrics(predictions: DataFrame, label: str = LABEL, group: Sequence[str] = ()) -> DataFrame:
    """RMSE and R² in one aggregate, optionally per split."""
    error = F.pow(F.col(label) - F.col("prediction"), F.lit(2.0))
    sums = predictions.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(error).alias("_mse"), F.var_pop(label).alias("_var"))
    return sums.select(*group, "n", F.sqrt("_mse").alias("rmse"),
                       (F.lit(1.0) - F.try_divide("_mse", "_var")).alias("r2"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def linear_attributions(model: PipelineModel, rows: DataFrame, key: str, baseline: DataFrame | None = None) -> DataFrame:
    """Feature attributions of a linear model: (key, feature_no, attribution).

    Each is coefficient x (value - mean value over ``baseline``, as a rule the training rows; the rows themselves
    without one); their sum is the prediction minus the prediction at the mean. Only the means, one row, come to the driver.
    """
    scored = model.transform(rows).select(key, "features")
    means = (scored if baseline is None else model.transform(baseline)).agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    coefficients = model.stages[-1].coefficients.toArray()
    terms = F.array(*[F.struct(F.lit(float(c)).alias("c"), F.lit(float(m)).alias("m"))
                      for c, m in zip(coefficients, means)])
    parts = F.zip_with(vector_to_array("features"), terms, lambda x, t: t["c"] * (x - t["m"]))
    return scored.select(key, F.posexplode(parts).alias("feature_no", "attribution"))
