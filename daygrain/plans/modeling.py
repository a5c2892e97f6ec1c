"""Modelling hand-off (M1-M6) on ``pyspark.ml``, with no data leaving Spark.

The documented consumer drops the leaky columns and the key, keeps complete
rows, splits chronologically 80/20 without shuffling, fits a 100-tree
random forest (seed 42), reports R^2 on the later part and ranks feature
importances.  Text features (``day_name``, ``month_name``) are indexed
instead of being fed raw.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.sinks import materialize

LEAKY_SUFFIX = "__leaky"


def written(mart: DataFrame) -> DataFrame:
    """The mart from a table in the shared folder: counting, indexing, fitting and scoring all read it again."""
    return materialize(mart, scratch_path(mart.sparkSession, "model-mart"))


def select_features(df: DataFrame, key: str, target: str = "total_trips__leaky") -> list[str]:
    """M1: every non-leaky column except the key (target is leaky by name)."""
    return [c for c in df.columns if LEAKY_SUFFIX not in c and c != key and c != target]


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a null in any used column."""
    return df.dropna("any", subset=columns)


def chrono_split(df: DataFrame, order: str, train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """M3: first ``train_fraction`` of rows by ``order`` for training, the rest for test.

    The cut is the ``train_fraction`` quantile of the ordering column's
    ranks, computed with an exact count (one aggregation) and a
    ``row_number`` over the period series (one row per period).
    """
    n = df.count()
    cut = int(n * train_fraction)
    ranked = df.withColumn("_pos", F.row_number().over(_order_window(order)))
    train = ranked.filter(F.col("_pos") <= cut).drop("_pos")
    test = ranked.filter(F.col("_pos") > cut).drop("_pos")
    return train, test


def _order_window(order: str) -> Window:
    # One global ordering: the input is one row per period (thousands of rows).
    return Window.orderBy(F.col(order).asc_nulls_last())


def fit_forest(
    train: DataFrame, features: list[str], target: str = "total_trips__leaky", trees: int = 100, seed: int = 42,
    depth: int = 10,
) -> PipelineModel:
    """M4: index text features, assemble, fit a random-forest regressor.

    Every split sees all features.  ``depth`` bounds the trees (the documented
    consumer grows them without bound; Spark stops at 30).
    """
    text = [c for c in features if isinstance(train.schema[c].dataType, T.StringType)]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in text]
    inputs = [f"{c}__idx" if c in text else c for c in features]
    cast = train.select(
        *[F.col(c).cast("double").alias(c) if c not in text else F.col(c) for c in features],
        F.col(target).cast("double").alias(target),
    )
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, seed=seed,
                                        maxDepth=depth, featureSubsetStrategy="all"))
    return Pipeline(stages=stages).fit(cast)


def r2(model: PipelineModel, test: DataFrame, features: list[str], target: str = "total_trips__leaky") -> float:
    """M5: coefficient of determination on the test part."""
    text = {c for c in features if isinstance(test.schema[c].dataType, T.StringType)}
    cast = test.select(
        *[F.col(c) if c in text else F.col(c).cast("double").alias(c) for c in features],
        F.col(target).cast("double").alias(target),
    )
    pred = model.transform(cast)
    return RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="r2").evaluate(pred)


def importances(model: PipelineModel, features: list[str], spark=None) -> DataFrame:
    """M6 / O3: feature importances ranked, as a DataFrame."""
    from pyspark.sql import SparkSession

    # One weight per model feature: a vector the size of the feature list.
    values = model.stages[-1].featureImportances.toArray().tolist()
    session = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    df = session.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def top_features(ranked: DataFrame, k: int = 5) -> DataFrame:
    """O3: the ``k`` most important features (a top-k report)."""
    return ranked.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)
