"""A small tabular classifier: split, baseline, random search, scoring."""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 123
TRAIN_PERCENT = 75


def train_test_split(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT, seed: int = SEED) -> DataFrame:
    """Append ``is_train``, decided by a hash of seed and key.

    A row falls on the same side however the table is partitioned and in any other engine.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("is_train", bucket < train_percent)


def with_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))


def split_parts(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    marked = train_test_split(df, key)
    return marked.where("is_train"), marked.where("not is_train")


def fit_forest(train: DataFrame, label: str, trees: int = 10):
    return RandomForestClassifier(labelCol=label, numTrees=trees, seed=SEED).fit(train)


def auc(scored: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(scored)


def rf_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Area under the ROC curve of an untuned forest on rows it has not seen, and what it was fitted on."""
    model = fit_forest(train, label)
    value = auc(model.transform(test), label)
    rows = {"trees": model.getNumTrees, "train_rows": train.count(), "test_rows": test.count()}
    columns = [F.lit(int(n)).cast("bigint").alias(name) for name, n in rows.items()]
    return train.sparkSession.range(1).select(*columns, F.lit(float(value)).alias("auc"))


def feature_importance(model, spark, names: list[str] | None = None) -> DataFrame:
    """Features by importance; one row per feature of the model, not per row of the table."""
    names = names or [f"f{i}" for i in range(model.numFeatures)]
    rows = list(zip(names, [float(v) for v in model.featureImportances.toArray()], strict=True))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


# The search space of the studied sweep, its number of trials and of rounds. Depths end at 30
# instead of 100, Spark's limit. Its trees know no penalty terms: the range of one goes to the least gain
# of a split, that of the least child weight to the least rows of a node.
DEPTH = (4, 30)
LOG_RATE = (-3, 0)
LOG_MIN_GAIN = (-6, -1)
LOG_MIN_ROWS = (-1, 3)
TRIALS, ROUNDS, TOLERANCE = 96, 1000, 0.01


def draw_trials(estimator: GBTClassifier, trials: int, seed: int = SEED, depth: tuple[int, int] = DEPTH) -> list[dict]:
    """Random parameter maps; rates and penalties are drawn on a logarithmic scale."""
    rng = random.Random(seed)
    log_uniform = lambda low, high: math.exp(rng.uniform(low, high))
    return [
        {
            estimator.maxDepth: rng.randint(*depth),
            estimator.stepSize: log_uniform(*LOG_RATE),
            estimator.minInfoGain: log_uniform(*LOG_MIN_GAIN) / 10,
            estimator.minInstancesPerNode: max(1, round(log_uniform(*LOG_MIN_ROWS))),
            estimator.subsamplingRate: rng.uniform(0.6, 1.0),
        }
        for _ in range(trials)
    ]


def tuned_sweep(
    train: DataFrame,
    label: str,
    trials: int = TRIALS,
    parallelism: int = 10,
    rounds: int = ROUNDS,
    depth: tuple[int, int] = DEPTH,
    key: str = "vec_id",
):
    """Fit the drawn trials in parallel; returns (ranked trials, best model).

    Each fit stops once a fifth of its rows, held back by a hash of ``key``, gains less than
    ``TOLERANCE`` from a further round. A smaller search is the caller's choice.
    """
    held = train.withColumn("held_back", F.pmod(F.xxhash64(key), F.lit(5)) == 0)
    estimator = GBTClassifier(
        labelCol=label, maxIter=rounds, seed=SEED, validationIndicatorCol="held_back", validationTol=TOLERANCE
    )
    maps = draw_trials(estimator, trials, depth=depth)
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        trainRatio=TRAIN_PERCENT / 100,
        parallelism=parallelism,
        seed=SEED,
    ).fit(held)
    rows = [
        (i, *[float(m[p]) for p in m], float(score))
        for i, (m, score) in enumerate(zip(maps, search.validationMetrics, strict=True))
    ]
    names = ["trial", *[p.name for p in maps[0]], "auc"]
    spark = train.sparkSession
    schema = "trial int, " + ", ".join(f"{n} double" for n in names[1:])
    ranked = spark.createDataFrame(rows, schema).orderBy(F.desc("auc"), "trial")
    return ranked, search.bestModel


def batch_score(model, df: DataFrame, key: str) -> DataFrame:
    """One probability per row of a new table."""
    return model.transform(df).select(
        key, vector_to_array("probability")[1].alias("prediction")
    )


def stated_linear(spark, weights: list[float], intercept: float):
    """A logistic model with given coefficients, as one that was fitted elsewhere."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors

    jvm = spark.sparkContext._jvm
    coefficients = _py2java(spark.sparkContext, Vectors.dense(weights))
    return LogisticRegressionModel(
        jvm.org.apache.spark.ml.classification.LogisticRegressionModel("stated", coefficients, float(intercept))
    )


def fit_linear(train: DataFrame, label: str):
    return LogisticRegression(labelCol=label, maxIter=20, regParam=0.01).fit(train)


def score_udf(weights: list[float], intercept: float):
    """A vectorised function from a struct of feature columns to a probability.

    The weights travel inside the function: one number per feature, whatever the table's size.
    """
    import numpy as np

    vector = np.asarray(weights)

    @F.pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        margin = features.to_numpy(dtype=float) @ vector + intercept
        return pd.Series(1.0 / (1.0 + np.exp(-margin)))

    return score


def score_struct(df: DataFrame, key: str, features: str, weights: list[float], intercept: float) -> DataFrame:
    columns = F.struct(*[F.col(features)[i].cast("double").alias(f"f{i}") for i in range(len(weights))])
    return df.select(key, score_udf(weights, intercept)(columns).alias("prediction"))
