"""Fitted models that are stored, read again and applied by a function that SQL can call.

Spark's own writer and reader keep the model. For the function the stored numbers of a linear model or of a
forest are read as a table, whose size is that of the model, and travel to the executors once; a task builds its
scorer from them once and then scores batch after batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store_model(model, path: str) -> None:
    """Write a fitted model, over an older one at the same place."""
    model.write().overwrite().save(path)


def read_model(spark: SparkSession, path: str):
    """The model that was written to ``path``, whatever its class."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def _kind(spark: SparkSession, path: str) -> str:
    metadata = spark.read.text(f"{path}/metadata").first().value
    return json.loads(metadata)["class"].rpartition(".")[2]


def model_numbers(spark: SparkSession, path: str) -> dict:
    """What a scorer needs of a stored linear model or random forest of two classes."""
    kind = _kind(spark, path)
    data = spark.read.parquet(f"{path}/data")
    if kind == "LogisticRegressionModel":
        row = data.select("coefficientMatrix", "interceptVector").first()
        weights, intercept = row.coefficientMatrix.toArray(), row.interceptVector.toArray()
        if len(weights) != 1:
            raise ValueError("a scorer needs a model of two classes")
        return {"weights": weights[0], "intercept": float(intercept[0])}
    if kind == "RandomForestClassificationModel":
        node = F.col("nodeData")
        rows = data.select(
            "treeID",
            node["id"].alias("id"),
            node["impurityStats"].alias("stats"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["split"]["featureIndex"].alias("feature"),
            node["split"]["leftCategoriesOrThreshold"].alias("cut"),
            node["split"]["numCategories"].alias("categories"),
        ).toPandas()
        if (rows["categories"] > 0).any():
            raise ValueError("a scorer knows no categorical features")
        return {"trees": [_tree(part) for _, part in rows.groupby("treeID")]}
    raise ValueError(f"no scorer for {kind}")


def _tree(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """Nodes by number: feature and cut of a split, its children, and the share of the second class in a leaf."""
    rows = rows.sort_values("id")
    leaf = rows["left"].to_numpy() < 0
    stats = np.stack(rows["stats"].to_numpy())
    return {
        "feature": np.where(leaf, 0, rows["feature"].to_numpy()),
        "cut": np.array([0.0 if end else float(cut[0]) for cut, end in zip(rows["cut"], leaf)]),
        "left": np.where(leaf, rows["id"], rows["left"]),
        "right": np.where(leaf, rows["id"], rows["right"]),
        "share": stats[:, 1] / stats.sum(axis=1),
    }


def _scorer(numbers: dict):
    """Features as a matrix to probabilities of the second class."""
    if "weights" in numbers:
        return lambda x: 1.0 / (1.0 + np.exp(-(x @ numbers["weights"] + numbers["intercept"])))

    def forest(x):
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for tree in numbers["trees"]:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                down = np.where(x[rows, tree["feature"][at]] <= tree["cut"][at], tree["left"][at], tree["right"][at])
                if np.array_equal(down, at):
                    break
                at = down
            total += tree["share"][at]
        return total / len(numbers["trees"])

    return forest


def register_scorer(spark: SparkSession, name: str, path: str):
    """A function from a struct of numeric features to a probability, from a stored model; SQL calls it by ``name``.

    A feature that is missing makes the score missing.
    """
    numbers = spark.sparkContext.broadcast(model_numbers(spark, path))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        apply = _scorer(numbers.value)  # once a task
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            yield pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, apply(x))).replace({np.nan: None}).astype(float)

    return spark.udf.register(name, score)


def scored_by_sql(df: DataFrame, key: str, features: str, size: int, name: str) -> DataFrame:
    """``key`` and ``prediction`` of every row, through the function registered under ``name``."""
    columns = ", ".join(f"cast({features}[{i}] as double) f{i}" for i in range(size))
    view = f"scored_{name}"
    df.select(key, features).createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT {key}, {name}(struct({columns})) AS prediction FROM {view}")
