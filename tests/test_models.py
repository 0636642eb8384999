import random
import statistics

import pytest
from pyspark.sql import functions as F

from staylake.operators import models, profile, scoring
from staylake.session import scratch_dir


@pytest.fixture(scope="module")
def wine(spark):
    """Two informative features and one of noise; the label follows the first two."""
    rng = random.Random(5)
    rows = []
    for i in range(800):
        x = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, x, int(x[0] + 0.5 * x[1] + rng.gauss(0, 0.3) > 0.8)))
    return spark.createDataFrame(rows, "key long, x array<double>, high int").cache()


@pytest.fixture(scope="module")
def parts(wine):
    return models.split_parts(models.with_vector(wine, "x"), "key")


def test_split_is_stable_and_near_its_share(spark, wine):
    once = models.train_test_split(wine, "key").where("is_train").select("key")
    again = models.train_test_split(wine.repartition(7), "key").where("is_train").select("key")
    assert once.exceptAll(again).count() == again.exceptAll(once).count() == 0
    assert 0.70 < once.count() / wine.count() < 0.80


def test_forest_finds_the_signal(spark, parts):
    row = models.rf_baseline(*parts, "high").first()
    assert row.auc > 0.89 and row.trees == 10 and row.train_rows + row.test_rows == 800
    top = models.feature_importance(models.fit_forest(parts[0], "high"), spark, ["a", "b", "noise"]).collect()
    assert [r.feature for r in top] == ["a", "b", "noise"]
    assert sum(r.importance for r in top) == pytest.approx(1.0)


def test_sweep_ranks_its_trials(parts):
    ranked, best = models.tuned_sweep(parts[0], "high", trials=3, rounds=3, depth=(2, 4), key="key")
    scores = [r.auc for r in ranked.collect()]
    assert len(scores) == 3 and scores == sorted(scores, reverse=True)
    assert models.auc(best.transform(parts[1]), "high") > 0.85


def test_sweep_draws_from_the_whole_space():
    from pyspark.ml.classification import GBTClassifier

    estimator = GBTClassifier()
    maps = models.draw_trials(estimator, models.TRIALS)
    assert len(maps) == 96
    depths = [m[estimator.maxDepth] for m in maps]
    assert min(depths) >= 4 and max(depths) <= 30 and len(set(depths)) > 15
    assert all(0.0497 < m[estimator.stepSize] <= 1 for m in maps)


def test_scores_cover_every_row_and_agree(wine, parts):
    model = models.fit_linear(parts[0], "high")
    jvm = models.batch_score(model, models.with_vector(wine, "x"), "key")
    udf = models.score_struct(wine, "key", "x", model.coefficients.tolist(), float(model.intercept))
    both = jvm.join(udf.withColumnRenamed("prediction", "other"), "key")
    assert both.count() == wine.count()
    assert both.where(F.abs(F.col("prediction") - F.col("other")) > 1e-9).count() == 0


@pytest.mark.parametrize("seed, spread", [(1, 10**9), (2, 7), (3, 1)])
def test_quantiles_against_sorted_lists(spark, seed, spread):
    """One group has most rows, one has one row, one only NULLs; a small spread gives many ties."""
    rng = random.Random(seed)
    rows = [("hot", float(rng.randrange(spread))) for _ in range(3000)]
    rows += [("small", float(rng.randrange(spread))) for _ in range(10)] + [("one", 4.0), ("none", None), ("small", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in profile.exact_quantiles(df, ["g"], "v", profile.FIVE_NUMBERS).collect()}
    assert set(got) == {"hot", "small", "one"}
    for group, row in got.items():
        values = sorted(v for g, v in rows if g == group and v is not None)
        quarters = statistics.quantiles(values, n=4, method="inclusive") if len(values) > 1 else values * 3
        assert [row.min, row.q1, row.median, row.q3, row.max] == pytest.approx([values[0], *quarters, values[-1]])


@pytest.mark.parametrize("fit", [models.fit_linear, models.fit_forest])
def test_stored_read_and_called_models_agree(spark, wine, parts, fit):
    """Rows of which some lack a feature, more than one partition, a model over an older one."""
    path = scratch_dir(spark, "model")
    for trained in (models.fit_linear(parts[0], "high"), fit(parts[0], "high")):
        scoring.store_model(trained, path)
    scoring.register_scorer(spark, "score_high", path)
    called = scoring.scored_by_sql(wine.repartition(3), "key", "x", 3, "score_high").withColumnRenamed("prediction", "called")
    again = models.batch_score(scoring.read_model(spark, path), models.with_vector(wine, "x"), "key").withColumnRenamed("prediction", "again")
    rows = models.batch_score(trained, models.with_vector(wine, "x"), "key").join(again, "key").join(called, "key").collect()
    assert len(rows) == 800
    assert all(r.prediction == pytest.approx(r.again, abs=1e-9) == pytest.approx(r.called, abs=1e-9) for r in rows)
    sql = spark.sql("SELECT score_high(struct(1.0D a, CAST(NULL AS DOUBLE) b, 2.0D c)) AS p, score_high(struct(1.0D a, 0.5D b, 2.0D c)) AS q").first()
    assert sql.p is None and 0 < sql.q < 1


def test_only_known_models_have_a_scorer(spark, parts):
    from pyspark.ml.classification import GBTClassifier

    path = scratch_dir(spark, "model")
    scoring.store_model(GBTClassifier(labelCol="high", maxIter=1, maxDepth=1).fit(parts[0]), path)
    with pytest.raises(ValueError, match="GBT"):
        scoring.register_scorer(spark, "unknown", path)
