import math

import pytest
from pyspark.sql import functions as F

from helpers import bag
from pedalflow import operators as op
from pedalflow.constants import FEATURES
from pedalflow.plans import forecast as fc
from pedalflow.session import fresh_path, stored


@pytest.fixture(scope="module")
def features(spark):
    """Two weeks of half hours in two cities; utilization follows hour and temperature."""
    base = spark.range(0, 1344).select(
        F.timestamp_seconds(F.lit(1704067200) + F.expr("id div 2") * 1800).alias("window_start"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("city"),
        (F.pmod(F.hash("id"), F.lit(30)).cast("double")).alias("avg_temp"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(9)).cast("double")).alias("avg_wind"),
        F.lit(0.0).alias("avg_rain"),
        (F.pmod(F.hash("id", F.lit(2)), F.lit(100)).cast("double")).alias("avg_clouds"),
    )
    summary = base.withColumn("avg_util", F.hour("window_start") / 48 + F.col("avg_temp") / 60)
    return stored(op.split(op.feature_rows(summary)), "features")


@pytest.fixture(scope="module")
def fitted(features):
    return fc.fit_forecast(features.where("part = 'train'"))


def test_model_learns(features, fitted):
    scored = fc.score(fitted.model, features.where("part = 'test'"))
    got = fc.metrics(scored).first()
    assert got.n > 200 and got.rmse < 0.06 and got.r2 > 0.9 and got.mae <= got.rmse
    assert [name for name, _ in fitted.importances[:2]] in (["hour_t1h", "temp_t1h"], ["temp_t1h", "hour_t1h"])
    assert sum(weight for _, weight in fitted.importances) == pytest.approx(1)
    assert {name for name, _ in fitted.importances} == set(FEATURES)


def test_model_settings():
    forest = fc.build_pipeline().getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (120, 8, 42)


def test_metrics_formula(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    data = [(0.1, 0.2), (0.4, 0.35), (0.9, 0.7), (0.3, 0.3)]
    scored = spark.createDataFrame(data, "util_t1h double, prediction double")
    got = fc.metrics(scored).first()
    for name in ("rmse", "r2", "mae"):
        judge = RegressionEvaluator(labelCol="util_t1h", predictionCol="prediction", metricName=name)
        assert got[name] == pytest.approx(judge.evaluate(scored))
    assert got.rmse == pytest.approx(math.sqrt((0.01 + 0.0025 + 0.04) / 4))


def test_metrics_of_a_constant_label(spark):
    scored = spark.createDataFrame([(0.5, 0.4), (0.5, 0.6)], "util_t1h double, prediction double")
    assert fc.metrics(scored).first().r2 is None


def test_saved_model_predicts_the_same(spark, features, fitted):
    path = fresh_path(spark, "model")
    fc.save_model(fitted.model, path)
    fc.save_model(fitted.model, path)
    test = features.where("part = 'test'")
    assert bag(fc.score(fc.load_model(path), test)) == bag(fc.score(fitted.model, test))


def test_scores_without_label_and_latest(features, fitted):
    assert fc.score(fitted.model, features.drop("util_t1h")).count() == features.count()
    latest = fc.forecast_latest(fitted.model, features).collect()
    assert len(latest) == 1 and latest[0].city == "a"
    assert latest[0].time_t1h == features.agg(F.max("time_t1h")).first()[0]
    series = fc.forecast_series(fc.score(fitted.model, features)).collect()
    assert [r.time_t1h for r in series] == sorted(r.time_t1h for r in series)


def test_layout_moves_the_error_little(features, fitted):
    again = fc.fit_forecast(features.where("part = 'train'").repartition(5, "window_start"))
    test = features.where("part = 'test'")
    one, other = (fc.metrics(fc.score(m, test)).first().rmse for m in (fitted.model, again.model))
    assert abs(one - other) < 1e-2


def test_predictions_are_the_mean_of_the_trees_leaves(spark, features, fitted):
    """Walk the stored trees in plain Python: a wrong order of features or a model that predicts the mean shows here."""
    path = fresh_path(spark, "model")
    fc.save_model(fitted.model, path)
    trees = {}
    for r in spark.read.parquet(f"{path}/stages/1_*/data").collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    assert len(trees) == 120

    def leaf(tree, row):
        node = tree[0]
        while node["leftChild"] >= 0:
            split = node["split"]
            left = row[FEATURES[split["featureIndex"]]] <= split["leftCategoriesOrThreshold"][0]
            node = tree[node["leftChild" if left else "rightChild"]]
        return node["prediction"]

    scored = fc.score(fitted.model, features.where("part = 'test'")).collect()
    for row in scored:
        assert row["prediction"] == pytest.approx(sum(leaf(t, row) for t in trees.values()) / len(trees), abs=1e-12)
    assert len({round(r["prediction"], 6) for r in scored}) > 50


def test_a_rolling_test_beats_the_baseline_where_there_is_something_to_learn(features):
    cutoffs = ["2024-01-05 00:00:00", "2024-01-09 00:00:00"]
    rows = stored(op.folds(features.withColumn("avg_util", F.col("avg_util")).drop("part"), cutoffs), "folds")
    got = {r["fold"]: r for r in fc.rolling_test(rows, range(2)).collect()}
    assert set(got) == {0, 1} and all(r["rmse"] < r["base_rmse"] and r["r2"] > 0.8 for r in got.values())
    assert got[0]["n"] == rows.where("fold = 0 and part = 'test'").count()
