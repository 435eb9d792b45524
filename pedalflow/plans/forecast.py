"""A forecast of utilization one hour ahead: fit, score, judge and keep the model."""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEPTH, FEATURES, LABEL, SEED, TREES
from ..operators.reports import latest_row
from ..sources import ledger


@dataclass(frozen=True)
class Forecast:
    """A fitted model and the weight of each feature, greatest first."""

    model: PipelineModel
    importances: list[tuple[str, float]]


def build_pipeline(handle_invalid="error") -> Pipeline:
    """Assembler and forest. ``handle_invalid="skip"`` leaves out rows with a missing feature instead of failing."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid=handle_invalid)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    return Pipeline(stages=[assembler, forest])


def fit_forecast(train: DataFrame) -> Forecast:
    """Fit on rows of ``feature_rows``; give it a stored table, the forest reads its input several times."""
    model = build_pipeline().fit(train)
    weights = zip(FEATURES, model.stages[-1].featureImportances.toArray().tolist())
    return Forecast(model, sorted(weights, key=lambda pair: -pair[1]))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction``; rows need the features but not the label."""
    return model.transform(rows).drop("features")


def metrics(scored: DataFrame, *keys) -> DataFrame:
    """Root mean square error, share of variance explained and mean absolute error, in one pass; per ``keys`` if given."""
    label = F.col(LABEL)
    error = label - F.col("prediction")
    squares = F.sum(error * error)
    return scored.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(squares, F.var_pop(label) * F.count(label))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def rolling_test(rows: DataFrame, fold_numbers) -> DataFrame:
    """Metrics per fold of :func:`folds`, of a forest fitted for each fold and of the present utilization (``base_``).

    Give it a stored table. The folds are fitted one after the other, each fit being a job over the whole cluster, and
    judged together. A fold without rows to train on has no forest and is left out.
    """
    tested = []
    for k in fold_numbers:
        own = rows.where(F.col("fold") == k)
        train = own.where(F.col("part") == "train")
        if not train.isEmpty():
            tested.append(score(fit_forecast(train).model, own.where(F.col("part") == "test")))
    if not tested:
        tested = [rows.limit(0).withColumn("prediction", F.lit(0.0))]
    judged = reduce(DataFrame.unionByName, tested)
    base = metrics(judged.withColumn("prediction", F.col("avg_util")), "fold").drop("n")
    base = base.select("fold", *[F.col(c).alias(f"base_{c}") for c in base.columns if c != "fold"])
    return metrics(judged, "fold").join(base, "fold")


def forecast_latest(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The prediction for the latest row.

    Made from the weather that was later observed at the predicted time, as the training rows are; for a true forecast
    score rows whose weather columns hold a weather forecast.
    """
    return score(model, latest_row(rows))


def forecast_series(scored: DataFrame) -> DataFrame:
    """Actual and predicted values by time."""
    return scored.select("time_t1h", "city", LABEL, "prediction").orderBy("time_t1h", "city")


def save_model(model: PipelineModel, path: str) -> None:
    """Store the model, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_model(model: PipelineModel, folder: str) -> int:
    """Store the model as the next version in ``folder``; it counts from the moment it is complete."""
    spark = SparkSession.active()
    version = 1 + newest_model(spark, folder)[0]
    name = f"version-{version}-{uuid.uuid4().hex}"
    model.save(f"{folder}/{name}")
    if not ledger.publish(spark, folder, ledger.Entry("model", name, version)):
        raise RuntimeError(f"version {version} is there already; another model was faster")
    return version


def newest_model(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and path of the newest version; (0, None) before the first."""
    published = ledger.entries(spark, folder, "model")
    if not published:
        return 0, None
    newest = max(published, key=lambda e: e.generation)
    return newest.generation, f"{folder}/{newest.folder}"
