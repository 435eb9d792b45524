"""A forecast from a running stream: the latest final window of each city, scored an hour ahead by the newest model."""

import warnings

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import FEATURES, GRAIN_30M, TIME_AHEAD
from ..operators.features import calendar_features
from ..operators.leads import LEADS
from ..plans.forecast import load_model, newest_model, score
from ..sources.channels import trigger_of
from ..sources.summary import stream_summary
from .sinks import query_id


def live_features(summary: DataFrame, ahead=TIME_AHEAD, zone=None) -> DataFrame:
    """The features of the moment ``ahead`` of each row, with the row's own weather as the weather to come.

    Training rows hold the weather that was observed at that moment; a live row has none yet, so put a weather forecast
    into the weather columns of ``summary`` where there is one. Rows lacking a feature are dropped.
    """
    weather = [F.col(source).alias(name) for source, name in LEADS.items() if source not in ("window_start", "avg_util")]
    moment = (F.col("window_start") + F.expr(f"INTERVAL '{ahead}'")).alias("time_t1h")
    rows = calendar_features(summary.select("window_start", "city", "avg_util", *weather, moment), zone=zone)
    return rows.na.drop(subset=[c for c in FEATURES if c in rows.columns])


def latest_windows(summary: DataFrame, keys=("city",)) -> DataFrame:
    """The latest row of each key of a summary stream; state is one row for each key, however long it runs."""
    rest = [c for c in summary.columns if c not in keys]
    return summary.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("latest")).select(*keys, "latest.*")


class NewestModel:
    """The newest published model. A version that cannot be read leaves the one before in place."""

    def __init__(self, folder: str):
        self.folder = folder
        self.version, self.model = 0, None

    def get(self, spark: SparkSession) -> tuple[int, PipelineModel]:
        version, path = newest_model(spark, self.folder)
        if version != self.version:
            try:
                self.version, self.model = version, load_model(path)
            except Exception as error:
                if self.model is None:
                    raise
                warnings.warn(f"model {version} cannot be read, going on with {self.version}: {error}", stacklevel=2)
        if self.model is None:
            raise ValueError(f"no model is published in {self.folder}")
        return self.version, self.model


def start_score_job(
    spark: SparkSession, summary: str, models: str, path: str, checkpoint: str, grain=GRAIN_30M, fmt="parquet", every=None
) -> StreamingQuery:
    """Score the latest window of each city whenever it has a new one, with ``model_version`` beside the prediction.

    The model is looked up in each batch, so one that is published meanwhile serves from the next batch on. Each batch
    writes a folder of its own and replaces it if it is run again.
    """
    newest = NewestModel(models)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        version, model = newest.get(session)
        scored = score(model, live_features(batch)).withColumn("model_version", F.lit(version).cast("long"))
        scored.write.mode("overwrite").parquet(f"{path}/run={query_id(session, checkpoint)}/batch_id={batch_id}")

    writer = latest_windows(stream_summary(spark, summary, grain, fmt)).writeStream.foreachBatch(write).outputMode("update")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger_of(every)).start()


#: Columns of a score.
SCORES = "window_start timestamp, city string, avg_util double, temp_t1h double, wind_t1h double, rain_t1h double, clouds_t1h double, time_t1h timestamp, hour_t1h int, dow_t1h int, is_weekend_t1h double, prediction double, model_version long"


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORES).parquet(path).select(*[c.split()[0] for c in SCORES.split(", ")])
