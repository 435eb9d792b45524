"""Every operator as a query over the given tables.

Each query takes a session and the folder of the tables and reads those tables whole.
"""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..constants import DEFAULT_CITY, DELAY_1M, DELAY_30M, GRAIN_1M, GRAIN_30M, LABEL, TRAILING
from ..operators.rollup import WEATHER as WEATHER_ROLLUP
from ..schemas import STATION_INFO, STATION_STATUS, WEATHER
from ..session import few_state_partitions, fresh_path, stored
from ..sources import tables as src
from ..sources.channels import file_channel, read_messages, stream_messages, write_messages
from ..sources.summary import compact_summary, read_summary, stream_summary, write_summary
from ..streaming.intake import read_intake, start_intake_job
from ..streaming.jobs import finish
from ..streaming.scoring import read_scores, start_score_job
from ..streaming.sinks import start_files, start_summary_sink
from ..streaming.state import state_keys
from . import forecast as fc
from .analytics import (
    decoded_status,
    decoded_weather,
    station_snapshot,
    usage_from_messages,
    utilization_from_messages,
    weather_from_messages,
)

# One city for all events: every half hour then has enough rows for leads and forecasts.
METRO = "metro"
# Rows before this moment train, later ones test, in the split by time.
CUTOFF = "2024-01-25 00:00:00"
# The folds of the rolling-origin test begin at these moments.
CUTOFFS = ["2024-01-10 00:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00", "2024-01-25 00:00:00"]
# Stretches of time that a feed lands in, one after the other, in the streams over message files.
SLICES = 4
# A stretch has so many messages a file, more or less, so that tasks share the writing and reading of a large one.
FILE_ROWS = 250_000
# Batches of the summary that is compacted as it is written.
COMPACTED = 5
# How far apart in time the rows of a summary may reach the stream that joins it with itself.
LEAD_DELAY = "1 hour"


def tidy(rows: DataFrame, rounded=True) -> DataFrame:
    """Zone-less timestamps, and doubles to six digits: sums of doubles depend on the order of their terms."""
    columns = []
    for f in rows.schema.fields:
        column = F.col(f.name)
        if f.dataType.typeName() == "timestamp":
            column = column.cast("timestamp_ntz").alias(f.name)
        elif rounded and f.dataType.typeName() == "double":
            column = F.round(column, 6).alias(f.name)
        columns.append(column)
    return rows.select(*columns)


# Messages of the derived feeds. A message file or topic would hold the same columns.


def _status_messages(spark, folder, city=None, stream=False, raw=False):
    rows = (src.status_raw if raw else src.status)(spark, folder, city, stream)
    return op.encode_messages(src.status_records(rows), "station_id")


def _weather_messages(spark, folder, city=None, stream=False):
    # A reading without a city has no key and is not published.
    return op.encode_messages(src.weather_records(src.weather(spark, folder, city, stream)), "city")


def _info_messages(spark, folder):
    stations = src.station_raw(spark, folder)
    envelope = [F.timestamp_seconds(F.lit(0)).alias("timestamp"), F.col("msg_offset").cast("long").alias("offset")]
    value = F.to_json(F.struct(*STATION_INFO.names), {"ignoreNullFields": "false"}).cast("binary")
    return stations.select(F.col("station_id").cast("binary").alias("key"), value.alias("value"), *envelope)


# Decoding, cleaning, stamping.


def message_encode(spark, folder):
    messages = _status_messages(spark, folder, raw=True)
    return messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def decode_status(spark, folder):
    return op.decode_messages(_status_messages(spark, folder, raw=True), STATION_STATUS)


def decode_info(spark, folder):
    return op.decode_messages(_info_messages(spark, folder), STATION_INFO)


def decode_weather(spark, folder):
    return op.decode_messages(_weather_messages(spark, folder), WEATHER)


def stations_explode(spark, folder):
    return op.explode_stations(src.station_documents(spark, folder), STATION_INFO)


def static_snapshot(spark, folder):
    """The station list as a topic holds it: all records ever sent, of which the latest valid one per station counts."""
    channel = file_channel(fresh_path(spark, "station-messages"))
    write_messages(_info_messages(spark, folder), channel)
    return station_snapshot(read_messages(spark, channel))


def station_info_valid(spark, folder):
    return op.clean_station_info(src.station_raw(spark, folder))


def station_status_clean(spark, folder):
    return tidy(op.clean_station_status(src.status_raw(spark, folder)))


def weather_flatten(spark, folder):
    documents = src.weather_documents(src.weather(spark, folder))
    return op.flatten_weather(documents, "event_time", keep=["event_id"])


def weather_missing(spark, folder):
    """Every tenth document is lost, as after a failed download."""
    documents = src.weather_documents(src.weather(spark, folder))
    lossy = documents.withColumn("value", F.when(F.col("event_id") % 10 != 3, F.col("value")))
    return op.flatten_weather(lossy, "event_time", keep=["event_id"])


def stamped_status(spark, folder):
    rows = src.status(spark, folder, DEFAULT_CITY).drop("city")
    return op.stamp(rows, ingest_col="event_time").drop("event_time")


def event_time(spark, folder):
    rows = op.with_event_time(src.status_records(src.status(spark, folder, METRO)))
    return tidy(rows.select("event_id", "event_timestamp", "event_time"))


def utilization(spark, folder):
    rows = op.with_utilization(src.status(spark, folder))
    return tidy(rows.select("event_id", "station_id", "city", "utilization"))


def audit_counts(spark, folder):
    stations = op.audit_counts(src.station_raw(spark, folder), op.station_info_rules())
    states = op.audit_counts(src.status_raw(spark, folder, METRO), op.station_status_rules())
    return stations.select(F.lit("station_info").alias("feed"), "*").unionByName(
        states.select(F.lit("station_status").alias("feed"), "*")
    )


def _stations(spark, folder):
    """The station snapshot, written down: joins then see its size and have nothing to work out again."""
    valid = op.clean_station_info(src.station_raw(spark, folder))
    return stored(op.latest_by_key(valid, "station_id", "msg_offset").drop("msg_offset"), "stations")


def status_enriched(spark, folder):
    return tidy(op.enrich_status(src.status(spark, folder), _stations(spark, folder)))


# Windowed usage.


def _util(spark, folder, grain, city=None):
    return op.utilization_by_window(src.status(spark, folder, city), grain)


def _air(spark, folder, grain, city=None):
    return op.weather_by_window(src.weather(spark, folder, city), grain)


def _summary(spark, folder, grain=GRAIN_30M, city=None):
    return op.usage_summary(_util(spark, folder, grain, city), _air(spark, folder, grain, city))


def utilization_by_window_30m(spark, folder):
    return tidy(op.flat_window(_util(spark, folder, GRAIN_30M)))


def utilization_by_window_1m(spark, folder):
    return tidy(op.flat_window(_util(spark, folder, GRAIN_1M)))


def weather_by_window_30m(spark, folder):
    return tidy(op.flat_window(_air(spark, folder, GRAIN_30M)))


def weather_by_window_1m(spark, folder):
    return tidy(op.flat_window(_air(spark, folder, GRAIN_1M)))


def usage_summary_30m(spark, folder):
    return tidy(_summary(spark, folder))


def usage_summary_1m(spark, folder):
    return tidy(_summary(spark, folder, GRAIN_1M))


def usage_from_json_30m(spark, folder):
    """The same summary by way of JSON messages, the path of the real feeds."""
    return tidy(usage_from_messages(_status_messages(spark, folder), _weather_messages(spark, folder)))


def usage_ordered(spark, folder):
    return op.ordered(tidy(_summary(spark, folder)))


def _at_rest(spark, folder, city=None, fmt="parquet"):
    """The summary written to its dataset and read back."""
    path = fresh_path(spark, "usage")
    write_summary(_summary(spark, folder, city=city), path, fmt, GRAIN_30M)
    return read_summary(spark, path, fmt, GRAIN_30M)


def summary_csv_roundtrip(spark, folder):
    return tidy(_at_rest(spark, folder, fmt="csv"))


def usage_compacted(spark, folder):
    """The summary written as batches of a few days, which are rewritten as one generation after every second batch."""
    rows, path = stored(_summary(spark, folder), "usage"), fresh_path(spark, "usage")
    batch = F.pmod(F.dayofmonth("window_start"), F.lit(COMPACTED))
    for k in range(COMPACTED):
        write_summary(rows.where(batch == k), path, grain=GRAIN_30M, batch_id=k)
        if k % 2:
            compact_summary(spark, path, GRAIN_30M)
    return tidy(read_summary(spark, path, grain=GRAIN_30M))


def _summary_of_moments(util, air):
    return op.usage_summary(op.utilization_of(util), op.weather_of(air))


def usage_rollup(spark, folder):
    """Summaries per minute and per half hour from the moments per minute, for which each feed is read once."""
    util = stored(op.moments_by_window(src.status(spark, folder)), "moments")
    air = stored(op.moments_by_window(src.weather(spark, folder), WEATHER_ROLLUP), "moments")
    longer = _summary_of_moments(op.rollup(util), op.rollup(air, WEATHER_ROLLUP))
    both = _summary_of_moments(util, air).withColumn("grain", F.lit(GRAIN_1M))
    return tidy(both.unionByName(longer.withColumn("grain", F.lit(GRAIN_30M))))


def status_enriched_asof(spark, folder):
    """Status rows with the station record that held at their time."""
    return tidy(op.join_as_of(src.status(spark, folder), src.station_history(spark, folder), "station_id"))


# Leads, features, reports: all on the summary at rest.


def lead_rows(spark, folder):
    return tidy(op.lead_by_rows(_at_rest(spark, folder, METRO)))


def lead_rows_by_city(spark, folder):
    return tidy(op.lead_by_rows(_at_rest(spark, folder)))


def lead_exact(spark, folder):
    return tidy(op.lead_by_time(_at_rest(spark, folder, METRO)))


def lead_exact_by_city(spark, folder):
    return tidy(op.lead_by_time(_at_rest(spark, folder)))


def _trailing(summary):
    # Not rounded: the numbers come of whole sums and are the same in any engine.
    rows = op.trailing_features(summary.select("window_start", "city", "avg_util"), TRAILING)
    return tidy(rows.drop("avg_util"), rounded=False)


def trailing_features(spark, folder):
    return _trailing(_at_rest(spark, folder, METRO))


def trailing_features_by_city(spark, folder):
    return _trailing(_at_rest(spark, folder))


def calendar_features(spark, folder):
    rows = src.status(spark, folder, METRO).select("event_id", "event_time")
    return op.calendar_features(rows, "event_time").drop("event_time")


def feature_rows(spark, folder):
    return tidy(op.feature_rows(_at_rest(spark, folder, METRO)))


def feature_rows_by_rows(spark, folder):
    return tidy(op.feature_rows(_at_rest(spark, folder, METRO), rows=2))


def latest_row(spark, folder):
    return tidy(op.latest_row(op.feature_rows(_at_rest(spark, folder, METRO))))


def latest_row_per_city(spark, folder):
    return tidy(op.latest_by_key(op.feature_rows(_at_rest(spark, folder)), "city", "time_t1h"))


def util_histogram(spark, folder):
    """Of rounded values: a value on the edge of two bins must not move with the order of a sum."""
    return tidy(op.histogram(tidy(_at_rest(spark, folder, METRO)), "avg_util"))


def util_quantile_bins(spark, folder):
    """Twenty bins of about equally many windows, per city."""
    return tidy(op.quantile_bins(_at_rest(spark, folder), "avg_util", keys=["city"]))


# Streams. Each runs over all that is there and ends; the rows are read back from its sink.


def _run_rows(spark, rows):
    """Run a stream into a fresh table and read the table."""
    path = fresh_path(spark, "stream")
    with few_state_partitions(spark):
        query = start_files(rows, path, fresh_path(spark, "progress"))
    finish(query)
    return tidy(spark.read.schema(rows.schema).parquet(path))


def _run_windows(spark, windows):
    return _run_rows(spark, op.flat_window(windows))


def _summary_path(spark, summary, grain):
    """Run a summary stream into a fresh dataset; its path."""
    path = fresh_path(spark, "usage-stream")
    with few_state_partitions(spark):
        query = start_summary_sink(summary, path, fresh_path(spark, "progress"), grain)
    finish(query)
    return path


def _run_summary(spark, folder, grain, delay):
    summary = usage_from_messages(
        _status_messages(spark, folder, stream=True), _weather_messages(spark, folder, stream=True), grain, delay
    )
    return tidy(read_summary(spark, _summary_path(spark, summary, grain), grain=grain))


def stream_usage_summary(spark, folder):
    return _run_summary(spark, folder, GRAIN_30M, DELAY_30M)


def stream_usage_summary_1m(spark, folder):
    return _run_summary(spark, folder, GRAIN_1M, DELAY_1M)


def _landed_in_order(spark, rows, encode, label, late, resent=False):
    """Publish rows in SLICES equal stretches of time, one after the other; ``late`` sends the first again.

    The channel that comes back hands out a stretch in every micro-batch: each is in as many files, some of them empty
    where it has few rows. With ``resent`` each message is in its stretch twice.
    """
    at, copies = F.unix_seconds("event_time"), 2 if resent else 1
    first, last, count = rows.agg(F.min(at), F.max(at), F.count("*")).first()
    files = max(1, -(-count * copies // (SLICES * FILE_ROWS)))
    if files > 1:  # so many for each core, or some cores would wait for the last files
        cores = spark.sparkContext.defaultParallelism
        files = -(-files // cores) * cores
    channel = file_channel(fresh_path(spark, label), maxFilesPerTrigger=str(files))
    slice_of = F.floor((at - (first or 0)) * SLICES / ((last or 0) - (first or 0) + 1))
    landed = 0
    for k in [*range(SLICES), *([0] if late else [])]:
        sent = rows.where(slice_of == k)
        # By a running number: a moment with many rows is no larger file, and rows need no sort, as dealt in turn they do.
        sent = sent.coalesce(1) if files == 1 else sent.withColumn("_n", F.monotonically_increasing_id()).repartition(files, "_n").drop("_n")
        # A message is encoded and sent over the network once, however often it is written.
        messages = encode(sent).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
        write_messages(messages, channel)
        landed += files
        if files > 1:
            for _ in range(landed - len(read_messages(spark, channel).inputFiles())):
                write_messages(encode(rows.limit(0)).coalesce(1), channel)  # a file without rows
    return channel


def _usage_by_files(spark, folder, late=False, resent=False):
    """The path of a summary streamed from message files, a stretch of time of each feed in every micro-batch."""
    feeds = {
        "status": (src.status(spark, folder), lambda r: op.encode_messages(src.status_records(r), "station_id")),
        "weather": (src.weather(spark, folder), lambda r: op.encode_messages(src.weather_records(r), "city")),
    }

    def landed(name):
        rows, encode = feeds[name]
        return _landed_in_order(spark, stored(rows, name), encode, f"{name}-messages", late, resent)

    # Side by side: cores that the last tasks of one feed leave idle work for the other.
    with ThreadPoolExecutor(len(feeds)) as pool:
        status, weather = (stream_messages(spark, channel) for channel in pool.map(landed, feeds))
    return _summary_path(spark, usage_from_messages(status, weather, GRAIN_30M, DELAY_30M, resent=resent), GRAIN_30M)


def stream_usage_from_files(spark, folder):
    """Several micro-batches with rows: state is carried on and windows close in between."""
    return tidy(read_summary(spark, _usage_by_files(spark, folder), grain=GRAIN_30M))


def stream_usage_late_files(spark, folder):
    """The same, and the first file comes a second time when its windows are closed: its rows are late."""
    return tidy(read_summary(spark, _usage_by_files(spark, folder, late=True), grain=GRAIN_30M))


def stream_dedup_usage(spark, folder):
    """Every message is sent twice in time and counts once."""
    return tidy(read_summary(spark, _usage_by_files(spark, folder, resent=True), grain=GRAIN_30M))


def stream_lead_exact(spark, folder):
    """One job writes the summary in batches, and another reads it as a stream and joins it with itself an hour later."""
    summary = stream_summary(spark, _usage_by_files(spark, folder), GRAIN_30M)
    return _run_rows(spark, op.lead_on_stream(summary, delay=LEAD_DELAY))


def stream_usage_rollup(spark, folder):
    """Half hours from the moments per minute, in one query: windows of windows, and the join of both feeds."""
    status = decoded_status(_status_messages(spark, folder, stream=True))
    weather = decoded_weather(_weather_messages(spark, folder, stream=True))
    util = op.rollup(op.moments_by_window(status, delay=DELAY_30M))
    air = op.rollup(op.moments_by_window(weather, WEATHER_ROLLUP, delay=DELAY_30M), WEATHER_ROLLUP)
    return _run_rows(spark, _summary_of_moments(util, air))


def stream_intake_counts(spark, folder):
    """Messages per outcome: every 50th is broken, and the first quarter comes again when its windows are final.

    Accepted, rejected and late messages add up to those sent.
    """

    def encode(rows):
        messages = op.encode_messages(src.status_records(rows), "station_id")
        broken = F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long") % 50 == 7
        return messages.withColumn("value", F.when(broken, F.lit('{"station_id": ').cast("binary")).otherwise(F.col("value")))

    channel = _landed_in_order(spark, stored(src.status(spark, folder), "status"), encode, "status-messages", late=True)
    path = fresh_path(spark, "intake")
    finish(start_intake_job(spark, channel, STATION_STATUS, "station_id", path, fresh_path(spark, "progress")))
    return read_intake(spark, path, STATION_STATUS).groupBy("outcome").agg(F.count("*").alias("n"))


def stream_scores(spark, folder):
    """The latest window scored by the model of the time: a second version is published between two runs of the job."""
    rows = _features(spark, folder)
    summary, path, progress = fresh_path(spark, "usage"), fresh_path(spark, "scores"), fresh_path(spark, "progress")
    models, usage = fresh_path(spark, "models"), stored(_at_rest(spark, folder, METRO), "usage")
    early = F.col("window_start") < F.lit(CUTOFF).cast("timestamp")
    for batch_id, part in enumerate((early, ~early)):
        write_summary(usage.where(part), summary, grain=GRAIN_30M, batch_id=batch_id)
        known = _part(rows, "train").where(F.col("time_t1h") < F.lit(CUTOFF).cast("timestamp")) if batch_id == 0 else _part(rows, "train")
        fc.publish_model(fc.fit_forecast(known).model, models)
        finish(start_score_job(spark, summary, models, path, progress))
    return tidy(read_scores(spark, path).select("window_start", "city", "time_t1h", "model_version", "prediction"))


def stream_open_windows(spark, folder):
    """The windows that a stream still holds after its last batch, read from its checkpoint, with the rows of the state."""
    windows = utilization_from_messages(_status_messages(spark, folder, stream=True), GRAIN_30M, DELAY_30M)
    checkpoint = fresh_path(spark, "progress")
    with few_state_partitions(spark):
        query = start_files(op.flat_window(windows), fresh_path(spark, "stream"), checkpoint)
    finish(query)
    return tidy(state_keys(spark, checkpoint).select("window.start", "window.end", "city").toDF("window_start", "window_end", "city"))


def stream_utilization(spark, folder):
    windows = utilization_from_messages(_status_messages(spark, folder, stream=True), GRAIN_30M, DELAY_30M)
    return _run_windows(spark, windows)


def stream_weather_windows(spark, folder):
    windows = weather_from_messages(_weather_messages(spark, folder, stream=True), GRAIN_30M, DELAY_30M)
    return _run_windows(spark, windows)


def stream_status_enriched(spark, folder):
    rows = op.enrich_status(src.status(spark, folder, stream=True), _stations(spark, folder))
    return _run_rows(spark, rows)


def stream_weather_rows(spark, folder):
    return _run_rows(spark, decoded_weather(_weather_messages(spark, folder, stream=True)))


# Forecast.


def _features(spark, folder):
    return stored(op.split(op.feature_rows(_at_rest(spark, folder, METRO))), "features")


def _part(rows, name):
    return rows.where(F.col("part") == name)


def _fitted(spark, folder):
    rows = _features(spark, folder)
    return fc.fit_forecast(_part(rows, "train")), rows


def _scored_test(spark, folder):
    fitted, rows = _fitted(spark, folder)
    return fc.score(fitted.model, _part(rows, "test"))


def split_counts(spark, folder):
    return op.split_counts(op.split(op.feature_rows(_at_rest(spark, folder, METRO))))


def split_counts_by_time(spark, folder):
    return op.split_counts(op.split(op.feature_rows(_at_rest(spark, folder, METRO)), CUTOFF))


def _persistence(spark, folder):
    """Test rows with the present utilization as the prediction, a baseline for the forest."""
    return _part(_features(spark, folder), "test").withColumn("prediction", F.col("avg_util"))


def persistence_metrics(spark, folder):
    return tidy(fc.metrics(_persistence(spark, folder)))


def _folds(spark, folder):
    rows = stored(op.feature_rows(_at_rest(spark, folder, METRO)), "features")
    return op.folds(rows, CUTOFFS)


def fold_sizes(spark, folder):
    """Rows that train and test in each fold of a rolling-origin test."""
    return _folds(spark, folder).groupBy("fold", "part").agg(F.count("*").alias("n"))


def rolling_persistence(spark, folder):
    """Metrics per fold of the present utilization as the prediction."""
    judged = _part(_folds(spark, folder), "test").withColumn("prediction", F.col("avg_util"))
    return tidy(fc.metrics(judged, "fold"))


def rolling_forecast(spark, folder):
    """Metrics per fold of a forest fitted on what was known at the fold's cutoff, beside the baseline's."""
    return tidy(fc.rolling_test(stored(_folds(spark, folder), "folds"), range(len(CUTOFFS))))


def persistence_series(spark, folder):
    return tidy(fc.forecast_series(_persistence(spark, folder)))


def forecast_predictions(spark, folder):
    """Test rows with the forest's prediction beside the label."""
    return tidy(_scored_test(spark, folder).select("window_start", "city", "time_t1h", LABEL, "prediction"))


def forecast_metrics(spark, folder):
    return tidy(fc.metrics(_scored_test(spark, folder)))


def forecast_series(spark, folder):
    return tidy(fc.forecast_series(_scored_test(spark, folder)))


def test_label_histogram(spark, folder):
    """Distribution of the label over the test part."""
    return tidy(op.histogram(tidy(_part(_features(spark, folder), "test")), LABEL))


def test_label_histogram_by_time(spark, folder):
    rows = stored(op.split(op.feature_rows(tidy(_at_rest(spark, folder, METRO))), CUTOFF), "features")
    return tidy(op.histogram(_part(rows, "test"), LABEL))


def forecast_latest(spark, folder):
    fitted, rows = _fitted(spark, folder)
    return tidy(fc.forecast_latest(fitted.model, rows).select("window_start", "city", "time_t1h", LABEL, "prediction"))


def model_roundtrip(spark, folder):
    """Predictions of the fitted model, and of the same model stored and loaded."""
    fitted, rows = _fitted(spark, folder)
    path = fresh_path(spark, "model")
    fc.save_model(fitted.model, path)
    before = fc.score(fitted.model, _part(rows, "test")).withColumnRenamed("prediction", "prediction_fitted")
    after = fc.score(fc.load_model(path), before).withColumnRenamed("prediction", "prediction_loaded")
    return tidy(after.select("city", "window_start", "prediction_fitted", "prediction_loaded"))


_ALL = [
    message_encode,
    decode_status,
    decode_info,
    decode_weather,
    stations_explode,
    static_snapshot,
    station_info_valid,
    station_status_clean,
    weather_flatten,
    weather_missing,
    stamped_status,
    event_time,
    utilization,
    audit_counts,
    status_enriched,
    status_enriched_asof,
    utilization_by_window_30m,
    utilization_by_window_1m,
    weather_by_window_30m,
    weather_by_window_1m,
    usage_summary_30m,
    usage_summary_1m,
    usage_from_json_30m,
    usage_ordered,
    summary_csv_roundtrip,
    usage_compacted,
    usage_rollup,
    lead_rows,
    lead_rows_by_city,
    lead_exact,
    lead_exact_by_city,
    trailing_features,
    trailing_features_by_city,
    calendar_features,
    feature_rows,
    feature_rows_by_rows,
    latest_row,
    latest_row_per_city,
    util_histogram,
    util_quantile_bins,
    stream_usage_summary,
    stream_usage_summary_1m,
    stream_usage_from_files,
    stream_usage_late_files,
    stream_dedup_usage,
    stream_lead_exact,
    stream_usage_rollup,
    stream_utilization,
    stream_weather_windows,
    stream_status_enriched,
    stream_weather_rows,
    stream_open_windows,
    stream_intake_counts,
    stream_scores,
    split_counts,
    split_counts_by_time,
    fold_sizes,
    forecast_predictions,
    forecast_metrics,
    forecast_series,
    persistence_metrics,
    persistence_series,
    rolling_persistence,
    rolling_forecast,
    test_label_histogram,
    test_label_histogram_by_time,
    forecast_latest,
    model_roundtrip,
]


def _in_utc(query):
    """The same query with the session zone the tables are meant for.

    It stays set: the rows are worked out when the caller asks for them, in the zone the session then has.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES = {query.__name__: _in_utc(query) for query in _ALL}
