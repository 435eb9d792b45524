"""The long-running jobs, put together from channels, operators and sinks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..constants import DELAY_30M, GRAIN_30M, STATUS_CYCLE, WEATHER_CYCLE
from ..operators.enrich import enrich_status
from ..operators.usage import flat_window
from ..plans.analytics import (
    decoded_status,
    decoded_weather,
    station_snapshot,
    usage_from_messages,
    utilization_from_messages,
    weather_from_messages,
)
from ..plans.publish import status_messages, weather_messages
from ..session import stored
from ..sources.channels import Channel, read_messages, start_messages, stream_messages
from .sinks import show_sorted, start_batches, start_console, start_files, start_summary_sink


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that end by themselves; an error in one stops the others and is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def watch(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Run until the first of the queries ends, then stop the rest."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def start_usage_job(
    spark: SparkSession,
    status: Channel,
    weather: Channel,
    path: str,
    checkpoint: str,
    grain=GRAIN_30M,
    delay=DELAY_30M,
    fmt="parquet",
    every=None,
    show=False,
) -> StreamingQuery:
    """Summarize both feeds per window and append final windows to the dataset at ``path``.

    Accepted and rejected rows are counted in the query's progress, as ``status_rows`` and ``weather_rows``.
    """
    summary = usage_from_messages(stream_messages(spark, status), stream_messages(spark, weather), grain, delay, counts=True)
    also = [show_sorted("usage summary")] if show else []
    return start_summary_sink(summary, path, f"{checkpoint}/summary", grain, fmt, every, also)


def start_window_monitors(
    spark: SparkSession,
    status: Channel,
    weather: Channel,
    checkpoint: str,
    grain=GRAIN_30M,
    delay=DELAY_30M,
    every=None,
) -> list[StreamingQuery]:
    """Print the two windowed aggregates, each as soon as its own feed has passed the window."""
    util = utilization_from_messages(stream_messages(spark, status), grain, delay)
    air = weather_from_messages(stream_messages(spark, weather), grain, delay)
    return [
        start_batches(flat_window(rows), [show_sorted(label)], f"{checkpoint}/{label}", every)
        for label, rows in {"utilization": util, "weather": air}.items()
    ]


def start_enrich_job(
    spark: SparkSession, info: Channel, status: Channel, path: str, checkpoint: str, every=None
) -> StreamingQuery:
    """Store status rows with the columns of their station.

    The station list is read, reduced to the latest record per station and written down once, when the job starts.
    """
    stations = stored(station_snapshot(read_messages(spark, info)), "stations")
    rows = enrich_status(decoded_status(stream_messages(spark, status), observed="status_rows"), stations)
    return start_files(rows, path, f"{checkpoint}/enriched", every)


def start_weather_console(spark: SparkSession, weather: Channel, every=None) -> StreamingQuery:
    """Print weather messages as they come."""
    return start_console(decoded_weather(stream_messages(spark, weather)), every)


def start_status_publisher(
    documents: DataFrame, channel: Channel, checkpoint: str, city: str, every=STATUS_CYCLE
) -> StreamingQuery:
    """Publish landed station status documents as messages, once per cycle."""
    return start_messages(status_messages(documents, city), channel, checkpoint, every)


def start_weather_publisher(
    documents: DataFrame, channel: Channel, checkpoint: str, city: str, every=WEATHER_CYCLE
) -> StreamingQuery:
    """Publish landed weather documents as messages, once per cycle."""
    return start_messages(weather_messages(documents, city), channel, checkpoint, every)
