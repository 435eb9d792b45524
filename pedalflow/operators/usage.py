"""Utilization and weather per event-time window, and the usage summary.

Every function takes batch tables and streams alike. The aggregates are algebraic, so Spark reduces each input task to
one row per window and city before the shuffle: a city that holds a third of all rows does not become a large task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GRAIN_30M
from ..functions.clock import event_time
from ..functions.measures import utilization
from ..schemas import UTIL_MEASURES, WEATHER_MEASURES


def with_event_time(rows: DataFrame, epoch_col="event_timestamp") -> DataFrame:
    """Add ``event_time``; the default takes publish time, ``last_reported`` or ``timestamp`` are alternatives."""
    return rows.withColumn("event_time", event_time(epoch_col))


def with_utilization(status: DataFrame) -> DataFrame:
    return status.withColumn("utilization", utilization())


def drop_resent(rows: DataFrame, identity, delay=None) -> DataFrame:
    """One row of those that agree in the columns ``identity``, for messages that a producer sent again.

    On a stream, ``delay`` is its watermark and how far apart in event time copies can be told: they agree in their time,
    so each is remembered until the watermark passes it, and state does not grow. A copy that comes later than that is
    late, and a window takes it as little as any late row.
    """
    if delay is None:
        return rows.dropDuplicates(list(identity))
    return rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(identity))


def _per_window(rows, grain, delay, keys, measures, once=None):
    # Only the columns in use reach the watermark and the aggregation.
    slim = rows.select(*dict.fromkeys(["event_time", *keys, *measures, *(once or ())]))
    if once:
        slim = drop_resent(slim, once, delay)
    elif delay is not None:
        slim = slim.withWatermark("event_time", delay)
    return slim.groupBy(F.window("event_time", grain), *keys)


def utilization_by_window(status: DataFrame, grain=GRAIN_30M, delay=None, keys=("city",), once=None) -> DataFrame:
    """Average, maximum, minimum and sample deviation of utilization per tumbling window and key.

    ``delay`` is the watermark of a stream: how long a window waits for late rows before it is final. ``once`` names the
    columns by which rows that were sent again are told (see :func:`drop_resent`); ``event_time`` is one of them.
    """
    rows = status if "utilization" in status.columns else with_utilization(status)
    return _per_window(rows, grain, delay, keys, ["utilization"], once).agg(
        F.avg("utilization").alias("avg_util"),
        F.max("utilization").alias("max_util"),
        F.min("utilization").alias("min_util"),
        F.stddev_samp("utilization").alias("std_util"),
    )


def weather_by_window(weather: DataFrame, grain=GRAIN_30M, delay=None, keys=("city",), once=None) -> DataFrame:
    """Average temperature, wind, cloud cover and rain per tumbling window and key; ``once`` as above."""
    averages = {
        "temperature": "avg_temp",
        "wind_speed": "avg_wind",
        "cloudiness": "avg_clouds",
        "precipitation": "avg_rain",
    }
    return _per_window(weather, grain, delay, keys, list(averages), once).agg(
        *[F.avg(measure).alias(name) for measure, name in averages.items()]
    )


def flat_window(windowed: DataFrame) -> DataFrame:
    """The window struct as the two columns ``window_start`` and ``window_end``."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def usage_summary(util: DataFrame, weather: DataFrame, keys=("city",)) -> DataFrame:
    """Windows that have both a utilization and a weather aggregate, side by side.

    The join is on the window column itself. That is the column the watermark travels on, so a stream drops its join
    state when a window is final; joined on the start and end fields the state would grow for ever.
    """
    joined = util.join(weather, ["window", *keys], "inner")
    return flat_window(joined).select(
        "window_start",
        "window_end",
        *keys,
        *UTIL_MEASURES,
        *WEATHER_MEASURES,
    )


def ordered(rows: DataFrame, keys=("city",)) -> DataFrame:
    """Rows by window start; further keys break ties, so that many rows of one window can span several tasks."""
    return rows.orderBy("window_start", *keys)
