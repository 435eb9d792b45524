"""From messages to the usage summary; every function takes batches and streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import GRAIN_30M
from ..functions.clock import plausible
from ..operators.audit import message_rules, observe_counts
from ..operators.clean import clean_station_info
from ..operators.decode import CORRUPT, decode_messages
from ..operators.enrich import latest_by_key
from ..operators.usage import usage_summary, utilization_by_window, weather_by_window, with_event_time
from ..schemas import STATION_INFO, STATION_STATUS, WEATHER


# What the usage summary needs of a message, besides its time.
_STATUS_USED = ["num_bikes_available", "num_docks_available", "city"]
_WEATHER_USED = ["temperature", "wind_speed", "cloudiness", "precipitation", "city"]


def _decoded(messages, schema, columns, epoch_col, observed, key):
    columns = columns and [*columns, epoch_col, *([key] if observed and key not in columns else [])]
    sent = ["timestamp"] if "timestamp" in messages.columns else []
    rows = decode_messages(messages, schema, columns, keep=sent, keep_corrupt=bool(observed))
    rows = with_event_time(rows, epoch_col)
    if sent:
        name = next(c for c in ("message_timestamp", "timestamp") if c in rows.columns)
        rows = rows.withColumn("event_time", plausible("event_time", name)).drop(name)
    if observed:
        rules = {**message_rules(key), "bad_time": F.col("event_time").isNull()}
        rows = observe_counts(rows, observed, rules).drop(CORRUPT)
    return rows


def decoded_status(messages: DataFrame, columns=None, epoch_col="event_timestamp", observed=None) -> DataFrame:
    """Status messages as rows with ``event_time``; ``columns`` are the only fields needed beside the time.

    A time far ahead of the message's own (see ``plausible``) is null. ``observed`` names counts of accepted and rejected
    rows (``loaded``, ``corrupt``, ``no_key``, ``bad_time``) that a streaming query reports with its progress.
    """
    return _decoded(messages, STATION_STATUS, columns, epoch_col, observed, "station_id")


def decoded_weather(messages: DataFrame, columns=None, epoch_col="event_timestamp", observed=None) -> DataFrame:
    """Weather messages as rows with ``event_time``; as ``decoded_status``, with ``city`` for a key."""
    return _decoded(messages, WEATHER, columns, epoch_col, observed, "city")


# By what a message that was sent again is told from others: its key, its time and what it says.
STATUS_IDENTITY = ["station_id", "event_time", "num_bikes_available", "num_docks_available", "city"]
WEATHER_IDENTITY = ["city", "event_time", "temperature", "wind_speed", "cloudiness", "precipitation"]


def utilization_from_messages(messages: DataFrame, grain=GRAIN_30M, delay=None, observed=None, resent=False) -> DataFrame:
    """Windowed utilization of status messages; a stream needs ``delay``. ``resent`` counts a repeated message once."""
    used = ["station_id", *_STATUS_USED] if resent else _STATUS_USED
    rows = decoded_status(messages, used, observed=observed)
    return utilization_by_window(rows, grain, delay, once=STATUS_IDENTITY if resent else None)


def weather_from_messages(messages: DataFrame, grain=GRAIN_30M, delay=None, observed=None, resent=False) -> DataFrame:
    """Windowed weather of weather messages; a stream needs ``delay``. ``resent`` counts a repeated message once."""
    rows = decoded_weather(messages, _WEATHER_USED, observed=observed)
    return weather_by_window(rows, grain, delay, once=WEATHER_IDENTITY if resent else None)


def station_snapshot(messages: DataFrame) -> DataFrame:
    """The latest valid record of each station in a batch of station messages."""
    order = ["timestamp", "offset"]
    stations = clean_station_info(decode_messages(messages, STATION_INFO, keep=order))
    return latest_by_key(stations, "station_id", order).drop(*order)


def usage_from_messages(
    status: DataFrame, weather: DataFrame, grain=GRAIN_30M, delay=None, counts=False, resent=False
) -> DataFrame:
    """Usage summary of status and weather messages; a stream needs ``delay``.

    ``counts`` reports accepted and rejected rows of both feeds as ``status_rows`` and ``weather_rows``. ``resent`` counts
    a message that a producer sent again only once; it costs a shuffle by message, and on a stream the state of the
    messages of one ``delay``.

    The station list has no part in it: the summary uses none of its columns, so joining it would only move data.
    """
    return usage_summary(
        utilization_from_messages(status, grain, delay, "status_rows" if counts else None, resent),
        weather_from_messages(weather, grain, delay, "weather_rows" if counts else None, resent),
    )
