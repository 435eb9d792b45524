"""Validity rules and defaults of the three feeds.

A default applies to a missing field and to an explicit null alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_CITY, DEFAULT_STATION_NAME
from ..functions.clock import epoch_seconds
from ..functions.parsing import lenient, object_keys, parse_json
from ..schemas import WEATHER_DOCUMENT, WEATHER_READING

FLAGS = ("is_installed", "is_renting", "is_returning")
COUNTS = ("num_bikes_available", "num_docks_available")


def has_text(name: str) -> Column:
    """True for a column that holds something, false for null and the empty string."""
    text = F.col(name).cast("string")
    return text.isNotNull() & (text != "")


def clean_station_info(stations: DataFrame) -> DataFrame:
    """Drop stations without an id or a capacity (0 is a capacity) and name the unnamed."""
    return stations.where(has_text("station_id") & F.col("capacity").isNotNull()).withColumn(
        "name", F.coalesce("name", F.lit(DEFAULT_STATION_NAME))
    )


def clean_station_status(states: DataFrame) -> DataFrame:
    """Drop states without a station id; missing counts are 0 and missing flags are true."""
    defaults = {name: F.lit(0) for name in COUNTS} | {name: F.lit(True) for name in FLAGS}
    present = {name: F.coalesce(name, default) for name, default in defaults.items() if name in states.columns}
    return states.where(has_text("station_id")).withColumns(present)


def flatten_weather(documents: DataFrame, ingest_col=None, keep=(), document="value") -> DataFrame:
    """One reading per weather document.

    No rain reported means 0.0. A document that is missing, broken or empty still gives a row, with the ingest time and
    every measure null, so a gap in the feed stays visible. Without ``ingest_col`` the ingest time is now.
    """
    ingest = F.current_timestamp() if ingest_col is None else F.col(ingest_col)
    read = documents.select(
        *keep,
        epoch_seconds(ingest).alias("ingested"),
        (F.coalesce(F.size(object_keys(document)), F.lit(0)) > 0).alias("present"),
        parse_json(document, WEATHER_DOCUMENT).alias("w"),
    )
    sources = {
        "timestamp": F.col("w.dt"),
        "temperature": F.col("w.main.temp"),
        "wind_speed": F.col("w.wind.speed"),
        "cloudiness": F.col("w.clouds.all"),
        "precipitation": F.col("w.rain.1h"),
    }
    values = {f.name: F.when(F.col("present"), lenient(sources[f.name], f.dataType)) for f in WEATHER_READING.fields}
    values["timestamp"] = F.coalesce(values["timestamp"], F.col("ingested"))
    values["precipitation"] = F.when(F.col("present"), F.coalesce(values["precipitation"], F.lit(0.0)))
    return read.select(*keep, *[value.alias(name) for name, value in values.items()])


def stamp(rows: DataFrame, city=DEFAULT_CITY, ingest_col=None) -> DataFrame:
    """Add the city and the publish time in epoch seconds.

    Without ``ingest_col`` the publish time is now; on a stream that is the start of the micro-batch.
    """
    moment = F.current_timestamp() if ingest_col is None else F.col(ingest_col)
    return rows.withColumns({"city": F.lit(city), "event_timestamp": epoch_seconds(moment)})


def encode_messages(rows: DataFrame, key_col: str, columns=None) -> DataFrame:
    """Keyed JSON messages, one per row that has a key; nulls are written out.

    ``columns`` are the fields of the message, by default all columns.
    """
    value = F.to_json(F.struct(*(columns or rows.columns)), {"ignoreNullFields": "false"})
    return rows.where(has_text(key_col)).select(
        F.col(key_col).cast("string").cast("binary").alias("key"), value.cast("binary").alias("value")
    )
