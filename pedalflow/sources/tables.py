"""Bike-share rows derived from the general event and customer tables.

Events that are no page views become station states, page views become weather readings and customers become stations.
Each function gives a batch table or, with ``stream=True``, the same rows as a stream.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import epoch_seconds
from ..operators.clean import clean_station_info, clean_station_status
from ..operators.enrich import lookup_join


# The given tables, as far as the feeds are derived from them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _events(spark, folder, stream):
    if not stream:
        return table(spark, folder, "events")
    # A file stream wants a folder or a pattern; this pattern matches the table be it a file or a folder.
    return spark.readStream.schema(SCHEMAS["events"]).parquet(f"{folder}/event[s].parquet")


def _with_city(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add the region of the user.

    Users are joined straight from their table, whose file size tells the optimizer whether to broadcast it; if not,
    events are shuffled once, by the many values of the user. Nations with their regions are 25 rows at every scale.
    """
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("city")
    )
    return lookup_join(rows, users, "user_id").join(F.broadcast(places), "c_nationkey", "left").drop("c_nationkey")


def located_events(spark: SparkSession, folder: str, kept, city=None, stream=False) -> DataFrame:
    """Events of the kinds in ``kept`` with their city: the region of the user, or one city for all."""
    events = _events(spark, folder, stream).where(kept)
    rows = events.select(
        "event_id",
        F.date_trunc("second", "ts").alias("event_time"),
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    if city is not None:
        return rows.withColumn("city", F.lit(city))
    return _with_city(rows, spark, folder)


def status_raw(spark: SparkSession, folder: str, city=None, stream=False) -> DataFrame:
    """Station states as a feed might send them, with missing counts and flags."""
    k = F.col("k")
    return located_events(spark, folder, F.col("event_type") != "view", city, stream).select(
        "event_id",
        F.col("user_id").cast("string").alias("station_id"),
        F.when(k % 17 == 0, None).otherwise(F.floor("value").cast("int") % 21).alias("num_bikes_available"),
        F.when(k % 19 == 0, None).otherwise(k % 21).alias("num_docks_available"),
        F.when(k % 7 == 0, None).otherwise(k % 2 == 0).alias("is_renting"),
        "city",
        "event_time",
    )


def status(spark: SparkSession, folder: str, city=None, stream=False) -> DataFrame:
    return clean_station_status(status_raw(spark, folder, city, stream))


def weather(spark: SparkSession, folder: str, city=None, stream=False) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    return located_events(spark, folder, F.col("event_type") == "view", city, stream).select(
        "event_id",
        value.alias("temperature"),
        (k.cast("double") / 10).alias("wind_speed"),
        k.alias("cloudiness"),
        F.when(k % 5 == 0, value / 100).otherwise(F.lit(0.0)).alias("precipitation"),
        "city",
        "event_time",
    )


def _station_records():
    """The one or two records of a station: every third station is published again with more places."""
    name = F.col("c_name")
    places = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100).cast("int"))

    def record(name, capacity, offset):
        return F.struct(
            F.col("c_custkey").cast("string").alias("station_id"),
            name.alias("name"),
            (F.lit(20.0) + F.col("c_nationkey")).alias("lat"),
            (F.lit(50.0) + F.col("c_nationkey")).alias("lon"),
            capacity.alias("capacity"),
            F.lit(offset).alias("msg_offset"),
        )

    first = record(F.when(F.col("c_custkey") % 11 != 0, name), places, 1)
    second = F.when(F.col("c_custkey") % 3 == 0, record(name, places + 5, 2))
    return F.array_compact(F.array(first, second))


def station_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Station records as published, with repeats and invalid ones."""
    records = table(spark, folder, "customer").select(F.explode(_station_records()).alias("r"))
    return records.select("r.*")


def station_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same records packed into station documents, one per customer."""
    document = F.struct(F.struct(_station_records().alias("stations")).alias("data"))
    return table(spark, folder, "customer").select(F.to_json(document).alias("value"))


def station_history(spark: SparkSession, folder: str) -> DataFrame:
    """Valid station records with the moment from which they hold: a first one early in the month, a second one later."""
    days = F.when(F.col("msg_offset") == 1, F.col("station_id").cast("long") % 5).otherwise(10 + F.col("station_id").cast("long") % 13)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days.cast("int"))
    records = clean_station_info(station_raw(spark, folder))
    return records.withColumn("valid_from", start).drop("msg_offset")


def status_records(rows: DataFrame) -> DataFrame:
    """Status rows in the layout of a status message."""
    seconds = epoch_seconds("event_time")
    return rows.select(
        "event_id",
        "station_id",
        "num_bikes_available",
        "num_docks_available",
        F.col("is_renting").alias("is_installed"),
        "is_renting",
        F.col("is_renting").alias("is_returning"),
        seconds.alias("last_reported"),
        "city",
        seconds.alias("event_timestamp"),
    )


def weather_records(rows: DataFrame) -> DataFrame:
    """Weather rows in the layout of a weather message."""
    seconds = epoch_seconds("event_time")
    return rows.select(
        "event_id",
        seconds.alias("timestamp"),
        "temperature",
        "wind_speed",
        "cloudiness",
        "precipitation",
        "city",
        seconds.alias("event_timestamp"),
    )


def weather_documents(rows: DataFrame) -> DataFrame:
    """Weather rows as feed documents; the rain entry is left out where there was none."""
    rain = F.when(F.col("precipitation") > 0, F.struct(F.col("precipitation").alias("1h")))
    document = F.struct(
        epoch_seconds("event_time").alias("dt"),
        F.struct(F.col("temperature").alias("temp")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
        F.struct(F.col("cloudiness").alias("all")).alias("clouds"),
        rain.alias("rain"),
    )
    return rows.select("event_id", "event_time", F.to_json(document).alias("value"))
