"""Explicit schemas: nothing in the engine infers a schema. Field names are fixed values: data on the wire has them.

Epoch fields are ``long``: a 32-bit second counter overflows in 2038 and the JSON reader would turn a larger value into
null.
"""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, kind) for name, kind in fields.items()])


STATION_INFO = _struct(
    station_id=StringType(), name=StringType(), lat=DoubleType(), lon=DoubleType(), capacity=IntegerType()
)

# One element of a station status document, before it is stamped for publishing.
STATION_STATE = _struct(
    station_id=StringType(),
    num_bikes_available=IntegerType(),
    num_docks_available=IntegerType(),
    is_installed=BooleanType(),
    is_renting=BooleanType(),
    is_returning=BooleanType(),
    last_reported=LongType(),
)

STAMP = _struct(city=StringType(), event_timestamp=LongType())

STATION_STATUS = StructType(STATION_STATE.fields + STAMP.fields)

WEATHER_READING = _struct(
    timestamp=LongType(),
    temperature=DoubleType(),
    wind_speed=DoubleType(),
    cloudiness=IntegerType(),
    precipitation=DoubleType(),
)

WEATHER = StructType(WEATHER_READING.fields + STAMP.fields)

# The current-weather document; "1h" is the rain of the last hour.
WEATHER_DOCUMENT = _struct(
    dt=LongType(),
    main=_struct(temp=DoubleType()),
    wind=_struct(speed=DoubleType()),
    clouds=_struct(all=IntegerType()),
    rain=_struct(**{"1h": DoubleType()}),
)

# The part of a Kafka record the engine uses; also the layout of message files.
MESSAGE = _struct(key=BinaryType(), value=BinaryType(), timestamp=TimestampType(), offset=LongType())

# The measures of a usage summary, in the order of its columns.
UTIL_MEASURES = ["avg_util", "max_util", "min_util", "std_util"]
WEATHER_MEASURES = ["avg_temp", "avg_wind", "avg_clouds", "avg_rain"]

USAGE_SUMMARY = _struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    city=StringType(),
    **dict.fromkeys([*UTIL_MEASURES, *WEATHER_MEASURES], DoubleType()),
)
