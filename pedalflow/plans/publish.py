"""From feed documents to keyed messages; every function takes batches and streams."""

from pyspark.sql import DataFrame

from ..constants import DEFAULT_CITY
from ..operators.clean import clean_station_info, clean_station_status, encode_messages, flatten_weather, stamp
from ..operators.decode import explode_stations
from ..schemas import STATION_INFO, STATION_STATE, STATION_STATUS, WEATHER


def info_messages(documents: DataFrame) -> DataFrame:
    """Valid stations of station list documents, keyed by station."""
    return encode_messages(clean_station_info(explode_stations(documents, STATION_INFO)), "station_id")


def status_messages(documents: DataFrame, city=DEFAULT_CITY, ingest_col="landed_at") -> DataFrame:
    """Station states of status documents, stamped with city and publish time and keyed by station."""
    keep = [] if ingest_col is None else [ingest_col]
    states = clean_station_status(explode_stations(documents, STATION_STATE, keep))
    return encode_messages(stamp(states, city, ingest_col), "station_id", STATION_STATUS.names)


def weather_messages(documents: DataFrame, city=DEFAULT_CITY, ingest_col="landed_at") -> DataFrame:
    """Readings of weather documents, stamped and keyed by city."""
    keep = [] if ingest_col is None else [ingest_col]
    return encode_messages(stamp(flatten_weather(documents, ingest_col, keep), city, ingest_col), "city", WEATHER.names)
