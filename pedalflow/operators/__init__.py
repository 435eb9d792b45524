"""Operators: each takes DataFrames and returns a DataFrame."""

from .audit import audit_counts, message_rules, observe_counts, station_info_rules, station_status_rules
from .clean import clean_station_info, clean_station_status, encode_messages, flatten_weather, stamp
from .decode import decode_messages, explode_stations
from .enrich import enrich_status, latest_by_key, lookup_join
from .features import calendar_features, feature_rows, folds, split, split_counts
from .leads import lead_by_rows, lead_by_time, lead_on_stream
from .reports import histogram, latest_row, quantile_bins
from .rollup import moments_by_window, rollup, utilization_of, weather_of
from .timeline import join_as_of, trailing_features
from .usage import (
    drop_resent,
    flat_window,
    ordered,
    usage_summary,
    utilization_by_window,
    weather_by_window,
    with_event_time,
    with_utilization,
)

__all__ = [
    "audit_counts",
    "calendar_features",
    "clean_station_info",
    "clean_station_status",
    "decode_messages",
    "drop_resent",
    "encode_messages",
    "enrich_status",
    "explode_stations",
    "feature_rows",
    "flat_window",
    "flatten_weather",
    "folds",
    "histogram",
    "join_as_of",
    "latest_by_key",
    "latest_row",
    "lead_by_rows",
    "lead_by_time",
    "lead_on_stream",
    "lookup_join",
    "message_rules",
    "moments_by_window",
    "observe_counts",
    "ordered",
    "quantile_bins",
    "rollup",
    "split",
    "split_counts",
    "stamp",
    "trailing_features",
    "station_info_rules",
    "station_status_rules",
    "usage_summary",
    "utilization_by_window",
    "utilization_of",
    "weather_by_window",
    "weather_of",
    "with_event_time",
    "with_utilization",
]
