"""Column expressions, all built from Spark's own functions."""

from .clock import epoch_seconds, event_time, hour_of, is_weekend, weekday_of
from .measures import utilization
from .parsing import lenient, object_keys, parse_json, wire_schema

__all__ = [
    "epoch_seconds",
    "event_time",
    "hour_of",
    "is_weekend",
    "lenient",
    "object_keys",
    "parse_json",
    "utilization",
    "weekday_of",
    "wire_schema",
]
