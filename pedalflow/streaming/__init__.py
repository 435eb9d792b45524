"""Structured Streaming jobs and sinks."""

from .intake import read_intake, start_intake_job
from .jobs import (
    finish,
    start_enrich_job,
    start_status_publisher,
    start_usage_job,
    start_weather_console,
    start_weather_publisher,
    start_window_monitors,
    watch,
)
from .scoring import live_features, read_scores, start_score_job
from .sinks import save_summary, show_sorted, start_batches, start_console, start_files, start_summary_sink
from .state import state_keys, state_rows, state_stores

__all__ = [
    "finish",
    "live_features",
    "read_intake",
    "read_scores",
    "save_summary",
    "show_sorted",
    "start_batches",
    "start_console",
    "start_enrich_job",
    "start_files",
    "start_intake_job",
    "start_score_job",
    "start_status_publisher",
    "start_summary_sink",
    "start_usage_job",
    "start_weather_console",
    "start_weather_publisher",
    "start_window_monitors",
    "state_keys",
    "state_rows",
    "state_stores",
    "watch",
]
