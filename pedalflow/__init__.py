"""Shared-mobility usage analytics and forecasting on Spark."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans.analytics import station_snapshot, usage_from_messages
from .plans.forecast import (
    Forecast,
    build_pipeline,
    fit_forecast,
    forecast_latest,
    forecast_series,
    load_model,
    metrics,
    newest_model,
    publish_model,
    rolling_test,
    save_model,
    score,
)
from .plans.publish import info_messages, status_messages, weather_messages
from .session import build_session, stored
from .sources import *  # noqa: F403
from .sources import __all__ as _sources
from .streaming import *  # noqa: F403
from .streaming import __all__ as _streaming

__all__ = [
    *_operators,
    *_sources,
    *_streaming,
    "Forecast",
    "build_pipeline",
    "build_session",
    "fit_forecast",
    "forecast_latest",
    "forecast_series",
    "info_messages",
    "load_model",
    "metrics",
    "newest_model",
    "publish_model",
    "rolling_test",
    "save_model",
    "score",
    "station_snapshot",
    "status_messages",
    "stored",
    "usage_from_messages",
    "weather_messages",
]
