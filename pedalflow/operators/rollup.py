"""Windows of several lengths from one pass over the rows.

The shortest windows keep their moments: count, mean, sum of squared deviations, least and greatest value. Moments of
neighbouring windows merge, so longer windows come from the shorter ones' few rows and the raw rows are read once. Two
moments merge by their difference in means, which loses no digits however many rows lie behind them, unlike a difference
of large sums of squares.

The functions take batches and streams; on a stream the longer windows are a second stateful step, which follows the
first one's watermark.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import GRAIN_1M, GRAIN_30M
from .usage import with_utilization

UTIL = ("utilization",)
WEATHER = ("temperature", "wind_speed", "cloudiness", "precipitation")


def _moments(measure: str) -> Column:
    n = F.count(measure)
    return F.struct(
        n.alias("n"),
        F.avg(measure).alias("mean"),
        (F.var_pop(measure) * n).alias("m2"),
        F.min(measure).cast("double").alias("least"),
        F.max(measure).cast("double").alias("most"),
    ).alias(measure)


def moments_by_window(rows: DataFrame, measures=UTIL, grain=GRAIN_1M, delay=None, keys=("city",)) -> DataFrame:
    """A struct of moments of each measure per tumbling window and key; a stream needs ``delay``."""
    if "utilization" in measures and "utilization" not in rows.columns:
        rows = with_utilization(rows)
    slim = rows.select("event_time", *keys, *measures)
    if delay is not None:
        slim = slim.withWatermark("event_time", delay)
    return slim.groupBy(F.window("event_time", grain), *keys).agg(*[_moments(m) for m in measures])


def _merged(parts: Column) -> Column:
    """The moments of all rows behind an array of moments, one after the other."""

    def two(a, b):
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        both = F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
            F.least(a["least"], b["least"]).alias("least"),
            F.greatest(a["most"], b["most"]).alias("most"),
        )
        return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.element_at(parts, 1), two)


def rollup(moments: DataFrame, measures=UTIL, grain=GRAIN_30M, keys=("city",)) -> DataFrame:
    """Moments of longer windows from those of shorter ones that divide them.

    A window gathers one row for each shorter window in it, so a key has no more than their ratio to gather, however many
    rows lie behind them.
    """
    # The time of a window is its last moment, so it falls into the longer window that holds it.
    parts = F.sort_array(F.collect_list(F.struct("_start", *measures)))
    # A stream hands on the time of its windows by the window column alone.
    named = moments.withColumn("_start", F.col("window.start"))
    longer = named.groupBy(F.window(F.window_time("window"), grain), *keys).agg(parts.alias("_parts"))
    return longer.select("window", *keys, *[_merged(F.col(f"_parts.{m}")).alias(m) for m in measures])


def utilization_of(moments: DataFrame, keys=("city",)) -> DataFrame:
    """The measures of ``utilization_by_window`` from moments."""
    u = F.col("utilization")
    std = F.when(u["n"] > 1, F.sqrt(u["m2"] / (u["n"] - 1)))
    return moments.select(
        "window", *keys, u["mean"].alias("avg_util"), u["most"].alias("max_util"), u["least"].alias("min_util"), std.alias("std_util")
    )


def weather_of(moments: DataFrame, keys=("city",)) -> DataFrame:
    """The measures of ``weather_by_window`` from moments."""
    names = zip(WEATHER, ("avg_temp", "avg_wind", "avg_clouds", "avg_rain"))
    return moments.select("window", *keys, *[F.col(m)["mean"].alias(n) for m, n in names])
