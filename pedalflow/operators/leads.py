"""The state of a city one hour later, next to its present state.

Give the batch functions a stored summary (``read_summary`` or ``stored``): they read their input twice.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ROWS_AHEAD, TIME_AHEAD

# Summary columns and the names of their later values.
LEADS = {
    "avg_temp": "temp_t1h",
    "avg_wind": "wind_t1h",
    "avg_rain": "rain_t1h",
    "avg_clouds": "clouds_t1h",
    "window_start": "time_t1h",
    "avg_util": "util_t1h",
}


def lead_by_time(summary: DataFrame, ahead=TIME_AHEAD, columns=None, keys=("city",), order="window_start") -> DataFrame:
    """Add the values of the row exactly ``ahead`` later, null where that window is missing.

    An equi-join on key and window: keys are unique, so no task gets more than its share however large a city is.
    """
    columns = columns or LEADS
    later = summary.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        (F.col(order) - F.expr(f"INTERVAL '{ahead}'")).alias("_at"),
        *[F.col(source).alias(name) for source, name in columns.items()],
    )
    match = F.col(order) == F.col("_at")
    for k in keys:
        match &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return summary.join(later, match, "left").select(*summary.columns, *columns.values())


def lead_on_stream(
    summary: DataFrame, ahead=TIME_AHEAD, delay="0 seconds", columns=None, keys=("city",), order="window_start"
) -> DataFrame:
    """:func:`lead_by_time` on a stream of summary rows, as ``stream_summary`` gives them.

    An interval join of the stream with itself: a row waits for the one ``ahead`` later, and a row with none appears with
    nulls once the watermark says that none will come. Both sides have a watermark and are let go when it passes them, so
    state holds the rows of about ``ahead`` plus ``delay`` however long the stream runs. ``delay`` is how far apart in
    time rows may arrive; a summary's windows arrive in order but for those of one batch.
    """
    columns = columns or LEADS
    earlier = summary.withWatermark(order, delay)
    later = summary.select(
        F.col(order).alias("_at"), *[F.col(k).alias(f"_{k}") for k in keys], *[F.col(source).alias(name) for source, name in columns.items()]
    ).withWatermark("_at", delay)
    then = F.col(order) + F.expr(f"INTERVAL '{ahead}'")
    match = (F.col("_at") >= then) & (F.col("_at") <= then)
    for k in keys:
        match &= F.col(k) == F.col(f"_{k}")
    return earlier.join(later, match, "left").select(*summary.columns, *columns.values())


def lead_by_rows(
    summary: DataFrame, n=ROWS_AHEAD, columns=None, keys=("city",), order="window_start", chunk="week"
) -> DataFrame:
    """Add the values of the row ``n`` rows later in the same city, whatever time lies between.

    The timeline of a city is cut into calendar chunks (any unit of ``trunc``), and each chunk is a window partition of
    its own, so a long or fine-grained timeline is not sorted in one task. Each chunk borrows the first ``n`` rows that
    follow it, which the window needs at the end of the chunk; only these heads, at most ``n`` per chunk, are lined up
    per city.
    """
    columns = columns or LEADS
    needed = [order, *[c for c in columns if c != order]]
    chunked = summary.withColumn("_chunk", F.trunc(F.to_date(order), chunk))
    line = Window.partitionBy(*keys, "_chunk").orderBy(order)

    heads = (
        chunked.select(*keys, "_chunk", F.struct(*needed).alias("_row"), F.row_number().over(line).alias("_n"))
        .where(F.col("_n") <= n)
        .groupBy(*keys, "_chunk")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "_row"))).alias("_heads"))
    )
    following = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(1, n)
    borrowed = (
        heads.withColumn("_next", F.slice(F.flatten(F.collect_list("_heads").over(following)), 1, n))
        .select(*keys, "_chunk", F.explode("_next").alias("_next"))
        .select(*keys, "_chunk", "_next._row.*", F.lit(True).alias("_borrowed"))
    )
    padded = chunked.withColumn("_borrowed", F.lit(False)).unionByName(borrowed, allowMissingColumns=True)
    leads = [F.lead(source, n).over(line).alias(name) for source, name in columns.items()]
    return padded.select(*summary.columns, "_borrowed", *leads).where(~F.col("_borrowed")).drop("_borrowed")
