"""Training rows for the one-hour-ahead forecast."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FEATURES, LABEL, TIME_AHEAD, TRAIN_BELOW
from ..functions.clock import hour_of, is_weekend, weekday_of
from .leads import lead_by_rows, lead_by_time


def calendar_features(rows: DataFrame, at="time_t1h", zone=None) -> DataFrame:
    """Hour, weekday (Sunday = 1) and weekend flag of ``at``, in ``zone`` or the session zone."""
    return (
        rows.withColumn("hour_t1h", hour_of(at, zone))
        .withColumn("dow_t1h", weekday_of(at, zone))
        .withColumn("is_weekend_t1h", is_weekend("dow_t1h"))
    )


def feature_rows(summary: DataFrame, rows=None, ahead=TIME_AHEAD, zone=None, labeled=True) -> DataFrame:
    """Summary rows with everything the forecast needs.

    By default the later values are those exactly ``ahead`` later. ``rows=2`` takes the second next row instead, which
    is the same only where no window is missing. Rows lacking any feature are dropped, and with ``labeled`` also rows
    lacking the label.
    """
    led = lead_by_time(summary, ahead) if rows is None else lead_by_rows(summary, rows)
    needed = ["time_t1h", *[c for c in FEATURES if c in led.columns], *([LABEL] if labeled else [])]
    return calendar_features(led.na.drop(subset=needed), zone=zone)


def split(rows: DataFrame, cutoff=None, keys=("city",), order="window_start") -> DataFrame:
    """Add ``part``: "train" or "test".

    By default 8 of 10 rows train, chosen by the MD5 of the row's keys and epoch, so the split is the same however the
    data is laid out, and in any engine. With a ``cutoff`` time earlier rows train and later rows test, which is the honest test of a forecast.
    """
    if cutoff is None:
        name = F.concat_ws("|", *keys, F.unix_seconds(order).cast("string"))
        train = F.substring(F.md5(name.cast("binary")), 1, 4) < TRAIN_BELOW
    else:
        train = F.col(order) < (cutoff if isinstance(cutoff, Column) else F.lit(cutoff)).cast("timestamp")
    return rows.withColumn("part", F.when(train, "train").otherwise("test"))


def folds(rows: DataFrame, cutoffs, order="window_start", known="time_t1h") -> DataFrame:
    """Add ``fold`` and ``part`` for a rolling-origin test, in which a model is judged on what came after its training.

    ``cutoffs`` are moments in rising order. Fold k trains on the rows whose label was known at its cutoff, which is at
    ``known``, and tests on those from its cutoff up to the next one. Rows train in several folds and appear once for
    each; a row that begins before a cutoff and whose label lies after it takes no part in that fold.
    """
    ends = [F.lit(c).cast("timestamp") for c in cutoffs]
    parts = []
    for k, start in enumerate(ends):
        tests = F.col(order) >= start
        if k + 1 < len(ends):
            tests &= F.col(order) < ends[k + 1]
        part = F.when(F.col(known) < start, "train").when(tests, "test")
        parts.append(F.struct(F.lit(k).alias("fold"), part.alias("part")))
    every = rows.withColumn("_fold", F.explode(F.array(*parts)))
    return every.select(*rows.columns, "_fold.*").where(F.col("part").isNotNull())


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part").agg(F.count("*").alias("n"))
