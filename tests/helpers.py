from collections import Counter
from datetime import datetime, timezone


def utc(text):
    """Naive UTC time of "2024-01-01 00:30"."""
    return datetime.fromisoformat(text)


def epoch(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def bag(df, *columns):
    """The rows as a multiset of tuples, doubles to six digits."""

    def plain(value):
        return round(value, 6) + 0.0 if isinstance(value, float) else value

    picked = df.select(*columns) if columns else df
    return Counter(tuple(plain(v) for v in row) for row in picked.collect())


def rows(df, *columns):
    """The rows as a sorted list of tuples, nulls first."""
    return sorted(bag(df, *columns).elements(), key=lambda r: [(v is not None, v) for v in r])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def times(spark, texts, **constants):
    """A frame with a ``window_start`` per text, a running ``avg_util`` and constant columns."""
    from pyspark.sql import functions as F

    data = [(t, float(i)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "t string, avg_util double")
    frame = frame.select(F.col("t").cast("timestamp").alias("window_start"), "avg_util")
    return frame.withColumns({name: F.lit(value) for name, value in constants.items()})
