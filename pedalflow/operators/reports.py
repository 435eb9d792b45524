"""Small result tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import HISTOGRAM_BINS, KLL_K


def latest_row(rows: DataFrame, order="time_t1h", keys=("city",)) -> DataFrame:
    """The latest row; keys break ties. For one row per city use ``latest_by_key(rows, "city", order)``."""
    return rows.orderBy(F.col(order).desc(), *keys).limit(1)


def histogram(rows: DataFrame, column: str, bins=HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins between the smallest and the greatest value, empty bins included.

    The last bin includes its upper end. If all values are equal the range is half a unit to both sides. Nulls are left
    out. The range is a single row: as a scalar subquery it meets the values, exploded it becomes the bins, so nothing
    passes through the driver. Rows are read twice, so give it a stored table.
    """
    values = rows.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    margin = F.when(F.min("v") == F.max("v"), 0.5).otherwise(0.0)
    span = values.agg((F.min("v") - margin).alias("low"), (F.max("v") + margin).alias("high"))
    span = span.select("low", (F.col("high") - F.col("low")).alias("width"))
    whole = span.select(F.struct("low", "width")).scalar()
    bin_of = F.least(F.floor((F.col("v") - whole["low"]) * bins / whole["width"]), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    all_bins = span.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width") / bins).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width") / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def quantile_bins(rows: DataFrame, column: str, bins=HISTOGRAM_BINS, keys=(), accuracy=KLL_K) -> DataFrame:
    """Bins that hold about equally many values each, per key, from one pass.

    Each task keeps a KLL sketch per key, a few thousand bytes whatever it has read, and sketches merge on the way; so a
    hot key is no larger than another after that. Bin ends are quantiles whose rank is off by at most one value in 100 at
    the default ``accuracy``, in 99 of 100 cases, and by about half of that at twice the accuracy; the first and the last
    end are exact. Nulls and NaN are left out; a key without
    values has no bins.
    """
    v = F.col(column).cast("double")
    sketch = F.kll_sketch_agg_double(v, F.lit(accuracy))
    kept = rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(sketch.alias("_sketch"), F.count("*").alias("n"), F.min(v).alias("_least"), F.max(v).alias("_most"))
    ranks = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    ends = F.concat(F.array("_least"), F.kll_sketch_get_quantile_double("_sketch", ranks), F.array("_most"))
    spans = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda k: F.struct(k.alias("bin"), F.get("_ends", k).alias("bin_start"), F.get("_ends", k + 1).alias("bin_end")))
    placed = kept.where("n > 0").withColumn("_ends", ends).select(*keys, "n", F.explode(spans).alias("_bin"))
    return placed.select(*keys, "_bin.*", "n")
