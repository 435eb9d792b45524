"""What lies before a moment on a long timeline: the record that then held, and trailing sums.

A timeline of one key is cut into chunks of time. Inside a chunk a window partition of its own does the work; what is
carried from one chunk to the next is one row for each chunk. So no task sorts a whole key, and a station or city that
holds a third of all rows is as many pieces of work as it has chunks.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hours of a chunk.
CHUNK_HOURS = 24
# Sums are of whole numbers, values times this: exact, whatever the order of terms, and equal values deviate by nothing.
_UNIT = 1_000_000


def _chunk(at: str, hours: float) -> Column:
    return F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(int(hours * 3_600_000_000))).alias("_chunk")


def _carried(chunks: DataFrame, keys: list[str], columns: dict[str, Column]) -> DataFrame:
    """One row for each key and chunk with ``columns`` over all earlier chunks; under names no other frame has."""
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    names = [*keys, "_chunk"]
    return chunks.select(*[F.col(n).alias(f"_own_{n}") for n in names], *[c.over(before).alias(n) for n, c in columns.items()])


def _with_carried(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    names = [*keys, "_chunk"]
    match = reduce(Column.__and__, [rows[n].eqNullSafe(carried[f"_own_{n}"]) for n in names])
    return rows.join(carried, match, "left").drop(*[f"_own_{n}" for n in names])


def join_as_of(
    rows: DataFrame, history: DataFrame, key, at="event_time", since="valid_from", order=(), chunk_hours=CHUNK_HOURS
) -> DataFrame:
    """Add to each row the columns of the latest ``history`` record of its key at or before its time; nulls if none.

    ``since`` tells from when a record holds, further columns in ``order`` decide between records of one moment. The
    record's own time and order are left out. Rows without a key or time find nothing and stay.

    Records join the timeline of the rows as further rows of it: a running last value inside each chunk, and for the
    start of a chunk the last record of all earlier ones, which is a maximum for each chunk before it is lined up.
    """
    keys, order = [key] if isinstance(key, str) else list(key), [order] if isinstance(order, str) else list(order)
    added = [c for c in history.columns if c not in (*keys, since, *order)]
    record = F.struct(F.col(since).cast("timestamp").alias("_since"), *order, *added)
    left = rows.select(*keys, F.struct(*rows.columns).alias("_row"), F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"))
    right = history.where(F.col(since).isNotNull()).select(*keys, record.alias("_record"), F.col(since).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"))
    line = left.unionByName(right, allowMissingColumns=True).withColumn("_chunk", _chunk("_at", chunk_hours))

    # Records come before rows of the same moment, and the greatest order last.
    here = Window.partitionBy(*keys, "_chunk").orderBy("_at", "_kind", "_record").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_here", F.last("_record", ignorenulls=True).over(here)).where("_kind = 1")
    # Chunks of records, and chunks of rows that may hold none of their own.
    chunks = line.groupBy(*keys, "_chunk").agg(F.max("_record").alias("_latest"))
    carried = _carried(chunks, keys, {"_before": F.last("_latest", ignorenulls=True)})
    found = _with_carried(found, carried, keys)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]) & F.col("_at").isNotNull()
    held = F.when(known, F.coalesce("_here", "_before"))
    return found.withColumn("_held", held).select("_row.*", *[F.col(f"_held.{c}").alias(c) for c in added])


def trailing_features(
    summary: DataFrame, spans: dict[str, str], measure="avg_util", keys=("city",), order="window_start", chunk_hours=CHUNK_HOURS
) -> DataFrame:
    """Add count, mean, sample deviation and lag of ``measure`` for each of ``spans``, such as ``{"24h": "24 hours"}``.

    Count, mean and deviation are over the rows from ``span`` before up to the row itself, both ends included; the lag is
    the value of the row exactly ``span`` before. Values are rounded to six digits first. Nulls count nowhere. A key has one row for a
    moment, as in a summary.

    A sum between two moments is the difference of two running sums. Each row asks for the running sums at its own time
    and, as further rows of the timeline, for those just before each span begins; every running sum is the sum of the
    chunks before plus that inside its chunk.
    """
    keys = list(keys)
    value = F.round(F.round(measure, 6) * _UNIT).cast("decimal(18,0)")
    own = summary.select(*keys, F.struct(*summary.columns).alias("_row"), F.col(order).alias("_origin"), value.alias("_x"))
    probes = [own.select(*keys, "_origin", (F.col("_origin") - F.expr(f"INTERVAL {span}")).alias("_at"), F.lit(name).alias("_span")) for name, span in spans.items()]
    line = own.select("*", F.col("_origin").alias("_at"), F.lit("").alias("_span"))
    line = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), probes, line).withColumn("_chunk", _chunk("_at", chunk_hours))

    x = F.col("_x")
    sums = {"n": F.count(x), "s": F.sum(x), "q": F.sum((x * x).cast("decimal(36,0)"))}
    # Rows without a span are those of the table; a span asks for what lies before its first moment.
    later = F.when(F.col("_span") == "", 1).otherwise(0)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_at", later).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    moment = Window.partitionBy(*keys, "_chunk", "_at")
    running = line.select("*", *[c.over(inside).alias(f"_in_{n}") for n, c in sums.items()], F.max(x).over(moment).alias("_then"))
    chunks = line.groupBy(*keys, "_chunk").agg(*[c.alias(f"_all_{n}") for n, c in sums.items()])
    total = _with_carried(running, _carried(chunks, keys, {f"_before_{n}": F.sum(f"_all_{n}") for n in sums}), keys)

    def whole(name):
        zero = F.lit(0)
        return (F.coalesce(f"_before_{name}", zero) + F.coalesce(f"_in_{name}", zero)).cast("decimal(38,0)")

    of = lambda span, column: F.max(F.when(F.col("_span") == span, column))
    asked = [of(span, whole(n)).alias(f"_{n}_{span}") for span in ("", *spans) for n in sums]
    asked += [of(span, F.col("_then")).alias(f"_lag_{span}") for span in spans]
    met = total.groupBy(*keys, "_origin").agg(F.max("_row").alias("_row"), *asked)
    out = []
    for span in spans:
        n, s, q = (F.col(f"_{c}_") - F.col(f"_{c}_{span}") for c in sums)
        spread = (n * q).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")
        pairs = (n * (n - 1)).cast("double")
        out += [
            n.cast("long").alias(f"n_{span}"),
            F.when(n > 0, s.cast("double") / n.cast("double") / _UNIT).alias(f"mean_{span}"),
            F.when(n > 1, F.sqrt(spread.cast("double") / pairs) / _UNIT).alias(f"std_{span}"),
            (F.col(f"_lag_{span}").cast("double") / _UNIT).alias(f"lag_{span}"),
        ]
    return met.select("_row.*", *out)
