"""Messages taken in with a verdict: what was accepted, what was rejected and why, and what came too late.

Each micro-batch writes one folder with a sub-folder per outcome, so accepted, rejected and late rows add up to the
messages of the batch, and rejected ones keep their raw text. The folder is replaced if the batch is run again.

A row is late if its window was final before its batch began. A batch notes the greatest event time so far; the one
after it takes its watermark from that note, as Spark moves its own between batches, so a batch that is run again judges
as it did before.
"""

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..constants import DELAY_30M, GRAIN_30M
from ..functions.clock import plausible
from ..operators.audit import LOADED, message_rules, outcome
from ..operators.decode import CORRUPT, decode_messages
from ..operators.usage import with_event_time
from ..sources.channels import Channel, stream_messages, trigger_of

LATE = "late"


def _micros(interval: str) -> Column:
    return F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {interval})")


def judged(messages: DataFrame, schema, key_col: str, watermark_seconds=None, grain=GRAIN_30M) -> DataFrame:
    """Decoded messages with ``event_time``, their ``raw`` text and an ``outcome``.

    Outcomes are those of ``message_rules``, ``bad_time`` for a time that is missing or far ahead of the message's own,
    ``late`` for rows of windows that were final at ``watermark_seconds``, and ``loaded``.
    """
    raw = messages.withColumn("raw", F.col("value").cast("string"))
    rows = with_event_time(decode_messages(raw, schema, keep=["timestamp", "raw"], keep_corrupt=True))
    sent = next(c for c in ("message_timestamp", "timestamp") if c in rows.columns)
    rows = rows.withColumn("event_time", plausible("event_time", sent))
    rules: dict[str, Column] = {**message_rules(key_col), "bad_time": F.col("event_time").isNull()}
    if watermark_seconds is not None:
        # Windows begin at multiples of their length. The window function itself would drop rows without a time.
        length = _micros(grain)
        end = (F.floor(F.unix_micros("event_time") / length) + 1) * length
        rules[LATE] = end <= F.lit(int(watermark_seconds * 1_000_000))
    kept = [f.name for f in schema.fields]
    return rows.select(*kept, "event_time", "raw", outcome(rules).alias("outcome")).drop(CORRUPT)


def _noted(spark: SparkSession, notes: str, batch_id: int):
    """The greatest event time before a batch, in epoch seconds; None before any."""
    if batch_id == 0:
        return None
    return json.loads(spark.read.text(f"{notes}/batch_id={batch_id - 1}").first()[0])["greatest"]


def start_intake_job(
    spark: SparkSession, channel: Channel, schema, key_col: str, path: str, checkpoint: str, delay=DELAY_30M, grain=GRAIN_30M, every=None
) -> StreamingQuery:
    """Write the judged messages of a channel to ``path``, with ``outcome`` and ``batch_id`` as folders."""
    notes = f"{checkpoint}/intake"

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = _noted(session, notes, batch_id)
        wait = session.range(1).select(_micros(delay)).first()[0] / 1e6
        rows = judged(batch, schema, key_col, None if before is None else before - wait, grain)
        seen = Observation()
        timed = F.when(F.col("outcome").isin(LOADED, LATE), F.col("event_time"))
        rows = rows.observe(seen, F.unix_micros(F.max(timed)).alias("greatest"))
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch_id={batch_id}")
        now = seen.get["greatest"]
        greatest = max((s for s in (before, None if now is None else now / 1e6) if s is not None), default=None)
        note = session.createDataFrame([(json.dumps({"greatest": greatest}),)], "value string")
        note.coalesce(1).write.mode("overwrite").text(f"{notes}/batch_id={batch_id}")

    writer = stream_messages(spark, channel).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(every)).start()


def read_intake(spark: SparkSession, path: str, schema) -> DataFrame:
    """All judged rows; ``where("outcome = 'loaded'")`` reads the folders of accepted rows only."""
    shape = StructType(list(schema.fields)).add("event_time", "timestamp").add("raw", "string").add("outcome", "string").add("batch_id", "long")
    return spark.read.schema(shape).parquet(path)
