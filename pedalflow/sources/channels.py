"""Keyed messages in Kafka topics, or in folders of parquet files with the same columns.

The Kafka connector is a package of its own (``spark-sql-kafka-0-10``) that the cluster has to provide. A file channel
behaves the same for all functions here.
"""

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import DEFAULT_BROKER
from ..schemas import MESSAGE

KAFKA = "kafka"
FILES = "files"


@dataclass(frozen=True)
class Channel:
    """Where one kind of message lives. ``place`` is a topic or a folder; ``options`` go to the reader and writer."""

    kind: str
    place: str
    options: Mapping[str, str] = field(default_factory=dict)


def kafka_channel(topic: str, broker=DEFAULT_BROKER, **options) -> Channel:
    return Channel(KAFKA, topic, {"kafka.bootstrap.servers": broker, **options})


def file_channel(folder: str, **options) -> Channel:
    return Channel(FILES, folder, options)


def kafka_read_options(channel: Channel, streaming: bool) -> dict:
    """Reader options of a topic. A stream goes on when Kafka has already aged out messages it had not read."""
    defaults = {"failOnDataLoss": "false"} if streaming else {}
    return {**defaults, **channel.options, "subscribe": channel.place}


def _load(reader, channel, streaming):
    if channel.kind == KAFKA:
        loaded = reader.format("kafka").options(**kafka_read_options(channel, streaming)).load()
        return loaded.select(*MESSAGE.names)
    return reader.schema(MESSAGE).options(**channel.options).parquet(channel.place)


def read_messages(spark: SparkSession, channel: Channel) -> DataFrame:
    """Everything in the channel now."""
    return _load(spark.read, channel, streaming=False)


def stream_messages(spark: SparkSession, channel: Channel) -> DataFrame:
    """The channel as a stream. Limit a micro-batch by ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``."""
    return _load(spark.readStream, channel, streaming=True)


def _file_rows(messages: DataFrame) -> DataFrame:
    """Add what a broker would: publish time, and a number that orders messages published together.

    A stream leaves the number out, since Spark has no running number for streams; its batches differ in time.
    """
    number = F.lit(None).cast("long") if messages.isStreaming else F.monotonically_increasing_id()
    missing = {"timestamp": F.current_timestamp(), "offset": number}
    return messages.withColumns({c: v for c, v in missing.items() if c not in messages.columns}).select(*MESSAGE.names)


def write_messages(messages: DataFrame, channel: Channel) -> None:
    """Append encoded messages to the channel."""
    if channel.kind == KAFKA:
        writer = messages.select("key", "value").write.format("kafka").options(**channel.options)
        writer.option("topic", channel.place).save()
    else:
        _file_rows(messages).write.mode("append").parquet(channel.place)


def trigger_of(every=None) -> dict:
    """Run every ``every``, or once over all that is there now."""
    return {"processingTime": every} if every else {"availableNow": True}


def start_messages(messages: DataFrame, channel: Channel, checkpoint: str, every=None) -> StreamingQuery:
    """Publish a stream of encoded messages, every ``every`` or once over what is there."""
    if channel.kind == KAFKA:
        writer = messages.select("key", "value").writeStream.format("kafka").options(**channel.options)
        writer = writer.option("topic", channel.place)
    else:
        writer = _file_rows(messages).writeStream.format("parquet").option("path", channel.place)
    return writer.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger_of(every)).start()
