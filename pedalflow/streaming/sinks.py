"""Sinks of the streaming jobs."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.channels import trigger_of
from ..sources.summary import write_summary


def start_console(rows: DataFrame, every=None, checkpoint=None) -> StreamingQuery:
    """Print each micro-batch, untruncated."""
    writer = rows.writeStream.format("console").option("truncate", "false").outputMode("append")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(every)).start()


def start_files(rows: DataFrame, path: str, checkpoint: str, every=None) -> StreamingQuery:
    """Append rows to a parquet table, exactly once."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger_of(every)).start()


def show_sorted(label: str, order="window_start"):
    """A batch function that prints the first rows of a batch by time."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"{label}: batch {batch_id}")
        batch.orderBy(order).show(truncate=False)

    return show


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint, across restarts and as long as the checkpoint lives."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def save_summary(path: str, grain: str, fmt="parquet", checkpoint=None):
    """A batch function that writes each batch to a folder of its own.

    The folder is named by the id of the query and the batch number, so a batch that is run again after a failure
    replaces its first attempt instead of adding its rows twice, and a new checkpoint, which counts batches from 0
    again, replaces nothing.
    """

    run = []  # the id never changes while the checkpoint lives, and is not there before the query starts

    def save(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(query_id(batch.sparkSession, checkpoint) if checkpoint else "batch")
        write_summary(batch, path, fmt, grain, batch_id, run[0])

    return save


def start_batches(rows: DataFrame, functions, checkpoint: str, every=None) -> StreamingQuery:
    """Give each non-empty micro-batch to all ``functions``, each called with the batch and its number.

    One query serves any number of outputs: sources are read and state is kept once. The batch is kept until all are
    done with it, or else each of them, and the check for rows, would run the stateful plan again.
    """
    functions = list(functions)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                for function in functions:
                    function(batch, batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(handle).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_of(every)).start()


def start_summary_sink(
    summary: DataFrame, path: str, checkpoint: str, grain: str, fmt="parquet", every=None, also=()
) -> StreamingQuery:
    """Write a summary stream to its dataset; ``also`` are further batch functions, such as :func:`show_sorted`."""
    return start_batches(summary, [save_summary(path, grain, fmt, checkpoint), *also], checkpoint, every)
