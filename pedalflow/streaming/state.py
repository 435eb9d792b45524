"""What a stream holds between its batches, read from its checkpoint."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a stream with their stores and the batches that can be looked at."""
    known = spark.read.format("state-metadata").load(checkpoint)
    return known.select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )


def state_keys(spark: SparkSession, checkpoint: str, operator_id=0, batch_id=None) -> DataFrame:
    """The keys that an aggregation or a removal of duplicates holds after its last batch, or after ``batch_id``.

    Those of an aggregation are its open windows: windows that are final are gone. The checkpoint is only read.
    """
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*")


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows held per operator and store after the last batch: what has to stay small while a stream runs.

    The list of operators comes from the plan of the stream, a few rows at any size.
    """
    counted = None
    for row in state_stores(spark, checkpoint).collect():
        reader = spark.read.format("statestore").option("operatorId", row["operator_id"]).option("storeName", row["store"])
        own = reader.load(checkpoint).agg(F.count("*").alias("rows"))
        own = own.select(F.lit(row["operator_id"]).alias("operator_id"), F.lit(row["operator"]).alias("operator"), F.lit(row["store"]).alias("store"), "rows")
        counted = own if counted is None else counted.unionByName(own)
    if counted is None:
        return spark.createDataFrame([], "operator_id long, operator string, store string, rows long")
    return counted
