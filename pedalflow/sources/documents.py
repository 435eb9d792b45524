"""Feed documents that a downloader has landed as files.

The time a file landed comes along as ``landed_at``; as ingest time it makes a repeated run give the same rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(reader, path, whole):
    return reader.text(path, wholetext=whole).select(
        "value", F.col("_metadata.file_modification_time").alias("landed_at")
    )


def read_documents(spark: SparkSession, path: str, whole=True) -> DataFrame:
    """One row per document: a file each, or with ``whole=False`` a line each."""
    return _documents(spark.read, path, whole)


def stream_documents(spark: SparkSession, path: str, whole=True, files_per_batch=None) -> DataFrame:
    """The same for documents that keep landing."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _documents(reader, path, whole)
