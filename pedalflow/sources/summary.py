"""The usage summary at rest: parquet or CSV below ``grain=<window length>``, or one plain CSV file.

Each batch is a folder ``run=<name>/batch_id=<n>`` that counts from the moment its entry is published (see ``ledger``);
``compact_summary`` turns many of them into one folder, a generation.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import USAGE_SUMMARY
from . import ledger

# Zone-less text, as spreadsheet users and other readers of the file expect it.
_CSV_TIME = "yyyy-MM-dd HH:mm:ss"


def grain_name(grain: str) -> str:
    return grain.strip().replace(" ", "_")


def _has_grains(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(f"{path}/grain=*")
    except AnalysisException:
        return False
    return True


def _save(rows: DataFrame, target: str, fmt: str) -> None:
    """Small batches are packed into few files and large ones spread over many, by the size of the rows."""
    writer = rows.hint("rebalance").write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", _CSV_TIME)
    writer.save(target)


def _loader(reader, fmt: str):
    reader = reader.schema(USAGE_SUMMARY).format(fmt)
    return reader.option("header", True) if fmt == "csv" else reader


def write_summary(summary: DataFrame, path: str, fmt="parquet", grain=None, batch_id=0, run="batch") -> None:
    """Write one batch; writing the same batch of the same run again replaces it, and nothing else.

    ``run`` keeps apart what numbers its batches from 0 anew: each stream query has its own, batch jobs share ``batch``.
    Without ``grain`` the whole ``path`` is that batch; a dataset with grains is then refused.
    """
    spark = summary.sparkSession
    if grain is None:
        if _has_grains(spark, path):
            raise ValueError(f"{path} holds summaries by grain; name the grain to add to them")
        _save(summary, path, fmt)
    else:
        folder = f"grain={grain_name(grain)}/run={run}/batch_id={batch_id}"
        _save(summary, f"{path}/{folder}", fmt)
        ledger.publish(spark, path, ledger.Entry(grain_name(grain), folder))


def read_summary(spark: SparkSession, path: str, fmt="parquet", grain=None) -> DataFrame:
    """Read a summary by its fixed schema; with ``grain`` only the folders of that window length are read.

    A dataset with several window lengths is no single table: without ``grain`` it is an error. Where entries are
    published, only the folders that count are read.
    """
    published = ledger.entries(spark, path, grain and grain_name(grain))
    reader = _loader(spark.read, fmt)
    if published:
        rows = reader.option("basePath", path).load([f"{path}/{e.folder}" for e in ledger.live(published)])
    else:
        rows = reader.load(path)
    if grain is not None:
        rows = rows.where(F.col("grain") == grain_name(grain))
    elif "grain" in rows.columns and rows.select("grain").distinct().limit(2).count() > 1:
        raise ValueError(f"{path} holds summaries of several window lengths; name one as grain")
    return rows.select(*USAGE_SUMMARY.names)


def stream_summary(spark: SparkSession, path: str, grain: str, fmt="parquet", **options) -> DataFrame:
    """The batches of a summary dataset as a stream, in the order they were written; generations are no new rows.

    Limit a micro-batch by ``maxFilesPerTrigger``. The files of a batch are seen as they are written, so let the job that
    writes and the one that reads meet only in whole batches: a batch that fails and is written again is read again.
    """
    reader = _loader(spark.readStream, fmt).options(**options)
    return reader.load(f"{path}/grain={grain_name(grain)}/{ledger.BATCHES}").select(*USAGE_SUMMARY.names)


def compact_summary(spark: SparkSession, path: str, grain: str, fmt="parquet", least=2) -> int:
    """Rewrite the batches of a grain as one generation of few files; the number of folders it replaces.

    Readers see either the batches or the generation, never both. Streams go on writing meanwhile.
    """

    def read(folders):
        return _loader(spark.read, fmt).load([f"{path}/{f}" for f in folders]).select(*USAGE_SUMMARY.names)

    return ledger.compact(spark, path, grain_name(grain), read, lambda rows, folder: _save(rows, f"{path}/{folder}", fmt), least)


def expire_summary(spark: SparkSession, path: str, grain: str, age_seconds: float) -> int:
    """Delete the folders that a generation replaced more than ``age_seconds`` ago; the number of them."""
    return ledger.expire(spark, path, grain_name(grain), age_seconds)
