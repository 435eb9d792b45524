"""Session settings and the shared folder for tables written between stages."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: For clusters whose executors have not reported yet.
LEAST_STATE_PARTITIONS = 8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(name="pedalflow", master=None, shuffle_partitions=None, rocksdb=False, **conf) -> SparkSession:
    """A session with the settings the engine relies on.

    The zone is UTC, so hours, weekdays and zone-less text do not depend on the machine. ``rocksdb`` keeps streaming
    state off the JVM heap, writes only its changes to the checkpoint and gives a stream join one store per partition
    instead of four; use it when windows times keys outgrow executor memory. Further settings go in as keywords with
    ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
        settings["spark.sql.streaming.join.stateFormatVersion"] = "3"
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    A machine-local folder stands in only where the session itself is local and the setting is missing.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="/tmp/run-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The result has no lineage beyond its files: it survives lost executors without a rebuild, each later scan reads only
    the columns it needs, and file sizes give the optimizer real statistics.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def state_partitions(spark: SparkSession, count: int):
    """Start streaming queries inside this block to give their state ``count`` partitions.

    Each partition of a stateful query opens, commits and maintains its own state stores in every micro-batch, and the
    number is fixed by the first start. State holds one row per window and key, so it needs far fewer partitions than
    the shuffles of a batch job.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, count)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_state_partitions(spark: SparkSession):
    """:func:`state_partitions` with one for each core, or fewer if the session's shuffles have fewer.

    The shuffles of a job follow the size of its input; what it costs to open and commit state stores must not.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return state_partitions(spark, min(now, max(LEAST_STATE_PARTITIONS, spark.sparkContext.defaultParallelism)))
