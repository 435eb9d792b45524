"""Which folders of a dataset count: one small file for each folder, published when the folder is complete.

A reader takes the folders that published entries name, less those that a published generation replaces. An entry is
written under another name first and then renamed, so it appears whole or not at all, and a generation becomes visible
in the same moment as what it replaces goes. Whatever failed before its entry was published is not there for readers.

Generations are numbered and never overwritten: of two compactions that start from the same state, one is refused. That
relies on a file system whose rename does not overwrite, as HDFS; on an object store let one job compact at a time.
"""

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: The folders of batches below a grain, without those of generations.
BATCHES = "run=[^~]*/batch_id=*"
_LEDGER = "_ledger"
_ENTRY = "grain string, folder string, generation long, replaces array<string>"


@dataclass(frozen=True)
class Entry:
    """A folder below the dataset; a generation stands for the folders it replaces."""

    grain: str
    folder: str
    generation: int = 0
    replaces: tuple[str, ...] = ()


class _Files:
    """The file system a path lies on, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        configuration = spark._jsc.hadoopConfiguration()
        self._system = self._path(path).getFileSystem(configuration)
        self._context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._system.getUri(), configuration)
        self._options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def names(self, folder: str) -> dict[str, int]:
        """The names in a folder with their times in seconds; empty where there is none."""
        if not self._system.exists(self._path(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() // 1000 for s in self._system.listStatus(self._path(folder))}

    def write_new(self, path: str, content: bytes) -> bool:
        """Write a file that appears whole; false if there is one already."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self._system.create(self._path(draft))
        stream.write(content)
        stream.close()
        if self._system.exists(self._path(path)):
            self.delete(draft)
            return False
        try:
            self._context.rename(self._path(draft), self._path(path), self._options)
        except Exception as error:
            self.delete(draft)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def _name(entry: Entry) -> str:
    if entry.generation:
        return f"{entry.grain}-generation-{entry.generation:09d}.json"
    return f"{entry.folder.replace('/', '-').replace('=', '-')}.json"


def publish(spark: SparkSession, path: str, entry: Entry) -> bool:
    """Make a complete folder visible; false if its entry, or its number of generation, is there already."""
    content = json.dumps({**entry.__dict__, "replaces": list(entry.replaces)}).encode()
    return _Files(spark, path).write_new(f"{path}/{_LEDGER}/{_name(entry)}", content)


def entries(spark: SparkSession, path: str, grain=None) -> list[Entry]:
    """All published entries, of one grain or of all; a list as long as the number of batches since the last ``expire``."""
    if not any(n.endswith(".json") for n in _Files(spark, path).names(f"{path}/{_LEDGER}")):
        return []
    rows = spark.read.schema(_ENTRY).json(f"{path}/{_LEDGER}/*.json").collect()
    found = [Entry(r["grain"], r["folder"], r["generation"], tuple(r["replaces"])) for r in rows]
    return sorted((e for e in found if grain in (None, e.grain)), key=lambda e: (e.generation, e.folder))


def live(published: list[Entry]) -> list[Entry]:
    """The entries that count now."""
    replaced = {folder for e in published for folder in e.replaces}
    return [e for e in published if e.folder not in replaced]


def compact(spark: SparkSession, path: str, grain: str, read, write, least=2) -> int:
    """Rewrite the live folders of a grain as one generation; the number of folders it replaces, 0 if there was no need.

    ``read`` gives the rows of some folders and ``write`` puts rows into a new one. Batches that are published meanwhile
    stay as they are. Fewer than ``least`` live folders are left alone.
    """
    published = entries(spark, path, grain)
    now = live(published)
    if len(now) < least:
        return 0
    number = 1 + max(e.generation for e in published)
    # Laid out like a batch, under a name that BATCHES leaves out.
    folder = f"grain={grain}/run=~generation-{number}/batch_id={uuid.uuid4().hex}"
    rows: DataFrame = read([e.folder for e in now])
    write(rows, folder)
    if not publish(spark, path, Entry(grain, folder, number, tuple(e.folder for e in now))):
        raise RuntimeError(f"generation {number} of {grain} is there already; another compaction was faster")
    return len(now)


def expire(spark: SparkSession, path: str, grain: str, age_seconds: float) -> int:
    """Delete folders replaced longer ago than any reader runs, and their entries; the number of folders deleted.

    The generation's entry stays and goes on naming what it replaces, so a batch that is written again after that, by a
    stream that had not yet noted it as done, still does not count.
    """
    files, published = _Files(spark, path), entries(spark, path, grain)
    times = files.names(f"{path}/{_LEDGER}")
    gone = 0
    for generation in published:
        if not generation.generation or times[_name(generation)] > time.time() - age_seconds:
            continue
        for old in published:
            if old.folder in generation.replaces and not old.generation:
                files.delete(f"{path}/{_LEDGER}/{_name(old)}")
                files.delete(f"{path}/{old.folder}")
                gone += 1
            elif old.folder in generation.replaces and files.names(f"{path}/{old.folder}"):
                files.delete(f"{path}/{old.folder}")
                gone += 1
    return gone
