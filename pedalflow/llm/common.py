"""What the text operators share: tables, words and tables written between stages."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the controls tab to carriage return.
GAP_CHARS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text without null, in order; empty for an empty text."""
    bare = F.trim(text, F.lit(GAP_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP, -1))


def picked(docs: DataFrame, *columns: str, **renamed: str) -> DataFrame:
    """Only the named columns, so that no other column of the input can clash with those an operator adds."""
    return docs.select(*[docs[c] for c in columns], *[docs[old].alias(new) for new, old in renamed.items()])


#: Rows that a task holds as Python objects, and hands back, at a time.
PORTION = 500


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in portions, so that neither side of a task holds thousands of long texts at once.

    What Arrow has kept for later goes back to the system when the batches are done.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, PORTION):
            yield batch.slice(at, PORTION)
    pa.default_memory_pool().release_unused()
