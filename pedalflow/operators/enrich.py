"""Station metadata for status rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(names):
    return [names] if isinstance(names, str) else list(names)


def latest_by_key(rows: DataFrame, key, order) -> DataFrame:
    """The row with the greatest ``order`` for each ``key``.

    A maximum over the whole row reduces each input task to one row per key before the shuffle, so a key with very many
    versions costs no more than another, and ties fall the same way under any layout.
    """
    key, order = _names(key), _names(order)
    rest = [c for c in rows.columns if c not in key and c not in order]
    newest = rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("newest"))
    return newest.select(*key, "newest.*").select(*rows.columns)


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join of a large table or stream with a stored lookup table that has one row per key.

    The files of the lookup tell its size, so the optimizer broadcasts it only where that is safe; otherwise both sides
    are shuffled and adaptive execution splits the partitions of hot keys, in a batch and in a stateless stream alike.
    It can split only what several input tasks have read: let a topic with a hot partition be read in several pieces by
    giving its channel the option ``minPartitions``.
    """
    return facts.join(lookup, key, "left")


def enrich_status(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Add station columns to status rows; rows of unknown stations stay.

    ``stations`` must have one row per station (see :func:`latest_by_key`), otherwise status rows multiply. It should be
    a stored snapshot: its size is then known, a stream reads it again in each micro-batch, and adaptive execution can
    only split hot keys where both sides come straight out of a shuffle, not out of an aggregation.
    """
    return lookup_join(status, stations, "station_id")
