"""How many rows were accepted, and why the others were not."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import has_text
from .decode import CORRUPT

LOADED = "loaded"


def station_info_rules():
    return {"no_station_id": ~has_text("station_id"), "no_capacity": F.col("capacity").isNull()}


def station_status_rules():
    return {"no_station_id": ~has_text("station_id")}


def message_rules(key_col="station_id"):
    """Rules for rows decoded with ``keep_corrupt=True``."""
    return {"corrupt": F.col(CORRUPT).isNotNull(), "no_key": ~has_text(key_col)}


def outcome(rules: dict) -> Column:
    """The name of the first rule a row breaks, ``loaded`` if none."""
    return reduce(lambda rest, rule: F.when(rule[1], rule[0]).otherwise(rest), reversed(rules.items()), F.lit(LOADED))


def audit_counts(rows: DataFrame, rules: dict) -> DataFrame:
    """Rows per outcome, counted in one pass."""
    return rows.groupBy(outcome(rules).alias("outcome")).agg(F.count("*").alias("n"))


def observe_counts(rows: DataFrame, name: str, rules: dict) -> DataFrame:
    """The rows unchanged, with the same counts taken on the way.

    The counts appear under ``name`` in the progress of a streaming query and cost no extra pass.
    """
    found = outcome(rules)
    return rows.observe(name, *[F.count_if(found == kind).alias(kind) for kind in (LOADED, *rules)])
