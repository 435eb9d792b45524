"""From message and document text to typed rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.parsing import lenient, object_keys, parse_json

CORRUPT = "_corrupt_record"


def _typed(record: str, schema: StructType):
    return [lenient(F.col(record)[f.name], f.dataType).alias(f.name) for f in schema.fields]


def decode_messages(messages: DataFrame, schema: StructType, columns=None, keep=(), keep_corrupt=False) -> DataFrame:
    """Parse the ``value`` of each message and flatten it to the columns of ``schema``.

    A field that does not fit its type becomes null, a value that is no JSON gives a row of nulls. ``columns`` limits
    the fields that are taken out of the text. ``keep`` names envelope columns to carry along (say ``timestamp`` and
    ``offset``); one that has the name of a field becomes ``message_<name>``. ``keep_corrupt`` adds a column with the text of broken values.

    The fields come out of a generator: no later filter can be pushed through it, which would parse the text once more
    for the filter.
    """
    fields = [f for f in schema.fields if columns is None or f.name in columns]
    value = F.col("value").cast("string")
    broken = [F.when(object_keys("value").isNull(), value).alias(CORRUPT)] if keep_corrupt else []
    names = [f.name for f in fields]
    kept = [f"message_{c}" if c in names else c for c in keep]
    carried = [F.col(c).alias(name) for c, name in zip(keep, kept, strict=True)]
    texts = messages.select(*carried, *broken, F.json_tuple(value, *names).alias(*names))
    typed = [lenient(F.col(f.name), f.dataType).alias(f.name) for f in fields]
    return texts.select(*kept, *typed, *([CORRUPT] if keep_corrupt else []))


def explode_stations(documents: DataFrame, schema: StructType, keep=(), document="value") -> DataFrame:
    """One row per element of ``data.stations`` in each station document.

    A missing, broken or empty document gives no rows.
    """
    station_list = StructType([StructField("stations", ArrayType(schema))])
    parsed = parse_json(document, StructType([StructField("data", station_list)]))
    return (
        documents.select(*keep, parsed.alias("document"))
        .select(*keep, F.explode("document.data.stations").alias("station"))
        .select(*keep, *_typed("station", schema))
    )
