"""Reading JSON text by a fixed schema."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def wire_schema(kind: DataType) -> DataType:
    """The same nesting with every scalar read as text.

    Feeds disagree on how they write a flag (``true`` or ``1``) or a count (``5`` or ``"5"``). Text accepts all of them
    and :func:`lenient` settles the type.
    """
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, wire_schema(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(wire_schema(kind.elementType))
    return StringType()


def lenient(text: Column, kind: DataType) -> Column:
    """Text as ``kind``; null where it does not fit, never an error."""
    return text if isinstance(kind, StringType) else text.try_cast(kind)


def parse_json(text, schema: StructType) -> Column:
    """JSON text as a struct of texts shaped like ``schema``; broken text gives nulls."""
    text = F.col(text) if isinstance(text, str) else text
    return F.from_json(text.cast("string"), wire_schema(schema), {"mode": "PERMISSIVE"})


def object_keys(text) -> Column:
    """The top-level keys of a JSON object, null for text that is no complete JSON object."""
    text = F.col(text) if isinstance(text, str) else text
    return F.json_object_keys(text.cast("string"))
