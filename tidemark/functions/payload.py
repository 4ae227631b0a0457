"""JSON text in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_column

CORRUPT = "_corrupt_record"


def json_field(c: str | Column, field: str) -> Column:
    """Text of one field, by dotted path; null for bad JSON or a missing field."""
    return F.get_json_object(as_column(c), f"$.{field}")


def with_corrupt_field(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def json_struct(c: str | Column, schema: T.StructType | str) -> Column:
    """Typed struct of a JSON text; a text that does not fit lands in ``_corrupt_record``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return F.from_json(as_column(c), with_corrupt_field(schema),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
