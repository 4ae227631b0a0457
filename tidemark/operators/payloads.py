"""Parsing JSON payload columns and setting bad rows aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_column
from tidemark.functions.payload import CORRUPT, json_struct


def parse_json(df: DataFrame, column: str, schema: T.StructType | str,
               into: str = "payload", bad: str = "bad") -> DataFrame:
    """Add the parsed payload and a flag for rows that did not parse.

    A missing payload is bad as well: neither kind can pass for a row whose
    fields merely are null.
    """
    payload = json_struct(as_column(column).cast("string"), schema)
    # Exploding an array of one keeps later filters above the parser.  Pushed below
    # it they would each parse the text again.
    parsed = df.withColumn(into, F.explode(F.array(payload)))
    return parsed.withColumn(bad, F.col(into).isNull() | F.col(f"{into}.{CORRUPT}").isNotNull())


def quarantine(parsed: DataFrame, bad: str = "bad") -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into (good, bad)."""
    return parsed.where(~F.col(bad)).drop(bad), parsed.where(F.col(bad)).drop(bad)
