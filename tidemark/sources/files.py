"""Text, JSON and CSV files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import CORRUPT, with_corrupt_field


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def ddl_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def scan_lines(spark: SparkSession, path: str, name: str = "line") -> DataFrame:
    """One row per line of text."""
    return spark.read.text(path).withColumnRenamed("value", name)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines.

    With a schema nothing is read to plan the scan, and a line that does not fit
    is kept in ``_corrupt_record``.  Without one Spark reads the files once to
    find it.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(with_corrupt_field(as_struct(schema)))
    return reader.json(path)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, keep_corrupt: bool = False, **options: str) -> DataFrame:
    """CSV with declared types; a byte-order mark and CRLF line ends do no harm.

    Types are never guessed: guessing turns an hour of the day into a full
    timestamp.  ``keep_corrupt`` adds the text of lines that do not fit.
    """
    declared = as_struct(schema)
    return (spark.read.schema(with_corrupt_field(declared) if keep_corrupt else declared)
            .options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                     encoding="UTF-8", **options)
            .csv(path))


# How the types of semi-structured values are written, and what they are read as.
VALUE_TYPES = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING", "FLOAT": "DOUBLE", "TINYINT": "BIGINT", "SMALLINT": "BIGINT", "INT": "BIGINT"}


def value_schema(written: str) -> T.DataType:
    """The type to read JSON with, from the merged type of its values.

    Fractions are doubles; what is null throughout, or differs in kind, is text.
    """
    def read_as(found: re.Match) -> str:
        if found[1]:                    # a quoted name
            return found[1]
        return "DOUBLE" if found[2].startswith("DECIMAL") else VALUE_TYPES.get(found[2], found[2])

    types = re.sub(r"(`(?:[^`]|``)*`)|(DECIMAL\(\d+,\s*\d+\)|\b[A-Z]+\b(?!:))", read_as, written)
    return T.DataType.fromDDL(types.replace("STRUCT<>", "STRING"))


def infer_schema(df: DataFrame, column: str, n: int | None = None, order_by: str | None = None,
                 declared: T.StructType | str | None = None) -> T.StructType:
    """Schema of the JSON objects in ``column`` (runs a job).

    All texts are read, so a field that only one of them has is found.  The schema is an
    aggregate: every task merges those of its texts, and only merged schemas are shuffled.
    Texts that are no JSON objects are passed over.  ``n`` asks for a sample instead, the first
    ``n`` by ``order_by``, which then has to be given; a field missing from it is unseen.
    Fields in ``declared`` are added and override what was seen.
    """
    if n is not None and order_by is None:
        raise ValueError("a sample needs order_by, else it differs from run to run")
    texts = df.where(F.col(column).isNotNull())
    sample = texts if n is None else texts.orderBy(order_by).limit(n)
    seen = value_schema(merged_schema(sample, column).first()[0] or "OBJECT<>")
    fields = seen.fields if isinstance(seen, T.StructType) else []
    if declared is None:
        return T.StructType(fields)
    wanted = as_struct(declared)
    return T.StructType([*wanted.fields, *[f for f in fields if f.name not in wanted.fieldNames()]])


def merged_schema(df: DataFrame, column: str) -> DataFrame:
    """One row: the merged type of the JSON objects in ``column`` as Spark writes it, null without any."""
    value = F.try_parse_json(F.col(column).cast("string"))
    is_object = F.schema_of_variant(value).startswith("OBJECT<")
    return df.agg(F.schema_of_variant_agg(F.when(is_object, value)).alias("merged"))
