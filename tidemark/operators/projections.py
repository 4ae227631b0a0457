"""Selecting, guarding, flattening and packing columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_column
from tidemark.functions.nested import present


def where(df: DataFrame, condition: Column | str, *columns: str | Column) -> DataFrame:
    """Rows that meet ``condition``; given columns only, or all."""
    kept = df.where(condition)
    return kept.select(*columns) if columns else kept


def flatten(df: DataFrame, paths: Mapping[str, str], keep: bool = False) -> DataFrame:
    """Nested paths as flat columns, ``{"name": "place.name"}``; ``keep`` retains the rest."""
    flat = [F.col(path).alias(name) for name, path in paths.items()]
    return df.select(*([F.col("*")] if keep else []), *flat)


def with_derived(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns plus the given ones."""
    return df.withColumns(columns)


def require(df: DataFrame, *paths: str) -> DataFrame:
    """Rows in which every path and each of its parents is non-null."""
    return df.where(present(*paths))


def originals(df: DataFrame, reshare_of: str | Column) -> DataFrame:
    """Posts that reshare nothing."""
    return df.where(as_column(reshare_of).isNull())


def renamed(df: DataFrame, **names: str) -> DataFrame:
    """``renamed(df, old="new")``."""
    return df.withColumnsRenamed(names)


def pack(df: DataFrame, into: str, **fields: str) -> DataFrame:
    """Add a struct column made of flat columns, which stay."""
    return df.withColumn(into, F.struct(*(F.col(c).alias(f) for f, c in fields.items())))
