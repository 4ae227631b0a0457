"""Null handling and fall-back chains over flat and nested fields."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import as_column


def present(*paths: str) -> Column:
    """Every path is non-null; each parent of a dotted path is checked as well."""
    wanted: list[str] = []
    for path in paths:
        parts = path.split(".")
        wanted += [".".join(parts[:n]) for n in range(1, len(parts) + 1)]
    return reduce(Column.__and__, (F.col(p).isNotNull() for p in dict.fromkeys(wanted)))


def default_to(c: str | Column, value: object) -> Column:
    return F.coalesce(as_column(c), F.lit(value))


def first_filled(columns: Sequence[str | Column], default: str | None = None) -> Column:
    """First text that is neither null nor empty, else ``default``."""
    chain = [F.nullif(as_column(c), F.lit("")) for c in columns]
    return F.coalesce(*chain, F.lit(default))
