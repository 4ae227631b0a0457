"""Every operator as a query on the given tables, with the SQL it must agree with."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

FAMILIES = ("sources", "projections", "joins", "aggregates", "ranking", "sets", "sampling",
            "graph", "texts", "streams")


class Entry(NamedTuple):
    run: Query
    sql: str | None
    covers: tuple[str, ...]


class QueryBook:
    """Queries of one family, in the order written."""

    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def query(self, covers: str, sql: str | None = None, name: str | None = None):
        """Register the decorated function for the operators ``covers`` names."""
        def add(run: Query) -> Query:
            key = name or run.__name__
            if key in self.entries:
                raise ValueError(f"query {key} is registered twice")
            self.entries[key] = Entry(run, sql, tuple(covers.split()))
            return run
        return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def all_entries() -> dict[str, Entry]:
    entries: dict[str, Entry] = {}
    for family in FAMILIES:
        book = importlib.import_module(f"tidemark.registry.{family}").book
        clash = entries.keys() & book.entries.keys()
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        entries.update(book.entries)
    return entries


def pinned(run: Query) -> Query:
    """The query, on a session with the settings it relies on."""
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(pin_session(spark), sf_dir)
    call.__name__ = run.__name__
    call.__doc__ = run.__doc__
    return call
