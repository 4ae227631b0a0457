"""Two streams of ready-made counts per domain and window, side by side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import parse_timestamp
from tidemark.operators.payloads import parse_json, quarantine
from tidemark.operators.projections import flatten, pack, require
from tidemark.streaming.joins import join_streams_left

DOMAIN_SCHEMA = "window STRUCT<start STRING, end STRING>, domain STRING, count BIGINT"
#: Where a record holds what is compared.
DOMAIN_PATHS = {"window_start": "window.start", "window_end": "window.end", "domain": "domain", "count": "count"}


def unreadable_counts(records: DataFrame, schema: str = DOMAIN_SCHEMA) -> DataFrame:
    """The records that do not parse, as they came: what ``domain_counts`` leaves out."""
    _, bad = quarantine(parse_json(records, "value", schema))
    return bad.drop("payload")


def domain_counts(records: DataFrame, count_as: str, schema: str = DOMAIN_SCHEMA,
                  paths: Mapping[str, str] = DOMAIN_PATHS) -> DataFrame:
    """Window bounds as timestamps, domain and count; records lacking any of the first three go.

    ``paths`` says where a payload of another ``schema`` has them.  A missing count is null.
    """
    good, _ = quarantine(parse_json(records, "value", schema))
    flat = flatten(good, {count_as if name == "count" else name: f"payload.{path}" for name, path in paths.items()})
    timed = flat.withColumns({c: parse_timestamp(c) for c in ("window_start", "window_end")})
    whole = require(timed, "window_start", "window_end", "domain")
    return pack(whole, "window", start="window_start", end="window_end")


def compare_domains(originals: DataFrame, reshares: DataFrame, delay: str = "2 minutes",
                    original_as: str = "original_count",
                    reshare_as: str = "reshare_count", single: bool = False, schema: str = DOMAIN_SCHEMA,
                    paths: Mapping[str, str] = DOMAIN_PATHS) -> DataFrame:
    """Each original count beside the reshare count of its domain and window, 0 if there is none.

    Unreadable records take no part; ``unreadable_counts`` gives them, or write both kinds
    apart in one pass with ``streaming.output.sort_out`` and compare the readable ones.
    """
    joined = join_streams_left(
        domain_counts(originals, original_as, schema, paths), domain_counts(reshares, reshare_as, schema, paths),
        ["window_start", "window_end", "domain"], original_as, reshare_as,
        "window_end", delay, single=single)
    return joined.select(F.struct(F.col("window_start").alias("start"),
                                  F.col("window_end").alias("end")).alias("window"),
                         "domain", original_as, reshare_as)
