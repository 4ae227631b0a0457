"""Dates, hours and event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import as_column

# Fixed value: how a day is written out.
DAY_FORMAT = "MM-dd-yy"


def hour_of(c: str | Column) -> Column:
    return F.hour(as_column(c))


def day_of(c: str | Column) -> Column:
    """Real date; unlike the written form it sorts in time order across years."""
    return F.to_date(as_column(c))


def day_text(c: str | Column) -> Column:
    return F.date_format(as_column(c), DAY_FORMAT)


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """Timestamp from text, null where the text is no timestamp."""
    return F.try_to_timestamp(as_column(c), F.lit(fmt)) if fmt else F.try_to_timestamp(as_column(c))


def date_and_time(day: str | Column, clock: str | Column) -> Column:
    """One timestamp from a date column and an ``HH:mm`` text column."""
    return F.try_to_timestamp(F.concat_ws(" ", as_column(day).cast("string"), as_column(clock)),
                              F.lit("yyyy-MM-dd HH:mm"))


def event_time(c: str | Column) -> Column:
    """Zoned timestamp, the only kind a watermark accepts."""
    return as_column(c).cast("timestamp")


def plain_time(c: str | Column) -> Column:
    """Zone-free timestamp for output."""
    return as_column(c).cast("timestamp_ntz")
