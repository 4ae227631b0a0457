"""Row hashes that do not depend on partitioning, run or engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import as_column

# Fixed value: the hash is read as a number below 2^32.
HASH_RANGE = 4294967296


def hash_point(key: str | Column, seed: int) -> Column:
    """A number in [0, 2^32) drawn from the key and the seed."""
    text = F.concat_ws(":", as_column(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_threshold(fraction: str | float | Column) -> Column:
    """The hash point below which a row is kept; null, so no row, for a null fraction."""
    share = F.lit(float(fraction)) if isinstance(fraction, (int, float)) else as_column(fraction)
    capped = F.when(share > 1.0, F.lit(1.0)).otherwise(share)
    return F.floor(capped * F.lit(float(HASH_RANGE))).cast("bigint")


def hash_sum(hashed: Column) -> Column:
    """Sum of row hashes as a whole number wide enough never to wrap; 0 without rows.

    Unlike an exclusive or, rows that occur in pairs do not cancel out.
    """
    return F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def row_checksum(columns: Sequence[str]) -> Column:
    """Order-free checksum of a table; always read together with a row count."""
    return hash_sum(F.xxhash64(*columns))
