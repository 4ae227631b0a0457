"""Joining two streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_streams_left(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str,
                      right_value: str, event_time: str = "window_end", delay: str = "2 minutes",
                      right_as: str | None = None, fill: int = 0,
                      single: bool = False, salts: int = 1, salt_by: Sequence[str] = ()) -> DataFrame:
    """Every left row with the matching right value, ``fill`` where there is none.

    ``keys`` must contain ``event_time``.  A left row without a match comes out
    once the watermark (the slower stream's latest event time less ``delay``) has
    passed it; a right row later than that no longer counts.

    Several right rows of one key repeat the left row; ``single`` keeps the
    largest value per key on both sides instead.

    ``salts`` spreads the left rows of a key over that many tasks and states, by a hash of the
    columns ``salt_by``, and sends every right row to all of them: for few right rows per
    key and keys with a large share of the left rows, as nothing splits these at run time in
    a stream.  A left row lies in one of them, so it still comes out unmatched once at most.
    """
    name = right_as or right_value
    keys = list(keys)
    if event_time not in keys:
        raise ValueError(f"{event_time} has to be one of the join keys, else state is never dropped")
    left = left.withWatermark(event_time, delay)
    right = right.select(*keys, F.col(right_value).alias("_value")).withWatermark(event_time, delay)
    if single:
        left = left.groupBy(*keys).agg(F.max(value).alias(value))
        right = right.groupBy(*keys).agg(F.max("_value").alias("_value"))
    columns = left.columns
    if salts > 1:
        if not salt_by:
            raise ValueError("salts need columns whose hash tells the left rows of a key apart")
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append("_salt")
    right = right.select(*(F.col(k).alias(f"_right{k}") for k in keys), "_value")
    matches = [F.col(k) == F.col(f"_right{k}") for k in keys]
    return (left.join(right, matches, "leftOuter")
            .select(*columns, F.coalesce("_value", F.lit(fill)).alias(name)))
