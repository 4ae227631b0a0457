"""Posts per hour of the day, estimated from a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.aggregates import expand_estimate, hourly_profile
from tidemark.operators.sampling import sample_uniform


def estimated_hourly_profile(posts: DataFrame, ts: str, key: str, fraction: float = 0.01,
                             seed: int = 42, name: str = "posts") -> DataFrame:
    """Average per hour on a sample, scaled to the whole table, in order of the hour."""
    sample = sample_uniform(posts, key, fraction, seed)
    return expand_estimate(hourly_profile(sample, ts, name), name, fraction).orderBy("hour")
