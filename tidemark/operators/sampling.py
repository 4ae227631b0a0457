"""Uniform and stratified samples.

The default is a hash sample: a row is kept when the hash of its key and the
seed falls below a threshold.  The same rows come out on any number of
partitions and after any retry.  ``native`` is Spark's own sampler, whose choice
depends on how the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import hash_point, hash_threshold
from tidemark.functions.numbers import floor_to


def sample_uniform(df: DataFrame, key: str | Column, fraction: float, seed: int = 42,
                   mode: str = "hash") -> DataFrame:
    """About ``fraction`` of the rows, without replacement.

    ``key`` should differ from row to row: rows of one key stay or go together.
    """
    if mode == "native":
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    if mode != "hash":
        raise ValueError(f"unknown sampling mode {mode!r}")
    return df.where(hash_point(key, seed) < hash_threshold(fraction))


def strata_fractions(ratios: DataFrame, stratum: str, ratio: str, name: str = "fraction",
                     floor_decimals: int | None = 2) -> DataFrame:
    """Fraction per stratum that levels every ratio down to the smallest one.

    The smallest ratio is floored first, so the smallest stratum may get
    slightly less than 1; pass ``None`` for exactly 1.  It enters as a scalar
    subquery: one number, no join.
    """
    low = F.min(ratio)
    low = low if floor_decimals is None else floor_to(low, floor_decimals)
    smallest = ratios.agg(low.alias("smallest")).scalar()
    return ratios.select(stratum, F.try_divide(smallest, F.col(ratio)).alias(name))


def sample_stratified(df: DataFrame, stratum: str, fractions: DataFrame | Mapping[object, float],
                      key: str | Column | None = None, seed: int = 42,
                      fraction: str = "fraction", mode: str = "hash") -> DataFrame:
    """Sample each stratum at its own fraction; strata without one are dropped.

    ``fractions`` is a table with one row per stratum, or a mapping; ``native`` takes a
    mapping only.  The hash mode needs ``key``.  Pass a staged table
    (``tidemark.scratch.stage``): its size is then known, and below the broadcast
    threshold the big table is not shuffled at all.  A larger one is joined by
    shuffle, with skewed strata split at run time.
    """
    if mode == "native":
        if isinstance(fractions, DataFrame):
            raise ValueError("the native mode takes fractions as a mapping; collect a small table yourself")
        return df.sampleBy(stratum, fractions=dict(fractions), seed=seed)
    if mode != "hash":
        raise ValueError(f"unknown sampling mode {mode!r}")
    if key is None:
        raise ValueError("the hash mode needs a key that tells rows apart")
    if not isinstance(fractions, DataFrame):
        schema = T.StructType([T.StructField(stratum, df.select(stratum).schema[0].dataType),
                               T.StructField(fraction, T.DoubleType())])
        fractions = df.sparkSession.createDataFrame([(s, float(f)) for s, f in fractions.items()], schema)
    limits = fractions.select(F.col(stratum), hash_threshold(fraction).alias("_limit"))
    return (df.join(limits, stratum, "inner")
            .where(hash_point(key, seed) < F.col("_limit"))
            .select(*df.columns))
