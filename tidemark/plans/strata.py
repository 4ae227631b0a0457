"""Sampling places so that posts per unit of capacity come out level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import counts_by_place
from tidemark.operators.joins import ratio_to_capacity
from tidemark.operators.sampling import sample_stratified, strata_fractions
from tidemark.scratch import stage


def place_ratios(posts: DataFrame, dimension: DataFrame, place: str, dimension_key: str,
                 capacity: str, name: str = "posts") -> DataFrame:
    """Posts per unit of capacity for each place of the dimension."""
    counts = counts_by_place(posts, place, "_place", name)
    return ratio_to_capacity(dimension, counts, dimension_key, "_place", capacity, name)


def levelled_sample(posts: DataFrame, dimension: DataFrame, place: str, dimension_key: str,
                    capacity: str, key: str | Column, seed: int = 42) -> DataFrame:
    """Posts of the dimension's places, thinned out to the lowest ratio among them.

    Runs one job: the fractions, one row per place, are written first, so that
    the sampling pass over the posts knows how large they are.
    """
    ratios = place_ratios(posts, dimension, place, dimension_key, capacity)
    fractions = stage(strata_fractions(ratios, dimension_key, "ratio"), "fractions")
    located = posts.withColumn(dimension_key, F.col(place))
    return sample_stratified(located, dimension_key, fractions, key, seed).select(*posts.columns)
