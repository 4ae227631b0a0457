"""Who interacts with whom: edge lists and degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import count_by
from tidemark.operators.projections import require


def raw_edges(interactions: DataFrame, src: str, dst: str) -> DataFrame:
    """One row per interaction."""
    return require(interactions, src, dst).select(F.col(src).alias("src"), F.col(dst).alias("dst"))


def edge_list(interactions: DataFrame, src: str, dst: str, weight: str = "weight") -> DataFrame:
    """One row per pair; the weight is how often the pair interacted."""
    return count_by(raw_edges(interactions, src, dst), ["src", "dst"], weight)


def filter_edges(edges: DataFrame, min_weight: int = 2, weight: str = "weight") -> DataFrame:
    return edges.where(F.col(weight) >= min_weight)


def out_degree(edges: DataFrame, name: str = "out_degree", user_as: str = "user") -> DataFrame:
    """How many different users each user points at; ``edges`` holds each pair once."""
    return count_by(edges, [F.col("src").alias(user_as)], name)


def in_degree(edges: DataFrame, name: str = "in_degree", user_as: str = "user") -> DataFrame:
    """How many different users point at each user; ``edges`` holds each pair once."""
    return count_by(edges, [F.col("dst").alias(user_as)], name)


def out_strength(raw: DataFrame, name: str = "out_strength", user_as: str = "user") -> DataFrame:
    """How many interactions each user started, repeats included."""
    return count_by(raw, [F.col("src").alias(user_as)], name)


def degree_distribution(degrees: DataFrame, degree: str, name: str = "users") -> DataFrame:
    """How many users have each degree."""
    return count_by(degrees, degree, name)


def ranked_by(degrees: DataFrame, degree: str, user: str = "user") -> DataFrame:
    """Highest degree first, users in order within a tie."""
    order: list[Column] = [F.col(degree).desc(), F.col(user).asc()]
    return degrees.orderBy(*order)
