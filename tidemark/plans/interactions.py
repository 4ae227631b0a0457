"""Interaction graph of a sample of posts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from tidemark.operators.graph import (degree_distribution, edge_list, filter_edges, in_degree,
                                      out_degree, out_strength, ranked_by, raw_edges)
from tidemark.operators.sampling import sample_uniform


class InteractionGraph(NamedTuple):
    edges: DataFrame
    out_degree: DataFrame
    in_degree: DataFrame


def interaction_graph(posts: DataFrame, src: str, dst: str, key: str | Column,
                      fraction: float = 0.01, seed: int = 42,
                      min_weight: int = 2) -> InteractionGraph:
    """Repeated interactions in a sample, and the degrees in the graph they make."""
    sample = sample_uniform(posts, key, fraction, seed)
    edges = filter_edges(edge_list(sample, src, dst), min_weight)
    return InteractionGraph(edges, ranked_by(out_degree(edges), "out_degree"),
                            ranked_by(in_degree(edges), "in_degree"))


def activity_distribution(posts: DataFrame, src: str, dst: str, key: str | Column,
                          fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """How many users started how many interactions in a sample, in order of the number."""
    raw = raw_edges(sample_uniform(posts, key, fraction, seed), src, dst)
    return degree_distribution(out_strength(raw), "out_strength").orderBy("out_strength")
