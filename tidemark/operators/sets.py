"""Intersection, difference and union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in both, once each.  Copies are dropped on either side before the shuffle."""
    return a.distinct().intersect(b.distinct())


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that are not in ``b``; repeated rows of ``a`` stay repeated."""
    right = b.distinct()
    renamed = right.toDF(*(f"_r{i}" for i in range(len(right.columns))))
    same = reduce(Column.__and__, (a[c].eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(a.columns)))
    return a.join(renamed, same, "left_anti")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in either, once each, largest first."""
    both = a.unionByName(b).distinct()
    return both.orderBy(*(F.col(c).desc() for c in both.columns))
