"""Grouping where one element may belong to several groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_members(df: DataFrame, labels: Mapping[str, Column], name: str = "label") -> DataFrame:
    """One row per (label, element) for every label whose condition holds."""
    marks = F.array(*(F.when(condition, F.lit(label)) for label, condition in labels.items()))
    return df.withColumn(name, F.explode(F.array_compact(marks)))


def group_by_labels(df: DataFrame, labels: Mapping[str, Column], value: str,
                    name: str = "label") -> DataFrame:
    """Per label: number of elements and their sum."""
    return (label_members(df, labels, name).groupBy(name)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")))


def label_lists(df: DataFrame, labels: Mapping[str, Column], value: str, *carried: str,
                name: str = "label", span: int = 1000, most: int = 1000) -> DataFrame:
    """The elements of each label as sorted lists of (value, carried…, copies).

    ``value`` is a whole number.  Equal elements are counted before they are gathered.  A
    list covers ``span`` consecutive values from ``part`` on; where those have more than
    ``most`` different elements they are dealt by hash into pieces of about that many,
    numbered by ``piece``.  So no list outgrows the bounds, whatever the data.
    """
    counted = (label_members(df, labels, name).groupBy(name, value, *carried)
               .agg(F.count(F.lit(1)).alias("copies"))
               .withColumn("part", (F.col(value) - F.pmod(F.col(value), F.lit(span))).cast("bigint")))
    sizes = counted.groupBy(name, "part").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64(value, *carried), F.col("pieces")).cast("int")
    return (counted.join(sizes.select(F.col(name).alias("_name"), F.col("part").alias("_part"), "pieces"),
                         F.col(name).eqNullSafe(F.col("_name")) & F.col("part").eqNullSafe(F.col("_part")))
            .groupBy(name, "part", piece.alias("piece"))
            .agg(F.sort_array(F.collect_list(F.struct(value, *carried, "copies"))).alias("members")))
