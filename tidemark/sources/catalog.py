"""Named tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of whatever catalog the session has."""
    return spark.table(name)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to SQL as ``name``, replacing what was there."""
    df.createOrReplaceTempView(name)
    return df


def unregister(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current database: name, database, is_temporary."""
    return spark.sql("SHOW TABLES").select(
        F.col("tableName").alias("name"),
        F.nullif(F.col("namespace"), F.lit("")).alias("database"),
        F.col("isTemporary").alias("is_temporary"))
