"""Check a CSV data set and publish it with its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import as_struct, scan_csv
from tidemark.sources.integrity import publish_validated, validate_dataset


def publish_csv(spark: SparkSession, source: str, schema: T.StructType | str, target: str,
                sep: str = ",") -> DataFrame:
    """Validate ``source``, write the report to ``target/report``, and publish the data below ``target/data``.

    The report is written first and whatever it says; the data is published only if it
    is healthy and its copy agrees, else ``ValidationError`` is raised and what was
    published before stays.
    """
    declared = as_struct(schema)
    report_path = f"{target}/report"
    validate_dataset(spark, source, declared, sep).write.mode("overwrite").parquet(report_path)
    report = spark.read.parquet(report_path)
    rows = scan_csv(spark, source, declared, sep=sep)
    return publish_validated(rows, report, f"{target}/data")
