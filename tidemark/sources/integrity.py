"""Checking a data set and publishing a verified copy of it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import hash_sum, row_checksum
from tidemark.functions.payload import CORRUPT, with_corrupt_field
from tidemark.operators.ranking import preview
from tidemark.sources.files import as_struct, ddl_of, scan_csv

FILE_COLUMNS = ("file_name", "file_size", "file_modified")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_name, file_size, file_modified) of every file below ``path``, also of empty ones.

    The contents are not read.  Scans pass over empty files, so the names come from the listing
    that Spark keeps for any scan; an empty file has size 0 and no time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = spark.createDataFrame([(name,) for name in files.inputFiles()], "_listed STRING").select(
        _plain_path(F.col("_listed")).alias("file_path"))
    known = files.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("file_modified"))
    return names.join(known, "file_path", "left").select(
        "file_path", F.element_at(F.split("file_path", "/"), -1).alias("file_name"), F.coalesce("file_size", F.lit(0)).alias("file_size"),
        "file_modified")


def _plain_path(encoded: Column) -> Column:
    """A path that Spark has written as an address, as a listing writes it: odd characters and the slashes of a scheme differ."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(encoded, r"\+", "%2B")), "^file:/+", "file:/")


def _checked_lines(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    # Lines rather than the CSV reader: that one drops headers unseen, and here
    # they are to be checked, in the same single pass that parses the rows.
    # Splitting by lines rules out line breaks inside quoted fields.
    # A task reads its part of a file from front to back, so the first line of a
    # file is the one with the least number in the part that starts at 0.
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("value").alias("line"),
        _plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"))
    row = F.from_csv("line", ddl_of(with_corrupt_field(schema)),
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "sep": sep})
    header = sep.join(schema.fieldNames())
    return lines.where(F.length("line") > 0).select(
        "*", (F.col("line") == F.lit(header)).alias("is_header"), row.alias("row"))


def file_manifest(spark: SparkSession, path: str, schema: T.StructType | str,
                  sep: str = ",") -> DataFrame:
    """One row per file: size, time, header present, rows, corrupt rows, checksum.

    The listing names the files, so one without lines is there with no rows and no header.
    A header is the first line that is not blank; the same text further down is a row like any
    other, and a corrupt one if its fields do not parse.  The checksum ignores row order, so it survives
    a rewrite into other files: the whole data set's is the sum over its files.
    """
    declared = as_struct(schema)
    checked = _checked_lines(spark, path, declared, sep)
    fields = [f"row.{name}" for name in declared.fieldNames()]
    corrupt = F.col(f"row.{CORRUPT}").isNotNull()
    heads, found = F.col("is_header"), F.col("has_header")
    hashed = F.xxhash64(*fields)
    # The header line is taken off the sums again where it turns out to be one.
    per_file = checked.groupBy("file_path").agg(
        F.min_by("is_header", "at").alias("has_header"), F.count(F.lit(1)).alias("rows"), F.count_if(corrupt).alias("corrupt_rows"),
        hash_sum(hashed).alias("checksum"), F.max(F.when(heads, hashed)).alias("_hash"),
        F.max(F.when(heads, corrupt)).alias("_corrupt"))
    none, one = F.lit(0).cast("long"), F.when(found, 1).otherwise(0)
    listed = file_listing(spark, path).join(per_file, "file_path", "left")
    return listed.withColumn("has_header", F.coalesce("has_header", F.lit(False))).select(
        "file_path", *FILE_COLUMNS, "has_header", (F.coalesce("rows", none) - one).alias("rows"),
        (F.coalesce("corrupt_rows", none) - F.when(found & F.col("_corrupt"), 1).otherwise(0)).alias("corrupt_rows"),
        (F.coalesce("checksum", F.lit(0)) - F.when(found, F.col("_hash")).otherwise(0)).cast("decimal(38,0)").alias("checksum"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, rows, checksum) of every file below ``path``, whatever its size; an empty one has none of either.

    The checksum is the sum of the hashes of a file's lines, so a file is read in as
    many tasks as it has splits.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(_plain_path(F.col("_metadata.file_path")).alias("path"), "value")
    summed = lines.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), hash_sum(F.xxhash64("value")).alias("checksum"))
    listed = file_listing(spark, path).select(F.col("file_path").alias("path"), F.col("file_size").alias("length"))
    return listed.join(summed, "path", "left").select(
        "path", "length", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("checksum", F.lit(0)).cast("decimal(38,0)").alias("checksum"))


def sample_rows(spark: SparkSession, path: str, schema: T.StructType | str, n: int = 5,
                sep: str = ",") -> DataFrame:
    """A few rows as they parse, to look at; the same ones every time."""
    return preview(scan_csv(spark, path, schema, sep=sep), n)


def validate_dataset(spark: SparkSession, path: str, schema: T.StructType | str,
                     sep: str = ",") -> DataFrame:
    """One row on the whole data set, with a verdict.

    Healthy means: there is data, every file starts as declared, every row parses.  An empty
    file does not start as declared.
    """
    manifest = file_manifest(spark, path, schema, sep)
    report = manifest.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("corrupt_rows"), F.lit(0)).alias("corrupt_rows"),
        F.coalesce(F.min("has_header"), F.lit(False)).alias("has_header"),
        F.coalesce(F.sum("checksum"), F.lit(0)).cast("decimal(38,0)").alias("checksum"), F.max("file_modified").alias("last_modified"))
    return report.withColumn(
        "healthy", (F.col("rows") > 0) & (F.col("corrupt_rows") == 0) & F.col("has_header"))


class ValidationError(RuntimeError):
    """The data set may not be published."""


def publish_validated(df: DataFrame, report: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a new version below ``path`` if ``report`` allows it, verify it, then publish it (runs jobs).

    ``report`` is one row with ``healthy``, ``rows`` and ``checksum``.  The version is read
    back and has to show the same count and checksum; only then a row naming it is added
    to the table of verified versions, which readers go by.  An earlier version is never
    touched, and a refused one is never read.  Returns the copy.
    """
    spark = df.sparkSession
    verdict = report.select("healthy", "rows", "checksum").first()
    if verdict is None or not verdict["healthy"]:
        raise ValidationError(f"not published, report says {verdict}")
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    copy = spark.read.schema(df.schema).parquet(f"{path}/versions/{version}")
    found = copy.agg(F.count(F.lit(1)).alias("rows"),
                     row_checksum(copy.columns).alias("checksum")).first()
    if (found["rows"], found["checksum"]) != (verdict["rows"], verdict["checksum"]):
        raise ValidationError(f"copy differs: {found} instead of {verdict}")
    (spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published"),
                           F.lit(found["rows"]).alias("rows"), F.lit(found["checksum"]).cast("decimal(38,0)").alias("checksum"))
     .write.mode("append").parquet(f"{path}/verified"))
    return copy


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version verified last."""
    newest = spark.read.parquet(f"{path}/verified").orderBy(F.col("published").desc(), "version").first()
    return spark.read.parquet(f"{path}/versions/{newest['version']}")


def table_report(df: DataFrame) -> DataFrame:
    """The report of a table that is typed already: rows, checksum, and healthy when not empty."""
    return (df.agg(F.count(F.lit(1)).alias("rows"), row_checksum(df.columns).alias("checksum"))
            .withColumn("healthy", F.col("rows") > 0))
