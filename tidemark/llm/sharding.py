"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in seeded order; a row's fractional rank is
``(2 rank + 1) / (2 rows of its source)``.  In order of fractional rank every stretch of
rows holds the sources in proportion, so cutting that order into equal pieces gives
shards that each match the mixture.  Shard sizes differ by one row at most (law ``rows``).

Both orders are built from buckets: a source's ranks from 4096 buckets of the shuffle key,
the global order from 4096 bands of the fractional rank.  How many rows come before a band
follows from the sources' row counts alone, in integers, so nothing is counted twice and
no order is made in one task.

A null source is a source of its own.  Repeated rows are separate rows with neighbouring
places.  Null or empty texts are placed like any other.  An empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hex_bucket, packed, shuffle_key, source_key, unpacked
from tidemark.scratch import stage

BANDS = 4096
NEW = ("shard", "slot")


def assign_shards(docs: DataFrame, shards: int, id: str = "doc_id", digest: str = "text", source: str = "source",
                  seed: str = "shard") -> DataFrame:
    """The rows with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``digest`` is a column that tells rows of one id apart (the text or a hash of it).
    Runs a job that counts rows per source and bucket.  Input columns named ``shard`` or
    ``slot`` give way.
    """
    keyed = packed(docs, skey=source_key(F.col(source)), key=shuffle_key(seed, F.col(id), F.md5(
        F.col(digest).cast("string")))).withColumn("bucket", hex_bucket(F.col("key")))
    counts = stage(keyed.groupBy("skey", "bucket").agg(F.count("*").alias("n")), "shard-counts")
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    of_source = Window.partitionBy("skey")
    ahead = counts.select("skey", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                          F.sum("n").over(of_source).alias("rows"))
    inside = Window.partitionBy("skey", "bucket").orderBy("key")
    ranked = (keyed.join(ahead, ["skey", "bucket"])
              .withColumn("odd", 2 * (F.col("before") + F.row_number().over(inside)) - 1)
              .withColumn("band", F.expr(f"int(odd * {BANDS} div (2 * rows))")))
    # The least rank of a source in or after band b is ceil(b * rows / (BANDS / 2)) div 2.
    starts = (counts.groupBy("skey").agg(F.sum("n").alias("rows"))
              .select("rows", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
              .groupBy("band").agg(F.sum(F.expr(f"(rows * band + {BANDS // 2 - 1}) div {BANDS // 2} div 2")).alias("start"),
                                   F.sum("rows").alias("total")))
    order = Window.partitionBy("band").orderBy("fraction", "skey", "key")
    placed = (ranked.withColumn("fraction", F.col("odd") / (2 * F.col("rows"))).drop("rows")
              .join(starts, "band")
              .withColumn("place", F.col("start") + F.row_number().over(order) - 1)
              .withColumn("shard", F.expr(f"int(place * {shards} div total)"))
              .withColumn("slot", F.expr(f"place - (shard * total + {shards - 1}) div {shards}")))
    return unpacked(placed, "shard", "slot", new=NEW)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; the rows of a shard may lie in several files, each in slot order."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
