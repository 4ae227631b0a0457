"""Starting, finishing and reading back streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.scratch import scratch_path
from tidemark.sources.files import ddl_of

# A trigger that works through all there is, then stops.
AVAILABLE_NOW = "available now"

BatchFunction = Callable[[DataFrame, int], None]


def write_stream(df: DataFrame, mode: str = "append", sink: str | BatchFunction = "console",
                 path: str | None = None, trigger: str | None = AVAILABLE_NOW,
                 checkpoint: str | None = None, name: str | None = None,
                 options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start a stream.

    ``mode``: append, complete or update.  ``sink``: a format name, or a function
    called with every micro-batch and its number.  ``trigger``: an interval such
    as ``"10 seconds"``, ``AVAILABLE_NOW``, or None for as fast as possible.
    Without ``checkpoint`` the stream starts afresh every time.
    """
    writer = df.writeStream.outputMode(mode)
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
    if path:
        writer = writer.option("path", path)
    if name:
        writer = writer.queryName(name)
    writer = writer.option("checkpointLocation",
                           checkpoint or scratch_path(df.sparkSession, "checkpoint"))
    writer = writer.options(**(options or {}))
    if trigger == AVAILABLE_NOW:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def show_stream(df: DataFrame, mode: str = "append", rows: int = 20, truncate: bool = False,
                trigger: str | None = "10 seconds", checkpoint: str | None = None) -> StreamingQuery:
    """Print the first rows of every micro-batch."""
    return write_stream(df, mode, "console", trigger=trigger, checkpoint=checkpoint,
                        options={"numRows": str(rows), "truncate": str(truncate).lower()})


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until a bounded stream is through; its error, if any, is raised here."""
    query.awaitTermination()
    return query


def append_to(df: DataFrame, path: str, checkpoint: str | None = None,
              partition_by: str | None = None) -> DataFrame:
    """Run an append stream over what is there now into parquet and read the table back."""
    spark = df.sparkSession
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = (writer.option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint"))
             .trigger(availableNow=True).start())
    drain(query)
    return spark.read.schema(df.schema).parquet(path)


def sort_out(flagged: DataFrame, path: str, flag: str = "bad", checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run a stream of parsed rows once, writing good and bad ones apart; returns both tables.

    The input is read and parsed in one pass.  ``flag`` is a boolean column (as
    ``parse_json`` adds it); the tables come without it.
    """
    rows = append_to(flagged, path, checkpoint, partition_by=flag)
    return rows.where(~F.col(flag)).drop(flag), rows.where(flag).drop(flag)


def for_each_batch(df: DataFrame, action: BatchFunction, mode: str = "append",
                   checkpoint: str | None = None, trigger: str | None = AVAILABLE_NOW) -> StreamingQuery:
    """Call ``action(batch, number)`` for every micro-batch.

    After a failure the same number may come again, so ``action`` has to replace
    what it wrote for that number.  An error in it stops the stream rather than
    losing the batch.
    """
    return write_stream(df, mode, action, trigger=trigger, checkpoint=checkpoint)


# A micro-batch that the planner puts below so many bytes is written in two files at most, not in one a task.
SMALL_BATCH = 1 << 20

COMPACTIONS = "upto BIGINT, location STRING, keys ARRAY<STRING>, buckets INT, ddl STRING"


class BatchTable:
    """Parquet table with one folder per micro-batch, each replaced as a whole.

    ``compact`` reduces the batches so far to the newest row per key, in files bucketed by key, and
    enters that in a log beside the batches.  Every reader of the path goes by the log, in
    any process: it opens the compacted rows and later batches only.
    """

    def __init__(self, spark: SparkSession, path: str | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "batches")
        self.prepare = prepare
        self.schema = None
        self.last: int | None = None

    def _find_last(self) -> None:
        """Take up a table written by an earlier run, for a stream that found nothing new."""
        if self.last is None:
            rows = self.spark.read.parquet(self.path)
            self.schema = rows.drop("batch").schema
            self.last = rows.agg(F.max("batch")).first()[0]

    def __call__(self, batch: DataFrame, number: int) -> None:
        result = self.prepare(batch) if self.prepare else batch
        small = int(str(result._jdf.queryExecution().analyzed().stats().sizeInBytes())) < SMALL_BATCH
        writer = (result.coalesce(2) if small else result).write.mode("overwrite")
        # Nothing looks for the file that marks the end of a write, and it costs time at every micro-batch.
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{self.path}/batch={number}")
        self.schema, self.last = result.schema, number

    def snapshot(self) -> DataFrame:
        """What the latest batch wrote: the whole result of a complete-mode stream."""
        self._find_last()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={self.last}")

    def last_compaction(self) -> Row | None:
        """The newest entry of the log (upto, location, keys, buckets, ddl), if there is one."""
        try:
            log = self.spark.read.schema(COMPACTIONS).parquet(f"{self.path}/_compactions/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return log.orderBy(F.col("upto").desc(), "location").first()

    def _compacted(self, entry: Row) -> DataFrame:
        """The rows of a compaction, with the planner knowing their buckets."""
        name = f"compacted_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{k}`" for k in entry["keys"])
        self.spark.sql(f"CREATE TABLE {name} ({entry['ddl']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                       f"INTO {entry['buckets']} BUCKETS LOCATION '{entry['location']}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")        # the files stay

    def _batches(self, after: int | None) -> DataFrame:
        self._find_last()
        rows = self.spark.read.schema(f"{ddl_of(self.schema)}, batch BIGINT").parquet(self.path)
        return rows if after is None else rows.where(F.col("batch") > after)

    def all_batches(self) -> DataFrame:
        """The rows of every batch, with its number in ``batch``; of compacted ones what is left."""
        entry = self.last_compaction()
        if entry is None:
            return self._batches(None)
        return self._batches(entry["upto"]).unionByName(self._compacted(entry))

    def compact(self, *keys: str, buckets: int | None = None) -> None:
        """Keep only the newest row per key of the batches so far (runs jobs).

        An earlier compaction by the same keys is joined bucket by bucket, so only later
        batches are shuffled.  The rows are written first and entered in the log after that; one that
        dies between leaves no trace for readers.  The older folders are not deleted; they may be,
        once no reader that began before needs them.
        """
        entry = self.last_compaction()
        # With fewer buckets than the session has shuffle partitions, Spark would rather shuffle both sides.
        buckets = buckets or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), entry["buckets"] if entry is not None else 1)
        rows = self.latest_by(*keys, with_batch=True)
        upto, name = self.last, f"compacting_{uuid.uuid4().hex}"
        location = f"{self.path}/_compactions/upto={upto}-{uuid.uuid4().hex}"
        try:
            (rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
             .option("path", location).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        (self.spark.createDataFrame([(upto, location, list(keys), buckets, ddl_of(rows.schema))], COMPACTIONS)
         .coalesce(1).write.mode("append").parquet(f"{self.path}/_compactions/log"))

    def latest_by(self, *keys: str, with_batch: bool = False) -> DataFrame:
        """The newest row per key: the current result of an update-mode stream."""
        entry = self.last_compaction()
        merge = entry is not None and list(entry["keys"]) == list(keys)
        rows = self._batches(entry["upto"]) if merge else self.all_batches()
        newest = _newest(rows, keys)
        if merge:
            # Keys without nulls are joined by equality, which is what buckets serve; the few others are regrouped.
            whole = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
            old, new = self._compacted(entry), newest
            pairs = old.where(whole).alias("old").join(new.where(whole).alias("new"), [F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys], "full")
            newer = F.col("new.batch").isNotNull()
            merged = pairs.select(*[F.when(newer, F.col(f"new.`{c}`")).otherwise(F.col(f"old.`{c}`")).alias(c) for c in new.columns])
            odd = f"NOT ({whole})"
            newest = merged.unionByName(_newest(old.where(odd).unionByName(new.where(odd)), keys))
        return newest if with_batch else newest.drop("batch")


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the latest batch per key, with ``batch``."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    # A key occurs once per batch, so the columns may be picked one by one,
    # which leaves numbers to the hash aggregate; a struct would be sorted.
    return rows.groupBy(*keys).agg(*(F.max_by(c, "batch").alias(c) for c in rest), F.max("batch").alias("batch"))


def complete_result(df: DataFrame, checkpoint: str | None = None,
                    prepare: Callable[[DataFrame], DataFrame] | None = None,
                    path: str | None = None) -> DataFrame:
    """Run a complete-mode stream over what is there now; return its final result.

    To carry on from an earlier run give its ``checkpoint`` and ``path``.
    """
    table = BatchTable(df.sparkSession, path, prepare)
    drain(for_each_batch(df, table, "complete", checkpoint))
    return table.snapshot()


def updated_result(df: DataFrame, *keys: str, checkpoint: str | None = None,
                   path: str | None = None) -> DataFrame:
    """Run an update-mode stream over what is there now; return the newest row per key.

    To carry on from an earlier run give its ``checkpoint`` and ``path``.
    """
    table = BatchTable(df.sparkSession, path)
    drain(for_each_batch(df, table, "update", checkpoint))
    return table.latest_by(*keys)


def append_result(df: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Run an append stream over what is there now into a new table; return that table."""
    return append_to(df, scratch_path(df.sparkSession, "appended"), checkpoint)
