"""Scans, records, catalog, integrity.

Files are written from the given tables into the working folder, whole, and
scanned from there.
"""

import uuid

from pyspark.sql import functions as F

from tidemark.functions.timing import date_and_time, plain_time
from tidemark.operators.aggregates import count_by, total
from tidemark.operators.payloads import parse_json
from tidemark.operators.projections import flatten
from tidemark.plans.validated_copy import publish_csv
from tidemark.registry import QueryBook, read
from tidemark.scratch import scratch_path
from tidemark.sources.catalog import catalog_tables, register, scan_table, unregister
from tidemark.sources.files import infer_schema, scan_csv, scan_json, scan_lines
from tidemark.sources.integrity import (ValidationError, file_digests, file_manifest, publish_validated,
                                        read_published, sample_rows, table_report, validate_dataset)
from tidemark.sources.records import (EARLIEST, LATEST, decode_values, partition_ends, read_backlog, stream_records, to_records,
                                      write_records)
from tidemark.streaming.output import BatchTable, append_result, drain, for_each_batch

book = QueryBook()


@book.query("SRC-1", "SELECT props AS line, count(*) AS copies FROM events GROUP BY props")
def line_scan(spark, sf_dir):
    path = scratch_path(spark, "lines")
    read(spark, sf_dir, "events").select("props").write.text(path)
    return count_by(scan_lines(spark, path), "line", "copies")


def _customer_json(spark, sf_dir):
    path = scratch_path(spark, "customer-json")
    read(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                              F.col("c_nationkey").alias("nation")).alias("person")
    ).write.json(path)
    return path


CUSTOMER_SQL = """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance,
                         CAST(c_nationkey AS BIGINT) AS nation FROM customer"""
CUSTOMER_PATHS = {"id": "c_custkey", "name": "person.name", "balance": "person.balance",
                  "nation": "person.nation"}


@book.query("SRC-2", CUSTOMER_SQL)
def json_scan_declared(spark, sf_dir):
    schema = "c_custkey BIGINT, person STRUCT<name STRING, balance DOUBLE, nation BIGINT>"
    return flatten(scan_json(spark, _customer_json(spark, sf_dir), schema), CUSTOMER_PATHS)


@book.query("SRC-2", CUSTOMER_SQL)
def json_scan_inferred(spark, sf_dir):
    return flatten(scan_json(spark, _customer_json(spark, sf_dir)), CUSTOMER_PATHS)


ORDER_CSV = "day DATE, clock STRING, id BIGINT, price DOUBLE, status STRING"


def _orders_csv(spark, sf_dir, spoil=None):
    """Orders as CSV with header; ``spoil`` marks rows whose price is made unreadable."""
    path = scratch_path(spark, "orders-csv")
    price = F.col("o_totalprice").cast("string")
    if spoil is not None:
        price = F.when(spoil, F.lit("n/a")).otherwise(price)
    read(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day"), F.date_format("o_orderdate", "HH:mm").alias("clock"),
        F.col("o_orderkey").alias("id"), price.alias("price"), F.col("o_orderstatus").alias("status")
    ).write.option("header", True).csv(path)
    return path


@book.query("SRC-3", """SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status,
                               date_trunc('minute', o_orderdate)::TIMESTAMP AS ordered FROM orders""")
def csv_scan(spark, sf_dir):
    rows = scan_csv(spark, _orders_csv(spark, sf_dir), ORDER_CSV)
    return rows.select("id", "price", "status", plain_time(date_and_time("day", "clock")).alias("ordered"))


@book.query("SRC-4 SRC-10", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def catalog_scan(spark, sf_dir):
    register(read(spark, sf_dir, "customer"), "catalog_customer")
    return scan_table(spark, "catalog_customer").select("c_custkey", "c_name", "c_mktsegment")


@book.query("SRC-4", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0")
def stored_table_scan(spark, sf_dir):
    """A table the catalog stores as files, by name; the filter reaches its scan."""
    name = f"stored_customer_{uuid.uuid4().hex}"
    read(spark, sf_dir, "customer").write.option("path", scratch_path(spark, "stored-table")).saveAsTable(name)
    return scan_table(spark, name).where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")


@book.query("SRC-10", """SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
                         FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def named_view_sql(spark, sf_dir):
    unregister(spark, "order_view")
    register(read(spark, sf_dir, "orders"), "order_view")
    return spark.sql("""SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
                        FROM order_view WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")


@book.query("SRC-11 AGG-5", """
SELECT 'listed_events' AS name, true AS is_temporary, count(*) AS n FROM events
UNION ALL SELECT 'listed_orders', true, count(*) FROM orders
UNION ALL SELECT 'listed_documents', true, count(*) FROM documents""")
def catalog_listing(spark, sf_dir):
    tables = ("events", "orders", "documents")
    sizes = None
    for table in tables:
        rows = register(read(spark, sf_dir, table), f"listed_{table}")
        size = total(rows).withColumn("name", F.lit(f"listed_{table}"))
        sizes = size if sizes is None else sizes.unionByName(size)
    return catalog_tables(spark).join(sizes, "name").select("name", "is_temporary", "n")


@book.query("SRC-5 JSN-1", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
                              FROM events""")
def payload_schema(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    schema = infer_schema(events, "props")
    return flatten(parse_json(events, "props", schema), {"event_id": "event_id", "k": "payload.k"})


@book.query("SRC-5", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                               CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN 'late' END AS extra
                        FROM events""")
def schema_of_all_payloads(spark, sf_dir):
    """A field that only the last payload has is found."""
    events = read(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).scalar()
    longer = F.concat(F.substr("props", F.lit(1), F.length("props") - 1), F.lit(', "extra": "late"}'))
    events = events.withColumn("props", F.when(F.col("event_id") == last, longer).otherwise(F.col("props")))
    schema = infer_schema(events, "props")
    return flatten(parse_json(events, "props", schema),
                   {"event_id": "event_id", "k": "payload.k", "extra": "payload.extra"})


def _landed_events(spark, sf_dir):
    path = scratch_path(spark, "event-records")
    write_records(to_records(read(spark, sf_dir, "events"), "event_id", "props", "ts"),
                  "files", path, topic="events")
    return path


EVENT_RECORDS = "SELECT event_id AS key, props AS value FROM events"


@book.query("SRC-6 SRC-15 STR-11", EVENT_RECORDS)
def record_stream(spark, sf_dir):
    arriving = stream_records(spark, "files", _landed_events(spark, sf_dir))
    return append_result(decode_values(arriving, "bigint"))


@book.query("SRC-7", EVENT_RECORDS)
def record_backlog(spark, sf_dir):
    return decode_values(read_backlog(spark, "files", _landed_events(spark, sf_dir)), "bigint")


NUMBERED_RECORDS = """
WITH writes AS (SELECT event_id, props, CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'error' THEN 3 ELSE 2 END AS write,
                       CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id % 5 END AS partition FROM events),
     numbered AS (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY write, event_id) - 1 AS "offset" FROM writes)
"""


def _written_thrice(spark, sf_dir, **settings):
    """Clicks, then all but errors, then these, in order of their id; partition 0 has a third of all records and more."""
    path = scratch_path(spark, "numbered-records")
    events = read(spark, sf_dir, "events")
    place = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("event_id") % 5)
    kind = F.col("event_type")
    for part in (kind == "click", ~kind.isin("click", "error"), kind == "error"):
        records = to_records(events.where(part), "event_id", "props", "ts", place)
        write_records(records, "files", path, topic="events", order_by=F.col("key").cast("string").cast("bigint"), **settings)
    return path


@book.query("SRC-8 SRC-7", NUMBERED_RECORDS + """
SELECT 'events' AS topic, CAST(partition AS INTEGER) AS partition, "offset", event_id AS key, props AS value FROM numbered""")
def offsets_over_writes(spark, sf_dir):
    """Offsets go on from write to write, without gaps, in every partition."""
    records = read_backlog(spark, "files", _written_thrice(spark, sf_dir))
    return records.select("topic", "partition", "offset", F.col("key").cast("string").cast("bigint").alias("key"),
                          F.col("value").cast("string").alias("value"))


@book.query("SRC-7 SRC-8", NUMBERED_RECORDS + """,
     ends AS (SELECT partition, count(*) AS records FROM numbered GROUP BY partition)
SELECT CAST(partition AS INTEGER) AS partition, "offset", event_id AS key FROM numbered JOIN ends USING (partition)
WHERE CASE partition WHEN 0 THEN "offset" BETWEEN records // 2 AND records // 2 + 99 WHEN 1 THEN "offset" >= 10
                     WHEN 2 THEN false ELSE "offset" < 50 END""")
def offset_range(spark, sf_dir):
    """A stated range per partition, read through the ledger: the middle, all from 10 on, nothing, the first 50."""
    path = _written_thrice(spark, sf_dir)
    half = partition_ends(spark, path).where("partition = 0").first()["end"] // 2
    start = {"events": {0: half, 1: 10, 2: LATEST, 3: EARLIEST}}
    end = {"events": {0: half + 100, 1: LATEST, 3: 50, 4: 50}}
    records = read_backlog(spark, "files", path, start=start, end=end)
    return records.select("partition", "offset", F.col("key").cast("string").cast("bigint").alias("key"))


@book.query("SRC-6 STR-11", NUMBERED_RECORDS + """,
     later AS (SELECT * FROM numbered WHERE CASE partition WHEN 1 THEN "offset" >= 20 WHEN 2 THEN false ELSE true END)
SELECT partition::INTEGER AS partition, count(*) AS records, min("offset") AS first, true AS within_cap FROM later GROUP BY partition""")
def capped_records_from_offsets(spark, sf_dir):
    """A stream from stated offsets, with a cap on the records of a micro-batch that none exceeds."""
    path = _written_thrice(spark, sf_dir, records_per_file=300)
    arriving = stream_records(spark, "files", path, start={"events": {1: 20, 2: LATEST}}, per_trigger=5000)
    table = BatchTable(spark)
    drain(for_each_batch(arriving.select("partition", "offset"), table))
    records = table.all_batches()
    most = records.groupBy("batch").count().agg(F.max("count")).scalar()
    return records.groupBy("partition").agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("first")).withColumn(
        "within_cap", most <= 5000)


@book.query("SRC-8", """SELECT CAST(o_orderkey AS VARCHAR) AS key_text,
                               CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus AS value_text,
                               strlen(CAST(o_orderkey AS VARCHAR)) AS key_bytes FROM orders""")
def keyed_records(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    records = to_records(orders, "o_orderkey", F.concat_ws(":", "o_orderkey", "o_orderstatus"))
    return records.select(F.col("key").cast("string").alias("key_text"),
                          F.col("value").cast("string").alias("value_text"),
                          F.octet_length("key").cast("bigint").alias("key_bytes"))


@book.query("SRC-9", "SELECT p_partkey AS key, CAST(p_size AS BIGINT) AS value FROM part")
def decoded_records(spark, sf_dir):
    return decode_values(to_records(read(spark, sf_dir, "part"), "p_partkey", "p_size"),
                         "bigint", "bigint")


@book.query("SRC-13", """
SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS corrupt_rows, true AS has_header,
       count(*) FILTER (o_orderstatus = 'F') = 0 AS healthy FROM orders""")
def dataset_validation(spark, sf_dir):
    """Orders whose status is F are written with an unreadable price."""
    path = _orders_csv(spark, sf_dir, spoil=F.col("o_orderstatus") == "F")
    return validate_dataset(spark, path, ORDER_CSV).select(
        "rows", "corrupt_rows", "has_header", "healthy")


@book.query("SRC-13", """
SELECT 'orders' AS part, count(*) AS rows, true AS has_header, false AS empty, false AS healthy FROM orders
UNION ALL SELECT 'none', 0, false, true, false
UNION ALL SELECT 'turned', count(*) + 1, false, false, false FROM nation""")
def inventory_with_odd_files(spark, sf_dir):
    """Good files, an empty one, and one with its header in the middle: both of these make the whole unhealthy."""
    path, header, id, name = scratch_path(spark, "odd-csv"), "id,name", F.col("n_nationkey"), F.col("n_name")
    orders, nations = read(spark, sf_dir, "orders"), read(spark, sf_dir, "nation")
    orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("name")).write.option("header", True).csv(f"{path}/orders")
    lines = nations.select((2 * id).alias("at"), F.concat_ws(",", id, name).alias("value"))
    middle = nations.agg((F.count(F.lit(1)) + 1).alias("at"), F.lit(header).alias("value"))
    lines.unionByName(middle).coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{path}/turned")
    lines.where(F.lit(False)).select("value").coalesce(1).write.text(f"{path}/none")
    healthy = validate_dataset(spark, path, "id BIGINT, name STRING").select("healthy").scalar()
    manifest = file_manifest(spark, path, "id BIGINT, name STRING")
    return manifest.groupBy(F.element_at(F.split("file_path", "/"), -2).alias("part")).agg(
        F.sum("rows").alias("rows"), F.min("has_header").alias("has_header"), (F.max("file_size") == 0).alias("empty")).withColumn("healthy", healthy)


@book.query("SRC-13", "SELECT count(*) AS rows, 0::BIGINT AS corrupt_rows FROM orders")
def dataset_manifest(spark, sf_dir):
    """Per-file figures added up; what the files are is up to the writer."""
    manifest = file_manifest(spark, _orders_csv(spark, sf_dir), ORDER_CSV)
    return manifest.agg(F.sum("rows").alias("rows"), F.sum("corrupt_rows").alias("corrupt_rows"))


@book.query("SRC-13 SRT-3", """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey AS id, o_orderstatus AS status
                               FROM orders ORDER BY day, strftime(o_orderdate, '%H:%M'), id LIMIT 5""")
def dataset_sample(spark, sf_dir):
    rows = sample_rows(spark, _orders_csv(spark, sf_dir), ORDER_CSV)
    return rows.select(F.col("day").cast("string").alias("day"), "id", "status")


@book.query("SRC-13", "SELECT count(*) > 0 AS digested, 0::BIGINT AS unmatched FROM orders")
def dataset_digests(spark, sf_dir):
    """Two copies of one data set have the same digests."""
    first, second = (file_digests(spark, _orders_csv(spark, sf_dir)) for _ in range(2))
    unmatched = first.join(second, ["length", "rows", "checksum"], "left_anti").agg(F.count(F.lit(1))).scalar()
    return first.agg((F.count(F.lit(1)) > 0).alias("digested")).withColumn("unmatched", unmatched)


@book.query("SRC-14 SRC-13", """SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status,
                                       strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def published_csv(spark, sf_dir):
    copy = publish_csv(spark, _orders_csv(spark, sf_dir), ORDER_CSV, scratch_path(spark, "published"))
    return copy.select("id", "price", "status", F.col("day").cast("string").alias("day"))


@book.query("SRC-14", "SELECT * FROM supplier")
def published_table(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier")
    return publish_validated(rows, table_report(rows), scratch_path(spark, "published"))


@book.query("SRC-14", "SELECT * FROM supplier")
def refused_publish(spark, sf_dir):
    """A copy that does not agree with its report is refused, and the good one stays published."""
    path = scratch_path(spark, "published")
    rows = read(spark, sf_dir, "supplier")
    publish_validated(rows, table_report(rows), path)
    try:
        publish_validated(rows.where("s_suppkey % 2 = 0"), table_report(rows), path)
    except ValidationError:
        return read_published(spark, path)
    raise AssertionError("a bad copy was published")


@book.query("SRC-13", "SELECT 3 * count(*) AS rows, true AS told_apart FROM orders")
def paired_rows_told_apart(spark, sf_dir):
    """Tables that differ only in rows that occur in pairs have different checksums."""
    keys = read(spark, sf_dir, "orders").select("o_orderkey")
    first, second = (keys.unionAll(keys.select(F.col("o_orderkey") + shift)).unionAll(
        keys.select(F.col("o_orderkey") + shift)) for shift in (1, 2))
    other = table_report(second).select(F.col("checksum").alias("other"))
    return table_report(first).select("rows", (F.col("checksum") != other.scalar()).alias("told_apart"))
