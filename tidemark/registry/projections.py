"""Selections, guards, nested fields, scalar functions."""

from pyspark.sql import functions as F

from tidemark.functions.nested import default_to, first_filled
from tidemark.functions.numbers import cubed, floor_to, int_or_zero, multiple_above, ratio, scaled
from tidemark.functions.timing import day_text, hour_of, parse_timestamp, plain_time
from tidemark.operators.payloads import parse_json
from tidemark.operators.projections import (flatten, originals, pack, renamed, require, where,
                                            with_derived)
from tidemark.operators.reuse import reuse
from tidemark.registry import QueryBook, read
from tidemark.scratch import stage
from tidemark.sources.catalog import register

book = QueryBook()

SPANISH = "SELECT doc_id, text FROM documents WHERE lang = 'es'"


@book.query("PRJ-1", SPANISH)
def where_by_value(spark, sf_dir):
    return where(read(spark, sf_dir, "documents"), "lang = 'es'", "doc_id", "text")


@book.query("PRJ-1 SRC-10", SPANISH)
def where_by_value_sql(spark, sf_dir):
    register(read(spark, sf_dir, "documents"), "document_view")
    return spark.sql("SELECT doc_id, text FROM document_view WHERE lang = 'es'")


def _nested_customers(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(
            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
        ).alias("account")).alias("user"))


@book.query("PRJ-2", """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
                               c_acctbal AS balance FROM customer""")
def nested_to_flat(spark, sf_dir):
    return flatten(_nested_customers(spark, sf_dir), {
        "id": "c_custkey", "name": "user.name", "nation": "user.account.nation",
        "balance": "user.account.balance"})


@book.query("PRJ-3", "SELECT *, upper(c_mktsegment) AS segment FROM customer")
def derived_column(spark, sf_dir):
    return with_derived(read(spark, sf_dir, "customer"), segment=F.upper("c_mktsegment"))


@book.query("PRJ-4", """SELECT event_id, event_type FROM events
                        WHERE event_type <> 'error' AND nullif(user_id, 0) IS NOT NULL""")
def nested_guard(spark, sf_dir):
    """The parent is null for errors, the child for user 0."""
    event = F.struct(F.nullif("user_id", F.lit(0)).alias("user"), F.col("event_type").alias("type"))
    rows = read(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", event).alias("event"))
    return flatten(require(rows, "event.user"), {"event_id": "event_id", "event_type": "event.type"})


@book.query("PRJ-5", """SELECT p_partkey, p_size,
                               p_size::BIGINT * p_size * p_size AS size_cubed FROM part""")
def cubes(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", "p_size", cubed("p_size").alias("size_cubed"))


@book.query("PRJ-6", """SELECT p_partkey, p_size::BIGINT * p_size * p_size AS size_cubed FROM part
                        WHERE (p_size::BIGINT * p_size * p_size) % 7 = 0
                          AND p_size::BIGINT * p_size * p_size > 50""")
def cubes_multiple_of_seven(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", cubed("p_size").alias("size_cubed"))
    return rows.where(multiple_above("size_cubed", 7, 50))


@book.query("PRJ-7", """SELECT l_orderkey, l_linenumber, l_quantity * 2 AS doubled FROM lineitem""")
def doubled(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scaled("l_quantity", 2.0).alias("doubled"))


@book.query("PRJ-8", "SELECT event_id, user_id FROM events WHERE nullif(event_type, 'error') IS NOT NULL")
def original_rows(spark, sf_dir):
    """Errors stand for reshares."""
    reshare_of = F.when(F.col("event_type") == "error", F.col("event_id"))
    return originals(read(spark, sf_dir, "events"), reshare_of).select("event_id", "user_id")


@book.query("PRJ-9", """SELECT c_mktsegment AS segment, count(*) AS customers
                        FROM customer GROUP BY c_mktsegment""")
def renamed_columns(spark, sf_dir):
    counts = read(spark, sf_dir, "customer").groupBy("c_mktsegment").count()
    return renamed(counts, c_mktsegment="segment", count="customers")


@book.query("PRJ-10", """SELECT event_id, ts AS starts, ts + INTERVAL 1 HOUR AS ends FROM events""")
def packed_struct(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(
        "event_id", "ts", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("later"))
    packed = pack(rows, "window", start="ts", end="later").select("event_id", "window")
    return flatten(packed, {"event_id": "event_id", "starts": "window.start", "ends": "window.end"})


@book.query("PRJ-11", """
SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0) AS value,
       coalesce(nullif(CASE WHEN event_type = 'click' THEN '' ELSE event_type END, ''),
                nullif(CASE WHEN user_id = 0 THEN '' ELSE props END, ''), 'unknown') AS label
FROM events""")
def null_defaults(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    value = F.when(F.col("event_type") != "error", F.col("value"))
    kind = F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type"))
    props = F.when(F.col("user_id") == 0, "").otherwise(F.col("props"))
    return events.select("event_id", default_to(value, 0.0).alias("value"),
                         first_filled([kind, props], "unknown").alias("label"))


@book.query("DTM-1", "SELECT event_id, CAST(extract(hour FROM ts) AS INTEGER) AS hour FROM events")
def hour_of_day(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", hour_of("ts").alias("hour"))


@book.query("DTM-2", "SELECT event_id, strftime(ts, '%m-%d-%y') AS day FROM events")
def written_day(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", day_text("ts").alias("day"))


@book.query("DTM-3", """SELECT event_id, ts FROM events WHERE event_type <> 'error'""")
def parsed_timestamps(spark, sf_dir):
    """Errors carry a text that is no timestamp, and are dropped."""
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("ts").cast("string"))
    parsed = read(spark, sf_dir, "events").select("event_id", plain_time(parse_timestamp(text)).alias("ts"))
    return require(parsed, "ts")


@book.query("JSN-1 STR-14", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                                      event_type <> 'error' AS readable
                               FROM events WHERE event_type <> 'error'
                               UNION ALL SELECT event_id, NULL, false FROM events
                               WHERE event_type = 'error'""")
def payload_quarantine(spark, sf_dir):
    """The payload of errors is cut short."""
    props = F.when(F.col("event_type") == "error", F.substr("props", F.lit(1), F.length("props") - 1)
                   ).otherwise(F.col("props"))
    events = read(spark, sf_dir, "events").select("event_id", props.alias("props"))
    parsed = parse_json(events, "props", "k BIGINT")
    return parsed.select("event_id", F.col("payload.k").alias("k"), (~F.col("bad")).alias("readable"))


@book.query("MTH-1", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio,
       floor(l_quantity / 7.0::DOUBLE * 100) / 100 AS floored,
       coalesce(CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linenumber END, 0)::BIGINT AS whole
FROM lineitem""")
def guarded_arithmetic(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "A", F.lit("none")).otherwise(F.col("l_linenumber").cast("string"))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", ratio("l_discount", "l_tax").alias("ratio"),
        floor_to(F.col("l_quantity") / 7.0).alias("floored"), int_or_zero(text).alias("whole"))


@book.query("PHY-1 PRJ-6 PRJ-7", """SELECT o_orderkey AS n, o_orderkey * 2 AS doubled FROM orders
                                    WHERE o_totalprice > 250000""")
def reused_filter(spark, sf_dir):
    """Two jobs read the filtered rows, their number and their doubles: a filter is repeated rather than kept."""
    kept = read(spark, sf_dir, "orders").where("o_totalprice > 250000").select(F.col("o_orderkey").alias("n"))
    with reuse(kept) as rows:
        rows.count()
        return stage(rows.select("n", scaled("n").alias("doubled")), "doubled")


@book.query("UDF-1 UDF-2", """
SELECT user_id, count(*) FILTER (event_type <> 'error') AS originals,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
       max(length(upper(event_type))) AS longest FROM events GROUP BY user_id""")
def row_functions_as_columns(spark, sf_dir):
    """Map, filter, parse and per-key state, all as expressions and one aggregation."""
    rows = parse_json(read(spark, sf_dir, "events"), "props", "k BIGINT")
    return rows.groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "error").alias("originals"),
        F.sum("payload.k").alias("k_total"),
        F.max(F.length(F.upper("event_type"))).cast("bigint").alias("longest"))
