"""Counts and profiles."""

from pyspark.sql import functions as F

from tidemark.functions.numbers import cubed
from tidemark.functions.text import char_length
from tidemark.operators.aggregates import (count_by, counts_by_pairs, counts_by_place,
                                           counts_by_place_sql, distinct_count, hourly_counts,
                                           hourly_profile, received_counts, total, user_profile)
from tidemark.operators.labels import group_by_labels, label_lists
from tidemark.operators.words import tokens
from tidemark.plans.hourly import estimated_hourly_profile
from tidemark.registry import QueryBook, read
from tidemark.registry.joins import places, reshared_lines, user_posts
from tidemark.sources.catalog import register

book = QueryBook()


@book.query("AGG-1", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_type(spark, sf_dir):
    return count_by(read(spark, sf_dir, "events"), "event_type")


@book.query("AGG-2", """
SELECT c_custkey AS user_id, max(o_totalprice) AS max_price, count(*) AS posts
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE c_mktsegment = 'MACHINERY' GROUP BY c_custkey ORDER BY posts DESC, user_id""")
def user_profiles(spark, sf_dir):
    profile = user_profile(user_posts(spark, sf_dir), "user.id", {"max_price": "user.price"},
                           F.col("user.lang") == "MACHINERY", "user_id")
    return profile.orderBy(F.col("posts").desc(), "user_id")


@book.query("AGG-4", """SELECT o_custkey AS user_id, count(*) AS received
                        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def reshares_received(spark, sf_dir):
    return received_counts(reshared_lines(spark, sf_dir), "reshared.user.id", "user_id", times="times")


@book.query("AGG-5", "SELECT count(*) AS n FROM lineitem")
def row_total(spark, sf_dir):
    return total(read(spark, sf_dir, "lineitem"))


PLACE_COUNTS = """SELECT n_name AS name, count(*) AS posts FROM customer
                  JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


@book.query("AGG-6", PLACE_COUNTS)
def place_counts(spark, sf_dir):
    return counts_by_place(places(spark, sf_dir))


@book.query("AGG-6 SRC-10", PLACE_COUNTS)
def place_counts_sql(spark, sf_dir):
    register(places(spark, sf_dir), "place_view")
    return counts_by_place_sql(spark, "place_view")


@book.query("AGG-7 SRC-12 UDF-1", PLACE_COUNTS)
def place_counts_pairs(spark, sf_dir):
    return counts_by_pairs(places(spark, sf_dir), "place.name")


@book.query("AGG-8 DTM-1", """SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(extract(hour FROM ts) AS INTEGER) AS hour,
                                     count(*) AS posts FROM events GROUP BY 1, 2""")
def counts_per_day_and_hour(spark, sf_dir):
    counts = hourly_counts(read(spark, sf_dir, "events"), "ts")
    return counts.withColumn("day", F.col("day").cast("string"))


HOURLY = """
WITH counts AS (SELECT CAST(ts AS DATE) AS day, CAST(extract(hour FROM ts) AS INTEGER) AS hour,
                       count(*) AS posts FROM {source} GROUP BY 1, 2)
"""


@book.query("AGG-8", HOURLY.format(source="events")
            + "SELECT hour, avg(posts) AS posts FROM counts GROUP BY hour")
def hourly_average(spark, sf_dir):
    return hourly_profile(read(spark, sf_dir, "events"), "ts")


@book.query("AGG-8", HOURLY.format(source="(SELECT ts FROM events WHERE event_type = 'purchase')")
            + """SELECT CAST(h AS INTEGER) AS hour, coalesce(sum(posts), 0)::BIGINT
                        / CAST((SELECT count(DISTINCT day) FROM counts) AS DOUBLE) AS posts
                 FROM range(24) hours(h) LEFT JOIN counts ON hour = h GROUP BY h""")
def hourly_average_all_days(spark, sf_dir):
    """Purchases are sparse enough for hours to be missing on some days."""
    purchases = read(spark, sf_dir, "events").where("event_type = 'purchase'")
    return hourly_profile(purchases, "ts", zero_fill=True)


HASHED = "CAST('0x' || substr(md5({key} || ':42'), 1, 8) AS BIGINT)"


@book.query("AGG-9 SMP-1", HOURLY.format(
    source=f"""(SELECT ts FROM events
                WHERE {HASHED.format(key="CAST(event_id AS VARCHAR)")} < 42949672)""")
            + "SELECT hour, avg(posts) / 0.01::DOUBLE AS posts FROM counts GROUP BY hour")
def hourly_average_estimated(spark, sf_dir):
    return estimated_hourly_profile(read(spark, sf_dir, "events"), "ts", "event_id")


@book.query("AGG-8", HOURLY.format(source="(SELECT ts FROM events WHERE hour(ts) BETWEEN 6 AND 20)")
            + """SELECT CAST(h AS INTEGER) AS hour, coalesce(sum(posts), 0)::BIGINT
                        / CAST((SELECT count(DISTINCT day) FROM counts) AS DOUBLE) AS posts
                 FROM range(24) hours(h) LEFT JOIN counts ON hour = h GROUP BY h""")
def hourly_average_with_empty_hours(spark, sf_dir):
    """Nights are empty on all days and still have their rows."""
    daytime = read(spark, sf_dir, "events").where(F.hour("ts").between(6, 20))
    return hourly_profile(daytime, "ts", zero_fill=True)


LABELLED = """
WITH cubes AS (SELECT p_size, p_size::BIGINT * p_size * p_size AS size_cubed FROM part),
     chosen AS (SELECT * FROM cubes WHERE size_cubed % 7 = 0 AND size_cubed > 50),
     labelled AS (SELECT 'even' AS label, * FROM chosen WHERE p_size % 2 = 0
                  UNION ALL SELECT 'odd', * FROM chosen WHERE p_size % 2 <> 0
                  UNION ALL SELECT 'multiple of 5', * FROM chosen WHERE p_size % 5 = 0)
"""


def _cubes(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_size", cubed("p_size").alias("size_cubed"))
    size = F.col("p_size")
    labels = {"even": size % 2 == 0, "odd": size % 2 != 0, "multiple of 5": size % 5 == 0}
    return parts.where("size_cubed % 7 = 0 AND size_cubed > 50"), labels


@book.query("AGG-10 PRJ-5 PRJ-6", LABELLED + """
SELECT label, count(*) AS n, CAST(sum(size_cubed) AS BIGINT) AS total FROM labelled GROUP BY label""")
def label_totals(spark, sf_dir):
    rows, labels = _cubes(spark, sf_dir)
    return group_by_labels(rows, labels, "size_cubed")


@book.query("AGG-10", LABELLED + """
, counted AS (SELECT label, p_size, size_cubed, count(*) AS copies FROM labelled GROUP BY ALL)
SELECT label, p_size::BIGINT - p_size % 1000 AS part, 0 AS piece,
       string_agg(p_size || ',' || size_cubed || ',' || copies, ';' ORDER BY p_size) AS members
FROM counted GROUP BY 1, 2""")
def label_groups(spark, sf_dir):
    rows, labels = _cubes(spark, sf_dir)
    lists = label_lists(rows, labels, "p_size", "size_cubed")
    written = F.transform("members", lambda m: F.concat_ws(",", m.p_size, m.size_cubed, m.copies))
    return lists.select("label", "part", "piece", F.concat_ws(";", written).alias("members"))


@book.query("AGG-10", """
WITH labelled AS (SELECT 'finished' AS label, * FROM orders WHERE o_orderstatus = 'F'
                  UNION ALL SELECT 'dear', * FROM orders WHERE o_totalprice > 100000)
SELECT label, o_orderkey - o_orderkey % 1000 AS part, 0 AS piece,
       string_agg(o_orderkey || ',' || o_custkey || ',1', ';' ORDER BY o_orderkey) AS members
FROM labelled GROUP BY 1, 2""")
def label_groups_of_wide_range(spark, sf_dir):
    """Keys spread far beyond one span: a list per label and span."""
    orders = read(spark, sf_dir, "orders")
    labels = {"finished": F.col("o_orderstatus") == "F", "dear": F.col("o_totalprice") > 100000}
    lists = label_lists(orders, labels, "o_orderkey", "o_custkey")
    written = F.transform("members", lambda m: F.concat_ws(",", m.o_orderkey, m.o_custkey, m.copies))
    return lists.select("label", "part", "piece", F.concat_ws(";", written).alias("members"))


WORDS = r"""
WITH words AS (
  SELECT unnest(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}_]+', ' ', 'g')), ' ')) AS word
  FROM documents)
"""


@book.query("AGG-11", WORDS + "SELECT count(DISTINCT word) AS n FROM words WHERE length(word) BETWEEN 1 AND 6")
def distinct_words(spark, sf_dir):
    return distinct_count(tokens(read(spark, sf_dir, "documents"), "text"), "word")


@book.query("AGG-12 TXT-7", """SELECT lang, count(*) AS n, round(avg(length(text)), 2) AS avg_length
                               FROM documents GROUP BY lang""")
def length_by_language(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(char_length("text")), 2).alias("avg_length"))
