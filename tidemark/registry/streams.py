"""Streams over the events table, run to the end of what is there.

Append results hold the windows the final watermark has closed, so their SQL
keeps windows that end no later than the latest event less the delay.
"""

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.functions.timing import event_time, plain_time
from tidemark.operators.payloads import parse_json
from tidemark.operators.projections import originals
from tidemark.operators.ranking import numbered
from tidemark.plans.activity import sessions, tallies
from tidemark.plans.dashboard import busiest, dashboard, dashboard_of, user_panes
from tidemark.plans.domains import DOMAIN_SCHEMA, compare_domains
from tidemark.plans.posts import dashboard_posts, original_posts, timed_posts
from tidemark.registry import QueryBook, read
from tidemark.scratch import scratch_path, stage
from tidemark.sources.records import stream_records, to_records, write_records
from tidemark.streaming.joins import join_streams_left
from tidemark.streaming.output import (BatchTable, append_result, append_to, complete_result, drain,
                                       for_each_batch, sort_out, updated_result)
from tidemark.streaming.replay import land, stream_events, stream_table
from tidemark.streaming.rings import sliding_ring
from tidemark.streaming.state import stateful_update
from tidemark.streaming.windows import (ranked_in_window, running_count, slide_count, sliding_count, top_in_window,
                                        tumbling_count, windows_from_slides)

book = QueryBook()


def _events(spark, sf_dir):
    return stream_events(spark, f"{sf_dir}/events.parquet")


def _reshare_of():
    """Errors stand for reshares of something."""
    return F.when(F.col("event_type") == "error", F.col("event_id"))


@book.query("STR-1 STR-8 STR-10 PRJ-8", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n
FROM events WHERE event_type <> 'error' GROUP BY 1, 2
HAVING window_end <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 1 HOUR""")
def originals_per_hour(spark, sf_dir):
    originals_only = originals(_events(spark, sf_dir), _reshare_of())
    return append_result(tumbling_count(originals_only, "ts", "1 hour", delay="1 hour"))


@book.query("STR-2 STR-13 SRT-4", """
WITH counts AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n
                FROM events GROUP BY 1, 2)
SELECT * FROM (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n,
         CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS INTEGER) AS rank
  FROM counts) WHERE rank <= 2""")
def busiest_types_per_hour(spark, sf_dir):
    """The ranking is done in the callback on each batch's result."""
    counts = tumbling_count(_events(spark, sf_dir), "ts", "1 hour", ["event_type"])
    return complete_result(counts, prepare=lambda batch: top_in_window(batch, 2, ["event_type"]))


BY_TYPE = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"


@book.query("STR-3 STR-10 SRT-4", """
SELECT event_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place
FROM events GROUP BY event_type""")
def running_total(spark, sf_dir):
    """The batch function numbers the totals in their order, so the order is a column."""
    counts = running_count(_events(spark, sf_dir), "event_type")
    return complete_result(counts, prepare=lambda batch: numbered(batch, F.col("n").desc(), F.col("event_type")))


@book.query("UDF-2 STR-3 STR-12", """
WITH ordered AS (SELECT user_id, event_type,
                        lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
                        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
                 FROM events)
SELECT user_id, count(*) FILTER (before IS NOT NULL AND before <> event_type) AS changes,
       any_value(event_type) FILTER (back = 1) AS last_type
FROM ordered GROUP BY user_id""")
def type_changes(spark, sf_dir):
    """How often each user's event type changes: needs the last one seen, also across batches."""
    def update(key, rows, state):
        changes, last = state if state is not None else (0, None)
        types = rows["event_type"]
        before = types.shift(1, fill_value=last if last is not None else types.iloc[0])
        changes, last = changes + int((types != before).sum()), types.iloc[-1]
        return (changes, last), pd.DataFrame({"user_id": [key[0]], "changes": [changes], "last_type": [last]})

    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    path = scratch_path(spark, "changes")
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        changes = stateful_update(stream_events(spark, landing), ["user_id"], ["ts", "event_id"], update,
                                  "changes BIGINT, last_type STRING", "user_id BIGINT, changes BIGINT, last_type STRING")
        newest = updated_result(changes, "user_id", checkpoint=checkpoint, path=path)
    return newest


@book.query("UDF-2 STR-8 STR-12", """
WITH marked AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 12 HOUR, true) AS opens
                FROM events),
     sessions AS (SELECT user_id, ts, count(*) FILTER (opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
SELECT user_id, session, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS n FROM sessions
GROUP BY user_id, session HAVING max(ts) + INTERVAL 12 HOUR < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def user_sessions(spark, sf_dir):
    """Sessions that end 12 hours after a user's last event: open ones are a list in state, closed by the watermark."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "sessions")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        found = append_to(sessions(stream_events(spark, landing), ["user_id"], "ts", 12 * 3600, "1 hour"), out, checkpoint)
    return found.select("user_id", "session", plain_time("first_seen").alias("first_seen"), plain_time("last_seen").alias("last_seen"), "n")


@book.query("UDF-2 STR-3 STR-10", "SELECT user_id, event_type, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY ALL")
def tallies_per_user(spark, sf_dir):
    """A map in state, of which only the entries that a batch touches are read and put out."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    path = scratch_path(spark, "tallies")
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        changed = tallies(stream_events(spark, landing), ["user_id"], "event_type", "ts")
        newest = updated_result(changed, "user_id", "event_type", checkpoint=checkpoint, path=path)
    return newest.withColumn("last_seen", plain_time("last_seen"))


@book.query("STR-3 STR-10", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def running_total_updates(spark, sf_dir):
    """Only changed totals are written; the newest per user is the result."""
    return updated_result(running_count(_events(spark, sf_dir), "user_id"), "user_id")


SLIDING = """
WITH shifts AS (SELECT unnest(range(12)) AS i),
     counts AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS window_start,
                       event_type, count(*) AS n
                FROM events, shifts GROUP BY 1, 2)
"""
SLIDING_ROWS = SLIDING + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n FROM counts"""


@book.query("STR-4 STR-8", SLIDING_ROWS
            + " WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE")
def sliding_counts(spark, sf_dir):
    return append_result(sliding_count(_events(spark, sf_dir), "ts", "1 hour", "5 minutes",
                                       ["event_type"], delay="10 minutes"))


def _split_events(spark, sf_dir):
    """Everything but early clicks, and then these with the rest: rows that come late."""
    events = read(spark, sf_dir, "events")
    second = (F.col("event_type") == "click") | (F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    return events.where(~second), events.where(second)


def _by_half(spark, sf_dir):
    """The events in two parts, the second later in time than all of the first."""
    events = read(spark, sf_dir, "events")
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return events.where(first), events.where(~first)


@book.query("STR-4 STR-8", """
WITH split AS (SELECT *, event_type = 'click' OR ts >= TIMESTAMP '2024-01-16' AS second FROM events),
     shifts AS (SELECT unnest(range(12)) AS i),
     mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS first_mark,
                     (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS last_mark
              FROM split WHERE NOT second),
     rows AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS window_start,
                     event_type, second FROM split, shifts)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
FROM rows, mark
WHERE (NOT second OR window_start + INTERVAL 1 HOUR > first_mark)
  AND window_start + INTERVAL 1 HOUR <= last_mark GROUP BY ALL""")
def late_rows_in_open_windows(spark, sf_dir):
    """Clicks far later than the delay: they count in the windows that are still open, and only there."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _split_events(spark, sf_dir):
        land(part, landing)
        counts = sliding_count(stream_events(spark, landing), "ts", "1 hour", "5 minutes", ["event_type"], delay="10 minutes")
        windows = append_to(counts, out, checkpoint)
    return windows


@book.query("STR-4 STR-8 STR-12", SLIDING_ROWS
            + " WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE")
def sliding_counts_in_batches(spark, sf_dir):
    """Over two runs from one checkpoint: as no row is late, the result is that of one batch."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        counts = sliding_count(stream_events(spark, landing), "ts", "1 hour", "5 minutes", ["event_type"], delay="10 minutes")
        windows = append_to(counts, out, checkpoint)
    return windows


@book.query("STR-4 STR-8", """
WITH shifts AS (SELECT unnest(range(12)) AS i),
     rows AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS window_start, event_type, props
              FROM events, shifts)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, sum(length(props))::BIGINT AS chars
FROM rows WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY ALL""")
def sliding_ring_totals(spark, sf_dir):
    """By adding and subtracting slides in state; counts and another total in one ring."""
    return append_result(sliding_ring(_events(spark, sf_dir), "ts", "1 hour", "5 minutes", ["event_type"], "10 minutes",
                                      sums={"chars": F.length("props")}))


@book.query("STR-4 STR-8 STR-12", """
WITH split AS (SELECT *, event_type = 'click' OR ts >= TIMESTAMP '2024-01-16' AS second FROM events),
     shifts AS (SELECT unnest(range(12)) AS i),
     mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS first_mark,
                     (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS last_mark
              FROM split WHERE NOT second),
     rows AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INTEGER)) AS window_start,
                     user_id % 7 AS "group", second FROM split, shifts)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, "group", count(*) AS n
FROM rows, mark
WHERE (NOT second OR window_start + INTERVAL 1 HOUR > first_mark)
  AND window_start + INTERVAL 1 HOUR <= last_mark GROUP BY ALL""")
def late_rows_in_rings(spark, sf_dir):
    """Over two runs, clicks far later than the delay: a late row changes the windows still open, and no others."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _split_events(spark, sf_dir):
        land(part, landing)
        rows = stream_events(spark, landing).select("ts", (F.col("user_id") % 7).alias("group"))
        windows = append_to(sliding_ring(rows, "ts", "1 hour", "5 minutes", ["group"], "10 minutes"), out, checkpoint)
    return windows


@book.query("STR-4", SLIDING_ROWS)
def sliding_counts_stored(spark, sf_dir):
    """The same operator over the table itself."""
    events = read(spark, sf_dir, "events").withColumn("ts", event_time("ts"))
    return sliding_count(events, "ts", "1 hour", "5 minutes", ["event_type"])


@book.query("STR-7 SRT-4 STR-10", SLIDING + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n,
       row_number() OVER (PARTITION BY window_start ORDER BY n DESC, event_type) AS rank
FROM counts""")
def sliding_counts_complete(spark, sf_dir):
    """The stream counts slides; the batch function spreads them over the windows and ranks these."""
    keys = ["event_type"]
    counts = slide_count(_events(spark, sf_dir), "ts", "5 minutes", keys)
    return complete_result(counts, prepare=lambda batch: ranked_in_window(
        windows_from_slides(batch, "1 hour", "5 minutes", keys), keys))


DASHBOARD = """
WITH shifts AS (SELECT unnest(range(4)) AS i),
     rows AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * i AS INTEGER)) AS window_start,
                     props AS language, length(event_type) AS size, user_id, value
              FROM events, shifts),
     summary AS (SELECT window_start, language, count(*) AS n, round(avg(size), 2) AS avg_size,
                        first(user_id ORDER BY value DESC, user_id) AS user_id, max(value) AS value
                 FROM rows GROUP BY ALL),
     placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, language)
                               AS INTEGER) AS rank FROM summary)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, language, n, avg_size, user_id,
       value, rank FROM placed WHERE rank <= 10"""


def _scored(events):
    """The payload stands for the language: it has a hundred values."""
    return events.select("ts", F.col("props").alias("language"), F.length("event_type").alias("size"), "user_id", "value")


@book.query("STR-5 STR-13 AGG-12 WIN-1", DASHBOARD)
def language_dashboard(spark, sf_dir):
    """The stream adds up per slide and user; the batch function makes windows of that and picks the busiest."""
    panes = user_panes(_scored(_events(spark, sf_dir)), "ts", "6 hours", user="user_id", weight="value")
    return complete_result(panes, prepare=lambda batch: busiest(
        dashboard_of(batch, "1 day", "6 hours", user="user_id", weight="value")))


@book.query("STR-5", DASHBOARD)
def language_dashboard_stored(spark, sf_dir):
    """The same operator over the table itself."""
    rows = _scored(read(spark, sf_dir, "events").withColumn("ts", event_time("ts")))
    return busiest(dashboard(rows, "ts", "1 day", "6 hours", user="user_id", weight="value"))


@book.query("STR-5 STR-8", """
WITH split AS (SELECT *, event_type = 'click' OR ts >= TIMESTAMP '2024-01-16' AS second FROM events),
     shifts AS (SELECT unnest(range(4)) AS i),
     mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS first_mark, (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS last_mark
              FROM split WHERE NOT second),
     rows AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - to_hours(CAST(6 * i AS INTEGER)) AS window_start,
                     event_type AS language, length(props) AS size, user_id, value, second FROM split, shifts)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, language, count(*) AS n, round(avg(size), 2) AS avg_size,
       first(user_id ORDER BY value DESC, user_id) AS user_id, max(value) AS value
FROM rows, mark WHERE (NOT second OR window_start + INTERVAL 1 DAY > first_mark)
  AND window_start + INTERVAL 1 DAY <= last_mark GROUP BY ALL""")
def dashboard_with_late_rows(spark, sf_dir):
    """Two chained stateful aggregates, over two runs: late clicks reach the windows still open."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "dashboards")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _split_events(spark, sf_dir):
        land(part, landing)
        rows = stream_events(spark, landing).select(
            "ts", F.col("event_type").alias("language"), F.length("props").alias("size"), "user_id", "value")
        boards = append_to(dashboard(rows, "ts", "1 day", "6 hours", user="user_id", weight="value", delay="1 hour"), out, checkpoint)
    return boards


def _post_records(events):
    """Events as JSON posts in broker records; errors reshare something."""
    person = F.struct(F.concat(F.lit("user"), "user_id").alias("username"),
                      F.col("user_id").alias("followers_count"))
    post = F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("ts").cast("string").alias("created_at"),
        F.concat(F.lit("<p>"), "event_type", F.lit(" &amp; more</p>")).alias("content"),
        F.col("event_type").alias("language"),
        F.when(F.col("event_type") == "error", F.struct(F.col("event_id").alias("id"))).alias("reblog"),
        person.alias("account"))
    return to_records(events, "event_id", F.to_json(post), event_time("ts"))


@book.query("STR-6 JSN-1 PRJ-2 PRJ-8", """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS created_at, event_type AS language,
       'user' || user_id AS username, user_id AS followers_count
FROM events WHERE event_type <> 'error'""")
def projected_posts(spark, sf_dir):
    records = _post_records(stream_table(spark, f"{sf_dir}/events.parquet"))
    posts = original_posts(records).withColumn("created_at", plain_time("created_at")).drop("content")
    return append_result(posts)


@book.query("STR-7 DTM-3 JSN-1", """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
       time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type AS language,
       count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 1 DAY""")
def posts_per_day(spark, sf_dir):
    records = _post_records(stream_table(spark, f"{sf_dir}/events.parquet"))
    return append_result(tumbling_count(timed_posts(records), "created_at", "1 day", ["language"],
                                        delay="1 day"))


@book.query("STR-5 STR-8 TXT-6 PRJ-11", """
WITH shifts AS (SELECT unnest(range(2)) AS i),
     rows AS (SELECT time_bucket(INTERVAL 1 DAY, ts) - to_days(CAST(i AS INTEGER)) AS window_start,
                     event_type, user_id
              FROM events, shifts WHERE event_type <> 'error')
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, event_type AS language,
       count(*) AS n, round(avg(length(event_type) + 7), 2) AS avg_size,
       first('user' || user_id ORDER BY user_id DESC, 'user' || user_id) AS "user",
       max(user_id) AS followers
FROM rows GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 1 DAY""")
def post_dashboard(spark, sf_dir):
    """From JSON records to the dashboard, entities decoded on the way."""
    records = _post_records(stream_table(spark, f"{sf_dir}/events.parquet"))
    posts = dashboard_posts(records, "timestamp")
    return append_result(dashboard(posts, "timestamp", "2 days", "1 day", delay="1 day"))


@book.query("STR-14 JSN-1 SRC-15", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
       ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, event_type = 'error' AS bad
FROM events""")
def quarantined_records(spark, sf_dir):
    """Payloads of errors are cut short; one pass writes good and bad rows apart."""
    cut = F.when(F.col("event_type") == "error", F.substr("props", F.lit(1), F.length("props") - 1)
                 ).otherwise(F.col("props"))
    rows = stream_table(spark, f"{sf_dir}/events.parquet").withColumn("props", cut)
    flagged = parse_json(rows, "props", "k BIGINT").select("event_id", F.col("payload.k").alias("k"), "bad")
    return append_to(flagged, scratch_path(spark, "sorted-out"), partition_by="bad")


@book.query("STR-8", """
WITH split AS (SELECT *, event_type = 'click' OR ts >= TIMESTAMP '2024-01-16' AS second FROM events),
     mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS first_mark,
                     (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS last_mark
              FROM split WHERE NOT second),
     rows AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, second FROM split)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
FROM rows, mark
WHERE (NOT second OR window_start + INTERVAL 1 HOUR > first_mark)
  AND window_start + INTERVAL 1 HOUR <= last_mark GROUP BY ALL""")
def late_rows_left_out(spark, sf_dir):
    """Early clicks arrive after the first half of everything else: too late to count."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "hours")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in _split_events(spark, sf_dir):
        land(part, landing)
        counts = tumbling_count(stream_events(spark, landing), "ts", "1 hour", ["event_type"], delay="1 hour")
        hours = append_to(counts, out, checkpoint)
    return hours


DOMAIN_WINDOWS = """
WITH windows AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                        CAST(user_id % 10 AS VARCHAR) AS domain, event_type, count(*) AS n
                 FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1, 2, 3),
"""


def _domain_records(spark, sf_dir):
    """Hourly counts per tenth of the users as records of both kinds, one folder each.

    Domain 3 counts in billions, and the records of domain 4 are cut short.
    """
    path = scratch_path(spark, "domain-records")
    rows = read(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase"))
    counts = rows.groupBy("event_type", F.window(event_time("ts"), "1 hour").alias("window"),
                          (F.col("user_id") % 10).cast("string").alias("domain")).count()
    counts = counts.withColumn("count", F.when(F.col("domain") == "3", F.col("count") * 3_000_000_000).otherwise(F.col("count")))
    value = F.to_json(F.struct(
        F.struct(F.col("window.start").cast("string").alias("start"),
                 F.col("window.end").cast("string").alias("end")).alias("window"),
        "domain", "count"))
    value = F.when(F.col("domain") == "4", F.substr(value, F.lit(1), F.length(value) - 3)).otherwise(value)
    counts = stage(counts.withColumn("value", value), "domain-counts")
    folders = []
    for kind in ("click", "purchase"):
        one = counts.where(F.col("event_type") == kind)
        write_records(to_records(one, "domain", "value", "window.end"), "files", f"{path}/{kind}", topic=kind)
        folders.append(f"{path}/{kind}")
    return folders


@book.query("JOIN-4 STR-9 STR-8 PRJ-10 PRJ-11 SRC-6", DOMAIN_WINDOWS + """
     readable AS (SELECT window_start, domain, event_type, CASE WHEN domain = '3' THEN n * 3000000000 ELSE n END AS n
                  FROM windows WHERE domain <> '4'),
     l AS (SELECT * FROM readable WHERE event_type = 'click'),
     r AS (SELECT * FROM readable WHERE event_type = 'purchase'),
     mark AS (SELECT least((SELECT max(window_start) FROM l), (SELECT max(window_start) FROM r))
                     + INTERVAL 1 HOUR - INTERVAL 2 HOUR AS mark)
SELECT l.window_start, l.window_start + INTERVAL 1 HOUR AS window_end, l.domain,
       l.n AS original_count, coalesce(r.n, 0) AS reshare_count
FROM l LEFT JOIN r USING (window_start, domain), mark
WHERE r.n IS NOT NULL OR l.window_start + INTERVAL 1 HOUR <= mark""")
def domain_comparison(spark, sf_dir):
    """Clicks are originals, purchases reshares; a domain is a tenth of the users."""
    streams = [stream_records(spark, "files", path) for path in _domain_records(spark, sf_dir)]
    joined = compare_domains(*streams, "2 hours")
    return append_result(joined.select(
        plain_time("window.start").alias("window_start"), plain_time("window.end").alias("window_end"),
        "domain", "original_count", "reshare_count"))


@book.query("JOIN-4 STR-9", """
WITH clicks AS (SELECT event_id, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                       CASE WHEN user_id % 2 = 0 THEN 'hot' ELSE (user_id % 10)::VARCHAR END AS domain
                FROM events WHERE event_type = 'click'),
     counts AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                       CASE WHEN user_id % 2 = 0 THEN 'hot' ELSE (user_id % 10)::VARCHAR END AS domain, count(*) AS n
                FROM events WHERE event_type = 'purchase' GROUP BY ALL),
     mark AS (SELECT least((SELECT max(window_end) FROM clicks), (SELECT max(window_end) FROM counts)) - INTERVAL 2 HOUR AS mark)
SELECT event_id, window_end, domain, coalesce(n, 0) AS purchases
FROM clicks LEFT JOIN counts USING (window_end, domain), mark WHERE n IS NOT NULL OR window_end <= mark""")
def hot_domain_comparison(spark, sf_dir):
    """Every click with the purchases of its domain and hour; half of all clicks are of one domain, spread over eight states."""
    events = read(spark, sf_dir, "events")
    domain = F.when(F.col("user_id") % 2 == 0, "hot").otherwise((F.col("user_id") % 10).cast("string")).alias("domain")
    rows = events.select("event_id", "event_type", F.window(event_time("ts"), "1 hour")["end"].alias("window_end"), domain)
    clicks, counts = scratch_path(spark, "clicks"), scratch_path(spark, "purchases")
    land(rows.where("event_type = 'click'").drop("event_type"), clicks)
    land(rows.where("event_type = 'purchase'").groupBy("window_end", "domain").agg(F.count(F.lit(1)).alias("n")), counts)
    joined = join_streams_left(stream_table(spark, clicks), stream_table(spark, counts), ["window_end", "domain"], "event_id", "n",
                               delay="2 hours", right_as="purchases", salts=8, salt_by=["event_id"])
    return append_result(joined.withColumn("window_end", plain_time("window_end")))


@book.query("STR-14 JOIN-4", DOMAIN_WINDOWS + """
     one AS (SELECT 1)
SELECT event_type AS topic, domain, domain = '4' AS bad, count(*) AS records FROM windows GROUP BY ALL""")
def domain_records_sorted_out(spark, sf_dir):
    """One pass over each stream writes readable and unreadable records apart; both are kept."""
    found = None
    for path in _domain_records(spark, sf_dir):
        flagged = parse_json(stream_records(spark, "files", path), "value", DOMAIN_SCHEMA).select(
            "topic", F.col("key").cast("string").alias("domain"), F.col("value").cast("string").alias("value"), "bad")
        for rows, bad in zip(sort_out(flagged, scratch_path(spark, "sorted-records")), (False, True)):
            counts = rows.groupBy("topic", "domain").agg(F.count(F.lit(1)).alias("records")).withColumn("bad", F.lit(bad))
            found = counts if found is None else found.unionByName(counts)
    return found


@book.query("STR-10 SRC-15", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def compacted_updates(spark, sf_dir):
    """An update-mode table compacted between two runs: readers go on with the newest row per user."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    table = BatchTable(spark)
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        drain(for_each_batch(running_count(stream_events(spark, landing), "user_id"), table, "update", checkpoint))
        table.compact("user_id")
    return table.latest_by("user_id")


@book.query("STR-11", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def interval_replay(spark, sf_dir):
    """The same by a trigger at intervals, stopped when all there is has been worked through."""
    table = BatchTable(spark)
    query = for_each_batch(running_count(_events(spark, sf_dir), "user_id"), table, "update", trigger="1 second")
    query.processAllAvailable()
    query.stop()
    return table.latest_by("user_id")


@book.query("STR-11 SRC-6", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def capped_replay(spark, sf_dir):
    """A cap on the files per micro-batch that makes about four batches of any table."""
    landing = land(read(spark, sf_dir, "events"), scratch_path(spark, "landing"), "event_type")
    files = spark.read.parquet(landing).select("_metadata.file_path").distinct().count()
    arriving = stream_table(spark, landing, per_trigger=max(1, files // 4))
    return updated_result(running_count(arriving, "user_id"), "user_id")


@book.query("STR-12 STR-3", BY_TYPE)
def restarted_total(spark, sf_dir):
    """Half the rows, a stop, the other half: the totals carry on from the checkpoint."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for part in _by_half(spark, sf_dir):
        land(part, landing)
        counts = running_count(stream_events(spark, landing), "event_type")
        totals = complete_result(counts, checkpoint)
    return totals


@book.query("STR-12 STR-13", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def replay_after_a_failure(spark, sf_dir):
    """The second batch is written and dies before it is committed; run again from the checkpoint, it replaces itself."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    table = BatchTable(spark)

    def dies_after_writing(batch, number):
        table(batch, number)
        if number == 1:
            raise RuntimeError("lost between writing and committing")

    for part, action in zip(_by_half(spark, sf_dir), (table, dies_after_writing)):
        land(part, landing)
        try:
            drain(for_each_batch(running_count(stream_events(spark, landing), "user_id"), action, "update", checkpoint))
        except StreamingQueryException as error:
            if action is table or "lost between" not in str(error):
                raise
    drain(for_each_batch(running_count(stream_events(spark, landing), "user_id"), table, "update", checkpoint))
    return table.latest_by("user_id")


@book.query("STR-13", """SELECT event_type, max(value) AS highest,
                               CAST(sum(value::DECIMAL(18, 2)) AS DOUBLE) AS total
                         FROM events GROUP BY event_type""")
def batch_callback(spark, sf_dir):
    """Any batch operator inside the callback; partial results are merged on reading."""
    table = BatchTable(spark, prepare=lambda batch: batch.groupBy("event_type").agg(
        F.max("value").alias("highest"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")))
    drain(for_each_batch(_events(spark, sf_dir), table))
    return table.all_batches().groupBy("event_type").agg(
        F.max("highest").alias("highest"), F.sum("total").cast("double").alias("total"))
