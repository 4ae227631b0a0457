import json
import os
import subprocess
import sys
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.timing import event_time, plain_time
from tidemark.operators.payloads import parse_json
from tidemark.plans.dashboard import busiest, dashboard
from tidemark.plans.domains import compare_domains
from tidemark.plans.posts import dashboard_posts, original_posts, parsed_posts, timed_posts
from tidemark.sources.records import stream_records, to_records, write_records
from tidemark.streaming.output import (AVAILABLE_NOW, BatchTable, append_to, complete_result, drain,
                                       for_each_batch, show_stream, updated_result, write_stream)
from tidemark.streaming.replay import land, stream_events, stream_table
from tidemark.streaming.state import stateful_update
from tidemark.streaming.windows import (in_panes, largest_first, newest_first, running_count,
                                        seconds_of, sliding_count, top_in_window, tumbling_count)

START = datetime(2024, 3, 1, 12, 0, 0)


def at(seconds):
    return START + timedelta(seconds=seconds)


class Feed:
    """A landing folder and a checkpoint; every push is one micro-batch."""

    def __init__(self, spark, folder, schema, name="feed"):
        self.spark, self.schema = spark, schema
        self.path, self.checkpoint = f"{folder}/{name}", f"{folder}/{name}-checkpoint"
        self.out = f"{folder}/{name}-out"

    def push(self, *items):
        land(self.spark.createDataFrame(list(items), self.schema), self.path)
        return self

    def stream(self, ts="ts"):
        return stream_events(self.spark, self.path, ts) if ts else stream_table(self.spark, self.path)

    def append(self, build):
        return append_to(build(self.stream()), self.out, self.checkpoint)


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING")


def window(start, end, *rest):
    return (at(start), at(end), *rest)


def test_durations():
    assert seconds_of("5 seconds") == 5 and seconds_of("1 minute") == 60 and seconds_of("2 DAYS") == 172800
    assert seconds_of("1 month") is None and seconds_of("1 hour 5 minutes") is None
    assert in_panes("60 seconds", "5 seconds") and not in_panes("7 seconds", "2 seconds")
    assert not in_panes("1 month", "1 day")


def test_tumbling_count_closes_windows_and_ignores_late_rows(feed):
    def build(s):
        return tumbling_count(s, "ts", "10 seconds", ["lang"], delay="10 seconds")

    assert rows(feed.push((at(1), "es"), (at(9), "es"), (at(12), "ca")).append(build)) == []
    # The watermark is at 12 - 10 = 2: a row for the first window is late but counts.
    feed.push((at(3), "es"), (at(31), "es"))
    assert rows(feed.append(build)) == [window(0, 10, "es", 3), window(10, 20, "ca", 1)]
    # Now it is at 21: the first window is closed, the third is not.
    feed.push((at(4), "es"), (at(22), "es"), (at(50), "es"))
    assert rows(feed.append(build)) == [
        window(0, 10, "es", 3), window(10, 20, "ca", 1), window(20, 30, "es", 1), window(30, 40, "es", 1)]


def test_sliding_count_has_no_rows_for_absent_keys(spark, feed):
    feed.push((at(0), "es"), (at(7), "ca"), (at(100), "es"))
    counts = sliding_count(feed.stream(), "ts", "60 seconds", "5 seconds", ["lang"])
    got = complete_result(newest_first(counts, ["lang"]))
    assert got.where("n = 0").count() == 0
    assert got.agg(F.sum("n")).first()[0] == 3 * 12
    assert got.where("lang = 'ca'").agg(F.max("window_end")).first()[0] == at(65)
    stored = spark.read.parquet(feed.path).withColumn("ts", event_time("ts"))
    for size, slide in (("60 seconds", "5 seconds"), ("7 seconds", "2 seconds"), ("10 seconds", "10 seconds")):
        by_stream = complete_result(sliding_count(feed.stream(), "ts", size, slide, ["lang"]))
        assert rows(by_stream) == rows(sliding_count(stored, "ts", size, slide, ["lang"]))


def test_sliding_count_appended_equals_closed_windows(spark, feed):
    def build(s):
        return sliding_count(s, "ts", "20 seconds", "5 seconds", ["lang"], delay="10 seconds")

    feed.push((at(1), "es"), (at(9), "es"), (at(12), "ca")).append(build)
    feed.push((at(8), "ca"), (at(44), "es")).append(build)
    got = feed.push((at(61), "ca")).append(build)
    stored = spark.read.parquet(feed.path).withColumn("ts", event_time("ts"))
    whole = sliding_count(stored, "ts", "20 seconds", "5 seconds", ["lang"])
    assert rows(got) == rows(whole.where(F.col("window_end") <= F.lit(at(51)).cast("timestamp_ntz")))
    assert got.count() > 8


def test_running_total_survives_a_restart(feed):
    def run():
        return complete_result(largest_first(running_count(feed.stream(), "lang"), ["lang"]),
                               feed.checkpoint, path=feed.out)

    assert rows(feed.push((at(0), "es"), (at(1), "ca"), (at(2), "es")) and run()) == [("ca", 1), ("es", 2)]
    feed.push((at(3), "ca"), (at(4), "ca"), (at(5), None))
    assert rows(run()) == [("ca", 3), ("es", 2), (None, 1)]
    # A new process that finds nothing new still knows the result.
    assert rows(run()) == [("ca", 3), ("es", 2), (None, 1)]


def test_update_mode_writes_only_changes(spark, folder, feed):
    table = BatchTable(spark, f"{folder}/updates")
    for batch in ([(at(0), "es"), (at(1), "ca")], [(at(2), "es")]):
        feed.push(*batch)
        drain(for_each_batch(running_count(feed.stream(), "lang"), table, "update", feed.checkpoint))
    assert rows(table.all_batches()) == sorted([("ca", 1, 0), ("es", 1, 0), ("es", 2, 1)], key=repr)
    assert rows(table.latest_by("lang")) == [("ca", 1), ("es", 2)]
    assert rows(table.snapshot()) == [("es", 2)]


def test_capped_trigger_takes_one_file_at_a_time(spark, feed):
    for n in range(3):
        feed.push((at(n), "es"), (at(n), "ca"))
    files = len(spark.read.parquet(feed.path).inputFiles())
    numbers = []
    drain(for_each_batch(stream_table(spark, feed.path, per_trigger=1), lambda b, n: numbers.append(n)))
    assert numbers == list(range(files))
    assert rows(updated_result(running_count(stream_table(spark, feed.path, 1), "lang"), "lang")) == [
        ("ca", 3), ("es", 3)]


def test_top_of_each_window_settles_ties(spark, feed):
    feed.push(*[(at(i), k) for i, k in enumerate(["ca", "es", "en", "en"])], (at(15), "fr"))
    counts = tumbling_count(feed.stream(), "ts", "10 seconds", ["lang"])
    got = complete_result(counts, prepare=lambda batch: top_in_window(batch, 2, ["lang"]))
    assert rows(got) == [window(0, 10, "ca", 1, 2), window(0, 10, "en", 2, 1), window(10, 20, "fr", 1, 1)]


def test_a_failing_callback_stops_the_stream(feed):
    def fail(batch, number):
        raise ValueError("no room")

    feed.push((at(0), "es"))
    with pytest.raises(StreamingQueryException, match="no room"):
        drain(for_each_batch(feed.stream(), fail))


def test_console_and_interval_trigger(feed, capfd):
    feed.push((at(0), "es"))
    drain(show_stream(running_count(feed.stream(), "lang"), "complete", 5, trigger=AVAILABLE_NOW))
    query = write_stream(feed.stream(), sink="noop", trigger="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()


def post(i, seconds=0, **fields):
    body = {"id": str(i), "created_at": at(seconds).isoformat() + "Z", "content": "<p>hello</p>",
            "language": "es", "reblog": None, "account": {"acct": f"u{i}", "username": f"U{i}",
                                                         "display_name": "", "followers_count": i}}
    body.update(fields)
    return json.dumps(body)


POSTS = {
    "plain": post(1),
    "reshared": post(2, reblog={"id": "1", "account": {"acct": "x"}}),
    "no language": post(3, language=None),
    "empty language": post(4, language=""),
    "text instead": post(5, content="", text="Fish &amp; <b>chips</b>"),
    "second name": post(6, account={"acct": "", "username": "six", "followers_count": None}),
    "user instead": post(7, account=None, user={"display_name": "Seven", "followers_count": "70"}),
    "nobody": post(8, account={}),
    "broken": '{"id": "9", "language": "es"',
    "not json": "hello",
    "bad time": post(10, created_at="yesterday"),
}


@pytest.fixture
def post_records(spark, folder):
    df = spark.createDataFrame([(k, v) for k, v in POSTS.items()], "k STRING, v STRING")
    write_records(to_records(df, "k", "v"), "files", f"{folder}/posts")
    return stream_records(spark, "files", f"{folder}/posts")


def test_only_readable_original_posts_are_projected(spark, folder, post_records):
    got = append_to(original_posts(post_records), f"{folder}/out")
    assert {r["id"] for r in got.collect()} == {"1", "3", "4", "5", "6", "7", "8", "10"}
    assert tuple(got.where("id = '1'").first()) == (
        "1", "2024-03-01T12:00:00Z", "<p>hello</p>", "es", "U1", 1)
    good, bad = parsed_posts(post_records)
    assert append_to(bad.select(F.col("key").cast("string")), f"{folder}/bad").count() == 2
    timed = append_to(timed_posts(post_records), f"{folder}/timed")
    assert timed.count() == 6


def test_dashboard_fields_fall_back(folder, post_records):
    posts = dashboard_posts(post_records.withColumn("k", F.col("key").cast("string")), "k")
    got = {r["k"]: tuple(r)[1:] for r in append_to(posts, f"{folder}/out").collect()}
    assert got == {
        "plain": ("es", 5, "u1", 1), "empty language": ("", 5, "u4", 4),
        "text instead": ("es", len("Fish & chips"), "u5", 5), "second name": ("es", 5, "six", 0),
        "user instead": ("es", 5, "Seven", 70), "nobody": ("es", 5, "unknown", 0),
        "bad time": ("es", 5, "u10", 10)}


@pytest.fixture
def scored(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, language STRING, size INT, user STRING, followers BIGINT")
    return feed.push((at(1), "es", 10, "zoe", 5), (at(2), "es", 5, "ann", 5), (at(3), "ca", 7, "bo", 1),
                     (at(12), "es", 3, "cy", 9), (at(41), "en", 1, "dan", 0))


def test_dashboard_on_stream_and_table(spark, scored):
    live = complete_result(dashboard(scored.stream(), "ts", "20 seconds", "5 seconds"))
    stored = dashboard(spark.read.parquet(scored.path).withColumn("ts", event_time("ts")),
                       "ts", "20 seconds", "5 seconds")
    assert rows(live) == rows(stored)
    assert window(0, 20, "es", 3, 6.0, "cy", 9) in rows(stored)
    assert window(-5, 15, "es", 3, 6.0, "cy", 9) in rows(stored)
    assert window(-10, 10, "es", 2, 7.5, "ann", 5) in rows(stored)
    first = busiest(stored, 1).where(F.col("window_start") == F.lit(at(0)).cast("timestamp_ntz"))
    assert first.select("language").first()[0] == "es"
    odd = [dashboard(s, "ts", "7 seconds", "2 seconds") for s in (
        scored.stream(), spark.read.parquet(scored.path).withColumn("ts", event_time("ts")))]
    assert rows(complete_result(odd[0])) == rows(odd[1])


def test_dashboard_appended_equals_closed_windows(spark, scored):
    live = scored.append(lambda s: dashboard(s, "ts", "20 seconds", "5 seconds", delay="5 seconds"))
    stored = dashboard(spark.read.parquet(scored.path).withColumn("ts", event_time("ts")),
                       "ts", "20 seconds", "5 seconds")
    closed = stored.where(F.col("window_end") <= F.lit(at(36)).cast("timestamp_ntz"))
    assert rows(live) == rows(closed) and live.count() > 5


def count_record(minute, domain, n, start=None):
    begin = at(60 * minute).strftime("%Y-%m-%d %H:%M:%S") if start is None else start
    end = at(60 * minute + 60).strftime("%Y-%m-%d %H:%M:%S")
    return (domain or "", json.dumps({"window": {"start": begin, "end": end}, "domain": domain, "count": n}))


class Domains:
    def __init__(self, spark, folder, single=False):
        self.spark, self.folder, self.single = spark, folder, single

    def push(self, originals=(), reshares=()):
        for name, items in (("originals", originals), ("reshares", reshares)):
            df = self.spark.createDataFrame(list(items), "k STRING, v STRING")
            write_records(to_records(df, "k", "v"), "files", f"{self.folder}/{name}")
        joined = compare_domains(*(stream_records(self.spark, "files", f"{self.folder}/{n}")
                                   for n in ("originals", "reshares")), single=self.single)
        flat = joined.select(plain_time("window.start").alias("start"), "domain", "original_count", "reshare_count")
        got = append_to(flat, f"{self.folder}/out", f"{self.folder}/checkpoint")
        return sorted((int((r["start"] - START).total_seconds() // 60), r["domain"], r["original_count"],
                       r["reshare_count"]) for r in got.collect())


def test_two_streams_joined(spark, folder):
    domains = Domains(spark, folder)
    # A match in the same batch, and records with a missing window, domain or bad JSON.
    got = domains.push([count_record(0, "a", 5), count_record(0, "b", 6), count_record(1, "c", 7),
                        count_record(0, None, 1), count_record(0, "a", 1, start="soon"), ("x", "{oops")],
                       [count_record(0, "a", 2)])
    assert got == [(0, "a", 5, 2)]
    # A match in a later batch.  Both streams have reached minute 3, so what found
    # no match up to minute 1 comes out with 0.
    got = domains.push([count_record(2, "a", 1)], [count_record(1, "c", 3), count_record(2, "z", 9)])
    assert got == [(0, "a", 5, 2), (0, "b", 6, 0), (1, "c", 7, 3)]
    got = domains.push([count_record(9, "a", 1)], [count_record(9, "q", 1)])
    assert got == [(0, "a", 5, 2), (0, "b", 6, 0), (1, "c", 7, 3), (2, "a", 1, 0)]
    # A match after that is too late.
    assert domains.push([count_record(9, "d", 1)], [count_record(0, "b", 4)]) == got


def test_repeated_counts_multiply_unless_single(spark, folder):
    twice = ([count_record(0, "a", 5)], [count_record(0, "a", 2), count_record(0, "a", 3)])
    assert Domains(spark, f"{folder}/all").push(*twice) == [(0, "a", 5, 2), (0, "a", 5, 3)]
    later = ([count_record(9, "a", 1)], [count_record(9, "a", 1)])
    one = Domains(spark, f"{folder}/one", single=True)
    one.push(*twice)
    one.push(*later)
    assert one.push([count_record(20, "a", 1)], [count_record(20, "a", 1)])[0] == (0, "a", 5, 3)


def test_bad_payloads_are_written_apart(spark, folder):
    feed = Feed(spark, folder, "value STRING")
    feed.push(("{\"k\": 1}",), ("{\"k\"",), (None,), ("{}",))
    flagged = parse_json(feed.stream(None), "value", "k INT").select("payload.k", "bad")
    got = append_to(flagged, f"{folder}/sorted", partition_by="bad")
    assert sorted(os.listdir(f"{folder}/sorted"))[-2:] == ["bad=false", "bad=true"]
    assert rows(got.groupBy("bad").count()) == [(False, 2), (True, 2)]


def test_window_counts_add_up(spark, sf_dir):
    events = stream_events(spark, f"{sf_dir}/events.parquet")
    counts = complete_result(sliding_count(events, "ts", "1 hour", "5 minutes", ["event_type"]))
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert counts.agg(F.sum("n")).first()[0] == n * 12


def test_a_late_row_counts_in_open_windows_unless_panes_are_asked_for(spark, folder):
    """Delay 10 minutes, windows of an hour by 5 minutes, one row 20 minutes late."""
    found = {}
    for panes in (None, True):
        feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING", f"panes-{panes}")

        def build(s, panes=panes):
            return sliding_count(s, "ts", "1 hour", "5 minutes", ["lang"], delay="10 minutes", panes=panes)

        feed.push((at(0), "en"), (at(3600), "en")).append(build)
        feed.push((at(2400), "fr"), (at(3700), "en")).append(build)
        found[panes] = feed.push((at(20000), "en")).append(build).where("lang = 'fr'").count()
    # The row at 40 minutes is in 12 windows; those ending at 45 and 50 minutes had closed.
    assert found == {None: 10, True: 0}
    with pytest.raises(ValueError):
        sliding_count(feed.stream(), "ts", "1 hour", "5 minutes", panes=True)


def test_state_is_kept_across_batches_and_expires(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING, v LONG")

    def update(key, frame, state):
        last = state[0] if state is not None else None
        rises = int((frame["v"].diff().fillna(frame["v"].iloc[0] - last if last is not None else 0) > 0).sum())
        return (int(frame["v"].iloc[-1]),), pd.DataFrame({"lang": [key[0]], "rises": [rises]})

    def run():
        table = BatchTable(spark, feed.out)
        changes = stateful_update(feed.stream(), ["lang"], ["ts"], update, "last LONG", "lang STRING, rises LONG")
        drain(for_each_batch(changes, table, "update", feed.checkpoint))
        return rows(table.snapshot())

    feed.push((at(0), "en", 5), (at(9), "en", 3), (at(1), "en", 7), (at(0), "fr", 1))
    assert run() == [("en", 1), ("fr", 0)]
    feed.push((at(20), "en", 4))
    assert run() == [("en", 1)]


def test_compaction_keeps_the_newest_row_per_key(spark, folder, feed):
    table = BatchTable(spark, f"{folder}/totals")
    for n, langs in enumerate((["en", "fr"], ["en"], ["de", "en"])):
        feed.push(*[(at(n), lang) for lang in langs])
        drain(for_each_batch(running_count(feed.stream(), "lang"), table, "update", feed.checkpoint))
        if n == 1:
            table.compact("lang")
            assert rows(table.all_batches().select("lang", "n")) == [("en", 2), ("fr", 1)]
    assert rows(table.latest_by("lang").select("lang", "n")) == [("de", 1), ("en", 3), ("fr", 1)]


def test_compaction_is_found_by_any_reader(spark, folder, feed):
    """A second object, as in a second process, opens the compacted rows and later batches only."""
    path = f"{folder}/totals"
    table = BatchTable(spark, path)
    pushes = [["en", "fr", None], ["en", None], ["de", "en"], ["fr"], ["en", "xx", None]]
    for n, langs in enumerate(pushes):
        feed.push(*[(at(n), lang) for lang in langs])
        drain(for_each_batch(running_count(feed.stream(), "lang"), table, "update", feed.checkpoint))
        if n in (1, 3):
            BatchTable(spark, path).compact("lang")
    other = BatchTable(spark, path)
    wanted = {}
    for lang in sum(pushes, []):
        wanted[lang] = wanted.get(lang, 0) + 1
    assert rows(other.latest_by("lang").select("lang", "n")) == sorted(wanted.items(), key=repr)
    assert other.last_compaction()["upto"] == 3
    batches = other.all_batches().groupBy("batch").count()
    assert other.all_batches().count() == 4 + 3 and {r["batch"] for r in batches.collect()} <= {0, 1, 2, 3, 4}
    assert spark.catalog.listTables() == [t for t in spark.catalog.listTables() if "compact" not in t.name]


def test_a_second_compaction_joins_buckets_without_shuffling_the_first(spark, folder):
    path = f"{folder}/totals"
    table = BatchTable(spark, path)
    table(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0)
    table.compact("k")
    table(spark.range(5).select(F.col("id").alias("k"), F.lit(2).alias("n")), 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        newest = BatchTable(spark, path).latest_by("k")
        plan = newest._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 4 out of 4" in plan
        join = plan[plan.index("SortMergeJoin"):plan.index("SelectedBucketsCount: 4 out of 4")]
        assert "Exchange" not in join
        assert newest.groupBy("n").count().orderBy("n").collect() == [(1, 995), (2, 5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_compaction_that_dies_before_its_log_leaves_no_trace(spark, folder, monkeypatch):
    path = f"{folder}/totals"
    table = BatchTable(spark, path)
    table(spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0)
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.compact("k")
    monkeypatch.undo()
    assert table.last_compaction() is None and BatchTable(spark, path).latest_by("k").count() == 10


COMPACT_ELSEWHERE = """
from tidemark import build_session
from tidemark.streaming.output import BatchTable
spark = build_session("second", "local[2]")
table = BatchTable(spark, "{0}")
print("FOUND", table.last_compaction()["upto"], sorted((r["k"], r["n"]) for r in table.latest_by("k").where("k < 3").collect()))
"""


def test_another_process_follows_the_log(spark, folder):
    path = f"{folder}/totals"
    table = BatchTable(spark, path)
    table(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("n")), 0)
    table.compact("k")
    table(spark.range(1).select(F.col("id").alias("k"), F.lit(7).alias("n")), 1)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", COMPACT_ELSEWHERE.format(path)], cwd=root, capture_output=True, text=True, timeout=180)
    assert "FOUND 0 [(0, 7), (1, 1), (2, 1)]" in done.stdout, done.stderr[-2000:]


def test_a_batch_lost_between_writing_and_committing_is_repeated(spark, folder, feed):
    """The rerun replaces what the lost batch wrote; append-like batches are not doubled either."""
    table = BatchTable(spark, f"{folder}/rows")
    died = []

    def once(batch, number):
        table(batch, number)
        if number == 1 and not died:
            died.append(number)
            raise RuntimeError("lost")

    for push in ([(at(0), "a")], [(at(1), "b"), (at(2), "c")]):
        feed.push(*push)
        query = for_each_batch(feed.stream(), once, checkpoint=feed.checkpoint)
        try:
            drain(query)
        except StreamingQueryException:
            drain(for_each_batch(feed.stream(), once, checkpoint=feed.checkpoint))
    assert died == [1] and rows(table.all_batches().select("lang", "batch")) == [("a", 0), ("b", 1), ("c", 1)]
