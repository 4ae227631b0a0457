"""State per key: rings of slides, sessions, maps, lifetimes, timers, hot keys."""

import random
import time
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_streams import START, Feed, at
from tidemark.functions.timing import event_time
from tidemark.plans.activity import merged, sessions, tallies
from tidemark.plans.dashboard import dashboard, dashboard_of, user_panes
from tidemark.streaming.keyed import Entries, Items, Value, fold_state
from tidemark.streaming.output import BatchTable, append_to, complete_result, drain, for_each_batch, updated_result
from tidemark.streaming.rings import Ring, per_slide, sliding_ring
from tidemark.streaming.windows import (ranked_in_window, slide_count, sliding_count, windows_from_slides, with_watermark)


def brute_windows(events, size, slide, upto, after=0):
    """(end, n) of all windows with rows that end in (after, upto], every window on its own."""
    ends = {e for t in events for e in range(t // slide * slide + slide, t // slide * slide + size + slide, slide)}
    return sorted((e, sum(e - size <= t < e for t in events)) for e in ends if after < e <= upto)


@pytest.mark.parametrize("seed", range(30))
def test_a_ring_equals_counting_every_window(seed):
    """Rows in any order, late ones too: a row counts in the windows open when it comes."""
    rnd = random.Random(seed)
    slide = rnd.choice([1, 2, 5])
    size, time_now = slide * rnd.randrange(1, 7), 0
    ring, wanted, found, counted = Ring(size, slide, 0), {}, [], 0
    for _ in range(40):
        time_now += rnd.choice([0, 1, 3, 10, 60])
        timer = ring.next_end()
        found += ring.advance(time_now)
        if timer is None or timer > time_now:
            assert len(found) == counted            # nothing comes out before its timer
        counted = len(found)
        closed = time_now // slide * slide
        for _ in range(rnd.randrange(4)):
            t = max(0, time_now + rnd.randrange(-2 * size - 3, size + 9))
            start = t // slide * slide
            kept = ring.add(start, [1])
            opened = [e for e in range(start + slide, start + size + slide, slide) if e > closed]
            assert kept == bool(opened)
            for e in opened:
                wanted[e] = wanted.get(e, 0) + 1
        again, _ = Ring.from_row(size, slide, ring.to_row(None))
        ring = again if rnd.random() < 0.5 else ring
        assert len(ring.slides) <= (size + size + 9) // slide + 4
    found += ring.advance(time_now + 10 * size + 100)
    assert [(e, n[0]) for e, n in found] == sorted(wanted.items())
    assert ring.next_end() is None


def test_rings_equal_the_plain_windows_over_batches_with_late_rows(spark, folder):
    """Each push is a run, so both operators see the same watermarks; keys are null, repeated and new."""
    rnd = random.Random(5)
    found = {}
    pushes = [[(at(base + rnd.randrange(-400, 120)), rnd.choice(["a", "b", None, f"k{n}"])) for _ in range(30)]
              for n, base in enumerate(range(0, 2400, 300))] + [[(at(9000), "z"), (None, "a")]]
    builds = {"plain": lambda s: sliding_count(s, "ts", "60 seconds", "5 seconds", ["lang"], delay="20 seconds"),
              "ring": lambda s: sliding_ring(s, "ts", "60 seconds", "5 seconds", ["lang"], "20 seconds")}
    for name, build in builds.items():
        feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING", name)
        for push in pushes:
            got = feed.push(*push).append(build)
        found[name] = rows(got)
    assert found["ring"] == found["plain"] and len(found["plain"]) > 500


def test_rings_without_keys_and_with_sums(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING, v INT")
    feed.push((at(1), "a", 5), (at(2), "b", None), (at(7), "a", -3))

    def build(s):
        return sliding_ring(s, "ts", "10 seconds", "5 seconds", (), "0 seconds", "rows", {"v": "v", "twice": F.col("v") * 2})

    got = feed.push((at(100), "z", 1)).append(build)
    assert rows(got) == [(at(-5), at(5), 2, 5, 10), (at(0), at(10), 3, 2, 4), (at(5), at(15), 1, -3, -6)]
    with pytest.raises(ValueError, match="whole slides"):
        sliding_ring(feed.stream(), "ts", "7 seconds", "2 seconds")


def test_a_hot_key_is_added_up_before_the_shuffle(spark):
    events = spark.range(200_000).select(F.lit("hot").alias("lang"), F.expr("timestamp_seconds(1700000000 + id % 60)").alias("ts"))
    parts = per_slide(events.repartition(4), "ts", 5000, ["lang"], {})
    batch = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    assert parts.agg(F.sum("n0")).first()[0] == 200_000
    assert parts.count() <= 13 * (200_000 // batch + 4)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1                          # the test's own repartition


def test_a_million_rows_of_one_key_in_one_batch_take_one_frame_at_a_time(spark, folder):
    spark.range(1_000_000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).alias("v"), F.expr("timestamp_seconds(id div 1000)").alias("ts")).write.parquet(
        f"{folder}/hot")
    stream = spark.readStream.schema("k STRING, v BIGINT, ts TIMESTAMP").parquet(f"{folder}/hot")

    def on_rows(keyed, frame):
        n, total, frames, largest = keyed.value("sums", (0, 0, 0, 0))
        keyed["sums"].update((n + len(frame), total + int(frame["v"].sum()), frames + 1, max(largest, len(frame))))

    def after(keyed):
        return pd.DataFrame([(*keyed.key, *keyed.value("sums"))], columns=["k", "n", "total", "frames", "largest"])

    folded = fold_state(stream, ["k"], {"sums": Value("n BIGINT, total BIGINT, frames BIGINT, largest BIGINT")}, on_rows,
                        "k STRING, n BIGINT, total BIGINT, frames BIGINT, largest BIGINT", after, mode="update", time=None)
    (k, n, total, frames, largest), = rows(updated_result(folded, "k"))
    assert (k, n, total) == ("hot", 1_000_000, 499_500_000)
    assert frames >= 100 and largest <= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_sessions_close_by_watermark_and_merge_out_of_order_rows(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING")

    def build(s):
        return sessions(s, ["lang"], "ts", 60, "30 seconds")

    def got():
        return sorted((r["lang"], r["session"], (r["first_seen"] - START).total_seconds(), (r["last_seen"] - START).total_seconds(), r["n"])
                      for r in table.collect())

    table = feed.push((at(0), "a"), (at(70), "a"), (at(5), "b")).append(build)
    assert got() == []
    # The watermark is at 40: a late row joins both spans of a.
    table = feed.push((at(35), "a"), (at(200), "c"), (None, "c")).append(build)
    assert got() == [("a", 1, 0.0, 70.0, 3), ("b", 1, 5.0, 5.0, 1)]
    # At 170: too late for a new session of b, early enough for a second one of a.
    table = feed.push((at(20), "b"), (at(150), "a"), (at(500), "c")).append(build)
    assert got() == [("a", 1, 0.0, 70.0, 3), ("a", 2, 150.0, 150.0, 1), ("b", 1, 5.0, 5.0, 1), ("c", 1, 200.0, 200.0, 1)]


def test_a_key_has_one_timer_however_many_sessions_are_open(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING")
    table = BatchTable(spark, f"{folder}/sessions")
    timers = []

    def push(*rows):
        feed.push(*rows)
        query = drain(for_each_batch(sessions(feed.stream(), ["lang"], "ts", 60, "2000 seconds"), table, checkpoint=feed.checkpoint))
        timers.append([p["stateOperators"][0]["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress if p["numInputRows"]])
        return sorted((r["session"], (r["first_seen"] - START).total_seconds(), (r["last_seen"] - START).total_seconds(), r["n"])
                      for r in table.all_batches().where("lang = 'a' OR lang IS NULL").collect())

    assert push(*[(at(200 * n), "a") for n in range(6)]) == []
    # The first session grows, so its timer moves; the watermark, at 150, closes it and leaves five.
    assert push((at(50), "a"), (at(2150), "b")) == [(1, 0.0, 50.0, 2)]
    assert push((at(230), "a"), (at(2350), "b")) == [(1, 0.0, 50.0, 2), (2, 200.0, 230.0, 2)]
    assert push((at(90_000), "b")) == [(1, 0.0, 50.0, 2), (2, 200.0, 230.0, 2), *((n + 1, 200.0 * n, 200.0 * n, 1) for n in range(2, 6))]
    assert timers[0] == [1] and all(n <= 2 for held in timers for n in held), timers


def test_merged_spans():
    assert merged([(0, 5, 2), (20, 30, 1), (10, 12, 4)], 5) == [(0, 12, 6), (20, 30, 1)]
    assert merged([(0, 50, 2), (10, 20, 1)], 1) == [(0, 50, 3)] and merged([], 1) == []


def test_tallies_put_out_each_changed_entry_once(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING, kind STRING")
    table = BatchTable(spark, f"{folder}/tallies")
    for push in ([(at(1), "a", "x"), (at(9), "a", "x"), (at(3), "a", "y"), (None, "b", "x"), (at(2), "b", None)], [(at(4), "a", "x"), (at(8), None, "z")]):
        feed.push(*push)
        drain(for_each_batch(tallies(feed.stream(), ["lang"], "kind", "ts"), table, "update", feed.checkpoint))
    got = table.all_batches().select("batch", "lang", "kind", "n", F.col("last_seen").cast("timestamp_ntz"))
    assert rows(got) == sorted([(0, "a", "x", 2, at(9)), (0, "a", "y", 1, at(3)), (0, "b", "x", 1, None),
                                (1, "a", "x", 3, at(9)), (1, None, "z", 1, at(8))], key=repr)


def test_entries_are_forgotten_after_their_lifetime(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING, kind STRING")
    found = []
    for lifetime, wait in ((1000, 2.5), (3_600_000, 0.0)):
        table = BatchTable(spark, f"{folder}/kept-{lifetime}")
        for n in range(2):
            feed.push((at(n), "a", "x"))
            query = for_each_batch(tallies(feed.stream(), ["lang"], "kind", "ts", lifetime), table, "update",
                                   f"{folder}/checkpoint-{lifetime}", trigger="1 second")
            until = time.time() + 60            # such a stream always has another batch to run
            while not any(p["numInputRows"] for p in query.recentProgress) and time.time() < until:
                time.sleep(0.2)
            query.stop()
            time.sleep(wait)
        found.append([r["n"] for r in table.all_batches().orderBy("batch").collect() if r["n"]])
    assert found == [[1, 1], [3, 4]]


def test_lists_and_timers(spark, folder):
    """Rows wait in a list until the watermark passes their own time, then come out in order."""
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING")

    def on_rows(keyed, frame):
        keyed["held"].appendList([(int(t),) for t in frame["at"]])
        for t in set(frame["at"]):
            if int(t) not in keyed.timers():
                keyed.set_timer(int(t))

    def on_timer(keyed, when):
        held = sorted(r[0] for r in keyed["held"].get())
        due, left = [t for t in held if t <= when], [t for t in held if t > when]
        keyed["held"].put([(t,) for t in left]) if left else keyed["held"].clear()
        return pd.DataFrame([(*keyed.key, t) for t in due], columns=["lang", "at"])

    def build(s):
        timed = with_watermark(s, "ts", "0 seconds").select("lang", F.unix_millis("ts").alias("at"))
        return fold_state(timed, ["lang"], {"held": Items("at BIGINT")}, on_rows, "lang STRING, at BIGINT", on_timer=on_timer)

    zero = int((START - START.replace(year=1970, month=1, day=1, hour=0)) / timedelta(milliseconds=1))
    feed.push((at(3), "a"), (at(1), "a"), (at(2), "b")).append(build)
    got = feed.push((at(2), "a"), (at(9), "b")).append(build)
    assert rows(got) == sorted([("a", zero + 1000), ("a", zero + 2000), ("a", zero + 3000), ("b", zero + 2000), ("b", zero + 9000)], key=repr)


def plan_of(query):
    return query.explain_text if hasattr(query, "explain_text") else query._jsq.explainInternal(False)


def test_streams_aggregate_raw_rows_by_hash(spark, folder):
    """The dashboard with a delay: two stateful aggregates, and no sort below the first."""
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, language STRING, size INT, user STRING, followers BIGINT")
    feed.push((at(1), "es", 10, "zoe", 5), (at(90), "es", 5, "ann", 5))
    query = for_each_batch(dashboard(feed.stream(), "ts", "20 seconds", "5 seconds", delay="5 seconds"), BatchTable(spark, f"{folder}/t"))
    drain(query)
    text = plan_of(query)
    assert text.count("StateStoreSave") == 2
    below = text[text.index("StateStoreRestore", text.index("StateStoreRestore") + 1):]       # the first aggregate of the stream
    assert "HashAggregate" in below and "SortAggregate" not in below and "ObjectHash" not in below


def test_complete_streams_keep_slides_and_spread_them_in_the_batch(spark, folder):
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, language STRING, size INT, user STRING, followers BIGINT")
    rnd = random.Random(2)
    for _ in range(2):
        feed.push(*[(at(rnd.randrange(200)), rnd.choice("ab"), rnd.choice([1, 5, None]), rnd.choice("xyz"), rnd.choice([1, 2, None])) for _ in range(60)])
    stored = spark.read.parquet(feed.path).withColumn("ts", event_time("ts"))
    live = complete_result(user_panes(feed.stream(), "ts", "5 seconds"), prepare=lambda b: dashboard_of(b, "20 seconds", "5 seconds"))
    assert rows(live) == rows(dashboard(stored, "ts", "20 seconds", "5 seconds"))
    counts = complete_result(slide_count(feed.stream(), "ts", "5 seconds", ["language"]),
                             prepare=lambda b: windows_from_slides(b, "20 seconds", "5 seconds", ["language"]))
    assert rows(counts) == rows(sliding_count(stored, "ts", "20 seconds", "5 seconds", ["language"]))
    for odd in (lambda: windows_from_slides(stored, "7 seconds", "2 seconds"), lambda: dashboard_of(stored, "7 seconds", "2 seconds")):
        with pytest.raises(ValueError, match="whole slides"):
            odd()


def test_a_huge_window_is_ranked_by_many_tasks(spark):
    start = F.lit(at(0)).cast("timestamp_ntz")
    counts = spark.range(40_000).select(start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
                                        F.col("id").alias("word"), F.pmod(F.hash("id"), F.lit(50)).cast("long").alias("n"))
    few = counts.limit(5).withColumn("window_start", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    ranked = ranked_in_window(counts.unionByName(few), ["word"])
    wanted = sorted(((r["n"], r["word"]) for r in counts.collect()), key=lambda r: (-r[0], r[1]))
    got = ranked.where(F.col("window_start") == start).orderBy("rank").collect()
    assert [(r["n"], r["word"]) for r in got] == wanted and [r["rank"] for r in got] == list(range(1, 40_001))
    assert dict(ranked.dtypes)["rank"] == "bigint"
    assert rows(ranked.where(F.col("window_start") != start).select("rank")) == [(i,) for i in range(1, 6)]


def test_append_runs_leave_nothing_open_behind(spark, folder):
    """All windows of rows long past have come out, once each."""
    feed = Feed(spark, folder, "ts TIMESTAMP_NTZ, lang STRING")
    for n in range(3):
        feed.push(*[(at(100 * n + i), "a") for i in range(20)])
        got = append_to(sliding_ring(feed.stream(), "ts", "30 seconds", "10 seconds", ["lang"], "5 seconds"), feed.out, feed.checkpoint)
    feed.push((at(100_000), "b"))
    got = append_to(sliding_ring(feed.stream(), "ts", "30 seconds", "10 seconds", ["lang"], "5 seconds"), feed.out, feed.checkpoint)
    events = [100 * n + i for n in range(3) for i in range(20)]
    assert sorted(((r["window_end"] - START).total_seconds(), r["n"]) for r in got.collect()) == brute_windows(events, 30, 10, 10**6)
