"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each document of a source, in seeded order, gets a virtual finish time: the words of
its source up to and with it, divided by the target of the source.  All documents, and
their repeats, then form one queue by finish time, which is cut at the total budget; as
every source finishes its target at time 1, the cut leaves each near its target.

* Running sums per source are cut into 4096 buckets of the shuffle key, so a source with
  a third of all rows is spread over 4096 window groups.
* The cut is found by counting words per slice of finish time, and again inside the
  slice it falls in, until that slice is small; no sort of all rows is needed for it.
* Rows travel through one shuffle.

Null, empty or blank texts have size 0; a source whose texts are all so passes once.  A
null source is a source of its own, last in order.  Repeated rows are separate documents
and have equal results only if the cut does not fall between them.  An empty table gives
an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hex_bucket, packed, shuffle_key, source_key, unpacked
from tidemark.scratch import stage

SPACED = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SLICES = 1024
SMALL_SLICE = 200_000
NEW = ("size", "source_size", "target", "finish", "passes")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("long")


def water_levels(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(skey, source_size) with ``target``: the budget by weight, none above ``most`` times its size.

    ``sizes`` has a row per source, so the windows here are over sources, not documents.
    With the sources in order of cap over weight, the level that spends the whole budget is
    the largest ``(budget - caps before) / weights from here`` not above the source's own ratio.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name, by_ratio = Window.orderBy("skey"), Window.orderBy("ratio", "skey")
    everything = Window.partitionBy()
    rows = (sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1)))
            .withColumn("cap", (F.col("source_size") * most).cast("double"))
            .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("caps_before", F.coalesce(
                F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("weights_on", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weights_on"))
            .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)))
    target = F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))
    return rows.select("skey", "source_size", target.alias("target"), "budget")


def _queued(rows: DataFrame, ahead: DataFrame, most: int) -> DataFrame:
    inside = (Window.partitionBy("skey", "bucket").orderBy("key")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.join(ahead, ["skey", "bucket"]).withColumn("words", F.col("before") + F.sum("size").over(inside))
    finish = [F.when(F.col("target") > 0, (F.col("words") + F.col("source_size") * p) / F.col("target"))
              for p in range(most)]
    return rows.withColumn("finishes", F.array(*finish))


def _sized(docs: DataFrame, keep: list[str] | None, id: str, text: str, source: str, seed: str) -> DataFrame:
    key = shuffle_key(seed, F.col(id), F.md5(F.col(text)))
    return (packed(docs, keep, size=word_count(F.col(text)), skey=source_key(F.col(source)), key=key)
            .withColumn("bucket", hex_bucket(F.col("key"))))


def _cut(queue: DataFrame, budget: float):
    """The first queue place beyond the budget as (finish, skey, key), or None if all fit.

    Words are summed per slice of finish time and the slice with the cut is sliced again,
    until its rows are few; only then rows are put in order.
    """
    items = queue.select("skey", "key", "size", F.posexplode("finishes").alias("pass", "finish")).where(
        F.col("finish").isNotNull())
    low, width, before, slices = 0.0, 1.0, 0, SLICES
    while True:
        sums = items.groupBy(F.floor((F.col("finish") - low) / (width / slices)).alias("slice")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.min("finish").alias("first"),
            F.max("finish").alias("last"))
        run = F.sum("words").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hit = (sums.withColumn("run", run + F.lit(before)).where(F.col("run") > F.lit(budget))
               .orderBy("slice").first())
        if hit is None:
            return None
        before = hit["run"] - hit["words"]
        items = items.where(F.col("finish").between(hit["first"], hit["last"]))
        if hit["n"] <= SMALL_SLICE or hit["first"] == hit["last"]:
            break
        low, width = hit["first"], hit["last"] - hit["first"]
    run = F.sum("size").over(Window.orderBy("finish", "skey", "key", "pass")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (items.withColumn("run", run + F.lit(before)).where(F.col("run") > F.lit(budget))
            .orderBy("finish", "skey", "key", "pass").select("finish", "skey", "key").first())


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        share: float = 1.5, most: int = 2, seed: str = "mix", keep: list[str] | None = None) -> DataFrame:
    """Every document with its size, its source's size and target, and how often the mix takes it.

    Runs jobs to find the cut.  ``keep`` names the columns to carry along (all by default).  Adds ``size``, ``source_size``, ``target``, ``finish`` (its
    first finish time) and ``passes`` (0 to ``most``); an input column of such a name gives way.
    """
    sized = _sized(docs, keep, id, text, source, seed)
    sums = stage(sized.groupBy("skey", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    levels = water_levels(sums.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = stage(sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
                  .join(levels, "skey"), "mix-targets")
    queue = _queued(sized, ahead, most)
    first = ahead.select("budget").first()
    # The places alone are written once, so that slicing them does not count words again.
    places = stage(queue.select("skey", "key", "size", "finishes"), "mix-places") if first else None
    cut = _cut(places, first["budget"]) if first else None
    place = [F.struct(F.col("finishes")[p].alias("finish"), "skey", "key") for p in range(most)]
    if cut is None:
        taken = [F.lit(1)] * most
    else:
        end = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["skey"]).alias("skey"),
                       F.lit(cut["key"]).alias("key"))
        taken = [F.when(p < end, 1).otherwise(0) for p in place]
    passes = F.when(F.col("target") > 0, sum(taken[1:], taken[0])).otherwise(1)
    return unpacked(queue, "size", "source_size", "target", F.col("finishes")[0].alias("finish"),
                    passes.cast("int").alias("passes"), new=NEW)


def taken_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    passes = F.explode(F.sequence(F.lit(1), F.col("passes")))
    return mixed.where("passes > 0").withColumn("_pass", passes).select(*columns)


def in_queue_order(mixed: DataFrame) -> DataFrame:
    """The documents taken, range-sorted by finish time as a trainer would read them."""
    return mixed.where("passes > 0").repartitionByRange("finish").sortWithinPartitions("finish")
