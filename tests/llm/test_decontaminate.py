import hashlib
import re

import pytest

from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d

ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "tiny item"), (3, None), (4, ""),
         (None, "nameless window of words"), (5, "one two three four five six seven eight nine ten"), (1, "second text of one")]
TEXTS = ["zero one two three four five six seven eight nine ten eleven twelve", "ONE, two; three four five six seven eight nine ten!",
         "a tiny item, and a TINY-item again tiny item", None, "", "one two three four five six seven eight nine", "nameless window of words",
         "tiny", "second text of one " * 40, "..."]


def words(text):
    low = (text or "").translate(str.maketrans(d.UPPER, d.LOWER))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(texts, items):
    grams = set()
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            grams.add((item, tuple(w[i:i + 10])))
    out = []
    for text in texts:
        w = words(text)
        hit, found = set(), set()
        for item, g in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(item)
        found.discard(None)
        names = sorted(map(str, found))
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0])], "doc_id long, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("max_grams", [d.MAX_GRAMS, 0])
def test_report_is_that_of_brute_force(tables, max_grams):
    """Both with the windows as a set in the plan, and joined as for a large benchmark."""
    docs, items = tables
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                 for r in d.report(docs, items, max_grams=max_grams).collect())
    want = [(i, *row) for i, row in enumerate(brute(TEXTS, ITEMS))]
    assert got == sorted([*want, want[0]])


def test_documents_or_spans_are_removed(tables):
    docs, items = tables
    kept = {r["doc_id"] for r in d.decontaminate(docs, items).collect()}
    assert kept == {i for i, row in enumerate(brute(TEXTS, ITEMS)) if not row[-1]}
    clean = {r["doc_id"]: r["text"] for r in d.decontaminate(docs, items, "spans").collect()}
    assert clean[0] == "zero" + " " * 12 + "twelve" and clean[2] == "a  , and a - again  "
    assert clean[3] is None and clean[4] == "" and clean[5] == TEXTS[5]
    assert brute([clean[1], clean[2]], ITEMS)[0][-1] is False


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    assert d.decontaminate(edge_docs, items).columns == edge_docs.columns
    assert d.decontaminate(edge_docs, items).count() == edge_docs.count() - 5
    assert d.decontaminate(edge_docs, items.limit(0)).count() == edge_docs.count()
    assert d.report(no_docs, items).count() == 0


def test_documents_without_hits_are_dealt_evenly(spark, sf_dir):
    """With broadcasts off the last join shuffles all documents; those without a hit have no key in common."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    many = docs.select("doc_id", "text").unionAll(docs.select("doc_id", F.lit("nothing of the kind").alias("text"))).repartition(8)
    limit, parts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = d.report(many, benchmark)
        plan = found._jdf.queryExecution().executedPlan().toString()
        keyed = many.select(F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string")).alias("k")).repartition(16, "k")
        sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
        assert found.count() == many.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert "coalesce(" in plan and len(sizes) == 16 and max(sizes) < 3 * min(sizes)
