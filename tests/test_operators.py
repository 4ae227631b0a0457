from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.aggregates import (count_by, counts_by_pairs, counts_by_place,
                                           counts_by_place_sql, distinct_count, expand_estimate,
                                           hourly_profile, min_ratio_floor, received_counts, total,
                                           user_profile)
from tidemark.operators.graph import (degree_distribution, edge_list, filter_edges, in_degree,
                                      out_degree, out_strength, ranked_by, raw_edges)
from tidemark.operators.joins import aggregate_with_top, engagement_ratio, ratio_to_capacity
from tidemark.operators.labels import group_by_labels, label_lists, label_members
from tidemark.operators.payloads import parse_json, quarantine
from tidemark.operators.projections import flatten, originals, pack, renamed, require, where, with_derived
from tidemark.operators.ranking import numbered, preview, sort_by, top_k, top_per_group
from tidemark.operators import reuse as reuse_module
from tidemark.operators.reuse import choose, reuse
from tidemark.operators.sampling import sample_stratified, sample_uniform, strata_fractions
from tidemark.operators.sets import intersect, subtract, union_distinct
from tidemark.operators.words import texts_of, tokens, top_words_ending, word_count
from tidemark.plans.dashboard import dashboard_sql
from tidemark.plans.engagement import engagement
from tidemark.scratch import stage
from tidemark.sources.catalog import register

POST = """id BIGINT, text STRING, lang STRING, created_at TIMESTAMP_NTZ,
  user STRUCT<screen_name: STRING, lang: STRING, friends: BIGINT, followers: BIGINT>,
  reshared STRUCT<user: STRUCT<screen_name: STRING>>, place STRUCT<name: STRING>"""


def at(day, hour):
    return datetime(2023, 12, day, hour) if day < 32 else datetime(2024, 1, day - 31, hour)


@pytest.fixture(scope="module")
def posts(spark):
    ann, ann_later, bo = ("ann", "es", 10, 100), ("ann", "es", 9, 130), ("bo", "es", 5, 50)
    cy, nobody = ("cy", "ca", 7, 70), (None, "es", 1, 1)
    of = lambda name: ((name,),)
    return spark.createDataFrame([
        (1, "uno", "es", at(30, 10), ann, None, ("Lugo",)),
        (2, "dos", "es", at(31, 10), ann_later, of("bo"), ("Lugo",)),
        (3, "tres", "es", at(32, 10), bo, of("ann"), None),
        (4, "quatre", "ca", at(32, 11), cy, of("ann"), (None,)),
        (5, "cinc", "ca", at(32, 11), cy, of("ann"), ("Olot",)),
        (6, "sis", "ca", at(30, 10), cy, of("cy"), ("Olot",)),
        (7, "set", "ca", None, nobody, (None,), ("Lugo",)),
        (8, "vuit", "ca", at(32, 10), cy, ((None,),), None),
    ], POST)


def test_where_in_both_forms(spark, posts):
    register(posts, "posts_view")
    assert rows(where(posts, "lang = 'es'", "text")) == rows(spark.sql("SELECT text FROM posts_view WHERE lang = 'es'"))


def test_guards_need_parent_and_child(posts):
    assert rows(require(posts, "place.name").select("id")) == [(1,), (2,), (5,), (6,), (7,)]
    assert rows(require(posts, "reshared.user.screen_name").select("id")) == [(2,), (3,), (4,), (5,), (6,)]
    assert rows(originals(posts, "reshared").select("id")) == [(1,)]


def test_flatten_pack_derive_rename(posts):
    flat = flatten(posts, {"name": "place.name"}, keep=True)
    assert flat.columns == [*posts.columns, "name"]
    packed = pack(flatten(posts, {"a": "id", "b": "text"}), "both", first="a", second="b")
    assert packed.where("both.first = 1").first()["both"]["second"] == "uno"
    assert renamed(packed, a="z").columns == ["z", "b", "both"]
    assert with_derived(packed, c=F.lit(1)).columns[-1] == "c"


def test_user_profile_takes_largest_counter(posts):
    got = user_profile(posts, "user.screen_name", {"friends": "user.friends", "followers": "user.followers"},
                       F.col("user.lang") == "es")
    assert rows(got) == [("ann", 10, 130, 2), ("bo", 5, 50, 1)]


def test_engagement_leaves_out_users_never_reshared(posts):
    got = engagement(posts, posts, "user.screen_name", "reshared.user.screen_name",
                     {"followers": "user.followers"})
    assert [tuple(r) for r in got.collect()] == [
        ("ann", 130, 2, 3, 1.5), ("bo", 50, 1, 1, 1.0), ("cy", 70, 4, 1, 0.25)]
    spanish = engagement(posts, posts, "user.screen_name", "reshared.user.screen_name",
                         {"followers": "user.followers"}, F.col("user.lang") == "es")
    assert [r["user"] for r in spanish.collect()] == ["ann", "bo"]


def test_received_counts_ignore_language(posts):
    assert rows(received_counts(posts, "reshared.user.screen_name")) == [("ann", 3), ("bo", 1), ("cy", 1)]


def test_engagement_equals_joining_raw_rows(posts):
    users = user_profile(posts, "user.screen_name", {"followers": "user.followers"})
    raw = require(posts, "reshared.user.screen_name").select(F.col("reshared.user.screen_name").alias("author"))
    joined = (users.join(raw, users["user"] == raw["author"]).groupBy("user", "followers", "posts")
              .agg(F.count(F.lit(1)).alias("received"))
              .withColumn("ratio", F.col("received") / F.col("posts").cast("double")))
    assert rows(engagement_ratio(users, posts, "reshared.user.screen_name")) == rows(joined)


def test_place_counts_agree_in_three_forms(spark, posts):
    register(posts, "posts_view")
    want = [("Lugo", 3), ("Olot", 2)]
    assert rows(counts_by_place(posts)) == want
    assert rows(counts_by_place_sql(spark, "posts_view")) == want
    assert rows(counts_by_pairs(posts, "place.name")) == want


def test_hourly_profile_divides_by_days_that_have_the_hour(posts):
    assert rows(hourly_profile(posts, "created_at")) == [(10, 5 / 3), (11, 2.0)]
    assert rows(hourly_profile(posts, "created_at", zero_fill=True)) == sorted(
        [(h, {10: 5 / 3, 11: 2 / 3}.get(h, 0.0)) for h in range(24)], key=repr)
    assert rows(expand_estimate(hourly_profile(posts, "created_at"), "posts", 0.5))[1] == (11, 4.0)


def test_counts(posts):
    assert total(posts).first()[0] == 8
    assert rows(count_by(posts, "lang")) == [("ca", 5), ("es", 3)]
    assert distinct_count(posts, "user.screen_name").first()[0] == 4


@pytest.fixture(scope="module")
def seats(spark):
    return spark.createDataFrame([("Lugo", 4), ("Olot", 1), ("Vic", 3), ("Zero", 0)], "capital STRING, seats INT")


def test_ratio_to_capacity(spark, seats):
    counts = spark.createDataFrame([("Lugo", 11), ("Olot", 5), ("Zero", 2), ("Elsewhere", 9)], "name STRING, posts BIGINT")
    got = ratio_to_capacity(seats, counts, "capital", "name", "seats", "posts")
    assert rows(got) == [("Lugo", 11, 4, 2.75), ("Olot", 5, 1, 5.0), ("Zero", 2, 0, None)]
    assert min_ratio_floor(got, "ratio").first()[0] == 2.75
    fractions = strata_fractions(got, "capital", "ratio")
    assert rows(fractions) == [("Lugo", 1.0), ("Olot", 0.55), ("Zero", None)]


def test_floored_minimum_leaves_smallest_stratum_below_one(spark):
    ratios = spark.createDataFrame([("a", 2.669), ("b", 5.338)], "k STRING, ratio DOUBLE")
    floored = dict(rows(strata_fractions(ratios, "k", "ratio")))
    assert floored["a"] == pytest.approx(2.66 / 2.669) and floored["a"] < 1
    assert rows(strata_fractions(ratios, "k", "ratio", floor_decimals=None)) == [("a", 1.0), ("b", 0.5)]


def test_uniform_sample_is_the_same_on_any_layout(spark):
    ids = spark.range(20000)
    one, many = sample_uniform(ids.coalesce(1), "id", 0.01), sample_uniform(ids.repartition(8), "id", 0.01)
    assert rows(one) == rows(many)
    assert 120 < one.count() < 280
    assert rows(one) != rows(sample_uniform(ids, "id", 0.01, seed=7))
    assert sample_uniform(ids, "id", 1.0).count() == 20000
    assert sample_uniform(ids, "id", 0.0).count() == 0
    assert 120 < sample_uniform(ids, "id", 0.01, mode="native").count() < 280
    with pytest.raises(ValueError):
        sample_uniform(ids, "id", 0.01, mode="other")


def test_stratified_sample_drops_strata_without_fraction(spark):
    df = spark.range(9000).select("id", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")),
                                                     (F.col("id") % 3 + 1).cast("int")).alias("k"))
    fractions = spark.createDataFrame([("a", 1.0), ("b", 0.2), ("c", None), ("unused", 0.5)],
                                      "k STRING, fraction DOUBLE")
    got = dict(rows(count_by(sample_stratified(df, "k", fractions, "id"), "k")))
    assert got["a"] == 3000 and 450 < got["b"] < 750 and "c" not in got
    layouts = [rows(sample_stratified(df.repartition(n), "k", stage(fractions), "id")) for n in (1, 8)]
    assert layouts[0] == layouts[1]
    native = dict(rows(count_by(sample_stratified(df, "k", {"a": 1.0, "b": 0.2}, mode="native"), "k")))
    assert native["a"] == 3000 and "c" not in native


def test_labels_may_overlap(spark):
    numbers = spark.createDataFrame([(7,), (14,), (21,), (35,), (35,), (70,)], "n INT")
    n = F.col("n")
    labels = {"even": n % 2 == 0, "odd": n % 2 != 0, "five": n % 5 == 0}
    assert rows(group_by_labels(numbers, labels, "n")) == [("even", 2, 84), ("five", 3, 140), ("odd", 4, 98)]
    assert label_members(numbers, labels).count() == 9
    lists = {r["label"]: [tuple(m) for m in r["members"]] for r in label_lists(numbers, labels, "n").collect()}
    assert lists == {"even": [(14, 1), (70, 1)], "odd": [(7, 1), (21, 1), (35, 2)], "five": [(35, 2), (70, 1)]}


def test_label_lists_split_by_span_and_lose_nothing(spark):
    numbers = spark.range(2500).select(F.col("id").alias("n"))
    lists = label_lists(numbers, {"all": F.lit(True)}, "n", span=100).orderBy("part").collect()
    assert len(lists) == 25 and max(len(r["members"]) for r in lists) == 100
    assert [m["n"] for r in lists for m in r["members"]] == list(range(2500))


def test_set_operations_on_repeated_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v INT")
    b = spark.createDataFrame([(2,), (2,), (3,), (3,), (None,)], "v INT")
    assert rows(intersect(a, b)) == [(2,), (None,)]
    assert rows(subtract(b, a)) == [(3,), (3,)]
    assert rows(subtract(a, b)) == [(1,), (1,)]
    assert [r[0] for r in union_distinct(a, b).collect()] == [3, 2, 1, None]


def test_ranges_of_two_sensors(spark):
    a = spark.range(1, 26).select(F.col("id").alias("v"))
    b = spark.range(15, 36).select(F.col("id").alias("v"))
    assert [r[0] for r in intersect(a, b).orderBy("v").collect()] == list(range(15, 26))
    assert [r[0] for r in subtract(b, a).orderBy("v").collect()] == list(range(26, 36))
    assert [r[0] for r in union_distinct(a, b).collect()] == list(range(35, 0, -1))


def test_subtract_over_several_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, None), (1, None)], "n INT, t STRING")
    b = spark.createDataFrame([(1, "x")], "n INT, t STRING")
    assert rows(subtract(a, b)) == [(1, None), (1, None)]
    assert rows(subtract(a, a)) == []


EDGES = [("a", "b"), ("a", "b"), ("a", "b"), ("a", "c"), ("b", "c"), ("b", "c"), ("c", "c"), (None, "a"), ("a", None)]


def test_graph(spark):
    pairs = spark.createDataFrame(EDGES, "s STRING, d STRING")
    edges, raw = edge_list(pairs, "s", "d"), raw_edges(pairs, "s", "d")
    assert rows(edges) == [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("c", "c", 1)]
    assert rows(filter_edges(edges)) == [("a", "b", 3), ("b", "c", 2)]
    out, into, strength = out_degree(edges), in_degree(edges), out_strength(raw)
    assert [tuple(r) for r in ranked_by(out, "out_degree").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    assert rows(into) == [("b", 1), ("c", 3)]
    assert rows(strength) == [("a", 4), ("b", 2), ("c", 1)]
    assert rows(degree_distribution(out, "out_degree")) == [(1, 2), (2, 1)]
    assert rows(degree_distribution(strength, "out_strength")) == [(1, 1), (2, 1), (4, 1)]


def test_degree_sums(spark, sf_dir):
    from tidemark.registry.graph import DST, SRC, interactions
    pairs = interactions(spark, sf_dir)
    edges, raw = edge_list(pairs, SRC, DST), raw_edges(pairs, SRC, DST)
    n_edges, n_raw = edges.count(), raw.count()
    sums = [out_degree(edges).agg(F.sum("out_degree")), in_degree(edges).agg(F.sum("in_degree"))]
    assert [s.first()[0] for s in sums] == [n_edges, n_edges]
    assert out_strength(raw).agg(F.sum("out_strength")).first()[0] == n_raw
    distribution = degree_distribution(out_degree(edges), "out_degree")
    assert distribution.agg(F.sum("users")).first()[0] == out_degree(edges).count()


def test_orders_and_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("d", 3)], "k STRING, n INT")
    assert [r["k"] for r in sort_by(df, F.col("n").desc(), "k").collect()] == ["d", "a", "b", "c"]
    assert [(r["k"], r["place"]) for r in top_k(df, 2, F.col("n").desc(), "k", rank_as="place").collect()] == [("d", 1), ("a", 2)]
    assert [r["k"] for r in preview(df, 2).collect()] == ["a", "b"]


def test_best_in_group_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("es", "zoe", 9, 4), ("es", "ann", 9, 6), ("es", "bo", 1, 5), ("ca", "cy", 2, 3), ("ca", "al", None, 3)],
                               "language STRING, user STRING, followers BIGINT, size INT")
    best = top_per_group(df, "language", [F.col("followers").desc(), "user"])
    assert rows(best.select("language", "user")) == [("ca", "cy"), ("es", "ann")]
    want = [("ca", 2, 3.0, "cy", 2), ("es", 3, 5.0, "ann", 9)]
    assert rows(aggregate_with_top(df, "language", "size", "user", "followers")) == want
    assert [tuple(r) for r in dashboard_sql(df, "best_view").collect()] == want[::-1]


@pytest.mark.parametrize("how", ["again", "cache", "stage", "auto"])
def test_reuse_gives_the_same_rows_and_lets_go(spark, how):
    numbers = spark.range(1, 10001)
    kept = numbers.where("id > 5000")
    plain = rows(kept.select(F.col("id") * 2))
    with reuse(kept, how=how) as held:
        assert held.is_cached == (how == "cache")
        assert rows(held.select(F.col("id") * 2)) == plain and len(plain) == 5000
    assert not kept.is_cached
    with pytest.raises(ValueError, match="unknown way"), reuse(kept, how="hope"):
        pass


def test_what_is_kept_depends_on_what_it_costs_and_takes(spark, sf_dir, monkeypatch):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    light = orders.where("o_totalprice > 1000 AND o_orderstatus IN ('F', 'O')").selectExpr("o_orderkey + 1 AS k", "o_custkey")
    assert choose(light) == choose(spark.range(9).where("id % 3 = 1")) == "again"
    heavy = [orders.groupBy("o_custkey").count(), orders.join(light, "o_custkey"), orders.select(F.upper("o_orderstatus")),
             orders.where(F.col("o_orderpriority").rlike("^1")), orders.select(F.explode(F.array("o_orderkey", "o_custkey")))]
    assert [choose(df) for df in heavy] == ["cache"] * 5
    monkeypatch.setattr(reuse_module, "free_storage", lambda df: 100)
    assert [choose(df) for df in heavy] == ["stage"] * 5 and choose(light) == "again"


LINES = ['{"tweet": "El DÍA, la casa!", "likes": 1}', '{"likes": 2}', '{"tweet": null}', '{"tweet": ""}',
         "broken {", '{"tweet": "  "}', '{"tweet": "la casa_1 ventana ventanas irá"}']


def test_words_from_json_lines(spark):
    lines = spark.createDataFrame([(t,) for t in LINES], "line STRING")
    texts = texts_of(lines, "tweet")
    assert texts.count() == 2
    words = tokens(texts, "text")
    assert sorted(r[0] for r in words.collect()) == ["casa", "casa_1", "día", "el", "irá", "la", "la"]
    counts = word_count(words)
    assert dict(rows(counts))["la"] == 2
    top = top_words_ending(counts, 2)
    assert [tuple(r) for r in top.collect()] == [("la", 2), ("casa", 1)]


def test_malformed_payloads_are_not_taken_for_nulls(spark):
    values = ['{"a": 1, "reblog": null}', '{"a": 2, "reblog": {"id": 3}}', "{oops", None, '{"a": "text"}', '{}']
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    good, bad = quarantine(parse_json(df, "value", "a BIGINT, reblog STRING"))
    assert rows(good.select("value")) == sorted([(values[0],), (values[1],), (values[5],)], key=repr)
    assert bad.count() == 3
    assert rows(originals(good, "payload.reblog").select("payload.a")) == [(1,), (None,)]


def test_label_lists_are_bounded_by_members_too(spark):
    df = spark.range(20_000).select(F.lit(7).alias("n"), F.col("id").alias("c"))
    lists = label_lists(df, {"all": F.lit(True)}, "n", "c", most=1000).collect()
    assert max(len(r["members"]) for r in lists) < 1300
    assert sorted(m["c"] for r in lists for m in r["members"]) == list(range(20_000))


def test_stratified_sample_says_what_it_needs(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, id long")
    with pytest.raises(ValueError, match="needs a key"):
        sample_stratified(df, "k", {"a": 1.0})
    with pytest.raises(ValueError, match="as a mapping"):
        sample_stratified(df, "k", df.select("k", F.lit(1.0).alias("fraction")), mode="native")
    assert rows(sample_stratified(df, "k", {"a": 1.0}, "id")) == [("a", 1)]


def test_numbered_gives_every_row_its_place(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(7)
    found = numbered(df, F.col("v").desc())
    assert rows(found.select("place", "v")) == sorted([(i + 1, 999 - i) for i in range(1000)], key=repr)
    assert numbered(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("groups", [1, 3, 400])
def test_numbered_within_groups_across_tasks(spark, groups):
    """Groups that fill several tasks, share tasks, and hold a null; equal rows keep different places."""
    df = spark.range(1500).select(F.floor(F.col("id") * 37 % 1500 / 2).alias("v"), F.when(F.col("id") % groups > 0, F.col("id") % groups).alias("g"))
    found = numbered(df.repartition(7), F.col("v").desc(), within=["g"])
    wanted, seen = [], {}
    for v, g in sorted(((r["v"], r["g"]) for r in df.collect()), key=lambda r: (str(r[1]), -r[0])):
        seen[g] = seen.get(g, 0) + 1
        wanted.append((g, seen[g], v))
    assert rows(found.select("g", "place", "v")) == sorted(wanted, key=repr)
    assert dict(found.dtypes)["place"] == "bigint" and found.columns == ["v", "g", "place"]
    assert numbered(df.limit(0), "v", within=["g"]).count() == 0


def test_places_need_one_write_and_no_single_task(spark):
    tree = numbered(spark.range(100), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree and "Scan parquet" in tree
