"""Laws that hold whatever the rows are."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.graph import edge_list, in_degree, out_degree, out_strength, raw_edges
from tidemark.operators.labels import group_by_labels, label_lists
from tidemark.operators.sampling import sample_uniform
from tidemark.operators.sets import intersect, subtract, union_distinct
from tidemark.operators.words import tokens
from tidemark.functions.text import normalized

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
VALUES = st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=12)
NAMES = st.one_of(st.none(), st.sampled_from("abcd"))


def table(spark, values, kind="v BIGINT"):
    return spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], kind)


def bag(df):
    return Counter(r[0] for r in df.collect())


@FEW
@given(a=VALUES, b=VALUES)
def test_set_operations(spark, a, b):
    left, right = table(spark, a), table(spark, b)
    both, either = bag(intersect(left, right)), bag(union_distinct(left, right))
    assert both == Counter(set(a) & set(b)) and either == Counter(set(a) | set(b))
    assert len(either) == len(set(a)) + len(set(b)) - len(both)
    assert bag(subtract(left, right)) == Counter(v for v in a if v not in set(b))


@FEW
@given(pairs=st.lists(st.tuples(NAMES, NAMES), max_size=15))
def test_degrees(spark, pairs):
    df = table(spark, pairs, "s STRING, d STRING")
    edges, raw = edge_list(df, "s", "d"), raw_edges(df, "s", "d")
    whole = [p for p in pairs if None not in p]
    assert Counter({(r["src"], r["dst"]): r["weight"] for r in edges.collect()}) == Counter(whole)
    out, into = (d.collect() for d in (out_degree(edges), in_degree(edges)))
    assert sum(r["out_degree"] for r in out) == sum(r["in_degree"] for r in into) == len(set(whole))
    assert {r["user"]: r["out_strength"] for r in out_strength(raw).collect()} == Counter(s for s, _ in whole)


@FEW
@given(numbers=st.lists(st.integers(-50, 50), max_size=20), span=st.integers(1, 30))
def test_labels(spark, numbers, span):
    df = table(spark, numbers)
    v = F.col("v")
    labels = {"even": v % 2 == 0, "odd": v % 2 != 0, "third": v % 3 == 0}
    chosen = {"even": [n for n in numbers if n % 2 == 0], "odd": [n for n in numbers if n % 2],
              "third": [n for n in numbers if n % 3 == 0]}
    totals = {r["label"]: (r["n"], r["total"]) for r in group_by_labels(df, labels, "v").collect()}
    assert totals == {k: (len(ns), sum(ns)) for k, ns in chosen.items() if ns}
    listed = {k: Counter() for k in chosen}
    for r in label_lists(df, labels, "v", span=span).collect():
        assert len(r["members"]) <= span
        for m in r["members"]:
            assert m["v"] not in listed[r["label"]] and r["part"] <= m["v"] < r["part"] + span
            listed[r["label"]][m["v"]] = m["copies"]
    assert listed == {k: Counter(ns) for k, ns in chosen.items()}


@FEW
@given(seed=st.integers(0, 10 ** 6), small=st.floats(0, 0.5), more=st.floats(0, 0.5))
def test_larger_sample_holds_the_smaller(spark, seed, small, more):
    ids = spark.range(500)
    less, larger = (bag(sample_uniform(ids, "id", f, seed)) for f in (small, small + more))
    assert not less - larger


@FEW
@given(texts=st.lists(st.text(alphabet="aBçÉñ1_ .,!?-\n\t'’¿", max_size=25), max_size=6))
def test_words_are_the_pieces_of_the_normalized_text(spark, texts):
    df = table(spark, texts, "t STRING")
    cleaned = [r[0] for r in df.select(normalized("t")).collect()]
    assert all(c == " ".join(c.split()) for c in cleaned)
    want = Counter(w for c in cleaned for w in c.split(" ") if 0 < len(w) < 7)
    assert bag(tokens(df, "t")) == want
