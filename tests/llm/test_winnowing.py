import collections
import hashlib
import random

import pytest
import xxhash

from tests.conftest import rows
from tidemark.llm import winnowing


def brute_marks(text, gram, window):
    """Every window looked at on its own, run hashes by the definition of the polynomial."""
    points = [ord(c) for c in text]
    if not points:
        return []
    gram = min(gram, len(points))
    hashes = []
    for start in range(len(points) - gram + 1):
        value = 0
        for p in points[start:start + gram]:
            value = (value * int(winnowing.BASE) + p + 1) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            value = (value ^ value >> shift) * factor % 2**64
        hashes.append(value ^ value >> 31)
    window = min(window, len(hashes))
    chosen = set()
    for start in range(len(hashes) - window + 1):
        part = hashes[start:start + window]
        chosen.add(start + max(i for i, h in enumerate(part) if h == min(part)))
    return [(h - 2**64 if (h := hashes[i]) >= 2**63 else h, i) for i in sorted(chosen)]


def marks_of(text, **settings):
    hashes, places = winnowing.winnow(text, **settings)
    return list(zip(hashes.tolist(), places.tolist()))


@pytest.mark.parametrize("gram, window, piece", [(5, 7, 1 << 15), (5, 7, 3), (1, 1, 4), (8, 1, 2), (4, 16, 1), (6, 13, 10)])
def test_marks_are_those_of_the_definition(gram, window, piece):
    rnd = random.Random(gram * window)
    for size in (0, 1, 2, 4, 5, 6, 11, 12, 40, 200):
        for letters in ("ab", "a", "abcdefghijk é日\U0001f600"):
            text = "".join(rnd.choice(letters) for _ in range(size))
            assert marks_of(text, gram=gram, window=window, piece=piece) == brute_marks(text, gram, window)


def test_a_shared_passage_of_guaranteed_length_shares_a_mark():
    rnd = random.Random(1)
    word = lambda n: "".join(rnd.choice("abcdefg ") for _ in range(n))
    passage = word(winnowing.GRAM + winnowing.WINDOW - 1)
    for _ in range(50):
        a, b = (winnowing.winnow(word(rnd.randrange(300)) + passage + word(rnd.randrange(300)))[0] for _ in range(2))
        assert set(a.tolist()) & set(b.tolist())


def order_key(row):
    i, text = row
    digest = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
    return i is None, ~(i or 0) if i is not None else 0, digest - 2**64 if digest >= 2**63 else digest, text or ""


def brute_neighbours(docs, gram, window):
    ordered, out = sorted(docs, key=order_key), []
    for at, (i, text) in enumerate(ordered):
        own, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(own) // 2
        changed = own[:len(own) - half] + after[:half]
        marks, again, following = (brute_marks(t, gram, window) for t in (own, changed, after))
        sets = [{h for h, _ in m} for m in (marks, again, following)]
        like = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((i, len(own), marks, hashlib.sha256(changed.encode()).hexdigest(), again, *like))
    return out


def plain(df):
    return [(r[0], r[1], [tuple(m) for m in r[2]], r[3], [tuple(m) for m in r[4]], r[5], r[6]) for r in df.collect()]


@pytest.mark.parametrize("slice_bytes", [1 << 20, 60])
def test_neighbours_are_those_of_brute_force(spark, slice_bytes):
    rnd = random.Random(slice_bytes)
    docs = [(i, " ".join(rnd.choice(("alpha", "beta", "gamma", "日本", "x")) for _ in range(rnd.randrange(40)))) for i in range(90)]
    docs += [(None, None), (None, "one"), (7, ""), (7, None), (8, "same"), (8, "same"), (8, "same"), (-5, "z" * 50), (2**63 - 1, "top"), (-2**63, "low")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = plain(winnowing.neighbours(df, gram=5, window=8, slice_bytes=slice_bytes))
    assert sorted(found, key=repr) == sorted(brute_neighbours(docs, 5, 8), key=repr)


def test_edge_rows_keep_their_count(edge_docs, no_docs):
    found = winnowing.neighbours(edge_docs)
    wanted = brute_neighbours([(r["doc_id"], r["text"]) for r in edge_docs.where("length(text) < 1000 OR text IS NULL").collect()], 32, 64)
    assert found.count() == edge_docs.count() == len(wanted) + 1
    assert collections.Counter(r[0] for r in found.collect()) == collections.Counter(r["doc_id"] for r in edge_docs.collect())
    assert winnowing.neighbours(no_docs).count() == 0


def test_many_copies_come_out_as_often_as_they_went_in(spark):
    df = spark.range(1500).selectExpr("CAST(9 AS LONG) AS doc_id", "repeat('abc ', 30) AS text").unionAll(
        spark.createDataFrame([(3, "last")], "doc_id long, text string"))
    found = winnowing.neighbours(df).groupBy("doc_id", "near_next").count()
    assert rows(found) == [(3, 0.0, 1), (9, 0.0, 1), (9, 1.0, 1499)]


def test_fingerprints_keep_the_rows(edge_docs):
    marked = winnowing.fingerprints(edge_docs)
    assert marked.columns == [*edge_docs.columns, "marks"]
    assert rows(marked.drop("marks")) == rows(edge_docs)
    for r in marked.collect():
        assert [tuple(m) for m in r["marks"]] == marks_of(r["text"] or "")
    clash = winnowing.fingerprints(edge_docs.withColumnRenamed("size", "Marks"))
    assert clash.columns.count("marks") == 1 and "Marks" not in clash.columns
