import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm import phrases


def brute_counts(docs, longest):
    """All phrases of all pieces, one by one."""
    counts = collections.defaultdict(collections.Counter)
    for text, lang in docs:
        low = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    return counts


def brute(docs, longest=3, least=10, inside=50, top=2000):
    out = []
    for lang, f in brute_counts(docs, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        around = collections.defaultdict(int)
        for p, c in frequent.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i:i + m]] = max(around[p[i:i + m]], c)
        found = []
        for p, a in frequent.items():
            if p in around and 100 * around[p] >= inside * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -score) for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, number, letters):
    rnd = random.Random(seed)
    words = [*letters, "The", "über", "日本", "x\x00y", "a b", "--"]
    weights = [1 / (i + 1) for i in range(len(words))]
    glue = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", ""]
    texts = ["".join(w + rnd.choice(glue) for w in rnd.choices(words, weights, k=rnd.randrange(60))) for _ in range(number)]
    docs = [(t, rnd.choice(["en", "en", "en", "fr", None, "und"])) for t in texts]
    return docs + [docs[0]] * 30 + [(None, "en"), ("", "de"), ("   ", None), (None, None), (".,;", "it"), ("one", "es")]


@pytest.mark.parametrize("seed, settings", [
    (1, {}), (2, {"unit": 64}), (3, {"unit": 7}), (4, {"bits": 6}), (5, {"share": 0.0}), (6, {"share": 1.0, "unit": 200}),
    (7, {"longest": 2, "least": 4}), (8, {"longest": 5, "least": 6, "inside": 80, "unit": 90, "bits": 9}), (9, {"top": 5, "inside": 0})])
def test_collocations_are_those_of_brute_force(spark, seed, settings):
    docs = corpus(seed, 150, "abcdefghij")
    df = spark.createDataFrame([(t, g, "x") for t, g in docs], "text string, lang string, score string").repartition(4)
    wanted = {k: v for k, v in settings.items() if k in ("longest", "least", "inside", "top")}
    found = rows(phrases.collocations(df, **settings))
    assert found == brute(docs, **wanted) and found


def test_a_failed_border_leads_to_an_expansion(spark, monkeypatch):
    """Without proposals the full pass counts words only; the expansion finds all phrases built on them."""
    passes = []
    plain = phrases._named
    monkeypatch.setattr(phrases, "_named", lambda t, f, p, *rest: (passes.append(p is not None), plain(t, f, p, *rest))[1])
    docs = corpus(11, 100, "abcdef")
    df = spark.createDataFrame(docs, "text string, lang string")
    found = phrases.frequent_phrases(df, share=0.0, bits=16)
    assert passes == [True]
    counts = brute_counts(docs, 3)
    wanted = {(g, " ".join(p), c) for g, f in counts.items() for p, c in f.items() if c >= 10}
    assert {tuple(r) for r in found.where("words > 0").select("lang", "phrase", "n").collect()} == wanted
    assert found.where("words > 0").groupBy("lang", "phrase").count().where("count > 1").count() == 0
    passes.clear()
    phrases.frequent_phrases(df, share=1.0)
    assert passes == [False]


def test_phrases_that_share_a_hash_are_told_apart(monkeypatch):
    """With hashes of two bits nearly all phrases share one, and the last pass still counts each."""
    plain, longer = phrases.word_hashes, phrases.longer
    few = np.uint64(3)
    monkeypatch.setattr(phrases, "word_hashes", lambda lang, words: plain(lang, words) & few)
    monkeypatch.setattr(phrases, "longer", lambda hashes, word: longer(hashes, word) & few)
    unit = phrases.Unit("en")
    unit.add(b"a b c a b d")
    assert len({h for _, found, _ in phrases.hash_counts(unit, 3, None) for h in found.tolist()}) <= 4
    unit.add(b"a b c a b d")
    named = {p: n for found, counts in phrases.named_counts(unit, 3, np.full(64, 2**64 - 1, np.uint64)) for p, n in zip(found.to_pylist(), counts.tolist())}
    assert named[b"a b"] == 2 and named[b"c a b"] == 1 and named[b""] == 6


def test_full_sets_count_more_but_find_the_same(spark):
    docs = corpus(12, 80, "abcdefgh")
    df = spark.createDataFrame(docs, "text string, lang string")
    assert rows(phrases.frequent_phrases(df, bits=6)) == rows(phrases.frequent_phrases(df, bits=20))


EVERYTHING = np.full(2, 2**64 - 1, np.uint64)


def counted(parts):
    unit = phrases.Unit("en")
    seen = collections.Counter()
    for part, ahead in parts:
        unit.add(part, ahead)
        for found, counts in phrases.named_counts(unit, 3, EVERYTHING):
            seen.update(dict(zip(found.to_pylist(), counts.tolist())))
    return seen


def test_long_texts_without_a_break_are_followed_across_parts():
    text = b" ".join(b"w%d" % (i % 7) for i in range(500)) + b"\xff" + b"x" * 300 + b" y z\xff"
    for size in (5, 50, 299, 5000):
        assert counted(phrases.segments(text, size, 3)) == counted([(text, b"")])


def test_words_are_forgotten_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(phrases, "WORDS", 3)
    texts = [(b"a b c d a b", b""), (b"a b e", b""), (b"c d", b"")]
    assert counted(texts) == collections.Counter({b"": 11, b"a": 3, b"b": 3, b"c": 2, b"d": 2, b"e": 1, b"a b": 3, b"b c": 1, b"c d": 2, b"d a": 1,
                                                  b"b e": 1, b"a b c": 1, b"b c d": 1, b"c d a": 1, b"d a b": 1, b"a b e": 1})


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**9 + 7
    table = spark.createDataFrame([("en", 0, "", 10**10), ("en", 1, "a", big + 5), ("en", 1, "b", big + 11), ("en", 2, "a b", big)], "lang string, words int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a, **k: table)
    found = phrases.collocations(table).collect()
    assert [tuple(r) for r in found] == [("en", 1, "a b", big, big + 5, big + 11, 10**10, 10**6 * big * big // ((big + 5) * (big + 11)))]


def test_edge_rows_and_empty_tables(spark, edge_docs, no_docs):
    docs = [(r["text"], r["lang"]) for r in edge_docs.collect()]
    assert rows(phrases.collocations(edge_docs, least=2)) == brute(docs, least=2)
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(no_docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_no_language_is_ranked_in_one_task(spark):
    docs = spark.range(1000).select(F.lit("a b").alias("text"), F.lit("en").alias("lang"))
    plan = phrases.collocations(docs)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert len(windows) == 2 and "_w0" in windows[1] and "_w0" not in windows[0]        # the first over salted languages
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
