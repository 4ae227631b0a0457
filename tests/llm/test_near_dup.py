import random
import re

import numpy as np
import pytest

from tidemark.llm import near_dup as nd


def shingle_set(text):
    w = [v for v in re.split(r"[\W_]+", (text or "").lower()) if v]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows, similarity=0.8):
    """Smallest id of each component of texts linked by similarity or equality."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            both = sets[i] & sets[j]
            if same or (both and len(both) >= similarity * len(sets[i] | sets[j])):
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(id)
    return sorted((id, min(least[find(i)])) for i, (id, _) in enumerate(rows))


def corpus(seed=5):
    """Families of copies with words changed, chains of them, exact copies, short texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    texts = []
    for family in range(12):
        base = [word() for _ in range(rnd.choice([4, 12, 60, 200]))]
        texts.append(" ".join(base))
        for _ in range(rnd.choice([0, 3, 25])):
            changed = list(base)
            for at in rnd.sample(range(len(base)), min(len(base), rnd.choice([0, 1, 2, 3, 6]))):
                changed[at] = word()
            texts.append(" ".join(changed))
            if family % 2:
                base = changed
    return [(i, t) for i, t in enumerate(texts)]


def test_classes_are_those_of_brute_force(spark):
    rows = corpus()
    got = nd.classify(spark.createDataFrame(rows, "doc_id long, text string"), bands=48)
    assert sorted((r["doc_id"], r["class_id"]) for r in got.collect()) == brute_classes(rows)


def test_a_class_is_found_through_any_member(spark):
    """Members that differ too much from the smallest of the bucket are linked by others."""
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
    rows, current = [], base
    for i in range(40):
        rows.append((i, " ".join(current)))
        current = list(current)
        current[(i * 7) % 100] = f"new{i}"
    got = nd.classify(spark.createDataFrame(rows, "doc_id long, text string"), bands=48)
    assert sorted((r["doc_id"], r["class_id"]) for r in got.collect()) == brute_classes(rows)


def test_agreement_is_the_weighted_similarity():
    rnd = np.random.default_rng(1)
    n, k = 300, 4096
    hashes = rnd.integers(1, 2**63, n).astype(np.uint64)
    first, second = rnd.integers(0, 5, n).astype(float), rnd.integers(0, 5, n).astype(float)
    stacked = [(hashes[w > 0], w[w > 0]) for w in (first, second)]
    of = np.repeat([0, 1], [len(s[0]) for s in stacked])
    sketch = nd.dart_sketch(np.concatenate([s[0] for s in stacked]), of, np.concatenate([s[1] for s in stacked]), 2, k)
    want = np.minimum(first, second).sum() / np.maximum(first, second).sum()
    assert abs((sketch[0] == sketch[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k)
    alone = nd.dart_sketch(stacked[0][0], np.zeros(len(stacked[0][0]), int), stacked[0][1], 1, k)
    assert (alone[0] == sketch[0]).all()  # a sketch depends on its own text only


def test_parities_never_rule_out_a_link():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        a = rnd.integers(1, 2**63, 200).astype(np.uint64)
        b = a.copy()
        b[:rnd.integers(0, 40)] = rnd.integers(1, 2**63)
        b = np.unique(b)
        words = nd.parities(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
        apart = bin(int.from_bytes((words[0] ^ words[1]).tobytes(), "big")).count("1")
        assert apart <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("weighting", ["one", "count"])
def test_edge_rows(edge_docs, weighting):
    got = nd.classify(edge_docs, weighting=weighting)
    assert got.count() == edge_docs.count() and got.columns.count("class_id") == 1
    by_text = {(r["doc_id"], r["text"]): r for r in got.collect()}
    base = by_text[(1, edge_docs.first()["text"])]["text"]
    assert {by_text[(i, base)]["class_id"] for i in (1, 2, None)} == {1}
    assert by_text[(8, base + " nu xi")]["class_id"] == 1
    assert by_text[(3, None)]["class_id"] == 3 and by_text[(4, "")]["class_id"] == 4


def test_one_row_of_each_class_stays(edge_docs, no_docs):
    kept = nd.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    found = sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect())
    assert len(found) == 9 and sum(i == "1" for i, _ in found) == 1
    assert nd.deduplicated(no_docs).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(149, 150), (7, 7)]
    got = dict(tuple(r) for r in nd.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 151)}


def test_components_that_do_not_settle_raise(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").coalesce(1)
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        nd.components(path, rounds=2)
