import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as t


@pytest.fixture(scope="module")
def tables(spark):
    """Grade 1 texts hold a mild word, grade 2 texts a grave one; other words are alike."""
    rnd = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(1500):
        words = [f"n{rnd.integers(0, 400)}" for _ in range(rnd.integers(5, 60))]
        grade = int(rnd.choice([0, 0, 0, 0, 1, 2]))
        if grade:
            words.insert(int(rnd.integers(0, len(words))), rnd.choice(["darn", "heck"] if grade == 1 else ["vile", "vilest"]))
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, grade))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, grade int"), docs


def test_unlabelled_texts_are_judged(tables):
    docs, labels, texts = tables
    model = t.train(docs, labels)
    rows = {r["doc_id"]: r for r in t.score(docs, model).collect()}
    graded = {i: 2 if "vile" in text else 1 if ("darn" in text or "heck" in text) else 0 for i, text in texts}
    held = [i for i in graded if i % 3 == 0]
    assert sum(rows[i]["toxic"] == (graded[i] > 0) for i in held) / len(held) > 0.98
    assert sum(rows[i]["grade"] == graded[i] for i in held) / len(held) > 0.95
    mean = [np.mean([rows[i]["severity"] for i in held if graded[i] == g]) for g in (0, 1, 2)]
    assert mean[0] < 0.3 < mean[1] < 1.4 < mean[2] <= 2
    assert model.thresholds[0] < model.thresholds[1]


def test_scores_are_those_of_plain_python(tables):
    docs, labels, texts = tables
    model = t.train(docs, labels)
    for r in t.score(docs.limit(50), model).collect():
        found = {f for w in r["text"].split() for f in t.features_of(w) if f in model.weights}
        score = sum(model.weights[f] for f in found)
        assert r["severity"] == pytest.approx(sum(1 / (1 + np.exp(x - score)) for x in model.thresholds))
    again = t.train(docs.repartition(3), labels.repartition(2))
    assert again.weights == pytest.approx(model.weights)


def test_edge_rows(tables, edge_docs, no_docs):
    model = t.train(*tables[:2])
    scored = t.score(edge_docs, model)
    assert scored.count() == edge_docs.count() and scored.columns.count("severity") == 1
    assert scored.where("text IS NULL OR trim(text) = ''").where("toxic").count() == 0
    assert t.score(no_docs, model).count() == 0
    labels = edge_docs.select("doc_id", F.lit(0).alias("grade"))
    assert t.train(edge_docs, labels) is None
    assert t.train(edge_docs, labels.withColumn("grade", F.lit(None).cast("int"))) is None
    assert {(r["severity"], r["toxic"]) for r in t.score(edge_docs, None).collect()} == {(0.0, False)}


def test_held_out_accuracy_on_the_given_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = t.train(docs, t.toxic_grades(labels.where(~held)))
    judged = t.score(docs, model, keep=["doc_id"]).join(labels.where(held).withColumnRenamed("toxic", "label"), "doc_id")
    clean = judged.where("label = 0")
    assert clean.where("toxic").count() <= 0.05 * clean.count()
