import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id as li


def code_length(text: bytes, training: list[bytes], order: int) -> float:
    """PPM with escape method C, no exclusions, byte by byte."""
    counts = Counter(t[i - k:i + 1] for t in training for i in range(len(t)) for k in range(order + 1) if i >= k)
    after = {}
    for gram, n in counts.items():
        seen = after.setdefault(gram[:-1], [0, 0])
        seen[0] += n
        seen[1] += 1
    bits = 0.0
    for i in range(len(text)):
        for k in range(min(order, i), -1, -1):
            context = text[i - k:i]
            if context not in after:
                continue
            n, q = after[context]
            if text[i - k:i + 1] in counts:
                bits -= math.log2(counts[text[i - k:i + 1]] / (n + q))
                break
            bits -= math.log2(q / (n + q))
        else:
            bits += 8
    return bits


TRAINING = {"x": ["the cat sat on the mat", "that hat"], "y": ["le chat est sur le tapis", "un état"]}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, t) for lang, texts in TRAINING.items() for t in texts]
    return li.train(spark.createDataFrame(rows, "lang string, text string"), order=3)


def test_code_lengths_are_exact(model):
    texts = [t.encode() for t in ("the état", "", "a", "zzz", "le chat sat on un tapis " * 30)]
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
    want = np.array([[code_length(t, [s.encode() for s in TRAINING[lang]], 3) for lang in model.languages] for t in texts])
    assert np.allclose(model.text_bits(data, lengths), want, rtol=1e-4, atol=1e-3)
    assert np.allclose(model.text_bits(data, lengths, run=16), want, rtol=1e-4, atol=1e-3)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = li.train(li.training_sample(docs.where(~li.held_out(F.col("doc_id"))), "doc_id", "text", "lang"))
    found = li.predict(docs, model).where(li.held_out(F.col("doc_id")))
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
    assert found.where("score < 0 OR score > 1").count() == 0


def test_edge_rows(spark, edge_docs, no_docs, model):
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in li.predict(edge_docs, model).collect()}
    assert got[(3, None)] == got[(4, "")] == got[(5, "   ")] == ("und", 0.0)
    assert all(lang in ("x", "y") for (_, text), (lang, _) in got.items() if text and text.strip())
    assert li.predict(no_docs, model).count() == 0
    untrained = li.predict(edge_docs, li.train(li.training_sample(no_docs, "doc_id", "text", "lang")))
    assert {r["lang_pred"] for r in untrained.collect()} == {"und"}
    assert li.train(li.training_sample(edge_docs, "doc_id", "text", "lang")).languages == ["en", "fr", "ru"]  # the German text is empty


def test_sample_is_bounded(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"))
    assert li.training_sample(docs, "doc_id", "text", "lang", sample_docs=100).count() <= 100
    assert li.training_sample(docs, "doc_id", "text", "lang", sample_bytes=95).count() == 10
