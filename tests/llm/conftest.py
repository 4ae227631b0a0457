import pytest

#: Columns named like those the operators add.
CLASHING = ("size", "target", "shard", "slot", "score", "grade", "severity", "toxic", "class_id", "representative",
            "lang_pred", "hits", "words", "finish", "passes", "_pass", "row", "n", "digest", "key", "bucket")

LONG = " ".join(f"w{i % 9973}x{i % 7}" for i in range(60_000))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    return [(1, base, "en", "a"), (1, base, "en", "a"), (2, base, "en", None), (None, base, None, "a"), (3, None, "en", "a"),
            (4, "", "de", "b"), (5, "   ", None, "b"), (6, LONG, "en", "a"), (7, "one", "fr", None), (None, None, None, None),
            (8, base + " nu xi", "en", "c"), (9, "ünï cödé ÀÉ 日本語 текст", "ru", "c"), (7, "another text under one id", "fr", "a")]


@pytest.fixture(scope="session")
def edge_docs(spark):
    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string")
    return docs.selectExpr("*", *[f"'{c}!' AS `{c}`" for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
