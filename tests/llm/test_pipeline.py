import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as benchmark_hits
from tests.llm.test_near_dup import brute_classes
from tidemark.scratch import stage


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What goes into each stage and what comes out."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, sf_dir), "test-pipeline")
        out.append((name, docs, after))
        docs = after
    return out


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_in_order_keep_the_columns(steps):
    assert [s[0] for s in steps] == ["toxicity", "near-duplicates", "decontamination", "mixing", "sharding"]
    first = steps[0][1].columns
    assert all(after.columns == first for _, _, after in steps[:-1])
    assert steps[-1][2].columns == [*first, "shard", "slot"]


def test_toxic_documents_go_and_most_others_stay(steps, spark, sf_dir):
    _, before, after = steps[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lost = before.join(after, "doc_id", "left_anti").join(labels, "doc_id", "left")
    assert lost.where("toxic = 0").count() <= 0.02 * labels.where("toxic = 0").count() + 1
    assert set(rows_of(after)) <= set(rows_of(before))


def test_one_document_of_each_class_stays(steps):
    _, before, after = steps[1]
    assert [i for i, _ in rows_of(after)] == sorted({c for _, c in brute_classes(rows_of(before))})


def test_contaminated_documents_go(steps, spark, sf_dir):
    _, before, after = steps[2]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = rows_of(before)
    hits = benchmark_hits([t for _, t in rows], items)
    assert rows_of(after) == [r for r, hit in zip(rows, hits) if not hit[-1]]


def test_the_mix_and_its_shards(steps):
    _, before, after = steps[3]
    assert set(rows_of(after)) <= set(rows_of(before))
    size = lambda df: sum(len(t.split()) for _, t in rows_of(df))
    assert 0.8 * 1.5 * size(before) < size(after) <= 1.5 * size(before) + 1
    _, mixed, sharded = steps[4]
    assert rows_of(sharded) == rows_of(mixed)
    counts = [r["count"] for r in sharded.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1


def test_run_does_all_stages(spark, sf_dir, steps):
    assert rows_of(corpus_pipeline.run(spark, sf_dir)) == rows_of(steps[-1][2])


def test_stages_leave_columns_of_clashing_names_alone(spark, sf_dir, edge_docs):
    """Edge rows among the documents; every stage but the last gives back rows as they came in, value by value."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").limit(60)
    clash = [c for c in edge_docs.columns if c not in docs.columns] + ["source_size"]
    more = edge_docs.select("doc_id", "text", "lang", "source").unionByName(docs).selectExpr("*", *[f"concat('{c}!', doc_id) AS `{c}`" for c in clash])
    rows = more
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = stage(step(spark, rows, sf_dir), "test-clash")
        assert after.columns == more.columns, name
        assert after.distinct().join(rows.distinct(), [after[c].eqNullSafe(rows[c]) for c in more.columns], "left_anti").count() == 0, name
        rows = after
    sharded = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir)
    assert sharded.count() == rows.count() and sharded.where("size <> concat('size!', doc_id)").count() == 0


def test_stages_take_empty_tables(spark, sf_dir, no_docs):
    for _, step in corpus_pipeline.STAGES:
        found = step(spark, no_docs, sf_dir)
        assert found.count() == 0 and set(no_docs.columns) <= set(found.columns)
