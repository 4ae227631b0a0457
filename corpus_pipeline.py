"""The corpus pipeline: documents to sharded training data with the operators of the package.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame; ``run`` writes what a stage
gives to the shared folder and hands it to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, near_dup, sharding, toxicity
from tidemark.registry import QueryBook
from tidemark.scratch import stage

SHARDS = 40

book = QueryBook()


def carried(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns a stage works on beside the whole document, so that none it adds can take the place of one."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_document"), *columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the threshold, learned from the labels of ``docs``."""
    labels = toxicity.toxic_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(carried(docs, "doc_id", "text"), toxicity.train(docs.select("doc_id", "text"), labels))
    return scored.where(~F.col("toxic")).select("_document.*")


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; documents taken twice appear twice."""
    return mixing.taken_rows(mixing.mix(carried(docs, "doc_id", "text", "source")), ["_document"]).select("_document.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``; each shard has the mixture of the whole."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [("toxicity", not_toxic), ("near-duplicates", near_deduplicated), ("decontamination", decontaminated),
          ("mixing", mixed), ("sharding", sharded)]

#: A fitted model and similarity components are no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


@book.query("LLM-PIPELINE", ORACLE_SQL, name="pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
