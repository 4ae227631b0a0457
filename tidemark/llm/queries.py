"""The operators of this package as queries on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (decontaminate, extraction, language_id, mixing, near_dup, nearest, phrases, sharding, shallot, sql, toxicity,
                          url_filter, warc, winnowing)
from tidemark.registry import QueryBook, read
from tidemark.scratch import scratch_path

book = QueryBook()


@book.query("LLM-1", sql.HITS)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of all documents lie in windows of the benchmark, and of which items."""
    found = decontaminate.report(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read(spark, sf_dir, "benchmark"))
    return found.drop("items")


@book.query("LLM-2", sql.SHARDS)
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards that each match the mixture of sources."""
    text = F.col("text")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.md5(text).alias("digest"))
    placed = sharding.assign_shards(docs, 40, digest="digest")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@book.query("LLM-3", sql.MIX)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all sources takes from each document."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


@book.query("LLM-4")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = docs.where(~language_id.held_out(F.col("doc_id")))
    model = language_id.train(language_id.training_sample(learned, "doc_id", "text", "lang"))
    found = language_id.predict(docs, model, keep=["doc_id"])
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@book.query("LLM-5")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected severity of all documents, learned from a bounded sample of the labelled ones."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, toxicity.toxic_grades(read(spark, sf_dir, "labels")))
    return toxicity.score(docs, model, keep=["doc_id"])


@book.query("LLM-6")
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of near-duplicates they are in."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.classify(docs, keep=["doc_id"]).select("doc_id", "class_id", "representative")


@book.query("LLM-7", sql.CAPTURES)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back from them."""
    path = scratch_path(spark, "archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    found = warc.captures(warc.read_archives(spark, path))
    return found.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


@book.query("LLM-8", sql.NEAREST)
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors to each vector whose id is divisible by 100."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@book.query("LLM-9")
def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extraction.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])


URL_RULES = [url_filter.Rule("block", "net"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


@book.query("LLM-10")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls judged by rules, else by the links between hosts."""
    judged = url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@book.query("LLM-11")
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprints of all documents and of their edits, and how alike neighbours are."""
    found = winnowing.neighbours(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_chars", "edited_sha256", winnowing.fingerprint_text(F.col("marks")).alias("fingerprint"),
                        winnowing.fingerprint_text(F.col("edited_marks")).alias("edited_fingerprint"), "near_edited", "near_next")


@book.query("LLM-12", sql.CLUSTERS)
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 8 clusters after 10 rounds."""
    return shallot.clusters(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@book.query("LLM-13", sql.COLLOCATIONS)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words per language."""
    return phrases.collocations(read(spark, sf_dir, "documents").select("text", "lang"))
