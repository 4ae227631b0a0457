"""Benchmark decontamination in DataFrame functions only.

The windows of the benchmark (10 words; an item of fewer words is one window) form a
broadcast hash set.  A document is scanned in two steps:

1. Any occurrence of a window of ``w`` words holds a whole block of ``b = ceil(w / 2)``
   words that starts at a multiple of ``w - b + 1``.  So only these aligned blocks of a
   document are hashed and looked up among all blocks of the benchmark.
2. Documents with a known block have all their windows looked up by a 64-bit hash, and those
   found are verified by a second, independent one; reports also join them word for word.

Both steps run inside the scan: no document is exploded or shuffled.  The sets of hashes
travel as literals, so their size is checked first.  A benchmark of more than ``MAX_GRAMS`` windows
is joined instead: windows of all documents against windows of the benchmark.

Null texts, texts without words and items without words have no windows.  Items without
an id mark words but are not counted.  Equal items under several ids all count; an id with
several texts counts once.  Repeated documents are each judged alone.  An empty benchmark
marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, packed, unpacked
from tidemark.scratch import stage

WINDOW = 10
MAX_GRAMS = 20_000
#: Words of lower-cased text, and the same words before lower-casing.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
CASED_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HITS = "array<struct<start:int,len:int,gram:string>>"
#: Independent of the 64-bit hash that finds a window.
SECOND_HASH = "CAST(conv(substring(md5(gram), 1, 15), 16, 10) AS bigint)"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def _windows(words: Column, length: int) -> Column:
    """(start, len, gram) of every window of ``length`` words."""
    starts = F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.lit(length).alias("len"), F.array_join(F.slice(words, i + 1, length), " ").alias("gram")))


def _block(length: int) -> tuple[int, int]:
    block = (length + 1) // 2
    return block, length - block + 1


def benchmark_grams(benchmark: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, len, gram): the windows of every item, each once."""
    items = benchmark.select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    full = items.where(F.size("words") >= window).select("item", F.explode(_windows(F.col("words"), window)).alias("w"))
    short = items.where(F.size("words").between(1, window - 1)).select("item", F.struct(
        F.lit(0).alias("start"), F.size("words").alias("len"), F.array_join("words", " ").alias("gram")).alias("w"))
    return full.unionByName(short).select("item", "w.len", "w.gram").distinct()


def _listed(hashes) -> str:
    return ", ".join(f"{h}L" for h in hashes)


def _marked(rows: DataFrame, grams: DataFrame, max_grams: int) -> DataFrame:
    """``rows`` (with ``words``) and ``hits``: where windows of the benchmark occur."""
    known = grams.select("len", "gram").distinct()
    lengths = sorted(r["len"] for r in known.select("len").distinct().collect())
    if known.count() > max_grams:
        return _joined(rows, known, lengths)
    hits = []
    for length in lengths:
        block, step = _block(length)
        own = known.where(F.col("len") == length)
        pairs = own.select(F.xxhash64("gram"), F.expr(SECOND_HASH)).collect()
        blocks = own.select(F.explode(F.expr(f"""transform(sequence(1, {length - block + 1}),
            i -> xxhash64(slice(split(gram, ' '), i, {block})))"""))).distinct().collect()
        rows = rows.withColumn(f"seen{length}", F.expr(f"""CASE WHEN size(words) >= {length} THEN
            exists(sequence(1, size(words) - {block - 1}, {step}),
                   i -> xxhash64(slice(words, i, {block})) IN ({_listed(b[0] for b in blocks)})) ELSE false END"""))
        hits.append(F.expr(f"""CASE WHEN seen{length} THEN filter(
            transform(sequence(0, size(words) - {length}), i -> struct(
                i AS start, {length} AS len, array_join(slice(words, i + 1, {length}), ' ') AS gram)),
            w -> xxhash64(w.gram) IN ({_listed(p[0] for p in pairs)})
                 AND {SECOND_HASH.replace("gram", "w.gram")} IN ({_listed(p[1] for p in pairs)}))
            ELSE CAST(array() AS {HITS}) END"""))
    found = F.array_sort(F.concat(*hits)) if hits else F.array().cast(HITS)
    return rows.withColumn("hits", found)


def _joined(rows: DataFrame, known: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by a join, for a benchmark too large to travel with the plan."""
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "decontaminate")
    every = F.concat(*[_windows(F.col("words"), length) for length in lengths])
    found = (rows.select("at", F.explode(every).alias("w")).select("at", "w", "w.len", "w.gram")
             .join(known, ["len", "gram"], "left_semi")
             .groupBy("at").agg(F.array_sort(F.collect_list("w")).alias("hits")))
    return rows.join(found, "at", "left").withColumn("hits", F.coalesce("hits", F.array().cast(HITS))).drop("at")


def covered_words(hits: Column) -> Column:
    """How many words the windows cover, overlaps once; ``hits`` are in order of start."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state, hit):
        end = hit["start"] + hit["len"]
        return F.struct((state["n"] + F.greatest(F.lit(0), end - F.greatest(hit["start"], state["end"]))).alias("n"),
                        F.greatest(end, state["end"]).alias("end"))

    return F.aggregate(hits, start, add, lambda state: state["n"])


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, max_grams: int = MAX_GRAMS) -> tuple[DataFrame, DataFrame]:
    """Documents (packed, with ``words`` and ``hits``), and the windows of the benchmark.

    Runs jobs over the benchmark only (over the documents too, if it is above ``max_grams``).
    """
    grams = stage(benchmark_grams(benchmark, item_id, item_text, window), "benchmark-grams")
    # Exploded from an array of one, so that no filter moves below and splits texts again per word.
    rows = packed(docs, words=words_of(F.col(text))).select(ROW, F.explode(F.array("words")).alias("words"))
    return _marked(rows, grams, max_grams), grams


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text",
                  **options) -> DataFrame:
    """The documents without contamination, in the columns they came with.

    ``remove="documents"`` leaves out every document with a hit.  ``"spans"`` keeps all
    documents and takes the words hit out of their text, with white space and punctuation
    between words left as it is; a text without hits is not changed.
    """
    marked, _ = mark(docs, benchmark, text, **options)
    if remove == "documents":
        return unpacked(marked.where(F.size("hits") == 0))
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    original = F.col(f"{ROW}.{text}")
    cased = F.regexp_extract_all(original, F.lit(CASED_WORD), F.lit(0))
    gaps = F.split(original, CASED_WORD, -1)
    kept = F.transform(cased, lambda w, i: F.concat(F.when(F.exists(
        "hits", lambda h: (h["start"] <= i) & (i < h["start"] + h["len"])), F.lit("")).otherwise(w),
        F.element_at(gaps, i + 2)))
    clean = F.concat(F.element_at(gaps, 1), F.array_join(kept, ""))
    fixed = marked.withColumn("clean", F.when(F.size("hits") == 0, original).otherwise(clean))
    order = [F.col("clean").alias(c) if c == text else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns]
    return fixed.select(*order)


def report(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """Per document: n_words, n_hit (words inside windows), the items found, and their digest."""
    marked, grams = mark(docs, benchmark, **options)
    # The row number is given before the rows are exploded, so that it tells documents apart.
    rows = marked.select(F.col(f"{ROW}.{id}").alias(id), F.monotonically_increasing_id().alias("at"),
                         F.size("words").cast("long").alias("n_words"), "hits")
    rows = rows.select(id, "at", "n_words", F.explode_outer("hits").alias("hit"))
    items = grams.groupBy("gram").agg(F.collect_set("item").alias("items"))
    # A document without hits gets a key of its own, which no gram has, so that such rows are dealt evenly.
    key = F.coalesce(F.col("hit.gram"), F.concat(F.lit("\x00"), F.col("at").cast("string")))
    joined = rows.join(items, key == F.col("gram"), "left").select(
        id, "at", "n_words", F.when(F.col("gram").isNotNull(), F.struct("hit.start", "hit.len")).alias("place"), "items")
    found = joined.groupBy("at", id, "n_words").agg(
        F.array_sort(F.collect_set("place")).alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return found.select(id, "n_words", covered_words(F.col("places")).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("places") > 0).alias("contaminated"), "items")
