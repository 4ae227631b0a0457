"""Near-duplicate texts: DartMinHash sketches, a banded join, exact checks, components.

A text is its set of shingles (5 consecutive words; a text of fewer words is one shingle),
each with a weight: 1, or with ``weighting="count"`` how often it occurs.  Two texts are
linked if the (weighted) Jaccard similarity of their shingles is 0.8 or more; classes are
the components of the links.  The class id is the smallest document id of the class.

* **Sketch.**  Every shingle owns a region of width its weight in which darts fall at random,
  by a hash of the shingle, at increasing ranks.  All darts of a text with rank below
  ``t / total weight`` are thrown (about ``t = k ln k + 2k`` of them, however long the text),
  and each of the ``k`` coordinates keeps its earliest.  Two texts agree on a coordinate with
  probability their weighted similarity.
* **Copies** first: equal texts share one row from here on.
* **Bands** of ``r`` coordinates are joined by key.  Texts of one bucket are not paired with
  one another: each is compared with the smallest of its bucket.  After that, in buckets that
  still hold several classes, members of all but the largest class meet members of other
  classes, under an exact bound: the parities of a set's hashes in 2048 bits differ between
  two sets in no more bits than the sets differ in shingles.  Only pairs that the bound lets
  through leave the join, once each however many buckets they share, and are compared.  So every pair in a bucket is compared, ruled out
  by the bound, or lies in one class already, and a bucket of linked copies costs one
  comparison per member.
* **Checks** compare whole shingle sets, so no link is wrong.  A pair at similarity 0.8 is
  missed by all bands with probability ``(1 - 0.8^4)^24 = 3e-6``.
* **Components** by alternating large-star and small-star steps, each written out.

Words are runs of letters and digits of any script, lower-cased.  A null text is alone; a
text without words is linked to equal texts only.  Repeated rows are copies.  A null id is
never a class id unless the whole class has none.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, unpacked
from tidemark.scratch import stage

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
PARITY_WORDS = 32
#: Texts, and about so many bytes of them, handled at once in a task; words remembered there.
RUN_TEXTS, RUN_BYTES, MEMORY = 2048, 2_000_000, 1_000_000
WORD = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def shingles(words: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of consecutive texts, and which text each is of."""
    with np.errstate(over="ignore"):
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
        of = np.repeat(np.arange(len(lengths)), counts)
        first = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        width = np.minimum(lengths, size)[of]
        out = width.astype(np.uint64)
        for i in range(size):
            there = i < width
            word = words[np.minimum(first + i, len(words) - 1)] if len(words) else words[:0]
            out = np.where(there, mixed(out * MIX + word), out)
    return out, of


def weighed(hashes: np.ndarray, of: np.ndarray, weighting: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles per text, and their weights, in order of text."""
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate([at, [len(of)]]))
    return hashes[at], of[at], (counts if weighting == "count" else np.ones(len(at))).astype(np.float64)


def dart_sketch(hashes: np.ndarray, of: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """(n, k) sketches: per text and coordinate the earliest dart.  Rows of empty texts are 0.

    A shingle's region is cut into cells of widths 1, 2, 4, ... up to its weight; in each
    cell darts arrive as a Poisson process in rank, at a hashed place across the cell, and
    count if that place is below the weight.  Texts with a coordinate left empty throw on to
    twice the rank.
    """
    sketch = np.zeros((n, k), np.uint64)
    total = np.bincount(of, weights, n)
    limit = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
    open_texts = total > 0
    with np.errstate(over="ignore"):
        while open_texts.any():
            some = np.flatnonzero(open_texts[of])
            best = np.full(n * k, np.inf)
            ids = np.zeros(n * k, np.uint64)
            level = 0
            cell, low, width = hashes[some], 0.0, 1.0
            owner, weight = of[some], weights[some]
            while len(cell):
                seed = mixed(cell * MIX + np.uint64(level))
                rank, dart = np.zeros(len(cell)), np.uint64(0)
                who, heavy, key = owner, weight, seed
                while len(who):
                    dart += np.uint64(1)
                    hit = mixed(key + dart * MIX)
                    rank = rank - np.log(unit(hit)) / width
                    on = rank <= limit[who]
                    who, heavy, key, rank, hit = who[on], heavy[on], key[on], rank[on], hit[on]
                    place = mixed(hit ^ MIX)
                    landed = low + width * unit(place) <= heavy
                    slot = who * k + (mixed(place) % np.uint64(k)).astype(np.int64)
                    order = np.flatnonzero(landed)
                    order = order[np.argsort(-rank[order], kind="stable")]
                    better = order[rank[order] < best[slot[order]]]
                    best[slot[better]], ids[slot[better]] = rank[better], hit[better]
                low, width, level = low + width, width * 2, level + 1
                deeper = weight > low
                cell, owner, weight = cell[deeper], owner[deeper], weight[deeper]
            full = open_texts & np.isfinite(best.reshape(n, k)).all(axis=1)
            sketch[full] = ids.reshape(n, k)[full]
            open_texts &= ~full
            limit = limit * 2
    return sketch


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(sketch), 0)
        for r in range(rows):
            keys = mixed(keys * MIX + sketch[:, r::rows][:, :bands])
    return keys.view(np.int64)


def _words(batch: pa.RecordBatch, column: int, known: Hashes) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of bounded size: (rows, the hashes of their words, how many each text has)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < batch.num_rows:
        end, size = start, 0
        while end < batch.num_rows and end - start < RUN_TEXTS and (end == start or size + sizes[end] <= RUN_BYTES):
            size += sizes[end]
            end += 1
        part = batch.slice(start, end - start)
        found: list[int] = []
        lengths = np.zeros(end - start, np.int64)
        for i, text in enumerate(part.column(column).to_pylist()):
            before = len(found)
            found.extend(map(known.__getitem__, WORD.findall(text.lower())))
            lengths[i] = len(found) - before
        yield part, np.array(found, np.uint64), lengths
        start = end


def sketches(rows: DataFrame, bands: int = BANDS, r: int = ROWS, shingle: int = SHINGLE, weighting: str = "one") -> DataFrame:
    """``text`` of each row replaced by ``bands``, its band keys; empty for a text without words."""
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            for part, words, lengths in _words(batch, len(kept), known):
                hashes, of, weights = weighed(*shingles(words, lengths, shingle), weighting)
                sketch = dart_sketch(hashes, of, weights, len(lengths), bands * r)
                keys = band_keys(sketch, bands, r)[lengths > 0].reshape(-1)
                offsets = np.concatenate([[0], np.cumsum(np.where(lengths > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))]
                                                 + [pa.ListArray.from_arrays(offsets, pa.array(keys))],
                                                 [f.name for f in kept] + ["bands"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", bands array<long>"
    return rows.select(*[f.name for f in kept], "text").mapInArrow(run, schema)


def parities(hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """(n, PARITY_WORDS) words of 64 bits: each bit is the parity of the hashes that fall on it."""
    bits = 64 * PARITY_WORDS
    counts = np.bincount(of * bits + (hashes % np.uint64(bits)).astype(np.int64), minlength=n * bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).reshape(n, PARITY_WORDS)


def shingle_sets(rows: DataFrame, shingle: int = SHINGLE, weighting: str = "one") -> DataFrame:
    """(node, text) -> (node, set, n, parity): distinct shingles (with their occurrence
    numbers, if counts weigh), how many, and their parities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            for part, words, lengths in _words(batch, 1, known):
                hashes, of, weights = weighed(*shingles(words, lengths, shingle), weighting)
                with np.errstate(over="ignore"):  # the n-th occurrence of a shingle is an element of its own
                    times = weights.astype(np.int64)
                    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    hashes = mixed(np.repeat(hashes, times) + number.astype(np.uint64) * MIX)
                of = np.repeat(of, times)
                counts = np.bincount(of, minlength=len(lengths))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                parity = parities(hashes, of, len(lengths)).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))), pa.array(counts, pa.int32()),
                     pa.ListArray.from_arrays(np.arange(0, len(parity) + 1, PARITY_WORDS, dtype=np.int32), pa.array(parity))],
                    ["node", "set", "n", "parity"])

    return rows.select("node", "text").mapInArrow(run, "node long, set array<long>, n int, parity array<long>")


def _near(na: Column, nb: Column, parity_a: Column, parity_b: Column, similarity: float) -> Column:
    """Whether sizes and parities leave room for the similarity: at most so many shingles in one set only."""
    apart = F.aggregate(F.zip_with(parity_a, parity_b, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda x, y: x + y)
    return (F.least(na, nb) >= similarity * F.greatest(na, nb)) & (
        apart <= F.floor((1 - similarity) / (1 + similarity) * (na + nb) + 1e-6))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough; only those that may be are compared whole."""
    def of(node: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(node), *[F.col(c).alias(c + node) for c in columns])

    near = (pairs.join(of("a", "n", "parity"), "a").join(of("b", "n", "parity"), "b")
            .where(_near(F.col("na"), F.col("nb"), F.col("paritya"), F.col("parityb"), similarity))
            .select("a", "b", "na", "nb"))
    full = near.join(of("b", "set"), "b").join(of("a", "set"), "a")
    shared = F.size(F.array_intersect("seta", "setb"))
    return full.where(shared >= similarity * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each component of ``edges`` (a, b).

    Runs rounds until nothing changes, and raises if ``rounds`` of them are not enough.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        edges = stage(small.where("a <> b").distinct(), "edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _key(id: Column) -> Column:
    """The id as a join key that is never null."""
    return F.coalesce(id.cast("string"), F.lit("~"))


def _digested(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, digest, text) of the rows with a text; ``key`` is the id and never null."""
    return docs.select(F.col(id).alias("id"), _key(F.col(id)).alias("key"),
                       F.md5(F.col(text)).alias("digest"), F.col(text).alias("text")).where("text IS NOT NULL")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, shingle: int = SHINGLE,
            bands: int = BANDS, r: int = ROWS, weighting: str = "one") -> DataFrame:
    """(digest, class_digest, class_id) of every distinct text.

    Runs jobs and keeps their results in the shared folder.
    """
    if weighting not in ("one", "count"):
        raise ValueError("weighting is 'one' or 'count'")
    rows = _digested(docs, id, text)
    texts = stage(sketches(rows.select("id", "digest", "text"), bands, r, shingle, weighting)
                  .groupBy("digest").agg(F.first("bands").alias("bands"), F.min("id").alias("id"))
                  .withColumn("node", F.monotonically_increasing_id()), "near-texts")
    member = texts.select("node", F.explode("bands").alias("bucket"))
    center = member.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = stage(member.join(center, "bucket"), "near-shared")
    pairs = stage(shared.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct(), "near-pairs")
    wanted = stage(shared.select("node").distinct().join(texts, "node").select(
        "node", "digest", _key(F.col("id")).alias("key")), "near-wanted")
    # One row of each text: its least id's; joined on the id too, so copies of a text do not meet in one task.
    found = rows.select("digest", "key", "text").join(wanted, ["digest", "key"]).dropDuplicates(["digest", "key"])
    sets = stage(shingle_sets(found.select("node", "text"), shingle, weighting), "near-sets")
    links = stage(verified(pairs, sets, similarity), "near-links")
    rest = _unjoined(shared, components(links), sets, similarity).join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(stage(verified(rest, sets, similarity), "near-links"))
    named = (texts.select("node", "digest", "id").join(stage(components(links), "near-labels"), "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    names = named.groupBy("label").agg(F.min("id").alias("class_id"), F.min_by("digest", F.struct(
        F.col("id").isNull(), "id", "digest")).alias("class_digest"))
    return stage(named.join(names, "label").select("digest", "class_digest", "class_id"), "near-classes")


def _unjoined(shared: DataFrame, label: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b), a > b: pairs in buckets with several classes that may be similar, none inside a bucket's largest class."""
    known = shared.select("bucket", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = known.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = (sizes.groupBy("bucket").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("largest"))
               .where("labels > 1").drop("labels"))
    several = stage(known.join(largest, "bucket"), "near-mixed")
    of_node = several.groupBy("node").agg(F.collect_list("bucket").alias("buckets"))
    several = stage(several.join(of_node, "node").join(sets.select("node", "n", "parity"), "node"), "near-mixed")
    few = several.where("label <> largest").select("bucket", F.col("node").alias("x"), F.col("label").alias("lx"), F.col("n").alias("nx"),
                                                   F.col("parity").alias("px"), F.col("buckets").alias("bx"))
    every = several.select(F.col("bucket").alias("same"), F.col("node").alias("y"), F.col("label").alias("ly"),
                           F.col("n").alias("ny"), F.col("parity").alias("py"), F.col("buckets").alias("by"))
    near = _near(F.col("nx"), F.col("ny"), F.col("px"), F.col("py"), similarity)
    first = F.col("bucket") == F.array_min(F.array_intersect("bx", "by"))
    return (few.join(every, (F.col("bucket") == F.col("same")) & (F.col("lx") != F.col("ly")) & near & first)
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def classify(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """The documents with ``class_id``, the smallest id of their class, and ``representative``.

    A representative has the class id and the text of that document; a row with a null text
    is one.  ``keep`` names the columns to carry along (all by default); an input column
    named like the new ones gives way.
    """
    found = classes(docs, id, text, **options)
    rows = packed(docs, keep, digest=F.md5(F.col(text)), id=F.col(id)).join(found, "digest", "left")
    first = F.col("digest").isNull() | ((F.col("digest") == F.col("class_digest")) & F.col("id").eqNullSafe(F.col("class_id")))
    return unpacked(rows, F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                    first.alias("representative"), new=("class_id", "representative"))


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, in the columns the documents came with; null texts all stay.

    Joined on text and id, so the copies of one text are spread over the tasks; rows that
    repeat both meet there and leave one.
    """
    found = classes(docs, id, text, **options)
    first = found.where("digest = class_digest").select("digest", _key(F.col("class_id")).alias("key"))
    rows = packed(docs, digest=F.md5(F.col(text)), key=_key(F.col(id)))
    kept = rows.where("digest IS NOT NULL").join(first, ["digest", "key"]).dropDuplicates(["digest", "key"])
    return unpacked(kept).unionByName(unpacked(rows.where("digest IS NULL")))
