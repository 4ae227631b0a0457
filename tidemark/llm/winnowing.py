"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a rolling hash.  From each window of ``window``
neighbouring hashes the least is marked, of equal ones the rightmost; a fingerprint is the
list of marks, each a hash and its position.  Two texts that share ``gram + window - 1``
code points in a row have a mark in common there, whatever lies around it, and a mark in
common means ``gram`` equal code points.  Marks depend on the text alone, so equal texts have
equal fingerprints.

A text of fewer than ``gram`` code points is one run; one of fewer than ``window`` runs is
one window; a null text is an empty one, which has no marks.  Two fingerprints without marks
are alike to degree 1.  Texts of any length are worked through in pieces, so memory follows
the length of a text, not its square.

``neighbours`` compares every document with the next one by descending id (null ids last,
texts under one id by their hash; after the last comes the first) and with an edit of it.
Documents are dealt into slices of the id order of about ``SLICE_BYTES`` of text, several to a task
so that tasks are even, and the first document of a slice travels to the slice before as well.  Repeated rows (one id, one text) are
counted before the shuffle and come out again as often as they went in: the next document of
all but the last of them is the text itself.  A table of one document is its own next.  An
empty table has no rows.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, unpacked
from tidemark.scratch import stage

GRAM = 32
WINDOW = 64
PIECE = 1 << 15
SLICE_BYTES = 8 << 20
SLICES_A_TASK = 8
COPIES = 256
BASE = np.uint64(0x9E3779B97F4A7C15)
MARKS = "array<struct<hash: bigint, position: bigint>>"
NEW = ("marks",)
PLACED = "slice int, tail boolean, missing boolean, back long, digest long, text string, copies long"
STUDY_COLUMNS = ("missing boolean", "back long", "copies long", "n_chars long", "edited_sha256 string", f"marks {MARKS}",
                 f"edited_marks {MARKS}", "near_edited double", "near_next double")


def run_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """The hash of every run of ``gram`` points: a polynomial put together from runs of 1, 2, 4, ... points."""
    block, power, size = points.astype(np.uint64) + np.uint64(1), BASE, 1
    done, length, rest = None, 0, gram
    while True:
        if rest & 1:
            if done is None:
                done, length = block, size
            else:
                count = len(points) - length - size + 1
                done, length = done[:count] * power + block[length:length + count], length + size
        rest >>= 1
        if not rest:
            break
        count = len(points) - 2 * size + 1
        block, power, size = block[:count] * power + block[size:size + count], power * power, 2 * size
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        done = (done ^ (done >> np.uint64(shift))) * np.uint64(factor)
    return done ^ (done >> np.uint64(31))


def window_minima(values: np.ndarray, window: int) -> np.ndarray:
    """The place of the least value of every window, of equal ones the rightmost."""
    least, place, size = values, np.arange(len(values)), 1
    while size < window:
        step = min(size, window - size)
        right = least[step:] <= least[:-step]
        least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
        size += step
    return place


def winnow(text: str, gram: int = GRAM, window: int = WINDOW, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the marks of a text, in order of position."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gram = min(gram, len(points))
    runs = len(points) - gram + 1
    window = min(window, runs)
    windows = runs - window + 1
    hashes, places = [], []
    with np.errstate(over="ignore"):
        for start in range(0, windows, piece):
            count = min(piece, windows - start)
            values = run_hashes(points[start:start + count + window + gram - 2], gram)
            found = window_minima(values, window)
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            if places and found[0] + start == places[-1][-1]:
                found = found[1:]
            if len(found):
                hashes.append(values[found].view(np.int64))
                places.append(found + start)
    return np.concatenate(hashes), np.concatenate(places)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the different hashes of either list that are in both."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many of the first code points of the next one, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _marks(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    offsets = np.cumsum([0] + [len(h) for h, _ in found]).astype(np.int32)
    flat = [np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in (0, 1)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in flat], ["hash", "position"]))


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """The rows with ``marks``; an input column of that name gives way."""
    rows = packed(docs, keep, text=F.coalesce(F.col(text), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), _marks([winnow(t, gram, window) for t in part.column(1).to_pylist()])],
                                                 ["_row", "marks"])

    marked = rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, marks {MARKS}")
    return unpacked(marked, "marks", new=NEW)


def fingerprint_text(marks: Column) -> Column:
    """A fingerprint as text: hash in hexadecimal, ``@`` and position of each mark."""
    return F.array_join(F.transform(marks, lambda m: F.concat(F.lpad(F.lower(F.hex(m["hash"])), 16, "0"), F.lit("@"), m["position"].cast("string"))), " ")


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Documents with the key of their order: missing ids last, ids descending, then the hash of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    number = F.col(id).cast("long")
    return docs.select(number.isNull().alias("missing"), F.coalesce(F.bitwise_not(number), F.lit(0).cast("long")).alias("back"),
                       F.xxhash64(whole).alias("digest"), whole.alias("text"))


def _first_keys(keyed: DataFrame, slice_bytes: int) -> list[tuple]:
    """The first key of each slice, in order; their number follows the bytes of all texts (runs two jobs)."""
    keys = stage(keyed.select("missing", "back", "digest", F.octet_length("text").alias("size")), "winnowing-keys")
    total = keys.agg(F.sum("size")).first()[0]
    slices = max(SLICES_A_TASK * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total or 0) // slice_bytes + 1)
    dealt = keys.repartitionByRange(slices, "missing", "back", "digest").groupBy(F.spark_partition_id().alias("slice"))
    first = dealt.agg(F.min(F.struct("missing", "back", "digest")).alias("first")).select("first.*").distinct()
    return sorted(tuple(r) for r in first.collect())


def neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW,
               slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: its id (a whole number), ``n_chars``, ``marks``, ``edited_sha256``, ``edited_marks``,
    ``near_edited`` and ``near_next``.

    The edit replaces the second half of the text by the beginning of the next document.
    Runs two jobs over ids and hashes of texts; the first key of each slice comes to the
    driver.  Texts are shuffled once.
    """
    keyed = _keyed(docs, id, text)
    firsts = _first_keys(keyed, slice_bytes)
    before = {key: (number - 1) % len(firsts) for number, key in enumerate(firsts)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = {}, list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            texts = batch.column(3)
            for at, key in enumerate(keys):
                same = rows.setdefault(key, [])
                for entry in same:
                    if texts[entry[0]].equals(texts[at]):
                        entry[1] += 1
                        break
                else:
                    same.append([at, 1])
            out = []
            for key, same in rows.items():
                home = bisect.bisect_right(firsts, key) - 1
                out += [(home, False, at, copies) for at, copies in same]
                if key in before:
                    out += [(before[key], True, at, copies) for at, copies in same]
            if out:
                slices, tails, at, copies = (list(x) for x in zip(*out))
                picked = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(tails, pa.bool_()), *picked.columns,
                                                  pa.array(copies, pa.int64())],
                                                 ["slice", "tail", "missing", "back", "digest", "text", "copies"])

    def study(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []            # the document that waits for its next one: (slice, missing, back, text, marks, copies)

        def judged(following: str, after: tuple, copies: int) -> tuple:
            _, missing, back, own, marks, _ = held
            changed = edited(own, following)
            again = winnow(changed, gram, window)
            return (missing, back, copies, len(own), hashlib.sha256(changed.encode()).hexdigest(), marks, again,
                    likeness(marks[0], again[0]), likeness(marks[0], after[0]))

        def finished(following: str, after: tuple) -> Iterator[tuple]:
            yield judged(following, after, 1)
            repeats = held[5] - 1
            if repeats:                 # followed by the same text
                same = judged(held[3], held[4], COPIES)
                for start in range(0, repeats, COPIES):
                    yield (*same[:2], min(COPIES, repeats - start), *same[3:])

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            types = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), None, None, pa.float64(), pa.float64())
            out.clear()
            return pa.RecordBatch.from_arrays([_marks(c) if t is None else pa.array(c, t) for c, t in zip(columns, types)],
                                              [c.split()[0] for c in STUDY_COLUMNS])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6)]
            for number, tail, missing, back, own, copies in zip(*columns):
                if held is not None and held[0] != number:
                    raise RuntimeError("a slice of documents has lost the first document of the next")
                if held is None and tail:
                    continue            # a further candidate for the next document, of the same key
                if held is not None and not tail and held[1:4] == (missing, back, own):
                    held = (*held[:5], held[5] + copies)
                    continue
                marks = winnow(own, gram, window)
                if held is not None:
                    for row in finished(own, marks):
                        out.append(row)
                        if len(out) >= 256:
                            yield flush()
                held = None if tail else (number, missing, back, own, marks, copies)
        if held is not None:
            raise RuntimeError("a slice of documents has lost the first document of the next")
        if out:
            yield flush()

    placed = keyed.mapInArrow(place, PLACED).repartition(-(-len(firsts) // SLICES_A_TASK) or 1, "slice")
    ordered = placed.sortWithinPartitions("slice", "tail", "missing", "back", "digest", "text")
    found = ordered.mapInArrow(study, ", ".join(STUDY_COLUMNS))
    kind = docs.schema[id].dataType
    return found.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(
        F.when(~F.col("missing"), F.bitwise_not("back")).cast(kind).alias(id), "n_chars", "marks", "edited_sha256", "edited_marks",
        "near_edited", "near_next")
