"""Language identification by prediction by partial matching (PPM) with frozen statistics.

For each language a context tree of bytes is counted once: how often each byte follows each
context of up to ``order`` bytes.  A text is then coded with each tree and the language with
the shortest code is predicted.  A byte's code length is exact for these statistics: in the
longest context the tree has, a byte seen ``c`` times of ``n`` with ``q`` different bytes costs
``-log2(c / (n + q))``; an unseen byte costs the escape ``-log2(q / (n + q))`` and is coded in
the next shorter context (PPM with escape method C, without exclusions), at last as one of
256 equally likely bytes.

The statistics are frozen, so the code lengths of all grams seen in any language are worked
out beforehand, for all languages at once.  Coding a text is then one table lookup per byte,
and one more for each escape, over numpy arrays; texts are coded whole, in runs of bounded
size.

Training takes documents of each language in seeded order, whole, while their bytes before
them are below ``sample_bytes`` and their number at most ``sample_docs``; so the model is
bounded whatever the corpus.  Documents with a null text or language do not train.

A null text, or one without a letter, is ``und`` with score 0.  Without any training text all
are ``und``.  Equal code lengths go to the first language by name.  Repeated rows get equal
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, shuffle_key, unpacked
from tidemark.scratch import stage

ORDER = 4
SAMPLE_DOCS, SAMPLE_BYTES = 1500, 3_000_000
RUN_BYTES = 1 << 20
UNKNOWN = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
NEW = ("lang_pred", "score")


class GramTable:
    """Grams of one length with a value per gram, in an open hash table over numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slots, self.at = np.full(1 << bits, EMPTY), np.zeros(1 << bits, np.int32)
        self.values, self.longest = values, 0
        left, place = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.slots[place] == EMPTY
            _, first = np.unique(np.where(free, place, -1 - np.arange(len(place))), return_index=True)
            won = first[free[first]]
            self.slots[place[won]], self.at[place[won]] = keys[left[won]], left[won]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, place = left[rest], (place[rest] + 1) & self.mask
            self.longest += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        place = self._home(keys)
        got = self.slots[place]
        out = np.where(got == keys, self.at[place], np.int32(-1))
        open_ = np.flatnonzero((got != keys) & (got != EMPTY))
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            got = self.slots[place[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self.at[place[open_[hit]]]
            open_ = open_[~hit & (got != EMPTY)]
        return out


def gram_keys(data: np.ndarray, length: int) -> np.ndarray:
    """The gram of ``length`` bytes that ends at each position, as an integer (first ones are cut short)."""
    keys = data.astype(np.uint64)
    for back in range(1, length):
        keys[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
    return keys


def _place_in_text(lengths: np.ndarray) -> np.ndarray:
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class PPM:
    """Frozen context trees of all languages as tables of code lengths."""

    def __init__(self, languages: list[str], counts: list[dict[int, tuple[np.ndarray, np.ndarray]]], order: int) -> None:
        """``counts[language][k]``: grams of ``k + 1`` bytes, sorted, and how often each occurs."""
        self.languages, self.order = languages, order
        self.grams: list[GramTable] = []
        self.escapes: list[np.ndarray] = []
        flat = np.full((1, len(languages)), 8.0)
        for k in range(order + 1):
            keys = np.unique(np.concatenate([c[k][0] for c in counts]))
            if k == 0:
                keys = np.arange(256, dtype=np.uint64)
            # The context of a gram is its earlier bytes, which are the higher ones of its key.
            unique_contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            cost = np.zeros((len(keys), len(languages)))
            escape = np.zeros((len(unique_contexts), len(languages)))
            shorter = flat[np.zeros(len(keys), int)] if k == 0 else self.grams[k - 1].values[
                self.grams[k - 1].find(self._shorter(keys, k))]
            for l, seen in enumerate(counts):
                n_gram = np.zeros(len(keys))
                n_gram[np.searchsorted(keys, seen[k][0])] = seen[k][1]
                n = np.bincount(of, n_gram, len(unique_contexts))
                q = np.bincount(of, n_gram > 0, len(unique_contexts))
                known = n > 0
                escape[known, l] = -np.log2(q[known] / (n + q)[known])
                seen_here = n_gram > 0
                cost[:, l] = escape[of, l] + shorter[:, l]
                cost[seen_here, l] = -np.log2(n_gram[seen_here] / (n + q)[of][seen_here])
            self.grams.append(GramTable(keys, cost.astype(np.float32)))
            # Escapes of contexts of k bytes, by the row of that context among the grams of k bytes.
            if k == 0:
                self.escapes.append(escape.astype(np.float32))
            else:
                rows = np.zeros((len(self.grams[k - 1].values) + 1, len(languages)), np.float32)
                rows[self.grams[k - 1].find(unique_contexts)] = escape
                self.escapes.append(rows)

    @staticmethod
    def _shorter(keys: np.ndarray, k: int) -> np.ndarray:
        return keys & np.uint64((1 << (8 * k)) - 1)

    def bits(self, data: np.ndarray, lengths: np.ndarray, started: int = 0) -> np.ndarray:
        """Code length of each of the texts laid end to end, in every language (texts x languages).

        ``started`` bytes at the front of ``data`` are context only.
        """
        place = _place_in_text(lengths)
        total = np.zeros((len(data), len(self.languages)), np.float32)
        whole = gram_keys(data, self.order + 1)
        left = np.arange(len(data))
        for k in range(self.order, -1, -1):
            deep = place[left] >= k
            some = left[deep]
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            row = self.grams[k].find(whole[some] & mask)
            found = row >= 0
            total[some[found]] += self.grams[k].values[row[found]]
            missing = some[~found]
            if k and len(missing):
                context = self.grams[k - 1].find((whole[missing] & mask) >> np.uint64(8))
                total[missing] += self.escapes[k][context]
            left = np.concatenate([left[~deep], missing])
        ends = np.cumsum(lengths)
        sums = np.zeros((len(lengths), len(self.languages)))
        filled = lengths > 0
        total[:started] = 0
        if filled.any():
            sums[filled] = np.add.reduceat(total, (ends - lengths)[filled], axis=0, dtype=np.float64)
        return sums

    def text_bits(self, data: np.ndarray, lengths: np.ndarray, run: int = RUN_BYTES) -> np.ndarray:
        """The same in runs of about ``run`` bytes; a longer text is coded in pieces that share context."""
        out = np.zeros((len(lengths), len(self.languages)))
        ends = np.cumsum(lengths)
        i = 0
        while i < len(lengths):
            begin = ends[i] - lengths[i]
            j = max(i + 1, int(np.searchsorted(ends, begin + run, "right")))
            if lengths[i] <= run:
                out[i:j] = self.bits(data[begin:ends[j - 1]], lengths[i:j])
            else:
                j = i + 1
                for cut in range(begin, ends[i], run):
                    lead = min(self.order, cut - begin)
                    piece = data[cut - lead:min(cut + run, ends[i])]
                    out[i] += self.bits(piece, np.array([len(piece)]), lead)[0]
            i = j
        return out


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the length of each text (0 for null)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """(lang, text) -> (lang, k, gram, n): how often each gram of up to ``order + 1`` bytes occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            for name in dict.fromkeys(names):
                texts = batch.column(1).filter(pa.array(names == name))
                data, lengths = _text_bytes(texts)
                place = _place_in_text(lengths)
                whole = gram_keys(data, order + 1)
                for k in range(order + 1):
                    grams, n = np.unique(whole[place >= k] & np.uint64((1 << (8 * (k + 1))) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(np.full(len(grams), k, np.int32)),
                                                      pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "k", "gram", "n"])

    found = rows.select("lang", "text").mapInArrow(run, "lang string, k int, gram long, n long")
    return found.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


def training_sample(docs: DataFrame, id: str, text: str, lang: str, sample_docs: int = SAMPLE_DOCS,
                    sample_bytes: int = SAMPLE_BYTES, seed: str = "language") -> DataFrame:
    """(lang, text): a bounded seeded sample of whole documents of each language.

    Ids and lengths alone are ranked, and of these only the share of each language whose
    hashes are low enough to hold about twice ``sample_docs``.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), shuffle_key(seed, F.col(id), F.octet_length(text)).alias("key"),
        F.octet_length(text).alias("n"), F.col(text).alias("text"))
    of_all = stage(rows.groupBy("lang").agg(F.count("*").alias("rows")), "language-counts")
    place = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(1 << 48)
    order = Window.partitionBy("lang").orderBy("key")
    low = rows.select("lang", "key", "n").join(of_all, "lang").where(place * F.col("rows") < 2 * sample_docs)
    first = (low.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs)
             .withColumn("before", F.sum("n").over(Window.partitionBy("lang").orderBy("rank")) - F.col("n"))
             .where(F.col("before") < sample_bytes).select("lang", "key").distinct())
    # At most sample_docs short keys per language: small enough to send to every task.
    return rows.join(F.broadcast(stage(first, "language-sample")), ["lang", "key"], "left_semi").select("lang", "text")


def train(sample: DataFrame, order: int = ORDER) -> PPM | None:
    """The model of (lang, text) rows; its grams come to the driver, so the sample must be bounded."""
    grams = gram_counts(sample, order).toArrow()
    if not grams.num_rows:
        return None
    lang, k = np.array(grams["lang"].to_pylist(), dtype=object), grams["k"].to_numpy()
    gram, n = grams["gram"].to_numpy().view(np.uint64), grams["n"].to_numpy()
    languages = sorted(set(lang))
    counts = []
    for name in languages:
        counts.append({})
        for depth in range(order + 1):
            at = np.flatnonzero((lang == name) & (k == depth))
            at = at[np.argsort(gram[at])]
            counts[-1][depth] = (gram[at], n[at])
    return PPM(languages, counts, order)


def predict(docs: DataFrame, model: PPM | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, the share of its code in all codes' likelihood.

    ``keep`` names the columns to carry along (all by default); an input column named like
    the new ones gives way.
    """
    kept = docs.columns if keep is None else keep
    if model is None:
        rows = packed(docs, kept)
        return unpacked(rows, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), new=NEW)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spoken = F.when(F.col(text).rlike("\\p{L}"), F.col(text))
    rows = packed(docs, kept, text=spoken)
    row_type = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            data, lengths = _text_bytes(batch.column(1))
            bits = model.text_bits(data, lengths)
            best = bits.argmin(axis=1)
            score = 1.0 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -1000, 0)).sum(axis=1)
            silent = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            lang = names[best]
            lang[silent] = UNKNOWN
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(np.where(silent, 0.0, score))],
                                             ["_row", "lang_pred", "score"])

    return unpacked(rows.mapInArrow(run, f"_row {row_type}, lang_pred string, score double"), "lang_pred", "score", new=NEW)


def held_out(id, folds: int = 5):
    """Whether the crc32 of an id, as text, is a multiple of ``folds``."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds == 0

