"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < ... < K share one weight per feature; each step between grades has its own
threshold: ``P(grade >= k) = sigmoid(w . x - threshold_k)``.  The expected severity is the sum
of these probabilities over k.

Features are the distinct words of a text and the distinct beginnings of its words (3 to 6
characters), present or absent, so a text of any length is judged by what it holds.

Training takes at most ``sample_rows`` labelled texts of each grade in seeded order, weighed
back to the shares of their grades.  An L1 penalty worth ``support`` graded texts chooses the
features, so what a few texts share by chance is not learned.  The chosen ones are fitted
again with a slight ridge only, on the texts and on each of their words alone, so that one
word can decide where others usually come with it.  All other labelled and
unlabelled texts are only scored.

A null or empty text has no features and gets the severity of the thresholds alone; it is
never flagged.  Labels without a grade, and labels of missing or null texts, do not train;
several labels of one id count as the highest.  Without texts of two grades every severity
is 0.  Repeated rows get equal severities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, shuffle_key, unpacked
from tidemark.scratch import stage

SAMPLE_ROWS = 3000
SUPPORT = 8
#: Expected severity from which a text is flagged: clearly more likely graded than not.
THRESHOLD = 0.6
WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
#: Words remembered per task, so that a frequent word is looked up once.
MEMORY = 1_000_000
NEW = ("severity", "grade", "toxic")


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings."""
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) > n]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


class Model(NamedTuple):
    weights: dict[str, float]
    thresholds: list[float]

    def severity(self, score: float | np.ndarray):
        """P(grade >= 1), ..., P(grade >= K) along the last axis."""
        return 1.0 / (1.0 + np.exp(-np.clip(np.asarray(score)[..., None] - np.array(self.thresholds), -500, 500)))


def training_words(docs: DataFrame, labels: DataFrame, id: str, text: str, label_id: str, grade: str,
                   sample_rows: int = SAMPLE_ROWS, seed: str = "toxicity") -> DataFrame:
    """(grade, all, words, key) of the labelled sample; ``all`` is how many labels have the grade."""
    graded = (labels.where(F.col(label_id).isNotNull() & F.col(grade).isNotNull())
              .groupBy(F.col(label_id).alias("id")).agg(F.max(grade).cast("int").alias("grade")))
    all_of = stage(graded.groupBy("grade").agg(F.count("*").alias("all")), "toxicity-grades")
    # Only the share of each grade whose hashes are low enough to hold about twice the sample is ranked.
    keyed = graded.join(all_of, "grade").withColumn("key", shuffle_key(seed, F.col("id")))
    place = F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / float(1 << 48)
    order = Window.partitionBy("grade").orderBy("key")
    first = keyed.where(place * F.col("all") < 2 * sample_rows).withColumn("rank", F.row_number().over(order))
    sample = stage(first.where(F.col("rank") <= sample_rows).drop("rank", "key"), "toxicity-sample")
    # At most sample_rows ids per grade: small enough to send to every task.
    rows = (docs.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
            .join(F.broadcast(sample), "id").select("grade", "all", "text", F.xxhash64("id", "text").alias("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(
                    [sorted(words_of(t)) for t in part.column(2).to_pylist()], pa.list_(pa.string())), part.column(3)], ["grade", "all", "words", "key"])

    return rows.mapInArrow(run, "grade int, all long, words array<string>, key long")


class Sparse(NamedTuple):
    """Texts as (text, feature) pairs, and their words as (word, feature) pairs with each word's text."""

    names: list[str]
    row: np.ndarray
    column: np.ndarray
    word_text: np.ndarray
    word_row: np.ndarray
    word_column: np.ndarray

    def only(self, chosen: np.ndarray) -> Sparse:
        """With the chosen features alone, and the words that have one."""
        at, kept, inside = np.cumsum(chosen) - 1, chosen[self.column], chosen[self.word_column]
        words, word_row = np.unique(self.word_row[inside], return_inverse=True)
        return Sparse([n for n, c in zip(self.names, chosen) if c], self.row[kept], at[self.column[kept]],
                      self.word_text[words], word_row, at[self.word_column[inside]])


def sparse_features(words: pa.ChunkedArray, graded: np.ndarray, min_docs: int) -> Sparse:
    """Features in at least ``min_docs`` texts that graded texts have more often than others.

    Words are numbered once; the features of a text are never held for all texts together,
    only those chosen.
    """
    lists = words.combine_chunks()
    coded = lists.flatten().dictionary_encode()
    codes, ends = coded.indices.to_numpy(), lists.offsets.to_numpy()
    starts, ends = ends[:-1] - ends[0], ends[1:] - ends[0]
    ids: dict[str, int] = {}
    of_word = np.full((len(coded.dictionary), 1 + len(PREFIXES)), -1, np.int32)
    for i, word in enumerate(coded.dictionary.to_pylist()):
        found = [ids.setdefault(f, len(ids)) for f in features_of(word)]
        of_word[i, :len(found)] = found
    n, hits = np.zeros(len(ids)), np.zeros(len(ids))
    for i in range(len(graded)):
        here = np.unique(of_word[codes[starts[i]:ends[i]]])
        here = here[here >= 0]
        n[here] += 1
        hits[here] += graded[i]
    share = graded.mean()
    keep = (n >= min_docs) & (hits > 2 * share * n / (1 + share))
    at = np.append(np.where(keep, np.cumsum(keep) - 1, -1), -1).astype(np.int32)
    of_word = at[of_word]
    telling = (of_word >= 0).any(axis=1)
    row, column, word_text, word_row, word_column = [], [], [], [], []
    n_words = 0
    for i in range(len(graded)):
        here = codes[starts[i]:ends[i]]
        here = of_word[here[telling[here]]]
        found = np.unique(here)
        found = found[found >= 0]
        row.append(np.full(len(found), i))
        column.append(found)
        word, place = np.nonzero(here >= 0)
        word_text.append(np.full(len(here), i))
        word_row.append(word + n_words)
        word_column.append(here[word, place])
        n_words += len(here)
    joined = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (row, column, word_text, word_row, word_column)]
    return Sparse([name for name, k in zip(ids, keep) if k], *joined)


def fit(grades: np.ndarray, weight: np.ndarray, row: np.ndarray, column: np.ndarray, n_features: int, l1: float,
        ridge: float, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the weighted log loss plus ``l1 |w| + ridge w^2``.

    Accelerated proximal gradient; the step is halved whenever the bound it rests on fails.
    Thresholds are the first and gaps kept positive.
    """
    n, levels = len(grades), int(grades.max())
    share = weight / weight.sum()
    w, gaps = np.zeros(n_features), np.concatenate([[2.0], np.full(levels - 1, 1.0)])

    def loss(w, gaps):
        thresholds = np.cumsum(gaps)
        score = np.bincount(row, w[column], n) if n_features else np.zeros(n)
        above = 1.0 / (1.0 + np.exp(-np.clip(score[:, None] - thresholds, -60, 60)))
        edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        here = np.arange(n)
        p = np.maximum(edges[here, grades] - edges[here, grades + 1], 1e-12)
        slope = edges * (1 - edges)
        d_score = -(slope[here, grades] - slope[here, grades + 1]) / p * share
        d_threshold = np.zeros((n, levels + 2))
        d_threshold[here, grades] += slope[here, grades] / p * share
        d_threshold[here, grades + 1] -= slope[here, grades + 1] / p * share
        by_threshold = d_threshold[:, 1:-1].sum(axis=0)
        by_gap = np.cumsum(by_threshold[::-1])[::-1]
        return (-(share * np.log(p)).sum() + ridge * (w @ w),
                np.bincount(column, d_score[row], n_features) + 2 * ridge * w, by_gap)

    step, momentum = 8.0, 1.0
    w_ahead, g_ahead = w, gaps
    for _ in range(steps):
        value, dw, dg = loss(w_ahead, g_ahead)
        while True:
            w_new = w_ahead - step * dw
            w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * l1, 0)
            g_new = g_ahead - step * dg
            g_new[1:] = np.maximum(g_new[1:], 1e-3)
            gap_w, gap_g = w_new - w_ahead, g_new - g_ahead
            bound = value + dw @ gap_w + dg @ gap_g + (gap_w @ gap_w + gap_g @ gap_g) / (2 * step)
            if loss(w_new, g_new)[0] <= bound + 1e-12 or step < 1e-6:
                break
            step /= 2
        after = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        w_ahead = w_new + (momentum - 1) / after * (w_new - w)
        g_ahead = g_new + (momentum - 1) / after * (g_new - gaps)
        g_ahead[1:] = np.maximum(g_ahead[1:], 1e-3)
        w, gaps, momentum = w_new, g_new, after
        step *= 1.5
    return w, np.cumsum(gaps)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          grade: str = "grade", sample_rows: int = SAMPLE_ROWS, support: int = SUPPORT) -> Model | None:
    """The model, or None without texts of two grades.  The bounded sample comes to the driver."""
    sample = training_words(docs, labels, id, text, label_id, grade, sample_rows).toArrow()
    grades = sample["grade"].to_numpy()
    if not len(grades) or grades.min() == grades.max():
        return None
    order = np.argsort(sample["key"].to_numpy(), kind="stable")
    sample, grades = sample.take(pa.array(order)), grades[order]
    grades = np.unique(grades, return_inverse=True)[1]
    taken = np.bincount(grades)
    weight = sample["all"].to_numpy() / taken[grades]
    found = sparse_features(sample["words"], (grades > 0).astype(float), support)
    one = weight[grades > 0].mean() / weight.sum()
    w, _ = fit(grades, weight, found.row, found.column, len(found.names), l1=support * one, ridge=0.0)
    found = found.only(w > 0)
    # The texts, and each of their words alone; the words of a text weigh as much as the text.
    n_words = np.bincount(found.word_text, minlength=len(grades))
    w, thresholds = fit(np.concatenate([grades, grades[found.word_text]]),
                        np.concatenate([weight, (weight / np.maximum(n_words, 1))[found.word_text]]),
                        np.concatenate([found.row, len(grades) + found.word_row]),
                        np.concatenate([found.column, found.word_column]), len(found.names), l1=0.0, ridge=one / 10)
    return Model({name: float(x) for name, x in zip(found.names, w)}, [float(x) for x in thresholds])


def score(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """The documents with expected ``severity``, most likely ``grade``, and ``toxic`` (severity at ``threshold`` or above).

    ``keep`` names the columns to carry along (all by default); an input column named like
    the new ones gives way.
    """
    kept = docs.columns if keep is None else keep
    if model is None:
        return unpacked(packed(docs, kept), F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic"), new=NEW)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = packed(docs, kept, text=F.col(text))
    row_type = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights = model.weights
        known: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sums, silent = [], []
                for value in part.column(1).to_pylist():
                    found: set[str] = set()
                    words = words_of(value)
                    for word in words:
                        features = known.get(word)
                        if features is None:
                            if len(known) >= MEMORY:
                                known.clear()
                            features = known[word] = tuple(f for f in features_of(word) if f in weights)
                        if features:
                            found.update(features)
                    sums.append(sum(sorted(weights[f] for f in found)))
                    silent.append(not words)
                above = model.severity(np.array(sums, float))
                severity = above.sum(axis=1)
                edges = np.concatenate([np.ones((len(sums), 1)), above, np.zeros((len(sums), 1))], axis=1)
                grade = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(severity), pa.array(grade.astype(np.int32)),
                     pa.array((severity >= threshold) & ~np.array(silent, bool))], ["_row", "severity", "grade", "toxic"])

    scored = rows.mapInArrow(run, f"_row {row_type}, severity double, grade int, toxic boolean")
    return unpacked(scored, "severity", "grade", "toxic", new=NEW)


def toxic_grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels that only say toxic or not: 0, 1, or 2 if the text is also of low quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(
        F.col("quality") == 0, 2).otherwise(1)).alias("grade"))
