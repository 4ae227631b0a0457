"""Phrase collocation mining after Toivonen.

A text is cut into pieces at punctuation and line ends, a piece into words at spaces and tabs; A-Z are
lowered.  ``f(phrase)`` counts all contiguous occurrences inside pieces, per language.  A phrase
is frequent from ``least`` occurrences on.

A sample of the texts proposes phrases.  The full pass counts, over all texts, the proposed ones and
their negative border: all words, and every longer phrase whose two parts (without its last and
without its first word) are proposed.  It counts under 64-bit hashes, a number in place of a text in
every row that is shuffled.  Phrases that share a hash are counted together, so such a count is
never too low, and what it rules out is not frequent.

The second pass counts what is left by the phrases themselves, and its counts are the result: exact,
whatever the hashes do.  If the first has found a frequent phrase that was not proposed, the
border has failed, and the second pass is an expansion as well: it also counts what the first has
not counted of the phrases whose parts are frequent, or are counted in this very pass.  With that the
counts are closed: a frequent phrase has frequent parts, and each of these is known to be frequent
before the expansion or counted in it.  The longest phrases need no proposal, as nothing is built on them.

What is proposed or frequent goes to the tasks as bit sets of fixed size (two bits a phrase).  A phrase that
a bit set holds by chance is counted like the others, so the sets never grow with the corpus; when
they fill up, more phrases are counted.  Tasks count in units of about ``UNIT`` words and hand on one
row per different phrase of a unit, which Spark adds up.

Null texts are empty, a null language is ``und``.  Texts without words add nothing.  Repeated rows
count as often as they occur.  Texts of any length are taken in parts of ``CHUNK`` bytes, across
whose ends phrases are followed.  An empty table has no phrases.
"""

from __future__ import annotations

import collections
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import stage

UNIT = 1 << 19                                  # words
CHUNK = 1 << 20                                 # bytes
WORDS = 1 << 19
LANGS = 64
BITS = 27
ROOM = 32
SHARE = 0.125
SALTS = 64
STOP = b"\xff"                                  # in no UTF-8 text

# What ends a piece, and what parts words.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b"\t"

_TABLE = bytes.maketrans(ENDS + BLANKS + bytes(range(65, 91)), STOP * len(ENDS) + b" " * len(BLANKS) + bytes(range(97, 123)))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64)


def longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of phrases one word longer."""
    return _mixed(hashes * _FACTOR + word)


def holds(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a bit set holds; without a set, all."""
    if bits is None:
        return np.ones(len(hashes), bool)
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(hashes), bool)
    for places in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        found &= (bits[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def segments(text: bytes, unit: int, longest: int) -> Iterator[tuple[bytes, bytes]]:
    """A text in parts of about ``unit`` bytes, each with the words that follow it inside its last piece."""
    start = 0
    while len(text) - start > unit:
        cut = text.rfind(STOP, start, start + unit)
        if cut > start:
            yield text[start:cut], b""
        else:
            cut = text.rfind(b" ", start, start + unit)
            if cut <= start:
                cut = min((p for p in (text.find(b" ", start + unit), text.find(STOP, start + unit)) if p >= 0), default=len(text))
            end = text.find(STOP, cut)
            ahead = text[cut:end if end >= 0 else len(text)].split(None, longest - 1)[:longest - 1]
            yield text[start:cut], b" ".join(ahead)
        start = cut
    yield text[start:], b""


class Unit:
    """Texts of one language as word numbers, until there are enough to count.

    Number 0 ends a piece.  The words outlast a count, so that most are hashed once a task,
    until there are too many of them.
    """

    def __init__(self, lang: str):
        self.lang = lang
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = collections.defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[STOP]
        self.hashes = np.zeros(1, np.uint64)
        self.parts, self.apart, self.size = [], [], 0

    def add(self, text: bytes, ahead: bytes = b"") -> None:
        """Count ``text``; phrases may run on into ``ahead``, but those that begin there belong to the next unit."""
        tokens = text.replace(STOP, b" \xff ").split()
        begin = self.size + len(tokens)
        tokens += ahead.split()
        tokens.append(STOP)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)
        if ahead:
            self.apart.append((begin, self.size))

    def take(self) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Word numbers, where no phrase begins, the words and their hashes; the unit is empty after that."""
        ids = np.concatenate(self.parts).astype(np.int64) if self.parts else np.empty(0, np.int64)
        words = list(self.numbers)
        self.hashes = np.concatenate([self.hashes, word_hashes(self.lang, words[len(self.hashes):])])
        none = np.zeros(len(ids), bool)
        for start, end in self.apart:
            none[start:end] = True
        hashes, self.parts, self.apart, self.size = self.hashes, [], [], 0
        if len(words) > WORDS:
            self._forget()
        return ids, none, words, hashes


class Level(NamedTuple):
    """The phrases of one length in a unit, by the place where they begin."""

    length: int
    alive: np.ndarray
    hashes: np.ndarray


def _first(ids: np.ndarray, hashes: np.ndarray) -> Level:
    return Level(1, ids > 0, hashes[ids])


def _next(level: Level, ids: np.ndarray, hashes: np.ndarray) -> Level:
    last = ids[level.length:]
    return Level(level.length + 1, level.alive[:-1] & (last > 0), longer(level.hashes[:-1], hashes[last]))


def _held(level: Level, bits: np.ndarray | None, among: np.ndarray | None = None) -> np.ndarray:
    """The places whose phrase is in the bit set, of those in ``among``."""
    among = level.alive if among is None else among
    at, found = np.flatnonzero(among), np.zeros(len(level.alive), bool)
    found[at] = holds(bits, level.hashes[at])
    return found


def _held_words(ids: np.ndarray, hashes: np.ndarray, bits: np.ndarray | None) -> np.ndarray:
    """The places whose word is in the bit set; each word is looked up once."""
    held = holds(bits, hashes)
    held[0] = False
    return held[ids]


def _per_word(ids: np.ndarray, none: np.ndarray, words: list[bytes]) -> np.ndarray:
    counts = np.bincount(ids[~none], minlength=len(words))
    counts[0] = 0
    return counts


def hash_counts(unit: Unit, longest: int, proposed: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of words, hashes, counts) of the words of a unit and the phrases whose parts are in the bit set (None holds all)."""
    ids, none, words, hashes = unit.take()
    per_word = _per_word(ids, none, words)
    present = np.flatnonzero(per_word)
    yield 1, hashes[present], per_word[present]
    if longest == 1 or len(ids) < 2:
        return
    level, parts = _first(ids, hashes), _held_words(ids, hashes, proposed)
    for length in range(2, longest + 1):
        if len(ids) < length:
            return
        level = _next(level, ids, hashes)
        due = parts[:-1] & parts[1:] & level.alive
        now = due & ~none[:len(due)]
        if now.any():
            yield (length, *np.unique(level.hashes[now], return_counts=True))
        if length < longest:
            parts = _held(level, proposed)


def named_counts(unit: Unit, longest: int, frequent: np.ndarray, proposed: np.ndarray | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(phrases, counts) of the frequent phrases of a unit; the empty phrase has the total of words.

    With ``proposed``, also of the phrases that ``hash_counts`` has not counted under that bit
    set, though their parts are frequent or among these phrases themselves.
    """
    ids, none, words, hashes = unit.take()
    texts = pa.array(words, pa.binary())
    per_word = _per_word(ids, none, words)
    yield pa.array([b""], pa.binary()), np.array([per_word.sum()])
    present = np.flatnonzero((per_word > 0) & holds(frequent, hashes))
    yield texts.take(pa.array(present)), per_word[present]
    if longest == 1 or len(ids) < 2:
        return
    level, code, parts = _first(ids, hashes), ids, _held_words(ids, hashes, frequent)
    counted = None if proposed is None else _held_words(ids, hashes, proposed)
    for length in range(2, longest + 1):
        if len(ids) < length:
            return
        level = _next(level, ids, hashes)
        both = parts[:-1] & parts[1:] & level.alive
        parts = _held(level, frequent, both)
        if proposed is not None:
            parts |= both & ~(counted[:-1] & counted[1:])
            counted = _held(level, proposed, both) if length < longest else None
        if (int(code.max(initial=0)) + 1) * len(words) >= 2 ** 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code[:-1] * len(words) + ids[length - 1:]         # tells phrases apart, as hashes might not
        places = np.flatnonzero(parts & ~none[:len(parts)])
        if len(places):
            _, first, number = np.unique(code[places], return_index=True, return_counts=True)
            begun = places[first]
            yield pc.binary_join_element_wise(*[texts.take(pa.array(ids[begun + i])) for i in range(length)], pa.scalar(b" ", pa.binary())), number


def _units(batches: Iterator[pa.RecordBatch], unit: int, longest: int) -> Iterator[Unit]:
    """Units to count: short texts together, long ones in parts; none holds many more words than ``unit``."""
    units: dict[str, Unit] = {}
    held: dict[str, list[bytes]] = collections.defaultdict(list)
    size, piece = 0, min(unit, CHUNK)

    def tokenise() -> None:
        for lang, texts in held.items():
            units.setdefault(lang, Unit(lang)).add(STOP.join(texts))
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for at, lang in enumerate(langs):
            text = batch.column(1)[at].as_buffer().to_pybytes().translate(_TABLE)
            if len(text) > piece:
                mine = units.setdefault(lang, Unit(lang))
                for part, ahead in segments(text, piece, longest):
                    mine.add(part, ahead)
                    if mine.size >= unit:
                        yield mine
                continue
            held[lang].append(text)
            size += len(text)
            if size >= piece:
                tokenise()
                size = 0
                if sum(u.size for u in units.values()) >= unit:
                    yield from [u for u in units.values() if u.size]
                    units = {lang: u for lang, u in units.items() if len(units) <= LANGS}
    tokenise()
    yield from [u for u in units.values() if u.size]


def _counted(texts: DataFrame, proposed: Broadcast | None, longest: int, least: int, unit: int) -> DataFrame:
    """(hash, words, n) of proposed phrases and their border, where there are at least ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if proposed is None else proposed.value
        with np.errstate(over="ignore"):
            for one in _units(batches, unit, longest):
                for words, hashes, counts in hash_counts(one, longest, known):
                    for start in range(0, len(hashes), 65536):
                        part = hashes[start:start + 65536]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part.view(np.int64)), pa.array(np.full(len(part), words, np.int32)),
                             pa.array(counts[start:start + 65536].astype(np.int64))], ["hash", "words", "n"])

    rows = texts.mapInArrow(run, "hash long, words int, n long")
    return rows.groupBy("hash").agg(F.max("words").alias("words"), F.sum("n").alias("n")).where(F.col("n") >= least)


def _named(texts: DataFrame, frequent: Broadcast, proposed: Broadcast | None, longest: int, least: int, unit: int) -> DataFrame:
    """(lang, words, phrase, n) of the frequent phrases, and with 0 words the total per language; expanded if ``proposed`` is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if proposed is None else proposed.value
        with np.errstate(over="ignore"):
            for one in _units(batches, unit, longest):
                for phrases, counts in named_counts(one, longest, frequent.value, known):
                    for start in range(0, len(phrases), 65536):
                        part = phrases.slice(start, 65536)
                        yield pa.RecordBatch.from_arrays([pa.array([one.lang] * len(part)), part.cast(pa.string()),
                                                          pa.array(counts[start:start + 65536].astype(np.int64))], ["lang", "phrase", "n"])

    rows = texts.mapInArrow(run, "lang string, phrase string, n long")
    counted = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("phrase") == ""))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1)
    return counted.select("lang", words.cast("int").alias("words"), "phrase", "n")


def bit_set(hashes: DataFrame, bits: int) -> Broadcast:
    """A table's ``hash`` column as a bit set (runs two jobs).

    It has ``ROOM`` bits a hash, rounded up to a power of two, and never more than
    ``2**bits`` in all.  That size is all the driver and the tasks get.
    """
    bits = max(6, min(bits, (hashes.count() * ROOM).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            if batch.num_rows:
                held = batch.column(0).to_numpy().view(np.uint64)
                places = np.concatenate([held & mask, (held >> np.uint64(32)) & mask])
                slots, owner = np.unique(places >> np.uint64(6), return_inverse=True)
                values = np.zeros(len(slots), np.uint64)
                np.bitwise_or.at(values, owner, np.uint64(1) << (places & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(values.view(np.int64))], ["slot", "bits"])

    found = hashes.select("hash").mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(out)


def _outside(hashes: DataFrame, shared: Broadcast) -> bool:
    """Whether a hash is not in the bit set (runs a job)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missing = int((~holds(shared.value, batch.column(0).to_numpy().view(np.uint64))).sum())
            if missing:
                yield pa.RecordBatch.from_arrays([pa.array([missing])], ["missing"])

    return hashes.select("hash").mapInArrow(run, "missing long").agg(F.sum("missing")).first()[0] is not None


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, share: float = SHARE,
                     bits: int = BITS, unit: int = UNIT) -> DataFrame:
    """(lang, words, phrase, n) of all frequent phrases of up to ``longest`` words, and with 0 words the total per language.

    ``share`` of the texts, chosen by their hash, propose what they hold at least twice, or as often
    as ``least`` times the share.  Runs jobs for the sample and for two full passes.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    lowered = min(least, max(2, int(least * share)))
    proposed = bit_set(stage(_counted(sample, None, max(longest - 1, 1), lowered, unit), "phrases-proposed"), bits)
    found = stage(_counted(texts, proposed, longest, least, unit), "phrases-counted")
    failed = _outside(found.where(F.col("words") < longest), proposed)
    return stage(_named(texts, bit_set(found, bits), proposed if failed else None, longest, least, unit), "phrases-named")


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, inside: int = 50,
                 top: int = 2000, share: float = SHARE, bits: int = BITS, unit: int = UNIT) -> DataFrame:
    """The ``top`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    The score of a phrase is that of its weakest cut into two parts, ``floor(10**6 a a / (l r))``.  Phrases
    inside a longer frequent one with at least ``inside`` percent of their occurrences are left out.
    """
    found = frequent_phrases(docs, text, lang, longest, least, share, bits, unit)
    totals = found.where("words = 0").select("lang", F.col("n"))
    counts = found.where("words > 0").select("lang", "phrase", F.col("n").alias("f"))
    phrases = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("parts"))
    spans = F.expr(f"""flatten(transform(sequence(2, {longest - 1}), m -> transform(
        filter(sequence(0, words - 1), i -> i + m <= words AND m < words), i -> array_join(slice(parts, i + 1, m), ' '))))""")
    kept = phrases
    if longest > 2:
        around = (phrases.where("words > 2").select("lang", F.explode(spans).alias("phrase"), "a")
                  .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
        kept = phrases.join(around, ["lang", "phrase"], "left").where(
            f"around IS NULL OR 100 * CAST(around AS DECIMAL(20,0)) < {inside} * CAST(a AS DECIMAL(20,0))")
    cuts = kept.select("lang", "phrase", "a", "parts", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", _joined(F.expr("slice(parts, 1, k)")).alias("first"), _joined(F.expr("slice(parts, k + 1, size(parts))")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = {c: f"CAST({c} AS DECIMAL(15,0))" for c in "alr"}
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"({exact['a']} * {exact['a']} * CAST(1000000 AS DECIMAL(7,0))) div ({exact['l']} * {exact['r']})"))
    weakest = F.col("score") * 64 + F.col("k")          # a score is at most 10**6
    best = scored.groupBy("lang", "phrase", "a").agg(
        F.min("score").alias("score"), F.min_by("l", weakest).alias("l"), F.min_by("r", weakest).alias("r"))
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    short = best.withColumn("_rank", F.row_number().over(salted)).where(F.col("_rank") <= top).drop("_rank")
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
