"""Sliding totals kept up by adding and subtracting slides.

Each key holds a ring: the totals of the slides its open windows consist of, and the running
total of the window closed last.  When the watermark passes the next window end, the slide that
enters is added to the running total and the one that leaves is subtracted, so a window costs
two additions whatever its length, and a row is counted once, not once per window.  A late row
goes into its slide, and into the running total while that slide is inside it, and thereby into
the windows still open and no others.

Before the shuffle the rows of a task are added up per key and slide, so a key with a third of
all rows sends one row per slide and Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_column
from tidemark.functions.timing import plain_time
from tidemark.streaming.keyed import Keyed, Value, fold_state
from tidemark.streaming.windows import BOUNDS, in_panes, seconds_of, with_watermark

STATE = "closed BIGINT, running ARRAY<BIGINT>, starts ARRAY<BIGINT>, totals ARRAY<BIGINT>, timer BIGINT"


class Ring:
    """Totals per slide of one key, and of the window ``closed`` last; times in milliseconds."""

    def __init__(self, size: int, slide: int, closed: int, width: int = 1):
        self.size, self.slide, self.closed, self.width = size, slide, closed, width
        self.running = [0] * width
        self.slides: dict[int, list[int]] = {}

    def advance(self, to: int) -> list[tuple[int, list[int]]]:
        """Close all windows that end at or before ``to``; gives (end, totals) of those with rows."""
        to, done = to // self.slide * self.slide, []
        while self.closed < to and self.slides:
            if not self.running[0]:     # an empty stretch: on to the first slide that has rows
                first = min((s for s in self.slides if s >= self.closed), default=to)
                self.closed = max(self.closed, min(first, to))
                if self.closed >= to:
                    break
            end = self.closed + self.slide
            entering = self.slides.get(end - self.slide)
            leaving = self.slides.pop(end - self.size - self.slide, None)
            for i in range(self.width):
                self.running[i] += (entering[i] if entering else 0) - (leaving[i] if leaving else 0)
            self.closed = end
            if self.running[0]:
                done.append((end, list(self.running)))
        if self.closed < to:
            self.closed = to
        for start in [s for s in self.slides if s <= self.closed - self.size - self.slide]:
            del self.slides[start]
        return done

    def add(self, start: int, totals: Sequence[int]) -> bool:
        """Count rows of the slide from ``start``, unless all its windows are closed."""
        if start + self.size <= self.closed:
            return False
        held = self.slides.setdefault(start, [0] * self.width)
        for i, n in enumerate(totals):
            held[i] += n
            if start < self.closed:
                self.running[i] += n
        return True

    def next_end(self) -> int | None:
        """The end of the next window with rows, if the ring has any."""
        if self.running[0] - self.slides.get(self.closed - self.size, [0])[0]:
            return self.closed + self.slide
        ahead = [s for s in self.slides if s >= self.closed]
        return min(ahead) + self.slide if ahead else None

    def to_row(self, timer: int | None) -> tuple:
        starts = sorted(self.slides)
        return self.closed, list(self.running), starts, [n for s in starts for n in self.slides[s]], timer

    @classmethod
    def from_row(cls, size: int, slide: int, row: tuple) -> tuple[Ring, int | None]:
        closed, running, starts, totals, timer = row
        ring = cls(size, slide, closed, len(running))
        ring.running = list(running)
        ring.slides = {s: list(totals[i * ring.width:(i + 1) * ring.width]) for i, s in enumerate(starts)}
        return ring, timer


def per_slide(rows: DataFrame, ts: str, slide: int, keys: Sequence[str], sums: Mapping[str, str | Column]) -> DataFrame:
    """Rows added up per key and slide inside each task (no shuffle); ``slide`` in milliseconds."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    start = ((micros - F.pmod(micros, F.lit(slide * 1000))) / 1000).cast("long")
    wide = rows.where(F.col(ts).isNotNull()).select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], start.alias("start"), F.lit(1).cast("long").alias("n0"),
        *[F.coalesce(as_column(c).cast("long"), F.lit(0)).alias(f"n{i}") for i, c in enumerate(sums.values(), 1)])
    by, added = [c for c in wide.columns if c[0] != "n"], [c for c in wide.columns if c[0] == "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(by, use_threads=False).aggregate([(c, "sum") for c in added])
                yield from table.select([*by, *[f"{c}_sum" for c in added]]).rename_columns(by + added).to_batches()

    return wide.mapInArrow(run, wide.schema)


def sliding_ring(stream: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (), delay: str = "0 seconds",
                 name: str = "n", sums: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Rows, and totals of whole numbers, per overlapping window of a stream: (bounds, keys, ``name``, ``sums``).

    An append stream like ``sliding_count`` with ``delay``: windows come out once the watermark
    has passed them, and keys without rows do not appear.  A row counts in all windows whose
    end lies after the watermark under which its batch runs.  Windows have to consist of whole
    slides.  A null in a sum counts as 0.
    """
    if not in_panes(size, slide):
        raise ValueError("windows have to consist of whole slides")
    sums = dict(sums or {})
    whole, part, width = seconds_of(size) * 1000, seconds_of(slide) * 1000, 1 + len(sums)
    counted = per_slide(with_watermark(stream, ts, delay), ts, part, keys, sums)
    by = [c for c in counted.columns if c[0] == "k"] or ["start"]
    if not keys:
        counted = counted.withColumn("k0", F.lit(0))
        by = ["k0"]
    out = T.StructType([T.StructField("end", T.LongType()), *[counted.schema[k] for k in by],
                        *[T.StructField(f"n{i}", T.LongType()) for i in range(width)]])
    columns = out.fieldNames()

    def closed(keyed: Keyed, ring: Ring, timer: int | None, add: pd.DataFrame | None) -> pd.DataFrame | None:
        done = ring.advance(keyed.now)
        if add is not None:
            for start, *totals in add.itertuples(index=False):
                ring.add(int(start), [int(n) for n in totals])
        due = ring.next_end()
        if due is None:
            keyed["ring"].clear()
        else:
            keyed["ring"].update(ring.to_row(due))
        if timer is not None and timer != due and timer > keyed.now:
            keyed.drop_timer(timer)
        if due is not None and due != timer:
            keyed.set_timer(due)
        return pd.DataFrame([(end, *keyed.key, *totals) for end, totals in done], columns=columns) if done else None

    def held(keyed: Keyed) -> tuple[Ring, int | None]:
        row = keyed.value("ring")
        return (Ring(whole, part, keyed.now // part * part, width), None) if row is None else Ring.from_row(whole, part, row)

    def on_rows(keyed: Keyed, frame: pd.DataFrame) -> pd.DataFrame | None:
        added = frame.groupby("start", as_index=False)[[f"n{i}" for i in range(width)]].sum()
        return closed(keyed, *held(keyed), added)

    def on_timer(keyed: Keyed, when: int) -> pd.DataFrame | None:
        ring, timer = held(keyed)
        return closed(keyed, ring, timer, None) if timer == when else None

    found = fold_state(counted, by, {"ring": Value(STATE)}, on_rows, out, on_timer=on_timer)
    end = F.timestamp_millis("end")
    return found.select(plain_time(end - F.expr(f"INTERVAL {whole // 1000} SECONDS")).alias(BOUNDS[0]), plain_time(end).alias(BOUNDS[1]),
                        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
                        *[F.col(f"n{i}").alias(c) for i, c in enumerate([name, *sums])])
