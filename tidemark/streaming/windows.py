"""Counts over time windows and since the start.

All accept streams and tables.  Windows are cut at the epoch, start included, end
excluded.  With ``delay`` a stream drops state once no row can be that late any
more, which append mode needs; without it state is kept for ever.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import plain_time
from tidemark.operators.ranking import numbered, top_per_group

BOUNDS = ("window_start", "window_end")
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds_of(duration: str) -> int | None:
    """Length of a plain duration such as ``"5 minutes"``; None for any other form."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    return int(found[1]) * SECONDS[found[2]] if found and found[2] in SECONDS else None


def in_panes(size: str, slide: str) -> bool:
    """True where every window consists of whole slides."""
    whole, part = seconds_of(size), seconds_of(slide)
    return bool(whole and part and whole % part == 0)


def with_watermark(stream: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return stream.withWatermark(ts, delay) if delay else stream


def _bounds(window: str = "window") -> list[Column]:
    return [plain_time(f"{window}.start").alias(BOUNDS[0]), plain_time(f"{window}.end").alias(BOUNDS[1])]


def tumbling_count(stream: DataFrame, ts: str, size: str, keys: Sequence[str] = (),
                   delay: str | None = None, name: str = "n") -> DataFrame:
    """Rows per interval, and per key if given."""
    counted = (with_watermark(stream, ts, delay)
               .groupBy(F.window(ts, size), *keys).agg(F.count(F.lit(1)).alias(name)))
    return counted.select(*_bounds(), *keys, name)


def paned(stream: DataFrame, size: str, slide: str, delay: str | None, panes: bool | None = None) -> bool:
    """Whether to aggregate per slide before spreading over the windows.

    Overlapping windows multiply rows; aggregated slides are far fewer.  Needs windows
    made of whole slides.  On a table nothing else changes, so it is the default there.
    On a stream a slide closes before its windows do, and a row that comes after that is
    lost from all of them, so it is done only if asked for with ``panes=True``; it also
    takes a second aggregation, which Spark allows in append mode, hence with a delay.
    """
    if panes is None:
        return in_panes(size, slide) and not stream.isStreaming
    if panes and not (in_panes(size, slide) and (not stream.isStreaming or delay is not None)):
        raise ValueError("panes need windows of whole slides, and on a stream a delay")
    return panes


def windows_of(pane: str, size: str, slide: str) -> Column:
    """The windows a pane belongs to; a stream's watermark carries over."""
    return F.window(F.window_time(pane), size, slide)


def sliding_count(stream: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (),
                  delay: str | None = None, name: str = "n", panes: bool | None = None) -> DataFrame:
    """Rows per overlapping window; keys with no row in a window do not appear in it.

    A late row counts in every window still open.  ``panes``: see ``paned``.
    """
    rows = with_watermark(stream, ts, delay)
    if paned(stream, size, slide, delay, panes):
        panes = rows.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(
            F.count(F.lit(1)).alias("pane_n"))
        counted = (panes.groupBy(windows_of("pane", size, slide).alias("window"), *keys)
                   .agg(F.sum("pane_n").alias(name)))
    else:
        counted = rows.groupBy(F.window(ts, size, slide), *keys).agg(F.count(F.lit(1)).alias(name))
    return counted.select(*_bounds(), *keys, name)


def slide_count(stream: DataFrame, ts: str, slide: str, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows per slide, for ``windows_from_slides`` to spread over windows: a stream then keeps one count per slide."""
    return stream.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias(name))


def windows_from_slides(slides: DataFrame, size: str, slide: str, keys: Sequence[str] = (), name: str = "n") -> DataFrame:
    """The overlapping windows of a table of ``slide_count``; windows have to consist of whole slides."""
    if not in_panes(size, slide):
        raise ValueError("windows have to consist of whole slides")
    counted = slides.groupBy(F.window(F.col("pane.start"), size, slide), *keys).agg(F.sum(name).alias(name))
    return counted.select(*_bounds(), *keys, name)


def running_count(stream: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Total per key since the stream began."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def newest_first(counts: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Latest window first, largest count first within it (a stream: complete mode only)."""
    return counts.orderBy(F.col(BOUNDS[0]).desc(), F.col(name).desc(), *keys)


def largest_first(counts: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Largest count first (a stream: complete mode only)."""
    return counts.orderBy(F.col(name).desc(), *keys)


def top_in_window(counts: DataFrame, k: int, keys: Sequence[str], name: str = "n",
                  rank_as: str = "rank") -> DataFrame:
    """Largest ``k`` of each window, for finished windows or inside a batch callback."""
    return top_per_group(counts, list(BOUNDS), [F.col(name).desc(), *keys], k, rank_as)


def ranked_in_window(counts: DataFrame, keys: Sequence[str], name: str = "n",
                     rank_as: str = "rank") -> DataFrame:
    """All rows of each window, numbered from the largest count (runs jobs).

    A window's rows are sorted by as many tasks as they fill, see ``numbered``.
    """
    return numbered(counts, F.col(name).desc(), *keys, name=rank_as, within=BOUNDS)
