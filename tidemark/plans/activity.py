"""What users do over time, from state per user."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.keyed import Entries, Keyed, Value, fold_state
from tidemark.streaming.windows import with_watermark


def merged(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Sorted (first, last, rows) spans, with those joined that lie at most ``gap`` apart."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def sessions(stream: DataFrame, keys: Sequence[str], ts: str, gap: int, delay: str) -> DataFrame:
    """Runs of a key's rows no more than ``gap`` seconds apart: keys, ``session`` (from 1), ``first_seen``, ``last_seen``, ``n``.

    A session comes out once the watermark has passed its last row by more than the gap.  The state
    of a key is the list of its open sessions and the number of those closed, however many rows it has.
    A late row counts unless the watermark has passed it by more than the gap.
    """
    span, names = gap * 1_000_000, [f"k{i}" for i in range(len(keys))]
    rows = with_watermark(stream, ts, delay).where(F.col(ts).isNotNull()).select(
        *[F.col(k).alias(name) for k, name in zip(keys, names)], F.unix_micros(ts).alias("at"))
    kinds = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in names)

    def due(last: int) -> int:
        return (last + span) // 1000 + 1

    def on_rows(keyed: Keyed, frame: pd.DataFrame) -> None:
        at = frame["at"].to_numpy()
        at = np.sort(at[(at + span) // 1000 + 1 > keyed.now])
        if not len(at):
            return
        cuts = np.flatnonzero(np.diff(at) > span) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(at)]))
        new = zip(at[starts].tolist(), at[ends - 1].tolist(), (ends - starts).tolist())
        closed, before = held(keyed)
        keep(keyed, closed, merged([*before, *new], span), before)

    def held(keyed: Keyed) -> tuple[int, list[tuple[int, int, int]]]:
        closed, *spans = keyed.value("spans", (0, [], [], []))
        return closed, list(zip(*spans))

    def keep(keyed: Keyed, closed: int, spans: list[tuple], before: Sequence[tuple] = ()) -> None:
        """The one timer of a key stands at the first of its spans to close."""
        keyed["spans"].update((closed, *(map(list, zip(*spans)) if spans else ([], [], []))))
        old, fresh = (due(min(last for _, last, _ in found)) if found else None for found in (before, spans))
        if old != fresh:
            if old is not None:
                keyed.drop_timer(old)
            if fresh is not None:
                keyed.set_timer(fresh)

    def on_timer(keyed: Keyed, when: int) -> pd.DataFrame | None:
        number, spans = held(keyed)
        done = [s for s in spans if due(s[1]) <= keyed.now]
        if not done:
            return None
        keep(keyed, number + len(done), [s for s in spans if due(s[1]) > keyed.now])
        firsts, lasts, counts = zip(*done)
        return pd.DataFrame({**{name: [k] * len(done) for name, k in zip(names, keyed.key)},
                             "session": range(number + 1, number + len(done) + 1), "first": firsts, "last": lasts, "n": counts})

    found = fold_state(rows, names, {"spans": Value("closed BIGINT, first ARRAY<BIGINT>, last ARRAY<BIGINT>, n ARRAY<BIGINT>")}, on_rows,
                       f"{kinds}, session BIGINT, first BIGINT, last BIGINT, n BIGINT", on_timer=on_timer)
    return found.select(*[F.col(name).alias(k) for name, k in zip(names, keys)], "session", F.timestamp_micros("first").alias("first_seen"),
                        F.timestamp_micros("last").alias("last_seen"), "n")


def tallies(stream: DataFrame, keys: Sequence[str], kind: str, ts: str, lifetime: int | None = None) -> DataFrame:
    """Rows and latest time of each ``kind`` per key since the stream began, of what a batch has changed.

    With ``lifetime`` (milliseconds) a kind not seen for so long, by processing time, is forgotten.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = stream.select(*[F.col(k).alias(name) for k, name in zip(keys, names)], F.col(kind).cast("string").alias("kind"),
                         F.unix_micros(ts).alias("at")).where("kind IS NOT NULL")
    kinds = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in names)

    def on_rows(keyed: Keyed, frame: pd.DataFrame) -> None:
        for name, at in frame.groupby("kind")["at"]:
            held = keyed["kinds"].getValue((name,))
            n, last = (0, None) if held is None else held
            latest = at.max()
            latest = None if pd.isna(latest) else int(latest)
            last = latest if last is None else last if latest is None else max(last, latest)
            keyed["kinds"].updateValue((name,), (n + len(at), last))
            keyed.noted[name] = (n + len(at), last)

    def after(keyed: Keyed) -> pd.DataFrame:
        return pd.DataFrame([(*keyed.key, name, *held) for name, held in keyed.noted.items()], columns=[*names, "kind", "n", "last"])

    found = fold_state(rows, names, {"kinds": Entries("kind STRING", "n BIGINT, last BIGINT", lifetime)}, on_rows,
                       f"{kinds}, kind STRING, n BIGINT, last BIGINT", after, mode="update", time=None if lifetime is None else "clock")
    return found.select(*[F.col(name).alias(k) for name, k in zip(names, keys)], F.col("kind").alias(kind), "n",
                        F.timestamp_micros("last").alias("last_seen"))
