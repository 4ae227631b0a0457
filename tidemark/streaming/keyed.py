"""State per key with event time: values, lists and maps, lifetimes and timers.

The rows of a key reach the function frame by frame and are folded into its state, so a key
with any number of rows in one micro-batch takes the memory of one frame.  State lies in RocksDB
and is read as it is needed: an entry of a map or the items of a list, not the whole of a key.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any, NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor


class Value(NamedTuple):
    """One row per key.  ``lifetime`` in milliseconds of processing time since the last update, if any."""

    schema: str
    lifetime: int | None = None


class Items(NamedTuple):
    """A list of rows per key."""

    schema: str
    lifetime: int | None = None


class Entries(NamedTuple):
    """A map of rows per key; each entry has its own lifetime."""

    key: str
    schema: str
    lifetime: int | None = None


class Keyed:
    """What a function sees of one key: ``key``, its states by name, the time, and its timers.

    ``now`` is the watermark or the clock in milliseconds, whichever time is kept.  A timer set at ``when``
    fires once the time has reached ``when``.  ``noted`` is kept between the frames of one batch.
    """

    def __init__(self, key: tuple, states: Mapping[str, Any], handle, now: int | None):
        self.key, self.now, self._states, self._handle = key, now, states, handle
        self.noted: dict = {}

    def __getitem__(self, name: str):
        return self._states[name]

    def value(self, name: str, default: tuple | None = None) -> tuple | None:
        found = self._states[name].get()
        return default if found is None else tuple(found)

    def set_timer(self, when: int) -> None:
        self._handle.registerTimer(when - 1)     # Spark fires what lies before the watermark

    def drop_timer(self, when: int) -> None:
        self._handle.deleteTimer(when - 1)

    def timers(self) -> list[int]:
        return sorted(when + 1 for when in self._handle.listTimers())


#: Called for each frame of a key's rows; may put rows out.
OnRows = Callable[[Keyed, pd.DataFrame], pd.DataFrame | None]
#: Called once a batch, after the key's last frame.
After = Callable[[Keyed], pd.DataFrame | None]
#: Called when a timer has fired, with its time.
OnTimer = Callable[[Keyed, int], pd.DataFrame | None]


class _Fold(StatefulProcessor):
    def __init__(self, states: Mapping[str, Value | Items | Entries], on_rows: OnRows, after: After | None,
                 on_timer: OnTimer | None, time: str | None):
        self.kinds, self.on_rows, self.after, self.on_timer, self.time = dict(states), on_rows, after, on_timer, time

    def init(self, handle) -> None:
        self.handle, self.states = handle, {}
        for name, kind in self.kinds.items():
            if isinstance(kind, Entries):
                self.states[name] = handle.getMapState(name, kind.key, kind.schema, kind.lifetime)
            else:
                make = handle.getValueState if isinstance(kind, Value) else handle.getListState
                self.states[name] = make(name, kind.schema, kind.lifetime)

    def _keyed(self, key, times) -> Keyed:
        now = {"event": times.getCurrentWatermarkInMs, "clock": times.getCurrentProcessingTimeInMs, None: lambda: None}[self.time]()
        return Keyed(tuple(key) if isinstance(key, (tuple, list)) else (key,), self.states, self.handle, now)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keyed = self._keyed(key, timerValues)
        for frame in rows:
            out = self.on_rows(keyed, frame)
            if out is not None and len(out):
                yield out
        if self.after is not None:
            out = self.after(keyed)
            if out is not None and len(out):
                yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.on_timer is not None:
            out = self.on_timer(self._keyed(key, timerValues), expiredTimerInfo.getExpiryTimeInMs() + 1)
            if out is not None and len(out):
                yield out

    def close(self) -> None:
        pass


def fold_state(stream: DataFrame, keys: Sequence[str], states: Mapping[str, Value | Items | Entries], on_rows: OnRows,
               output: str, after: After | None = None, on_timer: OnTimer | None = None, mode: str = "append",
               time: str | None = "event", time_column: str = "") -> DataFrame:
    """Fold every key's new rows into its state; the functions put rows of the schema ``output`` out.

    Rows of a key come in no stated order, over any number of frames.  ``time`` is "event" for
    timers by watermark, which the stream then needs (rows later than it are left out by Spark where
    the time column is still among the columns); "clock" for timers and lifetimes by processing
    time, with which Spark always has another batch to run, so such a stream takes an interval
    trigger; or None for neither.  ``time_column`` names an output column that carries event time on
    to a further stateful operator.  Needs the RocksDB state store.
    """
    processor = _Fold(states, on_rows, after, on_timer, time)
    # Spark sets state up in a worker that does not get the files of a session; what it runs travels by value.
    for part in {__package__, *(f.__module__.rpartition(".")[0] for f in (on_rows, after, on_timer) if f is not None)}:
        if part.startswith(__package__.partition(".")[0] + "."):
            cloudpickle.register_pickle_by_value(sys.modules[part])
    mode_of = {"event": "EventTime", "clock": "ProcessingTime", None: "None"}
    return stream.groupBy(*keys).transformWithStateInPandas(processor, output, mode, mode_of[time], None, time_column)
