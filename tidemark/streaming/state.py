"""Per-key state that no aggregate expresses."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: (key, the key's new rows in order, old state or None) -> (new state or None, rows to put out).
Update = Callable[[tuple, pd.DataFrame, tuple | None], tuple[tuple | None, pd.DataFrame]]
Expire = Callable[[tuple, tuple], pd.DataFrame]


def stateful_update(stream: DataFrame, keys: Sequence[str], order: Sequence[str], update: Update, state_schema: str,
                    output_schema: str, idle: str | int | None = None, expire: Expire | None = None,
                    mode: str = "update") -> DataFrame:
    """Call ``update`` for every key with new rows in a micro-batch, with the state it returned last.

    Rows of a key come as one pandas frame sorted by ``order``, so a key's rows of one
    micro-batch have to fit in memory: cap the input per trigger, or, where their order does
    not matter, take ``keyed.fold_state``, which holds one frame.  A new state of None
    drops the key.  With ``idle`` (milliseconds) a key without rows for so long, by
    processing time, is dropped as well, after ``expire`` had its last say.
    """
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            old = state.get
            state.remove()
            if expire is not None:
                yield expire(key, old)
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values(list(order), ignore_index=True)
        new, out = update(key, rows, state.get if state.exists else None)
        if new is not None:
            state.update(new)
            if idle is not None:
                state.setTimeoutDuration(idle)
        elif state.exists:
            state.remove()
        yield out

    timeout = GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.ProcessingTimeTimeout
    return stream.groupBy(*keys).applyInPandasWithState(run, output_schema, state_schema, mode, timeout)
