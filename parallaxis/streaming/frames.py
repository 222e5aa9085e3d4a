"""Streaming frame selection (an extension: the batch operator's windows over an unbounded source).

A clip's frames arrive in index order; a window is decided once it is full or
its clip falls silent. State is one window a clip.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "clip STRING, window_id INT, frame_index LONG, score DOUBLE, keep BOOLEAN"
STATE = "window_id INT, seen INT, frame_index LONG, score DOUBLE"


def select_streaming(frames: DataFrame, size: int, threshold: float, silence_ms: int = 60_000) -> DataFrame:
    """``(clip, frame_index, score)`` to the best frame of each count window of ``size`` frames."""

    def step(key, batches, state: GroupState):
        window, seen, best, top = state.get if state.exists else (0, 0, None, None)
        rows = []
        if state.hasTimedOut:
            if seen:
                rows.append((key[0], window, best, top, top >= threshold))
            state.remove()
        else:
            found = pd.concat(list(batches)).sort_values("frame_index", kind="stable")
            for index, score in zip(found["frame_index"], found["score"], strict=True):
                if best is None or score > top:
                    best, top = int(index), float(score)
                seen += 1
                if seen >= size:
                    rows.append((key[0], window, best, top, top >= threshold))
                    window, seen, best, top = window + 1, 0, None, None
            state.update((window, seen, best, top))
            state.setTimeoutDuration(silence_ms)
        yield pd.DataFrame(rows, columns=["clip", "window_id", "frame_index", "score", "keep"])

    return frames.groupBy("clip").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
