"""Match segmentation as a stream: the batch state machine kept per video between micro-batches."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.segment import SPAN, Countdown, feed_frame, spans_frame


def segment_stream(samples: DataFrame, idle_ms: int = 600_000, auton: int = 15, driver: int = 105) -> DataFrame:
    """Spans of a stream of samples, emitted when they close.

    A span's start may still move while it is open, so nothing of it leaves
    before. Within a micro-batch samples are put in order of time; a sample
    older than one already seen is dropped. A video without samples for idle_ms
    of processing time counts as ended: a match in its driver period is emitted
    without an end.
    """

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        machine = pickle.loads(state.get[0]) if state.exists else Countdown(auton, driver)
        if state.hasTimedOut:
            machine.finish()
            state.remove()
            yield spans_frame(machine.ready, key[0])
            return
        rows = pd.concat(list(frames))
        rows = rows[rows["video_ts"].notna()].sort_values(["video_ts", "timer"], kind="stable")
        if machine.before is not None:
            rows = rows[rows["video_ts"] >= machine.before[0]]
        feed_frame(machine, rows)
        ready, machine.ready = machine.ready, []
        state.update((pickle.dumps(machine),))
        state.setTimeoutDuration(idle_ms)
        yield spans_frame(ready, key[0])

    return samples.groupBy("video_id").applyInPandasWithState(run, SPAN, "machine binary", "append", GroupStateTimeout.ProcessingTimeTimeout)
