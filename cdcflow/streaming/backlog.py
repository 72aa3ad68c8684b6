"""Alerts of a backlog as its samples arrive: a state machine with timers.

Each queue is a key. Its state is whether it was over the level, up to which time it has been judged, and the samples that are
newer than the watermark. A timer fires as the watermark passes waiting samples; they are then judged in the order of their times,
so samples may come in any order within ``delay``. Later ones are left out, as what follows them has been judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.operators.progress import BACKLOG_CAPACITY, BACKLOG_LEVEL

_STATE = "was_full boolean, judged bigint, times array<bigint>, levels array<double>"
_NEVER = -(1 << 62)


def judge(was_full: bool, samples: list[tuple[int, float]], limit: float) -> tuple[bool, list[tuple[int, float, str]]]:
    """Samples in order to whether the last is over the limit, and the alerts on the way."""
    out = []
    for at, level in samples:
        full = level > limit
        if full or was_full:
            out.append((at, level, "alert" if full else "recovered"))
        was_full = full
    return was_full, out


def backlog_states(
    samples: DataFrame, queue: str, time: str, level: str, capacity: int = BACKLOG_CAPACITY, threshold: float = BACKLOG_LEVEL, delay: str = "0 seconds"
) -> DataFrame:
    """``queue``, ``time``, ``level``, state: ``alert`` at every sample over the threshold, ``recovered`` at the first back under it.

    Samples without a time or level are left out. ``time`` is a timestamp; samples of one time are judged by level. The last
    ``delay`` before the newest sample waits for the next one.
    """
    limit = capacity * threshold

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        was_full, judged, times, levels = state.get if state.exists else (False, _NEVER, [], [])
        waiting = list(zip(times, levels))
        for part in parts:
            waiting += [(int(t), float(v)) for t, v in zip(part["micros"], part["value"]) if t > judged]
        watermark = state.getCurrentWatermarkMs()
        waiting.sort()
        due = [s for s in waiting if s[0] // 1000 <= watermark]
        left = waiting[len(due) :]
        was_full, alerts = judge(was_full, due, limit)
        judged = max(judged, due[-1][0]) if due else judged
        state.update((was_full, judged, [t for t, _ in left], [v for _, v in left]))
        if left:
            # A timer fires once the watermark is past it, so a millisecond early to judge the sample itself.
            state.setTimeoutTimestamp(max(left[0][0] // 1000 - 1, watermark + 1))
        if alerts:
            yield pd.DataFrame([(key[0], *a) for a in alerts], columns=["queue", "micros", "value", "state"])

    known = samples.where(F.col(queue).isNotNull() & F.col(time).isNotNull() & F.col(level).isNotNull())
    at = known.select(
        F.col(queue).alias("queue"), F.col(time).cast("timestamp").alias("at"), F.unix_micros(F.col(time).cast("timestamp")).alias("micros"), F.col(level).cast("double").alias("value")
    ).withWatermark("at", delay)
    queue_type = known.schema[queue].dataType.simpleString()
    states = at.groupBy("queue").applyInPandasWithState(run, f"queue {queue_type}, micros bigint, value double, state string", _STATE, "append", "EventTimeTimeout")
    time_type, level_type = known.schema[time].dataType, known.schema[level].dataType
    return states.select(
        F.col("queue").alias(queue), F.timestamp_micros("micros").cast(time_type).alias(time), F.col("value").cast(level_type).alias(level), "state"
    )
