"""Structured Streaming forms of the windowed operators; state is bounded by watermarks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tumbling_counts(events: DataFrame, at: str, key: str, width: str = "400 milliseconds", late: str = "10 seconds") -> DataFrame:
    """Fixed windows: rows, greatest and mean value per key; rows later than the watermark are dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count("*").alias("n"), F.max("value").alias("peak"), F.avg("value").alias("mean"))


def sliding_counts(events: DataFrame, at: str, key: str, length: str = "30 seconds", step: str = "25 seconds", late: str = "10 seconds") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, length, step), key).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, at: str, key: str, gap: str = "750 milliseconds", late: str = "10 seconds") -> DataFrame:
    """Session windows with a half-open gap: an event exactly one gap later begins a new session."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n"))


def merged_spans(spans: DataFrame, key: str = "target_id", gap_us: int = 0, idle_ms: int = 60_000) -> DataFrame:
    """Spans (key, start_us, end_us, arriving in order of start for each key) merged with a closed gap: one that starts
    exactly `gap_us` after the end joins. A span is given out when a later one cannot join it, or after idle time."""
    kind = spans.schema[key].dataType.simpleString()

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, open_ = [], state.get if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({key: [k[0]], "start_us": [open_[0]], "end_us": [open_[1]], "parts": [open_[2]]})
            return
        rows = sorted((int(r.start_us), int(r.end_us)) for pdf in batches for r in pdf.itertuples() if r.end_us > r.start_us)
        for s, e in rows:
            if open_ and s - open_[1] <= gap_us:
                open_ = (min(open_[0], s), max(open_[1], e), open_[2] + 1)
            else:
                if open_:
                    done.append(open_)
                open_ = (s, e, 1)
        if open_:
            state.update(open_)
            state.setTimeoutDuration(idle_ms)
        if done:
            yield pd.DataFrame({key: k[0], "start_us": [d[0] for d in done], "end_us": [d[1] for d in done], "parts": [d[2] for d in done]})

    return spans.groupBy(key).applyInPandasWithState(
        fold, f"{key} {kind}, start_us long, end_us long, parts long", "start_us long, end_us long, parts long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
