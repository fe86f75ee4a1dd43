"""Segments over streams of frames.

Frames arrive as files; the watermark is the longest gap that may still be merged, so a segment that leaves can no longer
grow. With the availableNow trigger a stage processes what is new since its checkpoint and ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_frames(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def session_segments(frames: DataFrame, keys: list[str], at: str, gap: str, lateness: str) -> DataFrame:
    """Segments as session windows: rows of a key no further apart than gap."""
    w = F.session_window(at, gap)
    return frames.withWatermark(at, lateness).groupBy(*keys, w).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")).drop("session_window")


def stateful_segments(frames: DataFrame, key: str, at: str, gap_seconds: int, lateness: str) -> DataFrame:
    """The same with state of our own: key, first_at, last_at, n as soon as the watermark has passed the gap.

    State is one open segment a key; rows of a batch are sorted first, late rows beyond the watermark do not arrive.
    """
    gap = pd.Timedelta(seconds=gap_seconds)

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        first, last, n = (pd.Timestamp(state.get[0]), pd.Timestamp(state.get[1]), state.get[2]) if state.exists else (None, None, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({key: [group[0]], "first_at": [first], "last_at": [last], "n": [n]})
            return
        for t in pd.concat([p[at] for p in parts]).sort_values():
            if n and t - last > gap:
                out.append((group[0], first, last, n))
                n = 0
            first, last, n = (t if n == 0 else min(first, t)), (t if n == 0 else max(last, t)), n + 1
        state.update((first.to_pydatetime(), last.to_pydatetime(), n))
        ends = int((last + gap).timestamp() * 1000) + 1
        state.setTimeoutTimestamp(max(ends, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[key, "first_at", "last_at", "n"])

    kind = dict(frames.dtypes)[key]
    return frames.withWatermark(at, lateness).groupBy(key).applyInPandasWithState(
        run, f"{key} {kind}, first_at timestamp, last_at timestamp, n long", "first_at timestamp, last_at timestamp, n long", "append", GroupStateTimeout.EventTimeTimeout
    )


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes what is there, appends to Parquet and ends."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
