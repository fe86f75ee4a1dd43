"""Frames, seconds and time labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(column: str) -> Column:
    """Microseconds since 1970 of a timestamp without a zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({column} as timestamp_ntz))")


def frame_seconds(frame: Column, fps: Column) -> Column:
    """Seconds of a frame, null without a frame rate."""
    return F.when(fps > 0, frame / fps)


def clip_duration(start: Column, end: Column, fps: Column) -> Column:
    """Seconds of an inclusive range of frames."""
    return F.when(fps > 0, (end - start + 1) / fps)


def minute_label(seconds: Column) -> Column:
    """MMmSSs; minutes go beyond 60."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02dm%02ds", F.floor(s / 60).cast("long"), s % 60)


def clip_name(stem: Column, start_s: Column, end_s: Column) -> Column:
    return F.concat(stem, F.lit("_"), minute_label(start_s), F.lit("-"), minute_label(end_s), F.lit(".mp4"))


def elapsed_label(seconds: Column) -> Column:
    """1h 2m 3s, 2m 3s or 3s."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def frame_file(frame: Column) -> Column:
    return F.format_string("frame_%06d", frame)


def inferred_fps(fps: Column, start: Column, end: Column, start_s: Column, end_s: Column) -> Column:
    return F.coalesce(fps, F.try_divide(end - start, end_s - start_s))
