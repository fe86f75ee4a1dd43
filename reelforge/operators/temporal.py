"""Nearest rows and intervals in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nearest(probe: DataFrame, frames: DataFrame, keys: list[str], at: str, reach: int, probe_id: str, frame_id: str) -> DataFrame:
    """Per probe the frame nearest to it, at most reach away; the earlier one on ties.

    Both sides are dealt by keys and a bucket of width 2 * reach + 1; a frame is copied to the neighbouring buckets
    that its reach touches, so the join is an equi-join and never compares all frames of a key.
    """
    width = 2 * reach + 1
    p = probe.withColumn("_bucket", F.floor(F.col(at) / width)).withColumn("_at", F.col(at))
    f = frames.select(*keys, F.col(at).alias("_f"), frame_id).withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("_f") - reach) / width), F.floor((F.col("_f") + reach) / width))))
    near = p.join(f, [*keys, "_bucket"]).where(F.abs(F.col("_f") - F.col("_at")) <= reach)
    best = near.groupBy(*keys, probe_id).agg(F.min_by(F.struct(F.col(frame_id), F.col("_f").alias("frame_at")), F.struct(F.abs(F.col("_f") - F.col("_at")), F.col("_f"), F.col(frame_id))).alias("_b"))
    return best.select(*keys, probe_id, "_b.*")


def point_in_interval_bucketed(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, width: int) -> DataFrame:
    """Pairs with start <= at < end, over buckets of a width: an equi-join, and a key with very many intervals is dealt out."""
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    i = intervals.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    return p.join(i, [*keys, "_bucket"]).where((F.col(start) <= F.col(at)) & (F.col(at) < F.col(end))).drop("_bucket")


def first_match(pairs: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Of each key's pairs the one that starts first."""
    best = F.min_by(F.struct(*[c for c in pairs.columns if c not in keys]), start)
    return pairs.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def sessions(df: DataFrame, keys: list[str], at: str, gap: str) -> DataFrame:
    """Session windows over event time (an extension): start, last row and number of rows."""
    w = F.session_window(at, gap)
    return df.groupBy(*keys, w).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")).drop("session_window")
