"""Segments, streaks and gaps over ordered rows of a partition."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], order: list[str], breaks: Column, out: str = "island") -> DataFrame:
    """Numbers runs of rows; breaks says, over lagged values, where a run begins. The first row begins one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    return df.withColumn("_b", F.when(first | F.coalesce(breaks, F.lit(False)), 1).otherwise(0)).withColumn(out, F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_b")


def gap_before(keys: list[str], order: list[str], at: str) -> Column:
    """Distance to the row before."""
    return F.col(at) - F.lag(at).over(Window.partitionBy(*keys).orderBy(*order))


def merge_segments(df: DataFrame, keys: list[str], start: str, end: str, gap: float, tie: list[str] | None = None) -> DataFrame:
    """Segments with the number of the merged one they belong to: merged while start <= running end + gap."""
    w = Window.partitionBy(*keys).orderBy(start, end, *(tie or []))
    so_far = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return islands(df.withColumn("_so_far", so_far), keys, [start, end, *(tie or [])], F.col(start) > F.col("_so_far") + gap, "segment").drop("_so_far")


def split_long(df: DataFrame, start: str, end: str, step: Column, keep_tail: bool = True) -> DataFrame:
    """Inclusive ranges cut to at most step; without keep_tail a tail of one is lost, as a strict loop would have it."""
    last = F.col(end) if keep_tail else F.greatest(F.col(end) - 1, F.col(start))
    cut = df.withColumn("_step", F.greatest(step, F.lit(1))).withColumn("part_start", F.explode(F.sequence(F.col(start), last, F.col("_step"))))
    return cut.withColumn("part_end", F.least(F.col("part_start") + F.col("_step") - 1, F.col(end))).drop("_step")


def prorated(parts: DataFrame, start: str, end: str, counters: dict[str, int]) -> DataFrame:
    """Counters of split ranges shared out by the length of each part and rounded down, with a least value for each counter."""
    share = (F.col("part_end") - F.col("part_start") + 1).cast("double") / (F.col(end) - F.col(start) + 1)
    return parts.withColumns({c: F.greatest(F.lit(least).cast("long"), F.floor(F.col(c) * share)) for c, least in counters.items()})


def longest_streak(df: DataFrame, keys: list[str], order: list[str], holds: Column, out: str = "streak") -> DataFrame:
    """Per key the longest run of rows for which holds is true, 0 if there is none."""
    flagged = df.withColumn("_h", F.coalesce(holds, F.lit(False)))
    w = Window.partitionBy(*keys).orderBy(*order)
    runs = flagged.withColumn("_r", F.row_number().over(w) - F.row_number().over(Window.partitionBy(*keys, "_h").orderBy(*order)))
    return runs.groupBy(*keys, "_h", "_r").agg(F.count(F.lit(1)).alias("_n")).groupBy(*keys).agg(F.max(F.when(F.col("_h"), F.col("_n")).otherwise(F.lit(0))).cast("long").alias(out))


def gap_fill(df: DataFrame, keys: list[str], at: str, value: str, default: float) -> DataFrame:
    """One row for every step of the key's range; values are carried forward, before the first one stands default."""
    grid = df.groupBy(*keys).agg(F.min(at).alias("_a"), F.max(at).alias("_z")).select(*keys, F.explode(F.sequence("_a", "_z")).alias(at))
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(df.select(*keys, at, value), [*keys, at], "left").withColumn(value, F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit(default)))


def stride_sample(df: DataFrame, keys: list[str], order: list[str], stride: int, most: int, compat: bool = False) -> DataFrame:
    """Every stride-th row of a key, at most `most` of them (a sampling operator); compat keeps the first one only."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    hit = (F.col("_rn") % stride == 0) & (F.col("_rn") < stride * most)
    if compat and stride > 1:
        hit = F.col("_rn") == 0
    return df.withColumn("_rn", rn).where(hit).withColumn("sample", (F.col("_rn") / stride).cast("long")).drop("_rn")


def accepted_cuts(df: DataFrame, keys: list[str], at: str, signal: Column, cooldown: int) -> DataFrame:
    """Cut signals that come at least cooldown after the last accepted one.

    A signal that comes that long after the signal before it is accepted for certain, so a key's signals are first parted there; only
    what stands closer together is folded, in one array a part.
    """
    hits = islands(df.where(signal).select(*keys, F.col(at).cast("long").alias(at)), keys, [at], gap_before(keys, [at], at) >= cooldown, "_part")
    parts = hits.groupBy(*keys, "_part").agg(F.array_sort(F.collect_list(at)).alias("_at"))
    fold = F.aggregate(
        "_at", F.struct(F.lit(None).cast("bigint").alias("last"), F.expr("cast(array() as array<bigint>)").alias("kept")),
        lambda s, x: F.when(s["last"].isNull() | (x - s["last"] >= cooldown), F.struct(x.alias("last"), F.concat(s["kept"], F.array(x)).alias("kept"))).otherwise(s),
        lambda s: s["kept"],
    )
    return parts.select(*keys, F.explode(fold).alias(at))


def smoothing_window(fps: float, n: int) -> int:
    """Odd window of a quarter of a second, at least 5 and at most the number of frames."""
    w = max(int(0.25 * fps) | 1, 4)
    w += 1 - w % 2
    return min(w, n if n % 2 else n - 1)


def smoothing_weights(fps: float, widest: int | None = None, least: int = 5, order: int = 2) -> dict[tuple[int, int | None], list[tuple[int, float]]]:
    """Savitzky-Golay weights: by (rows of the series, place in it) the (offset, weight) of the values that make the smoothed one.

    A place counts from 0 at the beginning and from -1 backwards at the end, where the outermost window's polynomial holds; None is any
    other. A series of the widest window or more has the same weights whatever its length.
    """
    widest = widest or smoothing_window(fps, 1 << 30)
    out: dict[tuple[int, int | None], list[tuple[int, float]]] = {}
    for n in range(least, widest + 1):
        w = smoothing_window(fps, n)
        half, x = w // 2, np.arange(w) - w // 2
        powers = np.vander(x, order + 1, increasing=True).astype(float)
        fit = powers @ np.linalg.pinv(powers)  # the smoothed values of a window from its values
        for i in range(half):
            out[n, i] = [(j - i, float(fit[i, j])) for j in range(w)]
            out[n, -1 - i] = [(j - (w - 1 - i), float(fit[w - 1 - i, j])) for j in range(w)]
        out[n, None] = [(j - half, float(fit[half, j])) for j in range(w)]
    return out


def smooth(df: DataFrame, keys: list[str], order: str, values: list[str], fps: float, least: int = 5) -> DataFrame:
    """Smooths columns within a key to one decimal, as fixed sums over neighbouring rows; keys with fewer than `least` rows stay as they are."""
    w = Window.partitionBy(*keys).orderBy(order)
    weights = smoothing_weights(fps, least=least)
    widest = max(n for n, _ in weights)
    rows = df.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})

    def sums(c: str, terms: list[tuple[int, float]]) -> Column:
        total = None
        for o, weight in terms:
            v = F.lit(weight) * (F.col(c) if o == 0 else F.lag(c, -o).over(w) if o < 0 else F.lead(c, o).over(w))
            total = v if total is None else total + v
        return F.floor(total * 10 + 0.5) / 10

    for c in values:
        out = F.when(F.col("_n") < least, F.col(c).cast("double"))
        for (n, i), terms in weights.items():
            here = F.col("_n") >= n if n == widest else F.col("_n") == n
            if i is not None:
                here = here & (F.col("_i") == i if i >= 0 else F.col("_n") - F.col("_i") == -i)
            out = out.when(here, sums(c, terms))
        rows = rows.withColumn(f"_{c}", out)
    return rows.select(*[F.col(f"_{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def renumbered(df: DataFrame, keys: list[str], order: list[str], out: str = "frame") -> DataFrame:
    """Rows numbered anew from 0."""
    return df.withColumn(out, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))


def roll_up(df: DataFrame, keys: list[str], start: str, end: str, *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(start).alias("start"), F.max(end).alias("end"), *aggs)
