"""Summaries of logs and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelforge.sources.tables import reliable

PERCENTS = (10, 50, 90)


def cents(c: Column, digits: int = 4) -> Column:
    """A double as a decimal, so that sums do not depend on the order of rows."""
    return c.cast(f"decimal(28,{digits})")


def exact_sum(c: Column, digits: int = 4) -> Column:
    return F.sum(cents(c, digits)).cast("double")


def exact_mean(c: Column, digits: int = 4) -> Column:
    """Mean over non-null values."""
    return F.sum(cents(c, digits)).cast("double") / F.count(c)


def mean_over_all_rows(c: Column, digits: int = 4) -> Column:
    """Sum of what is there over all rows, also those without a value."""
    return F.coalesce(F.sum(cents(c, digits)).cast("double"), F.lit(0.0)) / F.count(F.lit(1))


def pct_stats(value: Column, prefix: str = "") -> list[Column]:
    """Largest, mean and exact, linearly interpolated percentiles."""
    at = F.percentile(value, F.array(*[F.lit(p / 100) for p in PERCENTS]))
    return [F.max(value).alias(f"{prefix}max"), exact_mean(value).alias(f"{prefix}mean"), *[at[i].alias(f"{prefix}p{p}") for i, p in enumerate(PERCENTS)]]


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def with_total(df: DataFrame, key: str, *aggs: Column, total: str = "TOTAL") -> DataFrame:
    """Per key and over all, the latter under the name total."""
    return df.rollup(key).agg(F.grouping(key).alias("_g"), *aggs).withColumn(key, F.when(F.col("_g") == 1, F.lit(total)).otherwise(F.col(key))).drop("_g")


def volume_check(baseline: DataFrame, current: DataFrame, low: float = 0.25, high: float = 4.0) -> DataFrame:
    """One row: counts of both, their ratio and whether it is in bounds."""
    a, b = baseline.agg(F.count(F.lit(1)).alias("n_baseline")), current.agg(F.count(F.lit(1)).alias("n_current"))
    ratio = F.try_divide(F.col("n_current").cast("double"), F.col("n_baseline").cast("double"))
    return a.join(b).select("n_baseline", "n_current", ratio.alias("ratio"), F.coalesce(ratio.between(low, high), F.lit(False)).alias("in_bounds"))


def best_detection(df: DataFrame, keys: list[str], score: Column, position: Column, *values: Column) -> DataFrame:
    """The detection of the highest score, missing scores counting as 0; the first one on ties."""
    best = F.min_by(F.struct(*values), F.struct(-F.coalesce(score, F.lit(0.0)), position))
    return df.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def count_and_mean(df: DataFrame, value: str) -> DataFrame:
    """One row: n and share, the mean, 0 without any row."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(exact_mean(F.col(value)), F.lit(0.0)).alias("share"))


def transcription_totals(df: DataFrame) -> DataFrame:
    """Per language: n, n_words and seconds of transcriptions(language, word_count, duration_seconds)."""
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.sum("word_count").cast("long").alias("n_words"), exact_sum(F.col("duration_seconds")).alias("seconds"))


def detection_totals(df: DataFrame, keys: list[str], persons: str, confidence: str) -> DataFrame:
    """n, persons and mean confidence."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(persons).cast("long").alias("persons"), F.round(exact_mean(F.col(confidence)), 4).alias("confidence"))


def ranged_percentiles(df: DataFrame, key: str, value: str, shares: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated percentiles of few keys with very many rows each: key and an array in the order of shares.

    Rows are dealt by ranges of (key, value), counted range by range, and only those at the ranks that are asked for
    are looked up, so no key's values are held or sorted in one task. Nulls are left out.
    """
    rows = df.select(key, value).where(F.col(value).isNotNull())
    ranged = reliable(rows.repartitionByRange(key, value).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))  # one row a key and range
    before = Window.partitionBy(key).orderBy("_range")
    offsets = counts.select(key, "_range", (F.sum("_n").over(before) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(key)).alias("_all"))
    asked = F.array(*[F.struct(F.lit(k).alias("k"), ((F.col("_all") - 1) * F.lit(float(s))).alias("at")) for k, s in enumerate(shares)])
    inner = F.row_number().over(Window.partitionBy("_range", key).orderBy(value)) - 1
    ranks = ranged.withColumn("_inner", inner).join(F.broadcast(offsets), [key, "_range"]).withColumn("_rank", F.col("_inner") + F.col("_before")).withColumn("_asked", asked)
    near = ranks.where(F.exists("_asked", lambda a: (F.floor(a["at"]) == F.col("_rank")) | (F.ceil(a["at"]) == F.col("_rank"))))
    found = near.groupBy(key).agg(F.first("_asked").alias("_asked"), F.map_from_entries(F.collect_list(F.struct("_rank", value))).alias("_at"))  # two rows a share at most

    def point(a: Column) -> Column:
        low, high = (F.element_at("_at", f(a["at"]).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (a["at"] - F.floor(a["at"]))

    return found.select(key, F.transform("_asked", point).alias("percentiles"))
