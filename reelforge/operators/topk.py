"""Best rows, budgets and interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelforge.sources.tables import reliable


def top_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in that order, by an aggregate that combines before the shuffle: no key's rows are gathered or sorted.

    Order columns rise, nulls first; numbers that are to fall are given negated.
    """
    cols = [c for c in df.columns if c not in keys]
    least = F.min_by(F.struct(*cols), F.struct(*[c.alias(f"_{k}") for k, c in enumerate(order)]))
    return df.groupBy(*keys).agg(least.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in cols])


def smallest(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of all (a top-k report)."""
    return df.orderBy(*order).limit(n)


def running_total(df: DataFrame, order: list[str], value: str, out: str = "running") -> DataFrame:
    """Exact running sum of a whole numbers column over all rows, without a single task for all.

    Rows are dealt by ranges of the order, each range is summed, and the sums before a range (one number a range)
    are added to the running sum in it.
    """
    ranged = reliable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("_range", before.alias("_before"))
    inner = F.sum(value).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(offsets, "_range").withColumn(out, (inner + F.col("_before")).cast("long")).drop("_range", "_before")


def budget_prefix(df: DataFrame, order: list[str], size: str, budget: int) -> DataFrame:
    """Rows in order while their sizes fit the budget together."""
    return running_total(df, order, size).where(F.col("running") <= budget)


def round_robin(df: DataFrame, kind: str, order: list[str]) -> DataFrame:
    """Adds turn, the row's number within its kind; sorting by (turn, kind) interleaves the kinds."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(kind).orderBy(*order)).cast("long"))
