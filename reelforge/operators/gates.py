"""Checks of tables: constraints, canonical digests, open schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def required(c: str) -> Column:
    return F.col(c).isNotNull()


def one_of(c: str, *values: str) -> Column:
    return F.col(c).isNull() | F.col(c).isin(*values)


def matching(c: str, pattern: str) -> Column:
    return F.col(c).isNull() | F.col(c).rlike(pattern)


def at_least(c: str, low: float) -> Column:
    return F.col(c).isNull() | (F.col(c) >= low)


def items_between(c: str, low: int, high: int) -> Column:
    return F.col(c).isNull() | F.size(c).between(low, high)


def exactly_one(*cols: str) -> Column:
    """oneOf: one of the alternatives is there."""
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0)) == 1


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds violations, the names of the rules that a row breaks."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("violations", broken)


def row_digest(*cols: str) -> Column:
    """SHA-256 of the row's canonical text: columns in order, null as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256)


def table_digest(df: DataFrame, *cols: str) -> DataFrame:
    """One row: number of rows and a digest that does not depend on their order.

    Rows are hashed where they lie and the first 60 bits of their digests are summed, so nothing is gathered or sorted.
    """
    part = F.conv(F.substring(row_digest(*cols), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(part).cast("string").alias("digest"))


def open_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null there, new ones stand on the right."""
    return a.unionByName(b, allowMissingColumns=True)
