"""Map columns: lookups, merges and fields set anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upserted(m: Column, key: Column, value: Column) -> Column:
    """The map with a field set anew or put in; a null key leaves it as it is."""
    others = F.map_filter(m, lambda k, _: k != key)
    return F.when(key.isNull(), m).otherwise(F.map_concat(others, F.create_map(key, value)))


def merged_by(df: DataFrame, keys: list[str], field: str, value: str, order: str) -> DataFrame:
    """One map a key: of each field the value that comes last in the order.

    Fields are reduced to their last value before any map is built, so a map holds distinct fields only.
    """
    last = df.groupBy(*keys, field).agg(F.max_by(value, order).alias("_v"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(field), F.col("_v")))).alias("merged"))
