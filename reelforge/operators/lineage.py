"""Lineage joins. Lookup sides are reduced to one row a key first, so a probe never fans out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_last_wins(probe: DataFrame, log: DataFrame, probe_key: Column, log_key: Column, value: Column, order: Column, out: str, miss: str | None = None) -> DataFrame:
    """Adds to probe the value of the log's last row for its key; blank keys and values do not count."""
    last = log.where(log_key.isNotNull() & (log_key.cast("string") != "") & value.isNotNull()).groupBy(log_key.alias("_key")).agg(F.max_by(value, order).alias(out))
    found = probe.join(last, probe_key == last["_key"], "left").drop("_key")
    return found if miss is None else found.withColumn(out, F.coalesce(out, F.lit(miss)))


def polymorphic_parent(rows: DataFrame, kind: Column, parents: dict[str, tuple[DataFrame, Column, Column]], default: str, out: str) -> DataFrame:
    """Adds the parent's id from the table that the row's kind names; parents: kind to (table, its key, probe key)."""
    value = None
    for n, (name, (table, key, probe)) in enumerate(parents.items()):
        side = table.select(key.alias(f"_k{n}"), F.lit(True).alias(f"_f{n}")).distinct()
        rows = rows.join(side, probe == side[f"_k{n}"], "left")
        here = F.when(F.col(f"_f{n}"), F.col(f"_k{n}"))
        value = F.when(kind == name, here) if value is None else value.when(kind == name, here)
        if name == default:
            fallback = here
    return rows.withColumn(out, value.otherwise(fallback)).drop(*[f"_{c}{n}" for n in range(len(parents)) for c in "kf"])


def resume(wanted: DataFrame, done: DataFrame, on: list[str], overwrite: bool = False) -> DataFrame:
    """What is left to do; overwrite does all anew."""
    return wanted if overwrite else wanted.join(done.select(*on).distinct(), on, "left_anti")


def with_sibling(rows: DataFrame, siblings: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose required sibling exists."""
    return rows.join(siblings.select(*on).distinct(), on, "left_semi")


def star(rows: DataFrame, on: list[str], *optional: DataFrame) -> DataFrame:
    """Attaches optional siblings, one row each at most (the caller reduces them by key)."""
    return reduce(lambda a, b: a.join(b, on, "left"), optional, rows)


def refreshed(rows: DataFrame, current: DataFrame, on: list[str], column: str) -> DataFrame:
    """The column takes the current table's value where that has one; adds changed."""
    new = current.select(*on, F.col(column).alias("_new"))
    value = F.coalesce("_new", column)
    return rows.join(new, on, "left").withColumn("changed", ~value.eqNullSafe(F.col(column))).withColumn(column, value).drop("_new")


def broken_provenance(rows: DataFrame, pool: DataFrame, parent: str, key: str) -> DataFrame:
    """Rows whose parent is named but not in the pool."""
    return rows.where(F.col(parent).isNotNull()).join(pool.select(F.col(key).alias(parent)).distinct(), parent, "left_anti")


def chain(*links: tuple[DataFrame, str]) -> DataFrame:
    """Joins each table to the one before on the named column, inner."""
    (first, _), *rest = links
    return reduce(lambda a, b: a.join(b[0], b[1]), rest, first)


def golden_diff(baseline: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """Per key removed, added, drift or match."""
    a, b = baseline.select(key, F.col(digest).alias("_a")), current.select(key, F.col(digest).alias("_b"))
    status = F.when(F.col("_b").isNull(), "removed").when(F.col("_a").isNull(), "added").when(F.col("_a") != F.col("_b"), "drift").otherwise("match")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))
