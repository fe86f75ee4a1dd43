"""Mixing sources to target weights by repetition rates.

Tokens (words) are summed per source, each source gets a repetition rate target / total, and every document
is emitted floor(rate) times plus one more time with probability rate - floor(rate), drawn from a hash of
its id, so a rerun takes the same copies wherever its rows lie.

Defined cases: a null or empty text has size 0; words of very long texts are all counted; a null source is one source, ordered
last; sources with equal needs are taken by code point; a null doc_id draws as the text 'null'; repeated rows and rows with equal ids
draw alike; without any word all targets are 0; an empty table gives no row; columns of the input other than doc_id, text and
source are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelforge.llm.common import WORD, cut, small_or_dealt

WEIGHTS = (5, 2, 1)
MOST_SOURCES = 100_000


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_num: int = 3, share_den: int = 2, most: int = 2) -> DataFrame:
    """Rates of sources: sizes(source, size) to (source, source_size, target), one row a source.

    Sources by code point, null last, take the weights in turn and share share_num / share_den of all sizes;
    a target stops at most times its source and the excess is shared anew by weight. That fixed point is
    found in closed form: sorted by size / weight the sources that stop are a prefix. Integers are exact
    (decimals of 38 digits), the one division comes last. The window runs over one row a source.
    """
    unit = 1
    for w in weights:
        unit = unit * w // _gcd(unit, w)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by_need = Window.orderBy("need", F.col("source").isNull(), F.col("source"))
    d = "decimal(38,0)"
    t = (
        per.withColumn("weight", weight.cast("long"))
        .withColumn("need", F.col("source_size").cast(d) * (F.lit(unit) / F.col("weight")).cast("long"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("above", F.coalesce(F.sum("source_size").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("left", F.sum("weight").over(by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("pool", (F.col("total") * share_num - F.col("above") * (share_den * most)).cast(d))
    )
    # a source stops while most * size < weight * pool / (share_den * left)
    stops = F.col("source_size").cast(d) * F.lit(share_den * most) * F.col("left").cast(d) < F.col("weight").cast(d) * F.col("pool")
    t = t.withColumn("stops", stops)
    first = F.min(F.when(~F.col("stops"), F.struct(F.lit(0), F.col("need"), F.col("source").isNull(), F.col("source"), F.col("pool"), F.col("left")))).over(Window.partitionBy())
    t = t.withColumn("first", first)
    shared = (F.col("weight").cast(d) * F.col("first.pool")).cast("double") / (F.col("first.left") * share_den).cast("double")
    target = F.when(F.col("stops"), (F.col("source_size") * most).cast("double")).otherwise(shared)
    return t.select("source", "source_size", target.alias("target"))


def _gcd(a: int, b: int) -> int:
    while b:
        a, b = b, a % b
    return a


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """Adds to each document size, source_size, target and copies (how often the mix takes it)."""
    sized = docs.drop("source_size", "target", "copies", "_rate", "_source").withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    return take(sized, source_rates(sized.select("source", "size"), weights), seed)


def take(sized: DataFrame, rates: DataFrame, seed: str = "mix") -> DataFrame:
    """Joins rates to rows with a source and a size and draws copies.

    Up to MOST_SOURCES rates are broadcast, so no source, however hot, is gathered; beyond that the join deals rows out by source.
    """
    r = small_or_dealt(cut(rates.select(F.col("source").alias("_source"), "source_size", "target")), MOST_SOURCES)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 8), 16, 10).cast("long")
    whole = F.floor(F.col("_rate"))
    extra = draw.cast("double") < (F.col("_rate") - whole.cast("double")) * F.lit(4294967296.0)
    return (
        sized.join(r, sized["source"].eqNullSafe(r["_source"]), "left")
        .withColumn("_rate", rate)
        .withColumn("copies", whole.cast("long") + F.when(extra, 1).otherwise(0))
        .drop("_rate", "_source")
    )
