"""Rules of progressive runs and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_steps(states: DataFrame, edges: DataFrame, deferred: Sequence[str]) -> DataFrame:
    """What each stage of a run does next: run, stage, next, deferred.

    states(run, stage, last_end, finished, failed) and edges(stage, needs). A stage without needs is finished after its run; it
    stops where something it needs has failed; it is finished when all it needs is and nothing of that ended later than
    its own last run; it runs again when something ended later; else it waits. Stages that load models are deferred until all they
    need is finished.
    """
    needed = states.select("run", F.col("stage").alias("needs"), "last_end", "finished", "failed")
    per = states.select("run", "stage").join(F.broadcast(edges), "stage").join(needed, ["run", "needs"])  # edges of thirteen stages
    per = per.groupBy("run", "stage").agg(F.bool_or("failed").alias("any_failed"), F.bool_and("finished").alias("all_finished"), F.max("last_end").alias("newest"))
    out = states.select("run", "stage", "last_end").join(per, ["run", "stage"], "left")
    step = (
        F.when(F.col("newest").isNull(), "finished").when(F.col("any_failed"), "deps_failed").when(F.col("all_finished") & (F.col("last_end") >= F.col("newest")), "finished")
        .when(F.col("newest") > F.col("last_end"), "rerun").otherwise("wait")
    )
    held = F.col("stage").isin(*deferred) & ~F.coalesce("all_finished", F.lit(True))
    return out.select("run", "stage", step.alias("next"), held.alias("deferred"))


def first_of_each(df: DataFrame, kind: str, most: Mapping[str, int], *order: str) -> DataFrame:
    """The first rows of each kind, as many as a report shows of it; Spark keeps no more of a kind a task than that."""
    place = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    limit: Column = F.lit(0)
    for k, n in most.items():
        limit = F.when(F.col(kind) == k, F.lit(n)).otherwise(limit)
    return df.withColumn("_k", place).where(F.col("_k") <= max(most.values())).where(F.col("_k") <= limit).drop("_k")
