"""The stage graph as tables: dependencies, closure of skipped stages, gating by media."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Each stage with the stages it needs and the media it works on (empty: all).
STAGES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "download": ((), ()),
    "clips": (("download",), ("video",)),
    "audio_clips": (("clips",), ("video",)),
    "images": (("download",), ("image",)),
    "face_crops_video": (("clips",), ("video",)),
    "face_crops_image": (("images",), ("image",)),
    "transcribe_video": (("clips",), ("video",)),
    "transcribe_audio": (("download",), ("audio",)),
    "docs": (("download",), ("text",)),
    "quality": (("face_crops_video", "face_crops_image"), ("video", "image")),
    "filter": (("quality",), ("video", "image")),
    "frames": (("filter",), ("video",)),
    "masks": (("filter", "frames"), ("video", "image")),
}
MEDIA = ("audio", "image", "text", "video")
#: Stages that load models and so wait until what they need has ended.
DEFERRED = ("filter", "quality", "transcribe_video")


def edges(spark: SparkSession) -> DataFrame:
    """stage, needs."""
    return spark.createDataFrame([(s, n) for s, (needs, _) in STAGES.items() for n in needs], "stage string, needs string")


def media_of(spark: SparkSession) -> DataFrame:
    """stage, media; stages for all media stand with each."""
    return spark.createDataFrame([(s, m) for s, (_, media) in STAGES.items() for m in media or MEDIA], "stage string, media string")


def closure(spark: SparkSession, skipped: DataFrame) -> DataFrame:
    """Skipped stages and all that need them, directly or not: skipped(stage) to stage."""
    edges(spark).createOrReplaceTempView("_stage_edges")
    skipped.createOrReplaceTempView("_stage_skipped")
    return spark.sql(
        """WITH RECURSIVE gone(stage) AS (
             SELECT stage FROM _stage_skipped
             UNION ALL
             SELECT e.stage FROM gone g JOIN _stage_edges e ON e.needs = g.stage)
           SELECT DISTINCT stage FROM gone"""
    )


def enabled(spark: SparkSession, media_types: DataFrame) -> DataFrame:
    """media_set(name, media) to every stage with whether it runs for that set."""
    hit = media_of(spark).join(media_types, "media").select("name", "stage").distinct().withColumn("runs", F.lit(True))
    stages = spark.createDataFrame([(s,) for s in STAGES], "stage string")
    return media_types.select("name").distinct().join(F.broadcast(stages)).join(hit, ["name", "stage"], "left").select("name", "stage", F.coalesce("runs", F.lit(False)).alias("runs"))


def allowed_media(requested: list[str]) -> list[str]:
    """Known media of a request, video without any."""
    return sorted({m.strip().lower() for m in requested} & set(MEDIA)) or ["video"]


def known_media(requested: Column) -> Column:
    """allowed_media() of a list column."""
    named = F.array_sort(F.array_intersect(F.array(*map(F.lit, MEDIA)), F.transform(requested, lambda m: F.lower(F.trim(m)))))
    return F.when(F.coalesce(F.size(named), F.lit(0)) > 0, named).otherwise(F.array(F.lit("video")))


def strange_stages(requested: Column) -> Column:
    """unknown_stages() of a list column."""
    return F.array_sort(F.array_distinct(F.array_except(requested, F.array(*map(F.lit, STAGES)))))


def unknown_stages(requested: list[str]) -> list[str]:
    return sorted(set(requested) - set(STAGES))


def plan(media: list[str], skip: list[str] = (), only: str | None = None) -> list[str]:
    """Stages that run, in order: gated by media, without the skipped ones and those that need them all."""
    gone = set(skip)
    for s, (needs, _) in STAGES.items():
        if needs and any(n in gone for n in needs):
            gone.add(s)
    return [s for s, (_, m) in STAGES.items() if s not in gone and (not m or set(m) & set(media)) and (only is None or s == only)]
