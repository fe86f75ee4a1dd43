"""Pluggable inference: a scorer is loaded once per task and gets Arrow batches. Only deterministic stubs are bundled.

Each scorer's rows have a schema of their own; a model with the same rows can take its stub's place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from reelforge.sources.tables import bound_batches

PERSON_DETECTOR = "boxes array<array<double>>, scores array<double>"
POSE_ESTIMATOR = "keypoints array<array<double>>, keypoint_scores array<double>"
FACE_SCORER = "score double"
OFIQ_MEASURES = ("sharpness", "compression_artifacts", "expression_neutrality", "no_head_coverings", "face_occlusion_prevention", "unified_score")
FACE_QUALITY = ", ".join(f"{m} double" for m in OFIQ_MEASURES)
TRANSCRIBER = "transcription string, language string, segments array<struct<start:double,end:double,text:string>>"
DOCUMENT_EXTRACTOR = "text string, extraction_method string, page_count int, word_count bigint, char_count bigint"
N_KEYPOINTS = 133
#: Most media that a scorer gets at once: a row of results can be far larger than its medium.
SCORED_ROWS = 256


class Scorer(Protocol):
    """Turns a batch of media into a frame of results, one row a medium, in order."""

    def __call__(self, media: pd.Series) -> pd.DataFrame: ...


def score(df: DataFrame, make: Callable[[], Scorer], media: str, schema: str, keep: list[str]) -> DataFrame:
    """Applies make() (called once per task) to the media column; keep names the columns carried along.

    Adds error: null, or why the scorer failed on a medium, whose results are null then; the job goes on. What a task holds is bounded by
    the bytes of a batch of media and by SCORED_ROWS results, whatever the table's size.
    """
    bound_batches(df.sparkSession)

    def one(scorer: Scorer, medium) -> pd.DataFrame:
        try:
            return scorer(pd.Series([medium])).assign(error=None)
        except Exception as e:  # whatever a model raises is told in its row
            return pd.DataFrame([{"error": f"{type(e).__name__}: {e}"}])

    fields = StructType.fromDDL(schema).fieldNames()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make()
        for pdf in (p.iloc[at : at + SCORED_ROWS] for p in parts for at in range(0, len(p), SCORED_ROWS)):
            try:
                out = scorer(pdf[media]).reset_index(drop=True).assign(error=None)
            except Exception:  # some medium of the batch: each by itself
                out = pd.concat([one(scorer, m) for m in pdf[media]], ignore_index=True)
            yield pd.concat([pdf[keep].reset_index(drop=True), out], axis=1).reindex(columns=[*keep, *fields, "error"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*dict.fromkeys([*keep, media])).mapInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keep), schema, "error string"]))


def _digest(medium: bytes, salt: str = "") -> int:
    """The first 32 bits of a SHA-256, from which the stubs draw; nothing is learned from it."""
    return int(hashlib.sha256(salt.encode() + bytes(medium)).hexdigest()[:8], 16)


class StubPersonDetector:
    """Up to three boxes an image, with scores."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        h = [_digest(m) for m in media]
        boxes = [[[float(x % 500 + 10 * k), float(x % 300), float(x % 500 + 10 * k + 40), float(x % 300 + 90)] for k in range(x % 4)] for x in h]
        return pd.DataFrame({"boxes": boxes, "scores": [[(x + k) % 1000 / 1000 for k in range(x % 4)] for x in h]})


class StubPoseEstimator:
    """All whole-body keypoints and their scores."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        h = [_digest(m) for m in media]
        points = [[[float((x + 37 * k) % 1000), float((x + 53 * k) % 1000)] for k in range(N_KEYPOINTS)] for x in h]
        return pd.DataFrame({"keypoints": points, "keypoint_scores": [[(x + k) % 100 / 100 for k in range(N_KEYPOINTS)] for x in h]})


class StubFaceScorer:
    """A face score in 0..100."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"score": [_digest(m) % 10_001 / 100 for m in media]})


class StubFaceQuality:
    """Six measures of a face in 0..100."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({m: [float(_digest(x, m) % 101) for x in media] for m in OFIQ_MEASURES})


class StubTranscriber:
    """The medium's own text, if it is any, as one segment; empty where there is none."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        texts = [bytes(m).decode("utf-8", "replace") for m in media]
        segments = [[{"start": 0.0, "end": len(t) / 16, "text": t[:40]}] if t else [] for t in texts]
        return pd.DataFrame({"transcription": [t[:40] for t in texts], "language": ["und" if t else "" for t in texts], "segments": segments})


class StubDocumentExtractor:
    """Plain text as it is, counted; a page has 2,000 characters."""

    def __call__(self, media: pd.Series) -> pd.DataFrame:
        texts = [bytes(m).decode("utf-8", "replace") for m in media]
        pages = [max(1, -(-len(t) // 2000)) for t in texts]
        return pd.DataFrame({"text": texts, "extraction_method": "native", "page_count": pages, "word_count": [len(t.split()) for t in texts], "char_count": [len(t) for t in texts]})
