"""Frames of uncompressed media: YUV4MPEG2 videos give one row a frame, netpbm images one row each.

Compressed media need a codec, which is not bundled; a decoder with the same rows can take this one's place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes a pixel of the chroma formats, in halves.
CHROMA_HALVES = {"mono": 2, "420": 3, "420jpeg": 3, "420mpeg2": 3, "420paldv": 3, "422": 4, "444": 6}
_NETPBM = re.compile(rb"P([56])\s+(\d+)\s+(\d+)\s+(\d+)\s")
_ROWS = "id long, frame long, width int, height int, seconds double, pixels binary"


def frames_of(media: bytes, start: int = 0, stride: int = 1) -> Iterator[tuple[int, int, int, float | None, bytes]]:
    """(frame, width, height, seconds, pixels) from frame start on, every stride-th one; ValueError for anything else."""
    if m := _NETPBM.match(media):
        if start == 0:
            yield 0, int(m[2]), int(m[3]), None, media[m.end() :]
        return
    head, _, _ = media.partition(b"\n")
    if not head.startswith(b"YUV4MPEG2"):
        raise ValueError("neither YUV4MPEG2 nor netpbm")
    fields = {p[:1].decode(): p[1:].decode() for p in head.split(b" ")[1:] if p}
    width, height = int(fields["W"]), int(fields["H"])
    rate, per = (int(x) for x in fields.get("F", "25:1").split(":"))
    size = width * height * CHROMA_HALVES[fields.get("C", "420")] // 2
    at, n = len(head) + 1, 0
    while at < len(media):
        at = media.index(b"\n", at) + 1
        if at + size > len(media):
            return  # a last frame that is cut short
        if n >= start and (n - start) % stride == 0:
            yield n, width, height, n * per / rate, media[at : at + size]
        at, n = at + size, n + 1


def read_frames(media: DataFrame, key: str, content: str, start: int = 0, stride: int = 1) -> DataFrame:
    """id, frame, width, height, seconds and pixels of every frame; media that cannot be read give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary())
        for b in batches:
            for at in range(b.num_rows):  # one medium at a time
                rows = []
                try:
                    rows = [(b.column(0)[at].as_py(), *f) for f in frames_of(b.column(1)[at].as_py() or b"", start, stride)]
                except (ValueError, KeyError):
                    pass
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in _ROWS.split(", ")])

    return media.select(F.col(key).cast("long").alias("id"), F.col(content).alias("content")).mapInArrow(run, _ROWS)
