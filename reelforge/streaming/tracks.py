"""Tracks over streams of detections: the tracker is the state of a scene, so a scene goes on from micro-batch to micro-batch."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reelforge.operators.kernels import Tracker, in_order


def stream_tracks(detections: DataFrame, scene: str, frame: str, box: list[str], make: Callable[[], Tracker] = Tracker) -> DataFrame:
    """scene, frame, box columns and track_id (null while a track is too young) of detections as they arrive.

    A scene's frames must arrive in their order over micro-batches, as a file source gives them; within one they are sorted. Frames that a
    scene has passed already are dropped. The state is the tracker, whose tracks end when they are lost, and the last frame; it has no
    timeout, as one by the clock would keep an availableNow run from ending.
    """

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracker, last = (pickle.loads(state.get[0]), state.get[1]) if state.exists else (make(), None)
        pdf = in_order(pd.concat(list(parts)), frame, box)
        if last is not None:
            pdf = pdf[pdf[frame] > last].reset_index(drop=True)
        ids = tracker.follow(pdf[frame].to_numpy(), pdf[box].to_numpy(float))
        last = int(known.max()) if len(known := pdf[frame].dropna()) else last
        state.update((pickle.dumps(tracker), last))
        yield pdf[[scene, frame, *box]].assign(track_id=pd.arrays.IntegerArray(ids, ids < 0))

    kinds = dict(detections.dtypes)
    out = ", ".join([*(f"{c} {kinds[c]}" for c in (scene, frame, *box)), "track_id long"])
    return detections.select(scene, frame, *box).groupBy(scene).applyInPandasWithState(run, out, "tracker binary, last long", "append", GroupStateTimeout.NoTimeout)
