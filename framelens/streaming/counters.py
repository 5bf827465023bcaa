"""Streaming counts over tracked detections with an event time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelens.functions.polygons import Points, contains


def windowed_region_counts(points: DataFrame, polygon: Points, window: str = "10 seconds", late: str = "30 seconds") -> DataFrame:
    """Detections strictly inside a region for each stream and event-time window, with a watermark for late ones."""
    inside = points.withWatermark("ts", late).where(contains(F.col("cx"), F.col("cy"), polygon))
    return inside.groupBy(F.window("ts", window), "stream").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "stream", "n")


def alarms(points: DataFrame, records: int) -> DataFrame:
    """One row for each stream, when a frame first has ``records`` detections; a stream's state is that it has fired."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        if state.exists:
            return
        counts = rows.groupby("frame").size()
        hit = counts[counts >= records]
        if len(hit):
            state.update((True,))
            yield pd.DataFrame({"stream": [key[0]], "frame": [int(hit.index.min())]})

    return points.select(F.col("stream").cast("long").alias("stream"), F.col("frame").cast("long").alias("frame")).groupBy("stream").applyInPandasWithState(run, "stream long, frame long", "fired boolean", "append", GroupStateTimeout.NoTimeout)


def newest_frames(batch: DataFrame) -> DataFrame:
    """Of a micro-batch the newest frame of each stream, for consumers that may skip."""
    newest = batch.groupBy("stream").agg(F.max("frame").alias("frame"))
    return batch.join(newest, ["stream", "frame"], "left_semi")
