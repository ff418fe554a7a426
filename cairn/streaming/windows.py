"""Totals by event time: tumbling and sliding windows whose state a watermark evicts.

A window's running totals stay in the state store only until the watermark (the greatest event time of earlier
batches, less the allowed delay) passes its end, so the state is bounded by the delay and not by the length of the
stream.  The rule for late rows is Spark's: the watermark that a batch's rows have settled closes windows at the end of
the next batch, and from the one after that on their late rows are dropped; all others count.  A batch's own rows never
decide about itself, so the result follows from the batches and not from the order of rows in them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_totals(stream: DataFrame, time_col: str, width: str, keys: Sequence[str], value: str, *, delay: str,
                    slide: str | None = None) -> DataFrame:
    """``window_start``, ``window_end``, keys, ``total``, ``count`` (rows) and ``count_values`` by event-time window.

    ``width`` and ``slide`` are durations such as ``"6 hours"``; without ``slide`` the windows tumble, with it a row is
    in ``width / slide`` of them.  ``delay`` is how far a row may lag behind the latest event time seen.  Works on a
    static frame too, where nothing is late.

    Output mode ``append`` emits a window once, when it is closed; ``update`` emits it whenever it changes, which
    :func:`cairn.streaming.replay.read_latest` reduces to the newest values, open windows included.  Rows without an
    event time are in no window.
    """
    window = F.window(F.col(time_col), width, slide) if slide else F.window(F.col(time_col), width)
    totals = stream.withWatermark(time_col, delay).groupBy(window.alias("__w"), *keys).agg(
        F.sum(value).alias("total"), F.count(F.lit(1)).alias("count"), F.count(value).alias("count_values"))
    return totals.select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys,
                         "total", "count", "count_values")


def write_arrivals(df: DataFrame, path: str, batch: Column, files: int = 1, most: int = 1000) -> int:
    """Write ``df`` as the batches in which its rows arrive, in ascending order of ``batch``; returns their number.

    Each batch is a job and a folder of ``files`` files below ``path``, so file times order the batches, and a replay of
    ``files`` files per trigger over ``path/*`` takes one batch at a time.  The source is scanned once per batch: this
    is for replays of at most ``most`` batches.
    """
    marked = df.withColumn("__batch", batch)
    batches = sorted(r[0] for r in marked.select("__batch").where("__batch is not null").distinct().limit(most + 1).collect())
    if len(batches) > most:
        raise ValueError(f"more than {most} batches")
    for k, value in enumerate(batches):
        (marked.where(F.col("__batch") == F.lit(value)).drop("__batch").repartition(files)
         .write.parquet(f"{path.rstrip('/')}/arrival_{k:05d}"))
    return len(batches)
