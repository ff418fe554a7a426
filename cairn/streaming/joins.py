"""Two streams joined within a bounded time, and a stream without its repeats: state that the watermark bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_stream_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], times: tuple[str, str], within: str,
                        delays: tuple[str, str], how: str = "inner") -> DataFrame:
    """Pairs with equal keys whose right time is at most ``within`` after the left one (the same moment included).

    Both sides are buffered: a left row until the right watermark is past its time by ``within``, a right row until the
    left watermark is past it.  ``delays`` says how far each stream's rows may lag; rows behind it are dropped.  With
    ``how="left"`` a left row without a partner appears, with nulls, once none can come any more.  The tables' column
    names must differ.  Static frames join in the same way, and nothing is late there.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns in both streams: {sorted(clash)}")
    a, b = (F.col(t) for t in times)
    cond = (b >= a) & (b <= a + F.expr(f"interval {within}"))
    for x, y in on:
        cond = cond & (F.col(x) == F.col(y))
    return left.withWatermark(times[0], delays[0]).join(right.withWatermark(times[1], delays[1]), cond, how)


def stream_distinct(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """The first row to arrive of each combination of ``keys``; a repeat within ``delay`` of it is dropped.

    A combination is forgotten once the watermark has passed its first row's time by ``delay``, so the state does not
    grow with the stream.  Null keys are equal to each other.
    """
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))
