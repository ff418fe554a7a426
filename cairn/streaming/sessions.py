"""Sessions by a gap of inactivity, kept as own state in buckets of keys and closed by event-time timers.

A key's open sessions are starts, ends, numbers of rows and totals.  Rows may come out of order within the watermark's
delay, so a row can extend a session at either end, or join two.  A session is final once the watermark has passed its end
by the gap, for no row that could join it is accepted any more; a timer at that moment emits it, and it leaves the state.
What is kept of a key is therefore bounded by what happens within gap and delay.

A call of a Python state function costs far more than the few rows that a key has in a batch, so keys are dealt by hash
into buckets, and a bucket is one group of the stream: a batch makes as many calls as there are buckets, however many
keys there are.  A bucket's state is the open sessions of its keys, its timer the first of theirs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from cairn.session import ship_by_value

#: Keys and how many open sessions each has; then the sessions, key after key.
STATE = "keys array<string>, sizes array<int>, starts array<long>, ends array<long>, counts array<long>, totals array<double>"

#: Groups into which keys are dealt: the calls of a batch at most.
BUCKETS = 256


def merge_sessions(open_: list[tuple], rows: list[tuple], gap: int) -> list[tuple]:
    """Sessions (start, end, count, total) in order, of ``open_`` ones and single rows; a gap of exactly ``gap`` joins."""
    out: list[tuple] = []
    for start, end, count, total in sorted(open_ + rows):
        if out and start - out[-1][1] <= gap:
            a, b, n, t = out[-1]
            out[-1] = (a, max(b, end), n + count, t + total)
        else:
            out.append((start, end, count, total))
    return out


def _as_text(column: Column, kind: DataType) -> tuple[Column, Callable[[Column], Column]]:
    """``column`` as text that is equal where the values are, and the way back; pandas would make floats of whole numbers with nulls."""
    name = kind.typeName()
    if isinstance(kind, (ArrayType, MapType, StructType)):
        raise ValueError(f"a session's key is one plain value, not {kind.simpleString()}")
    if name == "timestamp":
        return F.unix_micros(column).cast("string"), lambda c: F.timestamp_micros(c.cast("long"))
    if name == "binary":
        return F.hex(column), F.unhex
    plain = column + F.lit(0.0) if name in ("float", "double") else column  # -0.0 is 0.0
    return plain.cast("string"), lambda c: c.cast(kind)


def sessions(stream: DataFrame, key: str, time_col: str, value: str, *, gap_seconds: int, delay: str,
             buckets: int = BUCKETS) -> DataFrame:
    """key, ``session_start``, ``session_end`` (times of the first and last row), ``count``, ``total``: each session once.

    Output mode is append: a session appears when it is closed.  Rows behind the watermark are dropped; rows without a
    time belong to no session, a missing value adds nothing to the total.  The null key is a key of its own.

    ``buckets`` is fixed for a checkpoint.  It bounds the tasks that can share a batch, and a bucket's open sessions are in
    memory together, so it should grow with the stream's rows; the sessions do not depend on it.
    """
    gap = gap_seconds * 1_000_000
    text, back = _as_text(F.col(key), stream.schema[key].dataType)
    given = (stream.withWatermark(time_col, delay).where(F.col(time_col).isNotNull())
             .select(text.alias("__key"), F.col(time_col), F.unix_micros(F.col(time_col)).alias("__t"),
                     F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("__v"))
             .withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets))))

    def run(name: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        open_: dict[str | None, list[tuple]] = {}
        if state.exists:
            keys, sizes, *columns = state.get
            each = zip(*columns)
            open_ = {k: list(islice(each, n)) for k, n in zip(keys, sizes)}
        if not state.hasTimedOut:
            for batch in batches:
                rows = defaultdict(list)
                for k, t, v in zip(batch["__key"].tolist(), batch["__t"].tolist(), batch["__v"].tolist()):
                    rows[k if isinstance(k, str) else None].append((t, t, 1, v))
                for k, own in rows.items():
                    open_[k] = merge_sessions(open_.get(k, []), own, gap)
        passed = state.getCurrentWatermarkMs() * 1000
        closed = [(k, *s) for k, own in open_.items() for s in own if s[1] + gap < passed]
        left = {k: kept for k, own in open_.items() if (kept := [s for s in own if s[1] + gap >= passed])}
        if left:
            state.update((list(left), [len(own) for own in left.values()],
                          *([*x] for x in zip(*(s for own in left.values() for s in own)))))
            first = min(own[0][1] for own in left.values())
            state.setTimeoutTimestamp(max((first + gap) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if closed:
            yield pd.DataFrame(closed, columns=["__key", "__start", "__end", "count", "total"])

    out = given.groupBy("__bucket").applyInPandasWithState(
        run, "__key string, __start long, __end long, count long, total double", STATE, "append", "EventTimeTimeout")
    return out.select(back(F.col("__key")).alias(key), F.timestamp_micros("__start").alias("session_start"),
                      F.timestamp_micros("__end").alias("session_end"), "count", "total")


ship_by_value(__name__)
