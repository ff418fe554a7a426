"""Sessions with own state: order does not matter within the delay, timers close them, a restart goes on."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from cairn.session import scratch_path
from cairn.streaming.replay import replay_files, run_to_end
from cairn.streaming.sessions import BUCKETS, _as_text, merge_sessions, sessions
from cairn.streaming.windows import write_arrivals
from frames import rows

DAY = datetime(2024, 1, 1)
SCHEMA = "batch int, user string, ts timestamp, value double"


def plain(times, gap):
    out = []
    for t, v in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1] = (out[-1][0], t, out[-1][2] + 1, out[-1][3] + v)
        else:
            out.append((t, t, 1, v))
    return out


@given(st.lists(st.tuples(st.integers(0, 60), st.just(1.0)), max_size=25), st.integers(0, 7), st.randoms())
@settings(max_examples=100, deadline=None)
def test_merging_in_any_order_gives_the_same_sessions(times, gap, rng):
    open_ = []
    shuffled = list(times)
    rng.shuffle(shuffled)
    while shuffled:
        part, shuffled = shuffled[:4], shuffled[4:]
        open_ = merge_sessions(open_, [(t, t, 1, v) for t, v in part], gap)
    assert open_ == plain(times, gap)


def test_sessions_over_arrivals_and_a_restart(spark):
    rng = random.Random(1)
    data = [(b, rng.choice(["a", "a", "b", None]), 10 * b + rng.randint(-9, 9), rng.choice([1.0, 2.0, None])) for b in range(6) for _ in range(25)]
    data += [(6, "late", 2, 1.0), (6, "flush", 500, 0.0)]  # one behind the watermark, one that moves it past everything
    df = spark.createDataFrame([(b, u, DAY + timedelta(hours=h), v) for b, u, h, v in data], SCHEMA)
    source, out, check = (scratch_path(spark, x) for x in ("t-sessions", "t-sessions-out", "t-sessions-check"))
    write_arrivals(df.where("batch < 6"), source, F.col("batch"))

    def run():
        stream = replay_files(spark, f"{source}/*", df.schema, fmt="parquet")
        q = run_to_end(sessions(stream, "user", "ts", "value", gap_seconds=2 * 3600, delay="20 hours"), "t_sessions", mode="append",
                       sink="table", path=out, checkpoint=check, state_partitions=2)
        return q

    run()
    before = spark.read.parquet(out).count()
    df.where("batch = 6").coalesce(1).write.parquet(f"{source}/arrival_99")
    q = run()
    want = []
    for user in ("a", "b", None):
        own = [(h * 3600, v or 0.0) for b, u, h, v in data if u == user and b < 6]
        want += [(user, s // 3600, e // 3600, n, t) for s, e, n, t in plain(own, 7200)]
    got = spark.read.parquet(out).select("user", *(
        ((F.unix_timestamp(c) - F.unix_timestamp(F.lit(DAY))) / 3600).cast("int").alias(c) for c in ("session_start", "session_end")),
        "count", "total")
    assert rows(got) == sorted(want, key=repr) and 0 < before < len(want)  # the late row and the open session are not there
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1  # all but the last arrival's session has left the state


def test_a_batch_has_as_many_groups_as_buckets_not_as_keys(spark):
    keys = [2 ** 60 + k for k in range(3 * BUCKETS)] + [None]  # a float would mix up neighbours
    data = [(0, k, (7 * i + 5 * j) % 40, 1.0 + j) for i, k in enumerate(keys) for j in range(3)] + [(1, -1, 500, 0.0)]
    df = spark.createDataFrame([(b, u, DAY + timedelta(hours=h), v) for b, u, h, v in data], "batch int, user long, ts timestamp, value double")
    for buckets in (BUCKETS, 1):
        source, out = (scratch_path(spark, x) for x in ("t-buckets", "t-buckets-out"))
        write_arrivals(df, source, F.col("batch"))
        q = run_to_end(sessions(replay_files(spark, f"{source}/*", df.schema, fmt="parquet"), "user", "ts", "value", gap_seconds=5 * 3600,
                                delay="1 day", buckets=buckets), f"t_buckets_{buckets}", mode="append", sink="table", path=out, state_partitions=2)
        groups = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        assert 0 < max(groups) <= buckets
        want = [(k, s, e, n, t) for k in keys for s, e, n, t in plain([(h, v) for _, u, h, v in data if u == k], 5)]
        got = spark.read.parquet(out).select("user", *(
            ((F.unix_timestamp(c) - F.unix_timestamp(F.lit(DAY))) / 3600).cast("int").alias(c) for c in ("session_start", "session_end")),
            "count", "total")
        assert rows(got) == sorted(want, key=repr)


def test_keys_come_back_from_their_text(spark):
    df = spark.sql("""SELECT * FROM VALUES (2L << 60, 'a', 0.1D, timestamp'2024-11-03 01:30:00.123456', date'2024-01-01', X'00FF', 1.50BD, true),
                      (NULL, '', double('Infinity'), NULL, NULL, X'', -2.25BD, NULL), (-1L, NULL, NULL, timestamp'1969-01-01 00:00:00.000001', NULL, NULL, NULL, false)
                      AS t(i, s, d, t, day, raw, n, b)""")
    texts = {f.name: _as_text(F.col(f.name), f.dataType) for f in df.schema}
    assert {t for _, t in df.select(*(text.alias(c) for c, (text, _) in texts.items())).dtypes} == {"string"}
    assert rows(df.select(*(back(text).alias(c) for c, (text, back) in texts.items()))) == rows(df)
    with pytest.raises(ValueError):
        _as_text(F.col("x"), ArrayType(LongType()))
