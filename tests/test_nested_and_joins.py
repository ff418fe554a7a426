"""JSON columns with evidence, and joins and first rows of streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from cairn.session import scratch_path
from cairn.sources.nested import json_entries, parse_json
from cairn.streaming.joins import bounded_stream_join, stream_distinct
from cairn.streaming.replay import replay_files, run_to_end
from cairn.streaming.windows import write_arrivals
from frames import rows

DAY = datetime(2024, 1, 1)
SCHEMA = StructType([StructField("k", LongType()), StructField("tags", ArrayType(StringType())),
                     StructField("at", StructType([StructField("x", DoubleType())]))])


def test_json_is_typed_and_bad_text_is_kept(spark):
    good = ['{"k": 3, "tags": ["a", "b"], "at": {"x": 1.5}, "more": 1}', '{}', '{"k": null}', ' {"k": 4}', None]
    bad = ['{"k": "many", "at": {"x": 2}}', '{"k": 3', 'words', '[1, 2]', '7', '']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "id int, text string").withColumn("k", F.lit("own"))
    got = {r.id: r for r in parse_json(df, "text", SCHEMA, prefix="j_").collect()}
    assert len(got) == len(good + bad) and got[0].k == "own"
    assert (got[0].j_k, got[0].j_tags, got[0].j_at.x, got[0]._bad_json) == (3, ["a", "b"], 1.5, None)
    assert [(got[i].j_k, got[i]._bad_json) for i in (1, 2, 3, 4)] == [(None, None), (None, None), (4, None), (None, None)]
    for i in range(len(good), len(good + bad)):
        assert got[i]._bad_json == (good + bad)[i] and got[i].j_k is None
    assert got[len(good)].j_at is None or got[len(good)].j_at.x == 2.0
    assert parse_json(df.where("false"), "text", SCHEMA).count() == 0


def test_json_entries(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{}"), (3, None), (4, "oops")], "id int, text string")
    assert rows(json_entries(df, "text"), "id", "key", "value") == sorted(
        [(1, "a", "1"), (1, "b", "x"), (2, None, None), (3, None, None), (4, None, None)], key=repr)


def _arrive(spark, data, tag):
    df = spark.createDataFrame([(b, k, None if h is None else DAY + timedelta(hours=h), i) for b, k, h, i in data],
                               f"batch int, {tag}_k string, {tag}_ts timestamp, {tag}_id int")
    source = scratch_path(spark, f"t-join-{tag}")
    write_arrivals(df, source, F.col("batch"))
    schema = df.drop("batch").schema
    return df.drop("batch"), replay_files(spark, f"{source}/*", schema, fmt="parquet")


CLICKS = [(0, "u", 0, 1), (0, "v", 1, 2), (0, None, 1, 3), (1, "u", 5, 4), (2, "w", 60, 5), (3, "w", 200, 6)]
BUYS = [(0, "u", 2, 1), (0, "u", 3, 2), (1, "v", 4, 3), (1, None, 1, 4), (2, "u", 5, 5), (3, "x", 200, 6)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_stream_join_equals_the_static_join(spark, how):
    (a, left), (b, right) = _arrive(spark, CLICKS, "c"), _arrive(spark, BUYS, "b")
    options = dict(on=[("c_k", "b_k")], times=("c_ts", "b_ts"), within="3 hours", delays=("10 hours", "10 hours"), how=how)
    out = scratch_path(spark, "t-join-out")
    q = run_to_end(bounded_stream_join(left, right, **options), f"t_join_{how}", mode="append", sink="table", path=out, state_partitions=2)
    got = rows(spark.read.parquet(out), "c_id", "b_id")
    static = rows(bounded_stream_join(a, b, **options), "c_id", "b_id")
    pairs = [(1, 1), (1, 2), (2, 3), (4, 5)]
    assert [r for r in static if r[1] is not None] == sorted(pairs, key=repr)
    if how == "inner":
        assert got == static
    else:  # the last click is still waiting for a partner, and a null key never had one
        assert set(got) == set(static) - {(6, None)}
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert kept[-1] < len(CLICKS) + len(BUYS)
    with pytest.raises(ValueError):
        bounded_stream_join(left, left, **options)
    with pytest.raises(ValueError):
        bounded_stream_join(left, right, **{**options, "how": "outer"})


def test_repeats_are_dropped_and_forgotten(spark):
    data = [(0, "a", 0, 1), (0, "b", 1, 2), (0, None, 1, 3), (1, "a", 2, 4), (1, None, 3, 5), (2, "c", 100, 6), (3, "d", 101, 7), (4, "a", 102, 8)]
    _, stream = _arrive(spark, data, "e")
    out = scratch_path(spark, "t-distinct")
    q = run_to_end(stream_distinct(stream, ["e_k"], "e_ts", "10 hours"), "t_distinct", mode="append", sink="table", path=out,
                   state_partitions=2)
    got = rows(spark.read.parquet(out), "e_k")
    assert got == sorted([("a",), ("b",), (None,), ("c",), ("d",), ("a",)], key=repr)  # the second a is a new one by then
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
