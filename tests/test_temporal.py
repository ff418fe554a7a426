"""As-of joins, interval joins and window frames against plain loops, and on keys that hold most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cairn.operators.prefix import grouped_carry
from cairn.operators.temporal import as_of_join, frame, interval_join
from frames import rows


def test_carry_over_partitions(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), k, rng.choice([None, None, None, k])) for k in range(400)] + [("c", k, None) for k in range(30)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    got = {(r.g, r.o): r.carried for r in grouped_carry(df, ["o"], "v", group=["g"], width=13).collect()}
    last = {}
    for g, o, v in sorted(data, key=lambda r: r[1]):
        last[g] = v if v is not None else last.get(g)
        assert got[g, o] == last[g]
    whole = {r.o: r.carried for r in grouped_carry(df.where("g = 'c'"), ["o"], "v", width=5).collect()}
    assert set(whole.values()) == {None} and len(whole) == 30


def plain_as_of(left, right, strict=False, within=None):
    out = []
    for i, k, t in left:
        fine = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None
                and (r[1] < t if strict else r[1] <= t)]
        best = max(fine, key=lambda r: (r[1], r[2]), default=None)
        if best and within is not None and t - best[1] > within:
            best = None
        out.append((i, best[2] if best else None))
    return sorted(out)


@pytest.mark.parametrize("strict, within", [(False, None), (True, None), (False, 5), (True, 3)])
def test_as_of_join_against_a_loop(spark, strict, within):
    rng = random.Random(2)
    key = lambda: rng.choice(["hot"] * 6 + ["x", "y", None])
    left = [(i, key(), rng.choice([None, *range(60)])) for i in range(300)]
    right = [(key(), rng.choice([None, *range(60)]), i) for i in range(120)]
    df = as_of_join(spark.createDataFrame(left, "i long, k string, t long"), spark.createDataFrame(right, "k string, t long, v long"),
                    on=[("k", "k")], times=("t", "t"), take=["v"], tie=["v"], strict=strict,
                    within=F.lit(within) if within is not None else None, prefix="r_")
    assert df.columns == ["i", "k", "t", "r_v"]
    assert rows(df, "i", "r_v") == sorted(plain_as_of(left, right, strict, within), key=repr)


def test_as_of_join_keeps_left_rows_once_and_takes_nulls(spark):
    left = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (None, 5), (1, None)], "k long, t long")
    right = spark.createDataFrame([(1, 4, None), (1, 3, "old"), (None, 1, "none")], "k long, at long, v string")
    got = as_of_join(left, right, on=[("k", "k")], times=("t", "at"), take=["v"])
    assert rows(got, "k", "t", "v") == sorted([(1, 5, None)] * 2 + [(2, 5, None), (None, 5, None), (1, None, None)], key=repr)
    assert as_of_join(left.where("false"), right, on=[("k", "k")], times=("t", "at"), take=["v"]).count() == 0
    assert rows(as_of_join(left, right.where("false"), on=[("k", "k")], times=("t", "at"), take=["v"]), "v") == [(None,)] * 5


def test_as_of_join_spreads_a_hot_key(spark):
    left = spark.range(40_000).selectExpr("1L AS k", "id AS t")
    right = spark.range(0, 40_000, 7).selectExpr("1L AS k", "id AS t", "id AS v")
    got = as_of_join(left, right, on=[("k", "k")], times=("t", "t"), take=["v"])
    assert got.where("v = t - t % 7").count() == 40_000
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 25_000


def plain_interval(points, spans):
    return sorted((p, s) for p, a, k in points for s, low, high, q in spans
                  if None not in (a, low, high) and k == q and k is not None and low <= a <= high)


def test_interval_join_against_a_loop(spark):
    rng = random.Random(3)
    points = [(i, rng.choice([None, rng.randint(-2_000, 2_000), -(2 ** 40), 2 ** 40]), rng.choice(["a", "b", None])) for i in range(250)]
    spans = []
    for i in range(200):
        low = rng.randint(-2_500, 2_000)
        spans.append((i, rng.choice([low, None] + [low] * 9), low + rng.choice([-1, 0, 1, 2, 3, 7, 8, 63, 64, 1_000, 2 ** 41]), rng.choice(["a", "b", None])))
    spans += [(900, -(2 ** 62), 2 ** 62 - 1, "a"), (901, 5, 5, "b")]
    df = interval_join(spark.createDataFrame(points, "p long, at long, k string"),
                       spark.createDataFrame(spans, "s long, low long, high long, q string"), "at", ("low", "high"), on=[("k", "q")])
    assert rows(df, "p", "s") == sorted(plain_interval(points, spans), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("keyed", [True, False])
def test_interval_join_deals_out_crowded_buckets(spark, monkeypatch, keyed):
    from cairn.operators import temporal

    monkeypatch.setattr(temporal, "PAIRS_A_ROW", 0)
    monkeypatch.setattr(temporal, "PAIRS_A_TASK", 500)
    rng = random.Random(5)
    points = [(i, rng.choice([None, *[rng.randint(0, 1_000)] * 9]), rng.choice(["a", "b", None])) for i in range(400)]
    spans = [(i, low, low + rng.choice([-1, 0, 3, 60, 60, 60, 500]), rng.choice(["a", "b", None])) for i, low in
             ((i, rng.choice([None, *[rng.randint(-100, 1_000)] * 9])) for i in range(300)) if low is not None] * 2
    df = interval_join(spark.createDataFrame(points, "p long, at long, k string"),
                       spark.createDataFrame(spans, "s long, low long, high long, q string"), "at", ("low", "high"),
                       on=[("k", "q")] if keyed else [])
    plain = plain_interval(points, spans) if keyed else plain_interval(
        [(p, a, 0) for p, a, _ in points], [(s, low, high, 0) for s, low, high, _ in spans])
    assert rows(df, "p", "s") == sorted(plain, key=repr)
    by_task = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) > 16 and max(by_task) < len(plain) / 4  # four tasks before, however many pairs


def test_interval_join_of_times_without_keys(spark):
    day = datetime(2024, 1, 1)
    points = spark.createDataFrame([(k, day + timedelta(hours=k)) for k in range(100)], "p long, at timestamp")
    spans = spark.createDataFrame([(k, day + timedelta(hours=10 * k), day + timedelta(hours=10 * k + 3)) for k in range(10)],
                                  "s long, b timestamp, e timestamp")
    assert rows(interval_join(points, spans, "at", ("b", "e")), "p", "s") == sorted(
        [(10 * k + h, k) for k in range(10) for h in range(4)], key=repr)
    assert interval_join(points, spans.where("false"), "at", ("b", "e")).count() == 0
    with pytest.raises(ValueError):
        interval_join(points, spans.withColumnRenamed("s", "p"), "at", ("b", "e"))


def test_frames_equal_plain_windows(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a"] * 5 + ["b", None]), k, rng.choice([None, rng.random()])) for k in range(700)]
    df = spark.createDataFrame(data, "g string, o long, v double").repartition(5)
    compute = lambda w: {"lag3": F.lag("v", 3).over(w), "lead2": F.lead("o", 2).over(w),
                         "s": F.count("v").over(w.rowsBetween(-3, 2)), "m": F.max("v").over(w.rowsBetween(-2, 0))}
    from pyspark.sql import Window

    plain = df.select("*", *(c.alias(n) for n, c in compute(Window.partitionBy("g").orderBy("o")).items()))
    for block in (3, 10, 65_536):
        assert rows(frame(df, ["g"], ["o"], (3, 2), compute, block=block)) == rows(plain)
    assert rows(frame(df, ["g"], ["o"], (3, 0), lambda w: {"lag3": F.lag("v", 3).over(w)}, block=4)) == rows(plain.select("g", "o", "v", "lag3"))
    assert frame(df.where("false"), ["g"], ["o"], (3, 2), compute).count() == 0
    with pytest.raises(ValueError):
        frame(df, ["g"], ["o"], (5, 0), compute, block=4)
