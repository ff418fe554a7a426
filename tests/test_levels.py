"""Grouping sets, sketches and set operations against plain counting."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cairn.operators.levels import (compare_tables, cube_sets, distinct_sketches, grouping_levels, merged_distinct,
                                    rollup_sets, set_operation)
from frames import rows


def test_sets_of_cube_and_rollup():
    assert cube_sets(["a", "b"]) == [("a", "b"), ("a",), ("b",), ()]
    assert rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]


@pytest.mark.parametrize("sets", [cube_sets(["a", "b", "c"]), rollup_sets(["a", "b", "c"]), [("b",), ("a", "c"), ("b",)], [()]])
def test_levels_against_a_dictionary(spark, sets):
    rng = random.Random(1)
    data = [(rng.choice(["x", "x", "x", None]), rng.choice([1, 2, None]), rng.choice([True, False]), rng.choice([None, 1.0, 2.5])) for _ in range(300)]
    keys = list(dict.fromkeys(k for s in sets for k in s))
    held = defaultdict(list)
    for a, b, c, v in data:
        row = {"a": a, "b": b, "c": c}
        for s in {tuple(s) for s in sets}:
            level = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s)
            held[tuple(row[k] if k in s else None for k in keys) + (level,)].append(v)
    want = []
    for key, values in held.items():
        there = [v for v in values if v is not None]
        want.append((*key, len(values), len(there), sum(there) if there else None, sum(there) / len(there) if there else None,
                     min(there, default=None), max(there, default=None)))
    df = spark.createDataFrame(data, "a string, b int, c boolean, v double")
    assert rows(grouping_levels(df, sets, "v")) == sorted(want, key=repr)


def test_levels_scan_once_and_total_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id % 3 AS a", "id % 2 AS b", "double(id) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    plan = grouping_levels(df, cube_sets(["a", "b"]), "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows(grouping_levels(df.where("false"), cube_sets(["a", "b"]), "v")) == [(None, None, 3, 0, 0, None, None, None, None)]
    assert grouping_levels(df.where("false"), [("a",)], "v").count() == 0


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(60_000).selectExpr("id % 12 AS part", "id % 2 AS side", "cast(id % 20000 AS string) AS v")
    merged = merged_distinct(distinct_sketches(df, ["part", "side"], "v"), ["side"]).collect()
    assert len(merged) == 2
    for r in merged:
        assert r.n == 30_000 and abs(r.n_distinct - 10_000) <= r.error * 10_000 and r.error < 0.03
    none = merged_distinct(distinct_sketches(df.selectExpr("side", "cast(null AS string) AS v"), ["side"], "v"), ["side"]).collect()
    assert {(r.n_distinct, r.n) for r in none} == {(0, 0)}


def plain(a, b, kind, keep_all):
    x, y = Counter(a), Counter(b)
    if not keep_all:
        return sorted({"intersect": x.keys() & y.keys(), "except": x.keys() - y.keys(), "union": x.keys() | y.keys()}[kind], key=repr)
    return sorted({"intersect": x & y, "except": x - y, "union": x + y}[kind].elements(), key=repr)


@pytest.mark.parametrize("keep_all", [False, True])
@pytest.mark.parametrize("kind", ["intersect", "except", "union"])
def test_set_operations_against_counters(spark, kind, keep_all):
    rng = random.Random(2)
    some = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "", None])) for _ in range(n)]
    a, b = some(40) + [(9, "left")] * 3, some(30) + [(8, "right")] * 2
    left, right = (spark.createDataFrame(x, "n int, s string") for x in (a, b))
    got = set_operation(left, right.select("s", "n"), kind, keep_all)
    assert got.columns == ["n", "s"] and rows(got) == plain(a, b, kind, keep_all)
    assert rows(set_operation(left, right.where("false"), kind, keep_all)) == plain(a, [], kind, keep_all)


def test_counts_of_both_tables_and_an_unknown_operation(spark):
    left, right = spark.createDataFrame([(1,), (1,), (None,)], "n int"), spark.createDataFrame([(1,), (None,), (2,)], "n int")
    assert rows(compare_tables(left, right)) == sorted([(1, 2, 1), (None, 1, 1), (2, 0, 1)], key=repr)
    with pytest.raises(ValueError):
        set_operation(left, right, "minus")


def test_a_row_repeated_by_the_thousand(spark):
    left = spark.range(9_000).select((F.col("id") % 3).alias("k"))
    right = spark.range(300).select((F.col("id") % 3).alias("k"))
    assert set_operation(left, right, "except", keep_all=True).count() == 8_700
    assert set_operation(left, right, "intersect", keep_all=True).count() == 300
