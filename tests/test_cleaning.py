from pyspark.sql import Window
from pyspark.sql import functions as F

from cairn.operators.cleaning import dedupe_first, fill_missing, replace_token
from frames import rows


def test_fill_missing_keeps_types_and_only_fills_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, -1, "x"), (3, 5, None)], "id int, age int, tag string")
    out = fill_missing(df, {"age": -1, "tag": "NO"})
    assert dict(out.dtypes) == {"id": "int", "age": "int", "tag": "string"}
    assert rows(out) == [(1, -1, "NO"), (2, -1, "x"), (3, 5, "NO")]


def test_fill_missing_unknown_column_raises(spark):
    df = spark.createDataFrame([(1,)], "id int")
    try:
        fill_missing(df, {"nope": 0})
    except KeyError:
        return
    raise AssertionError("expected KeyError")


def test_replace_token_whole_value_does_not_touch_substrings(spark):
    df = spark.createDataFrame([("NA",), ("CANADA",), ("Gold",), (None,)], "medal string")
    whole = replace_token(df, "medal", "NA", "NO")
    sub = replace_token(df, "medal", "NA", "NO", whole=False)
    assert rows(whole) == rows(spark.createDataFrame([("NO",), ("CANADA",), ("Gold",), (None,)], "medal string"))
    assert ("CANODA",) in rows(sub)
    regex = replace_token(df, "medal", "^N.$", "NO", whole=False, regex=True)
    assert ("CANADA",) in rows(regex) and ("NO",) in rows(regex)


def _by_window(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*[F.col(n).asc() if a else F.col(n).desc() for n, a in order],
                                          *[F.col(c) for c in df.columns if c not in keys])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def test_dedupe_first_matches_row_number_and_is_partition_independent(spark):
    data = [(k % 7, k % 3, float(k % 5), f"s{k % 4}", k) for k in range(300)]
    df = spark.createDataFrame(data, "a int, b int, x double, s string, id int")
    for order in ([("x", True), ("s", True)], [("x", False), ("id", False)], [("x", False), ("s", True)],
                  [("s", False), ("x", True)]):
        expected = rows(_by_window(df, ["a", "b"], order))
        for parts in (1, 17):
            for strategy in ("window", "aggregate"):
                got = dedupe_first(df.repartition(parts), ["a", "b"], order, strategy=strategy)
                assert got.columns == df.columns
                assert rows(got) == expected, (order, strategy)


def test_dedupe_first_nulls_first_ascending_last_descending(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 2.0, 2), (1, 1.0, 3)], "k int, v double, id int")
    for strategy in ("window", "aggregate"):
        assert rows(dedupe_first(df, ["k"], ["v"], strategy=strategy), "id") == [(1,)]
        assert rows(dedupe_first(df, ["k"], [("v", False)], strategy=strategy), "id") == [(2,)]
        mixed = dedupe_first(df, ["k"], [("v", False), ("id", True)], strategy=strategy)
        assert rows(mixed, "id") == [(2,)]


def test_dedupe_first_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "k int, v int")
    plan = dedupe_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    # partial WindowGroupLimit (one row per key per map task) sits below the exchange
    partial = plan.index("WindowGroupLimit") if "Partial" in plan else -1
    assert partial >= 0 and plan.index("Exchange") < plan.rindex("Partial")
    agg_plan = dedupe_first(df, ["k"], ["v"], strategy="aggregate")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in agg_plan and "Aggregate" in agg_plan
    for strategy in ("window", "aggregate"):
        assert rows(dedupe_first(df, ["k"], ["v"], strategy=strategy).where("k = 0")) == [(0, 0)]


def test_dedupe_first_descending_strings_dates_mixed(spark):
    import datetime as dt

    data = [(1, "ab", dt.date(2020, 1, 2), True, 1), (1, "abc", dt.date(2020, 1, 1), False, 2),
            (1, None, dt.date(2021, 1, 1), None, 3), (1, "b", None, True, 4), (1, "", dt.date(2019, 1, 1), False, 5),
            (2, "é", dt.date(2020, 5, 5), True, 6), (2, "z", dt.date(2020, 5, 5), False, 7)]
    df = spark.createDataFrame(data, "k int, s string, d date, f boolean, id int")
    for order in ([("s", False), ("id", True)], [("d", False), ("id", True)], [("f", False), ("d", True)],
                  [("id", True), ("s", False)], [("d", True), ("s", False)]):
        want = rows(_by_window(df, ["k"], order))
        for strategy in ("window", "aggregate"):
            got = dedupe_first(df, ["k"], order, strategy=strategy)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert strategy == "window" or "Window" not in plan
            assert rows(got) == want, (order, strategy)
