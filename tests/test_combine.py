import pytest

from cairn.operators.combine import append_rows, broadcast_if_small, lookup_enrich, null_safe_join, outer_merge
from frames import rows


def _sides(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 99)], "k int, gold bigint")
    b = spark.createDataFrame([(2, 5), (3, 6), (None, 98)], "k int, silver bigint")
    c = spark.createDataFrame([(3, 1), (4, 2)], "k int, bronze bigint")
    return a, b, c


def test_outer_merge_union_equals_chained_full_joins(spark):
    a, b, c = _sides(spark)
    union = outer_merge([a, b, c], ["k"], fill=0, strategy="union")
    joined = outer_merge([a, b, c], ["k"], fill=0, strategy="join")
    assert rows(union) == rows(joined)
    # key in one, two, three sides; null keys never matched across inputs
    assert rows(union) == sorted([(1, 10, 0, 0), (2, 20, 5, 0), (3, 0, 6, 1), (4, 0, 0, 2), (None, 99, 0, 0),
                                  (None, 0, 98, 0)], key=repr)


def test_outer_merge_rejects_shared_value_columns(spark):
    a, b, _ = _sides(spark)
    try:
        outer_merge([a, b.withColumnRenamed("silver", "gold")], ["k"])
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_lookup_enrich_dedupes_dimension_before_join_and_fills_default(spark):
    facts = spark.createDataFrame([(1, "Serbia"), (2, "Russia"), (3, "Atlantis"), (4, "Nowhere"), (5, None)],
                                  "id int, team string")
    dim = spark.createDataFrame([("Serbia", "SRB"), ("Serbia", "SCG"), ("Russia", "RUS"), (None, "XXX")],
                                "team string, noc string")
    out = lookup_enrich(facts, dim, on="team", take="noc", default="UNK")
    assert out.count() == 5  # no fan-out from the duplicated name
    assert rows(out, "id", "noc") == [(1, "SCG"), (2, "RUS"), (3, "UNK"), (4, "UNK"), (5, "UNK")]


def test_broadcast_if_small_only_marks_proven_small(spark):
    small = spark.range(10)
    big = spark.range(1000)
    logical = lambda df: str(df._jdf.queryExecution().logical()).lower()
    assert "broadcast" in logical(small.join(broadcast_if_small(small, 1000), "id"))
    assert broadcast_if_small(big, 1000) is big
    # few rows of long text are not small
    wide = spark.range(3).selectExpr("id", "repeat('x', 5000) AS t")
    assert broadcast_if_small(wide, 1000) is wide


def test_merge_loses_no_row_of_a_repeated_key(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (2, 5)], "k int, x int")
    b = spark.createDataFrame([(1, 7)], "k int, y int")
    assert rows(outer_merge([a, b], ["k"])) == [(1, 10, 7), (1, 20, 7), (2, 5, None)]
    with pytest.raises(Exception, match="repeats a key"):
        outer_merge([a, b], ["k"], strategy="union").collect()
    maps = spark.sql("SELECT 1 AS k, map('a', 1) AS m")
    assert outer_merge([maps, b], ["k"], strategy="union").first().m == {"a": 1}


def test_lookup_reads_a_replaced_file_anew_and_needs_no_single_task(spark):
    from cairn.session import scratch_path

    path = scratch_path(spark, "t-dim")
    facts = spark.range(3).selectExpr("id AS k")
    dim = lambda: spark.read.parquet(path)
    spark.sql("SELECT 1L AS k, 'old' AS v").write.mode("overwrite").parquet(path)
    first = lookup_enrich(facts, dim(), on="k", take="v", default="-")
    assert rows(first) == [(0, "-"), (1, "old"), (2, "-")]
    assert "SinglePartition" not in first._jdf.queryExecution().executedPlan().toString()
    spark.sql("SELECT 1L AS k, 'new' AS v").write.mode("overwrite").parquet(path)
    spark.catalog.refreshByPath(path)
    assert rows(lookup_enrich(facts, dim(), on="k", take="v", default="-")) == [(0, "-"), (1, "new"), (2, "-")]


def test_append_rows_by_name_widens_types(spark):
    a = spark.createDataFrame([(1, "x")], "key int, name string")
    b = spark.createDataFrame([("y", 2**40)], "nm string, k bigint")
    out = append_rows(a, b, rename={"nm": "name", "k": "key"})
    assert dict(out.dtypes)["key"] == "bigint"
    assert rows(out) == [(1, "x"), (2**40, "y")]


def test_null_safe_join_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    b = spark.createDataFrame([(None, "n"), (2, "t")], "k int, y string")
    assert rows(null_safe_join(a, b, ["k"])) == [(2, 2, "t"), (None, 1, "n")]


def test_outer_merge_composite_keys_with_partial_nulls(spark):
    a = spark.createDataFrame([(1, None, 10), (1, "x", 11)], "k1 int, k2 string, a bigint")
    b = spark.createDataFrame([(1, None, 20), (1, "x", 21)], "k1 int, k2 string, b bigint")
    for strategy in ("union", "join"):
        got = rows(outer_merge([a, b], ["k1", "k2"], strategy=strategy))
        assert got == sorted([(1, "x", 11, 21), (1, None, 10, None), (1, None, None, 20)], key=repr), strategy
