import os

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from cairn.session import scratch_path, shared_dir
from cairn.sources.files import HeaderMismatchError, read_stage, read_typed_csv, split_write, write_stage
from frames import rows

SCHEMA = StructType([StructField("parcel", IntegerType()), StructField("street", StringType()),
                     StructField("floors", IntegerType()), StructField("net load", DoubleType())])


def _write_text(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(text)


def _local(spark, purpose):
    path = scratch_path(spark, purpose)
    return path[len("file:"):] if path.startswith("file:") else path


def test_shared_dir_comes_from_session(spark):
    assert shared_dir(spark).rstrip("/").endswith(spark.conf.get("spark.checkpoint.dir").rstrip("/").split(":")[-1])


def test_permissive_na_becomes_null_and_corrupt_line_is_kept(spark):
    path = _local(spark, "t-na")
    _write_text(path, "parcel,street,floors,net load\n1,Ann,NA,60.5\n2,Bo,31,70\n")
    df = read_typed_csv(spark, path, SCHEMA, corrupt_col="_bad")
    got = rows(df, "parcel", "floors", "net load", "_bad")
    assert got == [(1, None, 60.5, "1,Ann,NA,60.5"), (2, 31, 70.0, None)]


def test_failfast_raises_on_bad_cell(spark):
    path = _local(spark, "t-ff")
    _write_text(path, "parcel,street,floors,net load\n1,Ann,NA,60.5\n")
    try:
        read_typed_csv(spark, path, SCHEMA, mode="FAILFAST").collect()
    except Exception:
        return
    raise AssertionError("expected a parse failure")


def test_narrow_schema_is_positional_and_header_check(spark):
    path = _local(spark, "t-wide")
    _write_text(path, "parcel,street,floors,net load,Old\n1,Ann,30,60.5,21th\n")
    narrow = StructType(SCHEMA.fields[:3])
    assert rows(read_typed_csv(spark, path, narrow, check_header=True)) == [(1, "Ann", 30)]
    renamed = StructType([StructField("parcel", IntegerType()), StructField("Nom", StringType())])
    try:
        read_typed_csv(spark, path, renamed, check_header=True)
    except HeaderMismatchError:
        return
    raise AssertionError("expected HeaderMismatchError")


def test_untyped_read_gives_strings(spark):
    path = _local(spark, "t-str")
    _write_text(path, "parcel,net load\n1,60.5\n")
    df = read_typed_csv(spark, path, schema=None)
    assert df.dtypes == [("parcel", "string"), ("net load", "string")]


def test_stage_round_trip_parquet_and_csv(spark):
    df = spark.createDataFrame([(1, "Ann", None, 1.5)], SCHEMA)
    for fmt in ("parquet", "csv"):
        path = write_stage(df, scratch_path(spark, f"t-stage-{fmt}"), fmt=fmt)
        back = read_stage(spark, path, schema=SCHEMA, fmt=fmt)
        assert rows(back) == [(1, "Ann", None, 1.5)]


def test_split_write_one_folder_per_value(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"v{i % 2}") for i in range(60)], "id int, k string")
    path = split_write(df, scratch_path(spark, "t-split"), by="k", files_per_value=3)
    local = path[len("file:"):] if path.startswith("file:") else path
    assert sorted(d for d in os.listdir(local) if d.startswith("k=")) == ["k=hot", "k=v0", "k=v1"]
    back = read_typed_csv(spark, path, StructType([StructField("id", IntegerType()), StructField("k", StringType())]))
    assert rows(back) == rows(df)


def test_typed_columns_bad_text_becomes_null(spark):
    from cairn.sources.files import typed_columns

    df = spark.createDataFrame([("1.5", "a"), ("Price", "b"), (None, "c")], "Price string, Old string")
    assert rows(typed_columns(df, {"Price": "double"})) == [(1.5, "a"), (None, "b"), (None, "c")]


def test_persisted_caches_then_releases(spark):
    from cairn.session import persisted

    df = spark.range(100).selectExpr("id % 7 AS k")
    with persisted(df) as cached:
        assert cached.is_cached
        assert "InMemoryRelation" in cached.groupBy("k").count()._jdf.queryExecution().optimizedPlan().toString()
        assert cached.count() == 100
    assert not df.is_cached


def test_split_output_is_partition_pruned(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, f"v{i % 4}") for i in range(40)], "id int, k string")
    path = split_write(df, scratch_path(spark, "t-prune"), by="k", fmt="parquet")
    one = spark.read.parquet(path).where(F.col("k") == "v2")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan and "(k#" in plan
    assert rows(one) == sorted([(i, "v2") for i in range(2, 40, 4)], key=repr)


def test_split_write_caps_records_per_file(spark):
    df = spark.createDataFrame([(i, "a") for i in range(50)], "id int, k string").coalesce(1)
    path = split_write(df, scratch_path(spark, "t-cap"), by="k", fmt="parquet", max_records_per_file=10)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [f for f in os.listdir(os.path.join(local, "k=a")) if f.endswith(".parquet")]
    assert len(files) == 5
    assert spark.read.parquet(path).count() == 50


def test_csv_stage_keeps_strings(spark):
    from cairn.session import scratch_path
    from cairn.sources.files import read_stage, write_stage

    texts = ["a\nb", "", "  pad ", None, 'say "hi", you', "\\N", "\\n", "\\", "x\\\\n\r\n", ",", "é\u2028x", '"', "NA", "\t"]
    df = spark.createDataFrame([(k, t, None if k % 2 else 1.5) for k, t in enumerate(texts)], "k int, t string, v double")
    path = write_stage(df, scratch_path(spark, "t-strings"), fmt="csv")
    back = read_stage(spark, path, schema=df.schema, fmt="csv")
    assert sorted(back.collect()) == sorted(df.collect())


def test_every_file_header_is_checked(spark):
    from pyspark.sql import functions as F

    from cairn.session import scratch_path

    path = scratch_path(spark, "t-headers")
    spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c").write.option("header", True).csv(path)
    schema = spark.sql("SELECT 1 AS a, 2 AS b").schema
    assert read_typed_csv(spark, path, schema=schema, check_header=True).collect() == [(1, 2)]
    spark.sql("SELECT 5 AS b, 6 AS a, 3 AS c").write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception):
        read_typed_csv(spark, path, schema=schema, check_header=True).agg(F.sum("a")).collect()


def test_an_empty_folder_key_is_refused(spark):
    from cairn.session import scratch_path
    from cairn.sources.files import split_write

    df = spark.createDataFrame([("", 1), ("x", 2)], "k string, v int")
    with pytest.raises(Exception, match="empty string"):
        split_write(df, scratch_path(spark, "t-empty-key"), by="k")


def test_no_local_folder_off_a_local_master(spark, monkeypatch):
    from cairn import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Fake:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())
