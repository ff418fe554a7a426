"""The library's operators applied to the driver's test tables.

One function per operator row of the survey's test mapping; every function
takes ``(spark, sf_dir)``, reads whole tables from ``sf_dir`` and returns a
DataFrame whose column names equal those of the matching SQL in
:mod:`cairn.plans.oracle`.  Role mapping to the reference's data: order
status / event type / return flag play the medal class, customers and
users play athletes and teams, market segment plays the games, part size
plays the year built, priorities play diets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cairn.functions.numeric import add_total, band, difference, mean_from_totals, rounded
from cairn.operators.aggregate import category_counts, frequency_topk
from cairn.operators.cleaning import dedupe_first, fill_missing, replace_token
from cairn.operators.combine import append_rows, lookup_enrich, outer_merge
from cairn.operators.levels import (compare_tables, cube_sets, grouping_levels, merged_distinct, rollup_sets,
                                    set_operation, sketch_table)
from cairn.operators.prefix import durable
from cairn.operators.ranking import rank_within, top_k
from cairn.operators.stats import (anova_columns, anova_oneway, check_assumptions, pearson_matrix, pearson_test,
                                   welch_t)
from cairn.operators.temporal import as_of_join, frame, interval_join
from cairn.plans.recipes import category_table
from cairn.session import persisted, scratch_path
from cairn.sources.files import read_typed_csv, split_write, write_stage
from cairn.sources.nested import json_entries, parse_json
from cairn.streaming.joins import bounded_stream_join, stream_distinct
from cairn.streaming.replay import (mean_from_running, read_complete, read_latest, replay_files, run_to_end,
                                    running_totals)
from cairn.streaming.sessions import BUCKETS, sessions
from cairn.streaming.windows import windowed_totals, write_arrivals

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- sources


def csv_typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer written as headered CSV, re-read under its declared schema (header checked)."""
    customer = table(spark, sf_dir, "customer")
    path = write_stage(customer, scratch_path(spark, "customer-csv"), fmt="csv")
    return read_typed_csv(spark, path, schema=customer.schema, check_header=True, staged=True)


def csv_permissive_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes below 5 written as the text NA; the typed read turns them into nulls and flags the rows."""
    part = table(spark, sf_dir, "part")
    as_text = part.select("p_partkey",
                          F.when(F.col("p_size") < 5, F.lit("NA")).otherwise(F.col("p_size").cast("string"))
                          .alias("p_size"), "p_retailprice")
    path = write_stage(as_text, scratch_path(spark, "part-na-csv"), fmt="csv")
    schema = StructType([StructField("p_partkey", LongType()), StructField("p_size", part.schema["p_size"].dataType),
                         StructField("p_retailprice", DoubleType())])
    typed = read_typed_csv(spark, path, schema=schema, corrupt_col="_bad_line", staged=True)
    return typed.select("p_partkey", "p_size", "p_retailprice", F.col("_bad_line").isNotNull().alias("bad_row"))


def csv_narrow_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five customer columns written; read back under the first four (positional schema, header checked)."""
    customer = table(spark, sf_dir, "customer")
    path = write_stage(customer, scratch_path(spark, "customer-wide-csv"), fmt="csv")
    narrow = StructType(customer.schema.fields[:4])
    return read_typed_csv(spark, path, schema=narrow, check_header=True, staged=True)


def csv_string_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation written with a header and read back without a schema: every column is a string."""
    nation = table(spark, sf_dir, "nation")
    path = write_stage(nation, scratch_path(spark, "nation-csv"), fmt="csv")
    return read_typed_csv(spark, path, schema=None, staged=True)


def split_write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events split into one folder per event type in one write, re-read, counted and summed per type."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    path = split_write(events, scratch_path(spark, "events-split"), by="event_type")
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("value", DoubleType()), StructField("event_type", StringType())])
    back = read_typed_csv(spark, path, schema=schema, staged=True)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                          rounded(F.sum("value"), 2).alias("total_value"))


# ---------------------------------------------------------------- projection / filters


def select_filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status F, four columns."""
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                              "o_totalprice")


def filter_or_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with status F, or status P and price above 100000 (explicit precedence)."""
    orders = table(spark, sf_dir, "orders")
    keep = (F.col("o_orderstatus") == "F") | ((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 100000))
    return orders.where(keep).select("o_orderkey", "o_orderstatus", "o_totalprice")


def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of three types (IN list)."""
    events = table(spark, sf_dir, "events")
    return events.where(F.col("event_type").isin("view", "click", "error")).select("event_id", "user_id",
                                                                                   "event_type", "value")


def filter_between_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of size 10-20 whose type is not ECONOMY."""
    part = table(spark, sf_dir, "part")
    return part.where(F.col("p_size").between(10, 20) & (F.col("p_type") != "ECONOMY")).select(
        "p_partkey", "p_size", "p_type")


def filter_contains_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct part names containing 'ring', sorted."""
    part = table(spark, sf_dir, "part")
    return part.where(F.col("p_name").contains("ring")).select("p_name").distinct().orderBy("p_name")


def filter_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text (blanked for English) is not empty."""
    docs = table(spark, sf_dir, "documents")
    blanked = docs.select("doc_id", "lang", F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("text"))
                          .alias("text"))
    return blanked.where(F.length("text") > 0).select("doc_id", "lang")


def literal_rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region with a literal tag, renamed columns, one dropped, one derived."""
    region = table(spark, sf_dir, "region")
    tagged = region.withColumn("tag", F.lit("region")).withColumnsRenamed(
        {"r_regionkey": "region_key", "r_name": "region_name"})
    return tagged.withColumn("name_len", F.length("region_name").alias("name_len")).drop("region_key")


# ---------------------------------------------------------------- cleaning


def fill_numeric_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part size nulled for multiples of 7 and price nulled above size 45, then filled with -1 and 0."""
    part = table(spark, sf_dir, "part")
    gappy = part.select("p_partkey",
                        F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"),
                        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_retailprice"))
                        .alias("p_retailprice"))
    return fill_missing(gappy, {"p_size": -1, "p_retailprice": 0.0})


def fill_string_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer segment nulled for BUILDING, then filled with a default text."""
    customer = table(spark, sf_dir, "customer")
    gappy = customer.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
                            .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return fill_missing(gappy, {"c_mktsegment": "UNKNOWN"})


def replace_token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment tokens replaced as whole values and as substrings."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = replace_token(customer, "c_mktsegment", "BUILDING", "CONSTRUCTION", whole=True, name="seg_whole")
    out = replace_token(out, "c_mktsegment", "HOLD", "HOME", whole=True, name="seg_token_whole")
    out = replace_token(out, "c_mktsegment", "HOLD", "HOME", whole=False, name="seg_sub")
    return out.select("c_custkey", "seg_whole", "seg_token_whole", "seg_sub")


LINEITEM_VALUE_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                       "l_returnflag", "l_linestatus"]


def dedupe_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items kept once per (order, line number): the first under all other columns."""
    lineitem = table(spark, sf_dir, "lineitem")
    kept = dedupe_first(lineitem, ["l_orderkey", "l_linenumber"], LINEITEM_VALUE_COLS + ["l_shipdate"])
    return kept.select("l_orderkey", "l_linenumber", *LINEITEM_VALUE_COLS)


# ---------------------------------------------------------------- joins


def _event_counts(events: DataFrame, event_type: str, name: str) -> DataFrame:
    return (events.where(F.col("event_type") == event_type)
            .groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias(name)))


def full_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, purchase and signup counts merged by a full outer join on both keys, zeros filled."""
    events = table(spark, sf_dir, "events")
    purchases = _event_counts(events, "purchase", "purchases")
    signups = _event_counts(events, "signup", "signups")
    return outer_merge([purchases, signups], ["user_id", "day"], fill=0, strategy="join")


def three_way_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, click, view and error counts merged in one grouped pass (n-ary outer merge)."""
    events = table(spark, sf_dir, "events")
    sides = [_event_counts(events, t, n) for t, n in (("click", "clicks"), ("view", "views"), ("error", "errors"))]
    return outer_merge(sides, ["user_id", "day"], fill=0, strategy="union")


def category_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day, counts of three event types as columns, from one aggregate."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return category_counts(events, ["user_id", "day"], "event_type", ["click", "view", "error"],
                           ["clicks", "views", "errors"])


def lookup_enrich_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the first priority among their pending orders (many per customer), a default where none is."""
    pending = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P").select("o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookup_enrich(customer, pending, on="c_custkey", dim_key="o_custkey", take="o_orderpriority",
                         default="NONE", name="pending_priority")


def append_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers stacked by column name."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"), F.lit("customer").alias("kind"))
    supplier = table(spark, sf_dir, "supplier").select(
        "s_nationkey", "s_name", "s_suppkey", F.lit("supplier").alias("kind"))
    return append_rows(customer, supplier,
                       rename={"s_suppkey": "party_key", "s_name": "name", "s_nationkey": "nation_key"})


# ---------------------------------------------------------------- aggregates


def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per status: all rows and rows with a (nullable) price."""
    orders = table(spark, sf_dir, "orders")
    priced = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice"))
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.count(priced).alias("n_priced"))


def group_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item quantity and price sums per return flag."""
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.groupBy("l_returnflag").agg(rounded(F.sum("l_quantity"), 2).alias("sum_qty"),
                                                rounded(F.sum("l_extendedprice"), 2).alias("sum_price"))


def group_mean_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order count and rounded mean price per customer."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                           rounded(F.avg("o_totalprice"), 2).alias("avg_price"))


def frequency_topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five customers by order count (ties broken by key)."""
    orders = table(spark, sf_dir, "orders")
    return frequency_topk(orders, ["o_custkey"], 5, count_name="n_orders")


def composite_frequency_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five (user, event type) pairs with a display label."""
    events = table(spark, sf_dir, "events")
    return frequency_topk(events, ["user_id", "event_type"], 5, label="label")


def distinct_then_count_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five suppliers by distinct (part, flag) pairs, flag N excluded."""
    lineitem = table(spark, sf_dir, "lineitem")
    return frequency_topk(lineitem, ["l_suppkey"], 5, where=F.col("l_returnflag") != "N",
                          distinct_on=["l_suppkey", "l_partkey", "l_returnflag"])


def two_key_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and rounded mean price per (return flag, line status)."""
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("l_extendedprice"), 2).alias("avg_price"))


def _orders_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customer.join(counts, customer.c_custkey == counts.o_custkey, "inner").drop("o_custkey")


def dense_rank_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers dense-ranked by order count inside their market segment."""
    # one row per customer, needed for both passes of the rank: computed once
    return rank_within(durable(_orders_per_customer(spark, sf_dir)), ["c_mktsegment"], "n_orders", name="rank")


def topk_multi_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five users by click, view and error counts."""
    events = table(spark, sf_dir, "events")
    counts = category_counts(events, ["user_id"], "event_type", ["click", "view", "error"],
                             ["clicks", "views", "errors"])
    return top_k(counts, [F.desc("clicks"), F.desc("views"), F.desc("errors")], 5, tie_break=["user_id"])


def bottomk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five cheapest parts (ties broken by key)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    return top_k(part, [F.asc("p_retailprice")], 5, tie_break=["p_partkey"])


def row_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer order counts by status as columns plus their total."""
    orders = table(spark, sf_dir, "orders")
    counts = category_counts(orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["n_f", "n_o", "n_p"])
    return add_total(counts, ["n_f", "n_o", "n_p"], "total")


def rounded_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item price minus quantity, rounded to cents."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return difference(lineitem, "l_extendedprice", "l_quantity", "diff", 2).select("l_orderkey", "l_linenumber",
                                                                                   "diff")


SIZE_BANDS = [(1, 10, "small"), (11, 25, "medium"), (31, 50, "large")]


def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts banded by size (one range left uncovered): count and mean price per band."""
    part = band(table(spark, sf_dir, "part"), "p_size", SIZE_BANDS, "size_band")
    return part.groupBy("size_band").agg(F.count(F.lit(1)).alias("n"),
                                         rounded(F.avg("p_retailprice"), 2).alias("avg_price"))


# ---------------------------------------------------------------- statistics


def pearson_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson matrix of quantity, price and discount as long rows."""
    lineitem = table(spark, sf_dir, "lineitem")
    return pearson_matrix(lineitem, ["l_quantity", "l_extendedprice", "l_discount"], scale=6)


def pearson_test_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation test of discount and quantity per return flag."""
    lineitem = table(spark, sf_dir, "lineitem")
    return pearson_test(lineitem, "l_discount", "l_quantity", by=["l_returnflag"], scale=6)


def group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per event type."""
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.count("value").alias("n"), rounded(F.avg("value"), 6).alias("mean_value"))


def welch_t_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Welch t-test of event values: view against purchase."""
    events = table(spark, sf_dir, "events")
    return welch_t(events, "value", "event_type", "view", "purchase", scale=6)


def welch_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Welch test per market segment: order value of urgent vs low-priority orders."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return welch_t(joined, "o_totalprice", "o_orderpriority", "1-URGENT", "5-LOW", by=["c_mktsegment"], scale=6)


ANOVA_COLS = ["k", "n", "df_between", "df_within", "f", "p_value", "reject_null"]


def anova_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-way ANOVA of order price across the five priorities."""
    orders = table(spark, sf_dir, "orders")
    return anova_oneway(orders, "o_totalprice", "o_orderpriority", scale=6).select(*ANOVA_COLS)


def anova_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-way ANOVA of event values across three named event types."""
    events = table(spark, sf_dir, "events")
    return anova_oneway(events, "value", "event_type", groups=["view", "click", "error"], scale=6).select(*ANOVA_COLS)


def anova_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-way ANOVA across three per-user count columns."""
    events = table(spark, sf_dir, "events")
    counts = category_counts(events, ["user_id"], "event_type", ["click", "view", "error"],
                             ["clicks", "views", "errors"])
    return anova_columns(counts, ["clicks", "views", "errors"], scale=6).select(*ANOVA_COLS)


def anova_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ANOVA of order price across priorities for every market segment."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return anova_oneway(joined, "o_totalprice", "o_orderpriority", by=["c_mktsegment"], scale=6).select(
        "c_mktsegment", *ANOVA_COLS)


def assumption_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levene and Jarque-Bera checks of event values by event type."""
    events = table(spark, sf_dir, "events")
    return check_assumptions(events, "value", "event_type", scale=6)


# ---------------------------------------------------------------- streaming


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events split into files, replayed one file per trigger; running totals and means per type."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    source = split_write(events, scratch_path(spark, "events-stream-input"), by="event_type")
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("value", DoubleType()), StructField("event_type", StringType())])
    stream = replay_files(spark, source, schema, files_per_trigger=1)
    result_path = scratch_path(spark, "events-stream-result")
    # a handful of event types: the state is tiny whatever the volume, so few state partitions
    run_to_end(running_totals(stream, ["event_type"], "value"), "event_totals", mode="complete", sink="table",
               path=result_path, state_partitions=4)
    totals = read_complete(spark, result_path)
    out = mean_from_running(totals, ["event_type"], scale=2)
    return out.withColumn("total", rounded(F.col("total"), 2))


# ---------------------------------------------------------------- multi-step recipes


def participation_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the most distinct orders (each supplier/order pair counted once), top 5."""
    lineitem = table(spark, sf_dir, "lineitem")
    return frequency_topk(lineitem, ["l_suppkey"], 5, distinct_on=["l_suppkey", "l_orderkey"], count_name="n_orders")


QUANTITY_BANDS = [(1, 10, "1-10 units"), (11, 30, "11-30 units"), (31, 50, "31-50 units")]


def staged_band_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter, band, stage as headered CSV, re-read typed, then count and mean per band."""
    lineitem = table(spark, sf_dir, "lineitem").where(F.col("l_discount") > 0)
    banded = band(lineitem.select("l_quantity", "l_extendedprice"), "l_quantity", QUANTITY_BANDS, "qty_band")
    path = write_stage(banded, scratch_path(spark, "lineitem-bands-csv"), fmt="csv")
    schema = StructType([StructField("l_quantity", DoubleType()), StructField("l_extendedprice", DoubleType()),
                         StructField("qty_band", StringType())])
    staged = read_typed_csv(spark, path, schema=schema, check_header=True, staged=True)
    return staged.groupBy("qty_band").agg(F.count(F.lit(1)).alias("n"),
                                          rounded(F.avg("l_extendedprice"), 2).alias("avg_price"))


def two_class_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep class R, and class N only with a discount; stage; Welch test of price R vs N."""
    lineitem = table(spark, sf_dir, "lineitem")
    keep = (F.col("l_returnflag") == "R") | ((F.col("l_returnflag") == "N") & (F.col("l_discount") != 0))
    path = write_stage(lineitem.where(keep).select("l_returnflag", "l_extendedprice"),
                       scratch_path(spark, "lineitem-classes"))
    staged = spark.read.parquet(path)
    return welch_t(staged, "l_extendedprice", "l_returnflag", "R", "N", scale=6)


def _best_account_per_nation(accounts: DataFrame, nation_dim: DataFrame, kind: str) -> DataFrame:
    tagged = accounts.withColumn("kind", F.lit(kind))
    named = lookup_enrich(tagged, nation_dim, on="nation_key", dim_key="n_nationkey", take="n_name",
                          default="UNKNOWN", name="nation_name")
    best = dedupe_first(named, ["nation_name", "kind"], [("acctbal", False), ("party_key", True)])
    return best.select("nation_name", "kind", "party_key", "acctbal")


def append_with_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag rows, look up a code (default when missing), keep the top account per (code, tag), append, sort."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("acctbal"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("acctbal"))
    merged = append_rows(_best_account_per_nation(customers, nation, "customer"),
                         _best_account_per_nation(suppliers, nation, "supplier"))
    return merged.orderBy(F.desc("acctbal"), "party_key")


def documents_csv_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents staged as CSV and re-read: line ends, quotes, padding and empty strings come back as they were."""
    docs = table(spark, sf_dir, "documents")
    padded = docs.select("doc_id", "text", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("padded"),
                         F.when(F.col("lang") == "en", "").when(F.col("lang") == "de", F.col("source")).alias("gappy"))
    path = write_stage(padded, scratch_path(spark, "documents-csv"), fmt="csv")
    return read_typed_csv(spark, path, schema=padded.schema, check_header=True, staged=True)


def staged_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded price difference staged as CSV, re-read typed, then counted and averaged by sign."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    diff = difference(lineitem, "l_extendedprice", "l_quantity", "diff", 2).select("l_orderkey", "diff")
    path = write_stage(diff, scratch_path(spark, "difference-csv"), fmt="csv")
    staged = read_typed_csv(spark, path, schema=diff.schema, check_header=True, staged=True)
    return staged.groupBy((F.col("diff") >= 30000).alias("large")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.avg("diff"), 2).alias("avg_diff"))


def distinct_category_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier, line items counted once per (part, flag, status) by flag as columns, and their total."""
    lineitem = table(spark, sf_dir, "lineitem")
    return category_table(lineitem, ["l_suppkey"], "l_returnflag", ["A", "N", "R"], ["n_a", "n_n", "n_r"],
                          distinct_on=["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus"]).orderBy(
                              F.desc("total"), "l_suppkey")


def distinct_composite_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top five (supplier, flag) pairs by distinct orders: de-duplicated, then counted on the composite key."""
    lineitem = table(spark, sf_dir, "lineitem")
    return frequency_topk(lineitem, ["l_suppkey", "l_returnflag"], 5, label="label",
                          distinct_on=["l_suppkey", "l_returnflag", "l_orderkey"], count_name="n_orders")


def perfect_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation test of each order's price with twice itself, per status: r = 1, p = 0, rejected."""
    orders = table(spark, sf_dir, "orders").withColumn("double_price", F.col("o_totalprice") * 2)
    out = pearson_test(orders, "o_totalprice", "double_price", by=["o_orderstatus"], scale=6)
    return out.select("o_orderstatus", "n", "r", "p_value", "reject_null")


def wide_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson matrix of thirty columns of line items: five measures and their products and ratios."""
    lineitem = table(spark, sf_dir, "lineitem")
    base = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    cols = [F.col(c).cast("double").alias(c) for c in base]
    cols += [(F.col(a) * F.col(b)).cast("double").alias(f"{a}_x_{b}") for i, a in enumerate(base) for b in base[i:]]
    cols += [(F.col(a) / (F.col(b) + 1)).cast("double").alias(f"{a}_by_{b}") for a in base[:2] for b in base]
    wide = lineitem.select(*cols)
    return pearson_matrix(wide, wide.columns, scale=6, missing="listwise")


def stream_sorted_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals sorted by count, kept as a named in-memory table (one row per event type) and read by SQL."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    source = split_write(events, scratch_path(spark, "events-memory-input"), by="event_type")
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("value", DoubleType()), StructField("event_type", StringType())])
    stream = replay_files(spark, source, schema, files_per_trigger=1)
    name = f"event_totals_{uuid.uuid4().hex[:8]}"
    run_to_end(running_totals(stream, ["event_type"], "value", sort_desc="count"), name, mode="complete",
               sink="memory", state_partitions=4)
    return spark.sql(f"SELECT event_type, count, total FROM {name} ORDER BY count DESC").select(
        "event_type", "count", mean_from_totals("total", "count", 2).alias("avg_value"))


def ranked_table_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked status table written as a headered CSV stage and read back under its declared schema."""
    ranked = category_table_ranked(spark, sf_dir)
    path = write_stage(ranked, scratch_path(spark, "ranked-csv"), fmt="csv")
    return read_typed_csv(spark, path, schema=ranked.schema, check_header=True, staged=True)


def persisted_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered frame cached while two results are formed from it, then released; both results side by side."""
    lines = table(spark, sf_dir, "lineitem").where("l_discount > 0").select("l_returnflag", "l_linestatus", "l_quantity")
    with persisted(lines) as kept:
        flags = durable(kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("l_quantity"), 2).alias("quantity")))
        states = durable(kept.groupBy("l_returnflag").agg(F.count_distinct("l_linestatus").alias("n_status")))
    return flags.join(states, "l_returnflag")


def pearson_no_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations of three measures where a missing value is an error, per return flag."""
    lines = table(spark, sf_dir, "lineitem")
    return pearson_matrix(lines, ["l_quantity", "l_extendedprice", "l_discount"], by=["l_returnflag"], scale=6, missing="error")


# ---------------------------------------------------------------- levels, sketches, sets


def _levels(lines: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    out = grouping_levels(lines, sets, "l_quantity")
    return out.withColumns({"total": rounded("total", 2), "mean": rounded("mean", 6)})


def cube_line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by return flag, line status and line number in all eight combinations; null keys told from totals."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("l_linenumber"), "l_returnflag", "l_linestatus", "l_quantity")
    return _levels(lines, cube_sets(["l_returnflag", "l_linestatus", "l_linenumber"]))


def rollup_line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities by supplier and return flag, by supplier, and over all."""
    return _levels(table(spark, sf_dir, "lineitem"), rollup_sets(["l_suppkey", "l_returnflag"]))


def merged_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users by event type from sketches of each day, beside the exact number; is the estimate within its bound?"""
    events = table(spark, sf_dir, "events")
    daily = sketch_table(events.select(F.to_date("ts").alias("day"), "event_type", "user_id"), ["day", "event_type"], "user_id")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    near = F.abs(F.col("n_distinct") - F.col("n_users")) <= F.greatest(F.lit(1.0), F.col("error") * F.col("n_users"))
    return (merged_distinct(daily, ["event_type"]).join(exact, "event_type")
            .select("event_type", "n_users", F.col("n").alias("n_events"), near.alias("within_bound")))


def _status_pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers' (nation or null) rows and suppliers' rows, both with repeats."""
    nation = lambda c: F.when(F.col(c) % 5 != 0, F.col(c)).alias("nation")
    return (table(spark, sf_dir, "customer").select(nation("c_nationkey"), (F.col("c_custkey") % 3).alias("k")),
            table(spark, sf_dir, "supplier").select(nation("s_nationkey"), (F.col("s_suppkey") % 4).alias("k")))


def set_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often customers and suppliers hold each (nation, remainder) row."""
    return compare_tables(*_status_pairs(spark, sf_dir))


def intersect_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that both hold, as often as the one that holds them less often."""
    return set_operation(*_status_pairs(spark, sf_dir), "intersect", keep_all=True)


def except_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' rows less suppliers' rows, copy by copy."""
    return set_operation(*_status_pairs(spark, sf_dir), "except", keep_all=True)


def intersect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows that both hold."""
    return set_operation(*_status_pairs(spark, sf_dir), "intersect")


def except_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows that suppliers hold and customers do not."""
    return set_operation(*reversed(_status_pairs(spark, sf_dir)), "except")


# ---------------------------------------------------------------- time


def asof_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last order of its user (as customer) at or before it; of one day's orders the greatest key."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return as_of_join(events, orders, on=[("user_id", "o_custkey")], times=("ts", "o_orderdate"),
                      take=["o_orderkey", "o_totalprice"], tie=["o_orderkey"]).drop("ts")


def asof_last_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's last strictly earlier click of the two days before it."""
    events = table(spark, sf_dir, "events")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    return as_of_join(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks,
                      on=[("user_id", "user_id")], times=("ts", "ts"), take=["event_id", "value"], tie=["event_id"],
                      strict=True, within=F.expr("interval 2 days"), prefix="click_").drop("ts")


def interval_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase that falls into the time after an error, which lasts as many minutes as the error's value says."""
    events = table(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("begins"),
        F.expr("ts + make_dt_interval(0, 0, 0, cast(cast(value * 60 as bigint) as decimal(18, 6)))").alias("ends"))
    purchases = events.where("event_type = 'purchase'").select("event_id", "ts")
    return interval_join(purchases, errors, "ts", ("begins", "ends")).select("event_id", "error_id")


def interval_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line items of the same supplier shipped within its line's month (equal keys and an interval)."""
    lines = table(spark, sf_dir, "lineitem")
    spans = lines.where("l_linenumber = 1").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("begins"),
        (F.col("l_shipdate") + F.expr("interval 30 days")).alias("ends"))
    met = interval_join(lines.select("l_suppkey", "l_shipdate", "l_quantity"), spans, "l_shipdate", ("begins", "ends"),
                        on=[("l_suppkey", "supplier")])
    return met.groupBy("order_key").agg(F.count(F.lit(1)).alias("n_lines"), rounded(F.sum("l_quantity"), 2).alias("quantity"))


def moving_event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type in time order: previous value, next event, moving sum of ten values, greatest of the 21 around."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    out = frame(events, ["event_type"], ["ts", "event_id"], (10, 10), lambda w: {
        "previous": F.lag("value").over(w), "next_id": F.lead("event_id").over(w),
        "moving_sum": F.sum("value").over(w.rowsBetween(-9, 0)), "around": F.max("value").over(w.rowsBetween(-10, 10))})
    return out.select("event_id", "previous", "next_id", rounded("moving_sum", 4).alias("moving_sum"), "around")


def _event_windows(spark: SparkSession, sf_dir: str, width: str, slide: str | None) -> DataFrame:
    """Events replayed in four-day batches, every 25th two batches late; windows with a watermark of one day."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    source = scratch_path(spark, "event-arrivals")
    day = F.datediff(F.col("ts"), F.lit("2024-01-01"))
    write_arrivals(events, source, F.floor(day / 4) + 2 * (F.col("event_id") % 25 == 0).cast("int"))
    stream = replay_files(spark, f"{source}/*", events.schema, fmt="parquet")
    path = scratch_path(spark, "event-windows")
    totals = windowed_totals(stream, "ts", width, ["event_type"], "value", delay="1 day", slide=slide)
    run_to_end(totals, f"event_windows_{uuid.uuid4().hex[:8]}", mode="update", sink="table", path=path, state_partitions=4)
    latest = read_latest(spark, path, ["window_start", "window_end", "event_type"])
    return latest.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "count", rounded("total", 2).alias("total"))


def stream_tumbling_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by type in six-hour windows of event time; rows of windows that the watermark has passed are dropped."""
    return _event_windows(spark, sf_dir, "6 hours", None)


def stream_sliding_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in windows of a day that begin every eight hours: a late row may be in time for some of its windows."""
    return _event_windows(spark, sf_dir, "24 hours", "8 hours")


def stream_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, five hours of silence apart, over a replay in which every 25th event comes a batch late.

    A last arrival a year on, of no user, moves the watermark behind all events, so that every session is closed.
    """
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id", "value")
    source = scratch_path(spark, "session-arrivals")
    day = F.datediff(F.col("ts"), F.lit("2024-01-01"))
    batches = write_arrivals(events, source, F.floor(day / 8) + (F.col("event_id") % 25 == 0).cast("int"))
    events.agg((F.max("ts") + F.expr("interval 1 year")).alias("ts")).select(
        "ts", *(F.lit(None).cast(events.schema[c].dataType).alias(c) for c in ("event_id", "user_id", "value"))
    ).write.parquet(f"{source}/arrival_{batches:05d}")
    stream = replay_files(spark, f"{source}/*", events.schema, fmt="parquet")
    path = scratch_path(spark, "user-sessions")
    buckets = max(BUCKETS, events.count() // 100_000)
    run_to_end(sessions(stream, "user_id", "ts", "value", gap_seconds=5 * 3600, delay="17 days", buckets=buckets),
               f"user_sessions_{uuid.uuid4().hex[:8]}", mode="append", sink="table", path=path,
               state_partitions=max(4, min(buckets, spark.sparkContext.defaultParallelism)))
    return spark.read.parquet(path).select(
        "user_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")),
        F.col("count").alias("n_events"), rounded("total", 2).alias("total"))


def stream_click_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two replayed streams: each click with the purchases of its user in the twelve hours after it."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type", "user_id")
    sides = []
    for kind, tag in (("click", "c"), ("purchase", "p")):
        source = scratch_path(spark, f"{kind}-arrivals")
        part = events.where(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{tag}_id"), F.col("user_id").alias(f"{tag}_user"), F.col("ts").alias(f"{tag}_ts"))
        write_arrivals(part, source, F.floor(F.datediff(F.col(f"{tag}_ts"), F.lit("2024-01-01")) / 10))
        sides.append(replay_files(spark, f"{source}/*", part.schema, fmt="parquet"))
    joined = bounded_stream_join(*sides, on=[("c_user", "p_user")], times=("c_ts", "p_ts"), within="12 hours",
                                 delays=("11 days", "11 days"))
    path = scratch_path(spark, "click-purchases")
    run_to_end(joined, f"click_purchases_{uuid.uuid4().hex[:8]}", mode="append", sink="table", path=path, state_partitions=4)
    return spark.read.parquet(path).select("c_id", "p_id", F.col("c_user").alias("user_id"))


def stream_first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive twice, a batch apart, counted once per event by a bounded memory of their ids."""
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    source = scratch_path(spark, "repeated-arrivals")
    batch = F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01")) / 10)
    twice = events.withColumn("b", batch).unionByName(events.where("event_id % 7 = 0").withColumn("b", batch + 1))
    write_arrivals(twice, source, F.col("b"))
    stream = replay_files(spark, f"{source}/*", twice.schema, fmt="parquet")
    path = scratch_path(spark, "first-events")
    run_to_end(stream_distinct(stream, ["event_id"], "ts", "31 days"), f"first_events_{uuid.uuid4().hex[:8]}", mode="append",
               sink="table", path=path, state_partitions=4)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties by a declared schema; every 40th text is cut short and every 41st holds a word: kept and counted."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.when(
        F.col("event_id") % 40 == 0, F.expr("substr(props, 1, length(props) - 1)")).when(
        F.col("event_id") % 41 == 0, F.lit('{"k": "many"}')).otherwise(F.col("props")).alias("props"))
    read = parse_json(events, "props", StructType([StructField("k", LongType())]))
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("k").alias("n_k"), F.sum("k").alias("sum_k"), F.count("_bad_json").alias("n_bad"))


def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the event properties, whatever they are, with their numbers of rows and distinct values."""
    entries = json_entries(table(spark, sf_dir, "events").select("props"), "props")
    return entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("n_values"))


# ---------------------------------------------------------------- flagship recipe


def category_table_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer status counts, total, and dense rank of the total inside the segment."""
    orders = table(spark, sf_dir, "orders")
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return category_table(orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["n_f", "n_o", "n_p"],
                          attach=segments, rank_by=["c_mktsegment"])


QUERIES: dict[str, Query] = {
    "csv_typed_roundtrip": csv_typed_roundtrip,
    "csv_permissive_nulls": csv_permissive_nulls,
    "csv_narrow_schema": csv_narrow_schema,
    "csv_string_schema": csv_string_schema,
    "split_write_counts": split_write_counts,
    "select_filter_eq": select_filter_eq,
    "filter_or_and": filter_or_and,
    "filter_in_list": filter_in_list,
    "filter_between_ne": filter_between_ne,
    "filter_contains_distinct": filter_contains_distinct,
    "filter_non_empty": filter_non_empty,
    "literal_rename_drop": literal_rename_drop,
    "fill_numeric_sentinel": fill_numeric_sentinel,
    "fill_string_default": fill_string_default,
    "replace_token": replace_token_query,
    "dedupe_first": dedupe_first_query,
    "full_outer_merge": full_outer_merge,
    "three_way_outer_merge": three_way_outer_merge,
    "category_counts": category_counts_query,
    "lookup_enrich": lookup_enrich_query,
    "group_counts": group_counts,
    "group_sums": group_sums,
    "group_mean_rounded": group_mean_rounded,
    "frequency_topk": frequency_topk_query,
    "composite_frequency_topk": composite_frequency_topk,
    "distinct_then_count_topk": distinct_then_count_topk,
    "two_key_group_stats": two_key_group_stats,
    "dense_rank_within": dense_rank_within,
    "topk_multi_measure": topk_multi_measure,
    "bottomk": bottomk,
    "append_rows": append_rows_query,
    "row_total": row_total,
    "rounded_difference": rounded_difference,
    "band_counts": band_counts,
    "pearson_matrix": pearson_matrix_query,
    "pearson_test": pearson_test_query,
    "group_means": group_means,
    "welch_t": welch_t_query,
    "welch_by_segment": welch_by_segment,
    "anova_long": anova_long,
    "anova_subset": anova_subset,
    "anova_columns": anova_columns_query,
    "anova_by_segment": anova_by_segment,
    "assumption_checks": assumption_checks,
    "stream_running_totals": stream_running_totals,
    "category_table_ranked": category_table_ranked,
    "participation_topk": participation_topk,
    "staged_band_means": staged_band_means,
    "two_class_comparison": two_class_comparison,
    "append_with_lookup": append_with_lookup,
    "documents_csv_stage": documents_csv_stage,
    "staged_difference": staged_difference,
    "distinct_category_table": distinct_category_table,
    "distinct_composite_topk": distinct_composite_topk,
    "perfect_correlation": perfect_correlation,
    "wide_pearson": wide_pearson,
    "stream_sorted_memory": stream_sorted_memory,
    "ranked_table_staged": ranked_table_staged,
    "persisted_reuse": persisted_reuse,
    "pearson_no_missing": pearson_no_missing,
    "asof_last_order": asof_last_order,
    "asof_last_click": asof_last_click,
    "interval_errors": interval_errors,
    "interval_open_orders": interval_open_orders,
    "moving_event_stats": moving_event_stats,
    "stream_tumbling_totals": stream_tumbling_totals,
    "stream_sliding_totals": stream_sliding_totals,
    "stream_user_sessions": stream_user_sessions,
    "stream_click_purchases": stream_click_purchases,
    "stream_first_events": stream_first_events,
    "json_props": json_props,
    "json_keys": json_keys,
    "cube_line_totals": cube_line_totals,
    "rollup_line_totals": rollup_line_totals,
    "merged_distinct_users": merged_distinct_users,
    "set_counts": set_counts,
    "intersect_all_rows": intersect_all_rows,
    "except_all_rows": except_all_rows,
    "intersect_rows": intersect_rows,
    "except_rows": except_rows,
}
