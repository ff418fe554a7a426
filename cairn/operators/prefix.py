"""Durable cuts of a plan and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.session import shared_dir


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared checkpoint folder.

    Lineage ends there, so a lost executor costs a re-read and not a
    recomputation, and values that depend on how rows were dealt out
    (partition numbers) stay what they were.  Every call reads its input
    anew; nothing is remembered between calls.
    """
    shared_dir(df.sparkSession)  # makes sure a checkpoint folder is set
    return df.checkpoint(eager=True)


def task_count(spark: SparkSession, rows: int = 0, per_task: int = 250_000) -> int:
    """Shuffle width: the session's, or more where the row count asks for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task), 1)


def grouped_prefix(df: DataFrame, order: Sequence[str | Column], *, group: Sequence[str] = (),
                   sums: dict[str, str] | None = None, xors: dict[str, str] | None = None,
                   index: str | None = None, width: int | None = None) -> DataFrame:
    """Exclusive running sums (and xors) within each group, no group confined to one task.

    Rows are range-partitioned by (group, order) and kept durably with their
    partition's number as a column, so that number is data from then on;
    each partition sums locally, and a group that began in an earlier
    partition gets that partition's total added.  At most one group
    continues into a partition, so the carried totals are one row per
    partition at most: a structural bound, hence the broadcast.

    ``sums``/``xors`` map new column -> measured column; ``index`` names a
    column for the row's zero-based place in its group.  Rows with equal
    order values take an arbitrary but settled order.  An empty frame gives
    an empty frame.
    """
    spark, group = df.sparkSession, list(group)
    sums, xors = dict(sums or {}), dict(xors or {})
    pid, one = "__pid", "__one"
    ranged = durable(df.withColumn(one, F.lit(1).cast("long"))
                     .repartitionByRange(width or task_count(spark), *group, *order)
                     .withColumn(pid, F.spark_partition_id()))
    if index:
        sums[index] = one
    totals = ranged.groupBy(pid, *group).agg(
        *(F.sum(c).alias(f"__t_{o}") for o, c in sums.items()),
        *(F.bit_xor(c).alias(f"__t_{o}") for o, c in xors.items()), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(pid).alias("__p"), *(F.col(g).alias(f"__g_{g}") for g in group),
        *(F.sum(f"__t_{o}").over(before).alias(f"__b_{o}") for o in sums),
        *(F.bit_xor(f"__t_{o}").over(before).alias(f"__b_{o}") for o in xors),
        F.sum("__n").over(before).alias("__seen")).where("__seen > 0").drop("__seen")
    local = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = ranged.select("*", *((F.sum(c).over(local) - F.col(c)).alias(f"__l_{o}") for o, c in sums.items()),
                        *(F.bit_xor(c).over(local).bitwiseXOR(F.col(c)).alias(f"__l_{o}") for o, c in xors.items()))
    same = F.col(pid) == F.col("__p")
    for g in group:
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"`__g_{g}`"))
    out = run.join(F.broadcast(carried), same, "left")
    zero = F.lit(0).cast("long")
    return out.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *((F.col(f"__l_{o}") + F.coalesce(F.col(f"__b_{o}"), zero)).alias(o) for o in sums),
        *(F.col(f"__l_{o}").bitwiseXOR(F.coalesce(F.col(f"__b_{o}"), zero)).alias(o) for o in xors))


def grouped_carry(df: DataFrame, order: Sequence[str | Column], value: str, *, group: Sequence[str] = (),
                  name: str = "carried", width: int | None = None) -> DataFrame:
    """The last non-null ``value`` at or before each row in its group's order, no group confined to one task.

    As in :func:`grouped_prefix` rows are range-partitioned by (group, order) and kept durably.  Each partition carries
    its own values forward; a group that began earlier gets the last value of the partitions before, which is one row
    for each partition at most.  ``value`` may be a struct; a null struct is no value.
    """
    spark, group = df.sparkSession, list(group)
    pid = "__pid"
    ranged = durable(df.repartitionByRange(width or task_count(spark), *group, *order).withColumn(pid, F.spark_partition_id()))
    place = F.struct(*(F.when(F.col(value).isNotNull(), c) for c in _columns(order)))
    # in range partitions the last value of a group is that of its greatest row with one
    last = ranged.where(F.col(value).isNotNull()).groupBy(pid, *group).agg(F.max_by(value, place).alias("__last"))
    every = ranged.groupBy(pid, *group).agg(F.count(F.lit(1)).alias("__n")).join(
        last.select(F.col(pid).alias("__q"), *(F.col(f"`{g}`").alias(f"__h_{g}") for g in group), "__last"),
        _same(pid, "__q", group, "__h_"), "left").select(pid, *(f"`{g}`" for g in group), "__last")
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(F.col(pid).alias("__p"), *(F.col(f"`{g}`").alias(f"__g_{g}") for g in group),
                           F.last("__last", ignorenulls=True).over(before).alias("__old")).where("__old is not null")
    local = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = ranged.withColumn("__own", F.last(value, ignorenulls=True).over(local))
    out = run.join(F.broadcast(carried), _same(pid, "__p", group, "__g_"), "left")
    return out.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce("__own", "__old").alias(name))


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _same(pid: str, other: str, group: Sequence[str], prefix: str) -> Column:
    cond = F.col(pid) == F.col(other)
    for g in group:
        cond = cond & F.col(f"`{g}`").eqNullSafe(F.col(f"`{prefix}{g}`"))
    return cond
