"""Top-k and ranking inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators.combine import broadcast_if_small, null_safe_join
from cairn.operators.prefix import durable, grouped_prefix

#: Up to so many distinct (group, value) pairs, at a few dozen bytes each, are ranked in place and broadcast.
FEW_PAIRS = 100_000


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows under ``order`` then ``tie_break`` (ascending).

    Planned as ``TakeOrderedAndProject``: each task keeps its own best
    ``k`` rows, so no full sort or shuffle of the input happens.  Always
    pass a tie-break that makes the order total, otherwise rows tied at
    the cut are chosen arbitrarily.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    cols += [F.col(c).asc() for c in tie_break]
    return df.orderBy(*cols).limit(k)


def rank_within(df: DataFrame, partition_by: Sequence[str], order_col: str, ascending: bool = False,
                name: str = "rank", method: str = "dense", num_partitions: int | None = None,
                strategy: str = "range") -> DataFrame:
    """Add the rank of ``order_col`` inside each ``partition_by`` group.

    ``method``: ``"dense"`` (``dense_rank``: ties share a rank, no gaps) or
    ``"min"`` (``rank``: ties share a rank, gaps after ties).  Nulls order
    first ascending and last descending, as in SQL windows.

    ``strategy="window"`` is the textbook ``dense_rank() over (partition by
    g order by v)``: one shuffle, but every group is sorted inside a single
    task, which fails when one group holds a large share of the rows.

    ``strategy="range"`` (default) never puts a group in one task: rows are
    reduced to distinct ``(group, value)`` pairs with their number (partial
    aggregation shrinks hot groups early).  Up to ``FEW_PAIRS`` pairs, counted,
    are ranked by a window over them; beyond, a prefix sum over the pairs,
    range-partitioned by ``(group, value)``, gives each its rank
    (:func:`cairn.operators.prefix.grouped_prefix`).  The ranks, one row per
    pair, are joined back.  Keys keep their types throughout, and the join
    is a left join: no row is lost.  The ranks are kept durably and
    broadcast if they measure small, in which case the rows are not
    shuffled at all.  The input is read twice.
    """
    part = list(partition_by)
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    if strategy == "window":
        fn = F.dense_rank() if method == "dense" else F.rank()
        w = Window.partitionBy(*part).orderBy(order)
        return df.withColumn(name, fn.over(w).cast("bigint"))
    if strategy != "range":
        raise ValueError(f"unknown strategy {strategy!r}")
    if method not in ("dense", "min"):
        raise ValueError(f"unknown method {method!r}")
    pairs = durable(df.groupBy(*part, order_col).agg(F.count(F.lit(1)).alias("_mult")))
    if num_partitions is None and pairs.count() <= FEW_PAIRS:
        # so few pairs fit in one task even if all are of one group; they are one row per pair, not the rows
        w = Window.partitionBy(*part).orderBy(order)
        value = F.row_number().over(w) if method == "dense" else F.coalesce(
            F.sum("_mult").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
        few = F.broadcast(durable(pairs.select(*part, order_col, value.cast("bigint").alias(name))))
        return null_safe_join(df.drop(name) if name in df.columns else df, few, [*part, order_col], how="left")
    placed = grouped_prefix(pairs, [order], group=part, sums={"_before": "_mult"}, index="_dense", width=num_partitions)
    value = F.col("_dense") if method == "dense" else F.col("_before")
    ranks = broadcast_if_small(durable(placed.select(*part, order_col, (value + 1).cast("bigint").alias(name))))
    return null_safe_join(df.drop(name) if name in df.columns else df, ranks, [*part, order_col], how="left")
