"""Composite recipes built from the operators.

``category_table`` is the reference's medal table generalised: count each
category value per key (optionally counting each distinct combination of
``distinct_on`` once, as team medals are counted once per event), add the
row total, and rank the keys by that total inside a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.numeric import add_total
from cairn.operators.aggregate import category_counts
from cairn.operators.prefix import durable
from cairn.operators.ranking import rank_within


def category_table(df: DataFrame, keys: Sequence[str], category: str, values: Sequence[object],
                   names: Sequence[str] | None = None, distinct_on: Sequence[str] | None = None,
                   total: str = "total", rank_by: Sequence[str] | None = None, rank_name: str = "rank",
                   attach: DataFrame | None = None) -> DataFrame:
    """Per key: one count column per category value, their total, and optionally a rank.

    * ``distinct_on`` — columns whose distinct combinations are counted
      once (must contain ``keys`` and ``category``);
    * ``attach`` — a table joined to the counts on ``keys`` before ranking
      (e.g. a key's segment); keys without an attached row stay, with nulls,
      and a repeated attached key fails the job;
    * ``rank_by`` — the groups inside which keys are dense-ranked by the
      total, descending (skew-safe, see :func:`rank_within`).
    """
    names = list(names) if names is not None else [str(v) for v in values]
    source = df.select(*distinct_on).dropDuplicates() if distinct_on else df
    table = add_total(category_counts(source, keys, category, values, names), names, total)
    if attach is not None:
        others = [c for c in attach.columns if c not in keys]
        single = attach.groupBy(*keys).agg(F.any_value(F.struct(*others)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        checked = F.when(F.col("_n") > 1, F.raise_error(F.lit("category_table: attach repeats a key"))).otherwise(F.col("_n"))
        single = single.withColumn("_n", checked).where("_n > 0").select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
        table = table.join(single, on=list(keys), how="left")
    if rank_by is not None:
        # one row per key, needed for both passes of the rank: computed once
        table = rank_within(durable(table), list(rank_by), total, ascending=False, name=rank_name)
    return table
