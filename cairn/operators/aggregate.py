"""Grouped counting: category counts as columns, frequency top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.ranking import top_k


def category_counts(df: DataFrame, keys: Sequence[str], category: str, values: Sequence[object],
                    names: Sequence[str] | None = None, keep_all_keys: bool = False,
                    shares: bool = False) -> DataFrame:
    """One row per key with one count column per category value.

    Replaces "filter per value → group → full outer join → fill 0" by a
    single grouped aggregate of conditional counts: one scan and one
    shuffle whatever the number of categories, with map-side partial
    aggregation.  Rows are first restricted to the listed categories, so a
    key appears only if it has at least one of them — exactly the keys the
    chained outer joins produce.  ``keep_all_keys=True`` keeps every key of
    ``df`` (all-zero rows included).  ``shares=True`` adds ``<name>_share``
    columns: each count over the key's count of listed categories (null for
    a key without any).
    """
    names = list(names) if names is not None else [str(v) for v in values]
    if len(names) != len(values):
        raise ValueError("names and values differ in length")
    counts = [F.count_if(F.col(category) == F.lit(v)).alias(n) for v, n in zip(values, names)]
    source = df if keep_all_keys else df.where(F.col(category).isin(list(values)))
    out = source.groupBy(*keys).agg(*counts)
    if shares:
        total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
        out = out.select("*", *[F.try_divide(F.col(n).cast("double"), total).alias(f"{n}_share") for n in names])
    return out


def frequency_topk(df: DataFrame, keys: Sequence[str], k: int, where: Column | None = None,
                   distinct_on: Sequence[str] | None = None, label: str | None = None, sep: str = "_",
                   count_name: str = "n") -> DataFrame:
    """The ``k`` most frequent key combinations with their counts.

    * ``where`` filters rows first;
    * ``distinct_on`` counts each distinct combination of those columns once
      (it must include ``keys``);
    * ``label`` adds a display column joining the keys with ``sep`` — for
      display only, grouping is always on the real columns, so key parts
      containing ``sep`` cannot collide.

    Ties at the cut are broken by the keys (ascending), so the result is
    the same on every run.  The count is a partial + final hash aggregate;
    the cut is a ``TakeOrderedAndProject`` that keeps ``k`` rows per task.
    """
    keys = list(keys)
    source = df if where is None else df.where(where)
    if distinct_on:
        missing = [c for c in keys if c not in distinct_on]
        if missing:
            raise ValueError(f"keys {missing} must be part of distinct_on")
        source = source.select(*distinct_on).dropDuplicates()
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    if label:
        counts = counts.withColumn(label, F.concat_ws(sep, *[F.col(c).cast("string") for c in keys]))
    return top_k(counts, [F.col(count_name).desc()], k, tie_break=keys)
