"""Several levels of aggregation from one pass, mergeable sketches, and set operations with multiplicities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.prefix import durable


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All subsets of ``keys``, the whole first."""
    n = len(keys)
    return [tuple(k for i, k in enumerate(keys) if not (level >> (n - 1 - i)) & 1) for level in range(2 ** n)]


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    """All leading runs of ``keys``, the whole first."""
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def grouping_levels(df: DataFrame, sets: Sequence[Sequence[str]], value: str) -> DataFrame:
    """Count, sum, mean, least and greatest ``value`` for every grouping set, from one scan.

    The rows are aggregated once by all keys; the levels are aggregates of that result, so a row of the input is
    never repeated for a set, and a hot key has been reduced before the first shuffle.  Means come from sums and counts,
    not from means.  ``level`` has a bit for each key (the first key's is the highest) that is 1 where the set lacks the
    key, as SQL's GROUPING_ID: a null key of the data has bit 0, a key that is summed over has bit 1.

    Columns: keys, ``level``, ``n`` (rows), ``n_values``, ``total``, ``mean``, ``least``, ``greatest``.  As in SQL the set
    without keys gives a row even for an empty table; a repeated set gives its rows once.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    levels = sorted({sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s) for s in sets})
    finest = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"), F.sum(value).alias("total"),
        F.min(value).alias("least"), F.max(value).alias("greatest"))
    every = finest.withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    inside = lambda i: F.col("level").bitwiseAND(F.lit(1 << (len(keys) - 1 - i))) == 0
    every = every.withColumns({k: F.when(inside(i), F.col(k)) for i, k in enumerate(keys)})
    out = every.groupBy("level", *keys).agg(*(f(c).alias(c) for f, c in (
        (F.sum, "n"), (F.sum, "n_values"), (F.sum, "total"), (F.min, "least"), (F.max, "greatest"))))
    everything = (1 << len(keys)) - 1
    if everything in levels:  # the grand total of nothing
        spark = df.sparkSession
        blank = spark.range(1).select(F.lit(everything).alias("level"), *(F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys),
                                      F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("n_values"))
        out = out.unionByName(blank, allowMissingColumns=True).groupBy("level", *keys).agg(*(f(c).alias(c) for f, c in (
            (F.sum, "n"), (F.sum, "n_values"), (F.sum, "total"), (F.min, "least"), (F.max, "greatest"))))
    return out.select(*keys, "level", "n", "n_values", "total", F.try_divide(F.col("total"), F.col("n_values")).alias("mean"),
                      "least", "greatest")


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, log2_size: int = 14) -> DataFrame:
    """keys, ``sketch``, ``n``: a HyperLogLog sketch of the distinct values of each group, to be stored and merged later.

    A sketch has at most ``2 ** log2_size`` registers whatever the group's size.  Missing values are not counted.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), log2_size).alias("sketch"), F.count(value).alias("n"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], log2_size: int = 14) -> DataFrame:
    """keys, ``n_distinct`` (estimate), ``error`` (three standard errors, relative), ``n``: from stored sketches.

    The standard error of such a sketch is 1.04 / sqrt(registers), whatever was merged into it.
    """
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("__s"), F.sum("n").alias("n"))
    return merged.select(*keys, F.hll_sketch_estimate("__s").alias("n_distinct"),
                         F.lit(3 * 1.04 / 2 ** (log2_size / 2)).alias("error"), "n")


def compare_tables(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The distinct rows of two tables with ``in_left`` and ``in_right``, how often each holds them.

    One aggregate over both, combined before the shuffle, so a row repeated by the million is one row of it; nulls are
    equal to nulls.  All set operations follow from the two counts (:func:`set_operation`).
    """
    columns = list(columns or left.columns)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.select(*columns, one.alias("in_left"), none.alias("in_right")).unionByName(
        right.select(*columns, none.alias("in_left"), one.alias("in_right")))
    return both.groupBy(*columns).agg(F.sum("in_left").alias("in_left"), F.sum("in_right").alias("in_right"))


def set_operation(left: DataFrame, right: DataFrame, kind: str, keep_all: bool = False,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """INTERSECT, EXCEPT or UNION of two tables, distinct or (``keep_all``) with multiplicities; columns by name."""
    a, b = F.col("in_left"), F.col("in_right")
    times: dict[str, Column] = {"intersect": F.least(a, b), "except": F.greatest(a - b, F.lit(0)), "union": a + b}
    if kind not in times:
        raise ValueError(f"unknown set operation {kind!r}")
    columns = list(columns or left.columns)
    counted = compare_tables(left, right, columns)
    if not keep_all:
        keep = {"intersect": (a > 0) & (b > 0), "except": (a > 0) & (b == 0), "union": F.lit(True)}[kind]
        return counted.where(keep).select(*columns)
    many = counted.withColumn("__n", times[kind]).where("__n > 0")
    return many.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*columns)


def sketch_table(df: DataFrame, keys: Sequence[str], value: str, log2_size: int = 14) -> DataFrame:
    """:func:`distinct_sketches` kept durably, as a table of partial results is."""
    return durable(distinct_sketches(df, keys, value, log2_size))
