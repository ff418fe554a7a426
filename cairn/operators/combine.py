"""Merging tables: n-ary outer merge, lookup enrichment, appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest table, in bytes of its values, that is ever broadcast by choice.
BROADCAST_MAX_BYTES = 32 * 2**20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its values measure at most ``max_bytes``; else leave the join to AQE.

    The measure is one aggregate over all rows (16 bytes a value, plus the
    length of its text), summed per task before the shuffle.  ``df`` is read
    for it, so pass a frame that is durable or cheap to read.
    """
    size = reduce(lambda a, b: a + b, [F.lit(16) + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
                                       for c in df.columns])
    measured = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if measured <= max_bytes else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on same-named ``keys`` where null matches null; keeps the left key columns."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def outer_merge(dfs: Sequence[DataFrame], keys: Sequence[str], fill: object = None,
                strategy: str = "join") -> DataFrame:
    """Full outer merge of tables on ``keys``.

    Result: one row per key present in any input, the keys once (coalesced),
    then every input's value columns; a value column is null (or ``fill``)
    where its input lacks the key.  Rows whose key contains a null are never
    matched with other inputs, as in a SQL full outer join.

    ``strategy="join"`` (default) chains full outer joins; repeated keys
    pair as a join pairs them.  ``strategy="union"`` stacks the inputs and
    groups once: one shuffle for any number of inputs, with partial
    aggregation.  It is meant for inputs with at most one row per key
    (grouped aggregates); that is checked in the plan, and a repeated key
    fails the job instead of losing a row.
    """
    keys = list(keys)
    value_cols: list[str] = []
    for d in dfs:
        for c in d.columns:
            if c not in keys:
                if c in value_cols:
                    raise ValueError(f"value column {c!r} appears in more than one input")
                value_cols.append(c)

    if strategy == "join":
        merged = reduce(lambda a, b: a.join(b, on=keys, how="full"), dfs)
    elif strategy == "union":
        any_null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        parts = []
        for i, d in enumerate(dfs):
            own = [c for c in d.columns if c not in keys]
            alone = F.when(any_null_key, F.struct(F.lit(i).alias("side"), F.monotonically_increasing_id().alias("row")))
            parts.append(d.select(*keys, *own, alone.alias("_alone"), F.lit(i).alias("_side")))
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        grouped = stacked.groupBy(*keys, "_alone").agg(
            *[F.any_value(F.when(F.col("_side") == i, F.struct(*[F.col(c) for c in d.columns if c not in keys])), True)
              .alias(f"_v{i}") for i, d in enumerate(dfs) if set(d.columns) - set(keys)],
            *[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(dfs))])
        most = F.greatest(*[F.col(f"_n{i}") for i in range(len(dfs))], F.lit(0))
        checked = F.when(most > 1, F.raise_error(F.lit("outer_merge(strategy='union'): an input repeats a key"))).otherwise(most)
        merged = grouped.withColumn("_checked", checked).where("_checked >= 0").select(
            *keys, *[F.col(f"_v{i}.{c}").alias(c) for i, d in enumerate(dfs) for c in d.columns if c not in keys])
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    merged = merged.select(*keys, *value_cols)
    if fill is not None:
        types = dict(merged.dtypes)
        merged = merged.select(*keys, *[F.coalesce(F.col(c), F.lit(fill).cast(types[c])).alias(c)
                                        for c in value_cols])
    return merged


def lookup_enrich(df: DataFrame, dim: DataFrame, on: str, take: str, dim_key: str | None = None,
                  default: object = None, name: str | None = None, resolve: str = "min") -> DataFrame:
    """Add ``dim[take]`` to every row of ``df`` by key, keeping unmatched rows.

    The dimension is reduced to one value per key **before** the join
    (``resolve`` = ``min``/``max`` picks among codes that share a key), so
    the join cannot fan out and no de-duplication is needed afterwards.
    Unmatched rows get ``default``.  Nothing runs while the plan is built:
    AQE broadcasts the reduced dimension if its shuffle turns out small, and
    splits hot keys otherwise.
    """
    dim_key = dim_key or on
    name = name or take
    pick = {"min": F.min, "max": F.max}[resolve]
    reduced = (dim.where(F.col(dim_key).isNotNull())
               .groupBy(F.col(dim_key).alias("_lk_key")).agg(pick(take).alias("_lk_val")))
    joined = df.join(reduced, F.col(on) == F.col("_lk_key"), "left").drop("_lk_key")
    value: Column = F.col("_lk_val")
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    return joined.withColumn(name, value).drop("_lk_val")


def append_rows(first: DataFrame, second: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """UNION ALL by column name (after optional renames of ``second``).

    Matching by name avoids the positional pitfall of ``union`` when the two
    sides call a column differently; compatible types are widened
    (``int`` with ``bigint`` gives ``bigint``).
    """
    if rename:
        second = second.withColumnsRenamed(rename)
    return first.unionByName(second)
