"""Missing values, token replacement and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

OrderSpec = Sequence[str | tuple[str, bool]]


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column, ``{column: value}``; the column keeps its type.

    Unlike ``na.fill`` this never skips a column silently: the fill value is
    cast to the column's type (a type that cannot hold it raises at
    analysis time under ANSI mode).
    """
    types = dict(df.dtypes)
    out = df
    for name, value in values.items():
        if name not in types:
            raise KeyError(f"no column {name!r}")
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value).cast(types[name])))
    return out


def replace_token(df: DataFrame, col: str, old: str, new: str, whole: bool = True, regex: bool = False,
                  name: str | None = None) -> DataFrame:
    """Replace ``old`` by ``new`` in a string column.

    ``whole=True`` (default) replaces only cells equal to ``old`` — the
    token ``NA`` must not turn ``CANADA`` into ``CANODA``.  ``whole=False``
    replaces every occurrence inside the text, literally unless ``regex``.
    """
    c = F.col(col)
    if whole:
        expr = F.when(c == F.lit(old), F.lit(new)).otherwise(c)
    elif regex:
        expr = F.regexp_replace(c, old, new)
    else:
        expr = F.replace(c, F.lit(old), F.lit(new))
    return df.withColumn(name or col, expr)


def _order_pairs(order_by: OrderSpec) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order_by]


def _descending_key(name: str, dtype: DataType) -> Column | None:
    """An expression whose ascending order is the descending order of ``name``.

    Numbers, booleans, dates and timestamps are negated; strings are turned
    into the hex text of their UTF-8 bytes with every digit complemented
    (0↔F, 1↔E, …) followed by a terminator that sorts above every digit, so
    byte-wise order — Spark's string order — is reversed, prefixes included
    ("abc" before "ab").  ``None`` for types without such a key.
    """
    c = F.col(name)
    if isinstance(dtype, BooleanType):
        return -c.cast("int")
    if isinstance(dtype, NumericType):
        return -c
    if isinstance(dtype, DateType):
        return -F.unix_date(c)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, StringType):
        return F.concat(F.translate(F.hex(F.encode(c, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"),
                        F.lit("Z"))
    return None


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: OrderSpec, strategy: str = "window") -> DataFrame:
    """Keep one row per ``keys``: the first under ``order_by``.

    ``order_by`` holds column names (ascending) or ``(name, ascending)``
    pairs; nulls sort first ascending and last descending, as in SQL
    windows.  Rows tied on the whole order are broken by the remaining
    columns, so the survivor never depends on partitioning or task timing.

    Both strategies reduce a hot key before the shuffle, so a key holding a
    third of the rows is never sorted in a single task:

    * ``"window"`` (default): ``row_number() = 1`` over ``keys``.  Spark
      plans it with a partial ``WindowGroupLimit`` below the exchange (each
      map task keeps only its first row per key) and a final one after it
      — see ``spark.sql.optimizer.windowGroupLimitThreshold`` (default 1000;
      it must not be disabled).  Ties beyond ``order_by`` go to the
      remaining columns, ascending.
    * ``"aggregate"``: a grouped ``min``/``max`` over a struct led by the
      sort columns — map-side partial aggregation, independent of any
      optimizer setting, but a sort aggregate (slower on wide rows).  Mixed
      directions use order-reversing keys (:func:`_descending_key`); ties go
      to the remaining columns, ascending (descending when every sort column
      is descending).
    """
    keys = list(keys)
    order = _order_pairs(order_by)
    order_names = [n for n, _ in order]
    rest = [c for c in df.columns if c not in keys and c not in order_names]
    types = {f.name: f.dataType for f in df.schema.fields}

    def by_window() -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(m).asc() if a else F.col(m).desc() for m, a in order], *[F.col(c).asc() for c in rest])
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")

    if strategy == "window":
        return by_window()
    if strategy != "aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")

    all_asc = all(a for _, a in order)
    all_desc = all(not a for _, a in order)
    fields: list[Column] = []
    negated: list[str] = []
    if all_asc or all_desc:
        fields = [F.col(n).alias(f"_o{i}") for i, n in enumerate(order_names)]
        pick = F.min if all_asc else F.max
    else:
        pick = F.min
        for i, (n, asc) in enumerate(order):
            if asc:
                fields.append(F.col(n).alias(f"_o{i}"))
                continue
            key = _descending_key(n, types[n])
            if key is None:  # no order-reversing key for this type (arrays, maps, structs)
                return by_window()
            fields.append(F.col(n).isNull().alias(f"_n{i}"))  # descending: nulls last
            fields.append(key.alias(f"_o{i}"))
            negated.append(n)

    # sort fields first; payload holds only what the sort fields do not carry as is
    payload = [F.col(c).alias(f"_v_{c}") for c in negated + rest]
    best = df.groupBy(*keys).agg(pick(F.struct(*fields, *payload)).alias("_best"))
    source = {n: f"_best._o{i}" for i, n in enumerate(order_names)}
    source.update({c: f"_best._v_{c}" for c in negated + rest})
    return best.select(*keys, *[F.col(source[c]).alias(c) for c in order_names + rest]).select(*df.columns)
