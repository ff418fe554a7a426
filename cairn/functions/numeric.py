"""Column expressions: rounding, differences, bands, row totals, ratios.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage code generation; nothing here calls Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: ColumnLike, scale: int = 2) -> Column:
    """Round a double half-up on its decimal text, returned as double.

    A plain ``round`` on a double rounds the decimal text in Spark but the
    binary value in other engines, so results on a half (1.005, 2.675)
    disagree.  Going through a decimal (8 digits after the point, or
    ``scale`` if more) makes the rounding decimal and the same everywhere.  From 2**53 on every double is an integer, so
    rounding is the identity: such values, infinities and NaN are returned
    unchanged instead of overflowing the decimal.
    """
    x = _col(c)
    digits = max(scale, 8)
    if digits > 30:
        raise ValueError("scale must be 30 at most")
    # values of 2**53 and more are integers; with many decimals, smaller ones already are at their last digit
    exact = F.isnan(x) | (F.abs(x) >= F.lit(min(float(2**53), 10.0 ** (36 - digits))))
    kind = f"decimal({min(38, 20 + digits)},{digits})"
    return F.when(exact, x.cast("double")).otherwise(F.round(x.cast(kind), scale).cast("double"))


def difference(df: DataFrame, a: str, b: str, name: str, scale: int | None = 2) -> DataFrame:
    """Add ``name = a - b`` (rounded to ``scale`` decimals unless ``scale`` is None)."""
    diff = F.col(a) - F.col(b)
    return df.withColumn(name, rounded(diff, scale) if scale is not None else diff)


def band_expr(c: ColumnLike, bands: Sequence[tuple[float | None, float | None, str]],
              default: str | None = None) -> Column:
    """Label a value by inclusive ranges ``(lo, hi, label)``; ``None`` bound = open.

    Ranges are tested in order; a value matching none (including null) gets
    ``default``, which is null unless given.
    """
    value = _col(c)
    expr = None
    for lo, hi, label in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (value >= F.lit(lo))
        if hi is not None:
            cond = cond & (value <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default).cast("string")
    return expr.otherwise(F.lit(default).cast("string"))


def band(df: DataFrame, col: str, bands: Sequence[tuple[float | None, float | None, str]], name: str,
         default: str | None = None) -> DataFrame:
    """Add a band label column (see :func:`band_expr`)."""
    return df.withColumn(name, band_expr(col, bands, default))


def add_total(df: DataFrame, cols: Iterable[str], name: str = "total") -> DataFrame:
    """Add the row sum of ``cols`` (null parts count as 0)."""
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in cols]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.withColumn(name, total)


def mean_from_totals(total: ColumnLike, n: ColumnLike, scale: int | None = 2) -> Column:
    """``total / n`` as a double, null when ``n`` is 0, optionally rounded."""
    ratio = F.try_divide(_col(total).cast("double"), _col(n).cast("double"))
    return rounded(ratio, scale) if scale is not None else ratio
