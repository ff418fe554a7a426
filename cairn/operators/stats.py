"""Correlation and hypothesis tests as distributed aggregates.

Each test is a grouped aggregate of sufficient statistics (counts, means,
variances, co-moments) computed by Spark over all rows, followed by a tiny
finisher over the aggregated rows (one per test, or one per segment with
``by=``).  No input row reaches the driver; the only Python in the plan is
the p-value finisher (:mod:`cairn.functions.distributions`), which sees
only aggregated rows.

Every test returns ``p_value`` and ``reject_null = p_value < alpha``.
Perfect evidence is decided: |r| = 1, or a difference without any variance
within, gives an infinite statistic and p = 0.  Inputs without evidence (a
constant column, a one-member group, no variance at all) produce null
statistics instead of raising.  Results are rounded only if ``scale`` says so.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.distributions import f_test_p, r_critical_col, t_test_p
from cairn.functions.numeric import rounded
from cairn.operators.combine import broadcast_if_small, null_safe_join
from cairn.operators.prefix import durable
from cairn.session import ship_by_value

ship_by_value(__name__)

INFINITY = float("inf")
#: Up to so many columns the moments are built-in aggregates; sums that a task holds before it passes them on.
FEW, HELD_SUMS = 6, 1_000_000


def _r(c: Column, scale: int | None) -> Column:
    return rounded(c, scale) if scale is not None else c


def _pair_moments(x: str, y: str, tag: str) -> list[Column]:
    """Aggregates for the Pearson r of x, y over rows where both are present."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return [
        F.count_if(both).alias(f"n_{tag}"),
        F.covar_pop(F.col(x), F.col(y)).alias(f"c_{tag}"),
        F.var_pop(F.when(both, F.col(x))).alias(f"vx_{tag}"),
        F.var_pop(F.when(both, F.col(y))).alias(f"vy_{tag}"),
    ]


def _pair_r(tag: str) -> Column:
    return F.try_divide(F.col(f"c_{tag}"), F.sqrt(F.col(f"vx_{tag}") * F.col(f"vy_{tag}")))


def _grouped(df: DataFrame, by: Sequence[str], aggs: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _moment_rows(cols: list[str], by: list[str], shift: list[float], listwise: bool):
    """Per task and segment: sums, squares and products of every pair over the rows where both are present."""
    k = len(cols)
    names = [*by, "a", "b", "n", "sa", "sb", "qa", "qb", "p"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list[np.ndarray]] = {}
        i, j = (v.ravel() for v in np.indices((k, k)))

        def flush() -> Iterator[pd.DataFrame]:
            for key, (n, s, q, p) in held.items():
                out = pd.DataFrame({"a": i, "b": j, "n": n.ravel().astype("int64"), "sa": s.ravel(), "sb": s.T.ravel(),
                                    "qa": q.ravel(), "qb": q.T.ravel(), "p": p.ravel()})
                for name, v in zip(by, key):
                    out[name] = pd.Series([v] * len(out), dtype=object)
                yield out[names]
            held.clear()

        for batch in batches:
            parts = batch.groupby(by, dropna=False, sort=False) if by else [((), batch)]
            for key, part in parts:
                x = part[cols].to_numpy(dtype=np.float64)
                there = ~np.isnan(x)
                if listwise:
                    there &= there.all(axis=1, keepdims=True)
                d, m = np.where(there, x - np.asarray(shift), 0.0), there.astype(np.float64)
                # as Python objects: a missing key of any type is one key
                key = tuple(None if pd.isna(v) else v for v in key)
                sums = [m.T @ m, d.T @ m, (d * d).T @ m, d.T @ d]
                held[key] = [s + t for s, t in zip(held[key], sums)] if key in held else sums
                if len(held) * k * k > HELD_SUMS:  # partial sums go on; they are added up after the shuffle
                    yield from flush()
        yield from flush()

    return run


def _few_columns(source: DataFrame, cols: list[str], by: list[str], scale: int | None, listwise: bool) -> DataFrame:
    """Rows (x, y, n, r) of every pair from built-in aggregates.

    Merged variances of a constant column are rounding noise: a spread below 1e-13 of the values' size is none.
    """
    if listwise:
        source = source.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)))
    names = {(i, j): f"{i}_{j}" for i in range(len(cols)) for j in range(i, len(cols))}
    plain = [f"__c{i}" for i in range(len(cols))]
    narrow = source.select(*by, *(F.col(f"`{c}`").alias(p) for c, p in zip(cols, plain)))
    sums = _grouped(narrow, by, [
        *(m for (i, j), tag in names.items() for m in _pair_moments(plain[i], plain[j], tag)),
        *(F.avg(F.col(p) * F.col(p)).alias(f"q_{i}") for i, p in enumerate(plain))])

    def pair(i: int, j: int) -> Column:
        tag = names[min(i, j), max(i, j)]
        own = _pair_r(tag)
        r = F.lit(1.0) if i == j else F.greatest(F.lit(-1.0), F.least(own, F.lit(1.0)))
        first, second = min(i, j), max(i, j)
        known = ((F.col(f"vx_{tag}") > F.col(f"q_{first}") * 1e-26) & (F.col(f"vy_{tag}") > F.col(f"q_{second}") * 1e-26)
                 & own.isNotNull() & ~F.isnan(own))
        return F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"), F.col(f"n_{tag}").alias("n"),
                        _r(F.when(known, r), scale).alias("r"))

    cells = F.array(*(pair(i, j) for i in range(len(cols)) for j in range(len(cols))))
    return sums.select(*by, F.explode(cells).alias("__x")).select(*by, "__x.x", "__x.y", "__x.n", "__x.r")


def pearson_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), scale: int | None = None,
                   shape: str = "long", missing: str = "pairwise") -> DataFrame:
    """Pearson correlation of every pair of ``cols``.

    Up to ``FEW`` columns every pair is a handful of built-in aggregates, which stay in the JVM and combine before the
    shuffle.  Beyond, one pass forms the moments of all pairs as matrix products of Arrow batches, centred on the
    columns' means (one cheap aggregate before) so that nothing cancels; each task emits one row per pair and segment,
    which are summed.  The cost of wide tables is then that of a matrix product, not of one aggregate per pair.  A
    constant column gives ``r = null``.

    A missing value is null or NaN.  ``missing="pairwise"`` (default) correlates each pair over the rows where both values
    are present; ``"listwise"`` keeps only rows where all ``cols`` are present (what an assembled feature vector with
    invalid rows skipped gives); ``"error"`` fails the job at the first missing value (what such a vector does by default).

    ``shape="long"``: rows ``(x, y, n, r)``; ``shape="wide"``: one row per
    ``x`` with one ``r`` column per variable, like the printed k×k matrix.
    """
    cols, by = list(cols), list(by)
    if shape == "wide":
        long = pearson_matrix(df, cols, by, scale, shape="long", missing=missing)
        return long.groupBy(*by, "x").pivot("y", cols).agg(F.first("r"))
    if missing not in ("pairwise", "listwise", "error"):
        raise ValueError(f"unknown missing-value rule {missing!r}")
    given = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols]
    if missing == "error":
        stop = [F.raise_error(F.lit(f"pearson_matrix: a value of {c} is missing")).cast("double") for c in cols]
        given = [F.when(v.isNotNull(), v).otherwise(e) for v, e in zip(given, stop)]
    source = df.select(*by, *(v.alias(c) for v, c in zip(given, cols)))
    if len(cols) <= FEW:
        return _few_columns(source, cols, by, scale, missing == "listwise")
    means = source.agg(*[F.avg(F.when(F.abs(F.col(c)) < INFINITY, F.col(c))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    types = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in by), "a int, b int, n long, sa double, sb double, qa double, qb double, p double"])
    shift = [float(m) if m is not None else 0.0 for m in means]
    rows = source.mapInPandas(_moment_rows(cols, by, shift, missing == "listwise"), schema)
    total = rows.groupBy(*by, "a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "p")])
    if not by:  # also without any row
        blank = df.sparkSession.range(len(cols) ** 2).select(
            F.floor(F.col("id") / len(cols)).cast("int").alias("a"), (F.col("id") % len(cols)).cast("int").alias("b"))
        total = blank.join(total, ["a", "b"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    mean_a, mean_b = F.try_divide(F.col("sa"), F.col("n")), F.try_divide(F.col("sb"), F.col("n"))
    va, vb = F.col("qa") - F.col("sa") * mean_a, F.col("qb") - F.col("sb") * mean_b
    # a variance that is rounding noise beside the values' size is none
    flat = (va <= F.col("qa") * 1e-14) | (vb <= F.col("qb") * 1e-14)
    r = F.when(~flat, F.try_divide(F.col("p") - F.col("sa") * mean_b, F.sqrt(va * vb)))
    r = F.when(F.col("a") == F.col("b"), F.when(~flat, F.lit(1.0))).otherwise(
        F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(r, F.lit(1.0)))))
    r = F.when(flat, F.lit(None).cast("double")).otherwise(r)
    label = F.array(*[F.lit(c) for c in cols])
    return total.select(*by, F.get(label, F.col("a")).alias("x"), F.get(label, F.col("b")).alias("y"), "n", _r(r, scale).alias("r"))


def pearson_test(df: DataFrame, x: str, y: str, alpha: float = 0.05, alternative: str = "two-sided",
                 by: Sequence[str] = (), scale: int | None = None, critical: bool = False) -> DataFrame:
    """Test for correlation of ``x`` and ``y``: ``r``, ``t = r·sqrt((n-2)/(1-r²))``, p.

    ``alternative`` is ``"two-sided"``, ``"greater"`` (positive
    correlation) or ``"less"``; the decision follows it, rather than
    comparing ``|r|`` with a one-tailed critical value.  ``critical=True``
    adds ``r_critical``, the smallest ``|r|`` significant at ``alpha`` for
    the row's ``n`` (for n = 4600, α = .05, one-tailed: 0.02426).
    """
    by = list(by)
    stats = _grouped(df, by, _pair_moments(x, y, "xy"))
    r = _pair_r("xy")
    n = F.col("n_xy")
    dof = n - 2
    t = r * F.sqrt(F.try_divide(dof.cast("double"), F.lit(1.0) - r * r))
    t = F.when((F.abs(r) >= 1.0) & (dof > 0), F.signum(r) * INFINITY).otherwise(t)
    out = stats.select(*by, F.lit(x).alias("x"), F.lit(y).alias("y"), n.alias("n"), r.alias("_r"),
                       t.alias("_t"), dof.alias("df"))
    out = out.withColumn("_p", t_test_p(F.col("_t"), F.col("df"), alternative))
    extra = [_r(r_critical_col(F.col("n"), alpha, alternative), scale).alias("r_critical")] if critical else []
    return out.select(*by, "x", "y", "n", _r(F.col("_r"), scale).alias("r"), _r(F.col("_t"), scale).alias("t"),
                      "df", _r(F.col("_p"), scale).alias("p_value"), (F.col("_p") < alpha).alias("reject_null"),
                      *extra)


def welch_t(df: DataFrame, value: str, group: str, a: object, b: object, alpha: float = 0.05,
            alternative: str = "two-sided", by: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """Welch's two-sample t-test (unequal variances) of group ``a`` against ``b``.

    The statistic is ``mean(a) - mean(b)`` over its standard error, so the
    sign follows the argument order.  Both groups' n, mean and variance
    come from one conditional aggregate (no pivot, no join).  Nulls are
    skipped; a group with fewer than two values, or equal means without any
    variance, gives null ``t`` and ``p``; different means without any
    variance give an infinite ``t`` and ``p = 0``.
    """
    by = list(by)
    va = F.when(F.col(group) == F.lit(a), F.col(value))
    vb = F.when(F.col(group) == F.lit(b), F.col(value))
    stats = _grouped(df.where(F.col(group).isin(a, b)), by, [
        F.count(va).alias("n_a"), F.avg(va).alias("mean_a"), F.var_samp(va).alias("var_a"),
        F.count(vb).alias("n_b"), F.avg(vb).alias("mean_b"), F.var_samp(vb).alias("var_b"),
    ])
    sa = F.try_divide(F.col("var_a"), F.col("n_a"))
    sb = F.try_divide(F.col("var_b"), F.col("n_b"))
    se2 = sa + sb
    apart = F.col("mean_a") - F.col("mean_b")
    certain = (se2 == 0) & (apart != 0)  # means differ, nothing varies
    t = F.when(certain, F.signum(apart) * INFINITY).otherwise(F.try_divide(apart, F.sqrt(se2)))
    dof = F.try_divide(se2 * se2, F.try_divide(sa * sa, F.col("n_a") - 1) + F.try_divide(sb * sb, F.col("n_b") - 1))
    dof = F.when(certain, (F.col("n_a") + F.col("n_b") - 2).cast("double")).otherwise(dof)
    out = stats.select(*by, F.lit(str(a)).alias("group_a"), F.lit(str(b)).alias("group_b"), "n_a", "n_b",
                       "mean_a", "mean_b", t.alias("_t"), dof.alias("_df"))
    out = out.withColumn("_p", t_test_p(F.col("_t"), F.col("_df"), alternative))
    return out.select(*by, "group_a", "group_b", "n_a", "n_b", _r(F.col("mean_a"), scale).alias("mean_a"),
                      _r(F.col("mean_b"), scale).alias("mean_b"), _r(F.col("_t"), scale).alias("t"),
                      _r(F.col("_df"), scale).alias("df"), _r(F.col("_p"), scale).alias("p_value"),
                      (F.col("_p") < alpha).alias("reject_null"))


def group_summary(df: DataFrame, value: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group n, mean and sample variance of ``value`` (nulls skipped)."""
    return (df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
            .groupBy(*by, group)
            .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var")))


def _anova_from_groups(groups: DataFrame, by: Sequence[str], alpha: float, scale: int | None) -> DataFrame:
    """One-way ANOVA from per-group (n, mean, var) rows, one result per ``by``.

    The group table (one row per group) is needed twice — for the segment
    totals (N, k, grand mean) and to centre each group mean — so it is kept
    durably: the input is scanned once, and anew at every call.  With ``by`` the totals (one row per
    segment) are joined back on ``by``; without, the single totals row is
    attached as a scalar subquery (no join).  No step gathers all groups of
    a segment into one task, even for an ANOVA over millions of groups.
    """
    by = list(by)
    groups = durable(groups)
    sums = [F.sum("n").alias("_N"), F.count(F.lit(1)).alias("_k"),
            F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_grand")]
    if by:
        with_totals = null_safe_join(groups, groups.groupBy(*by).agg(*sums), by)
    else:
        totals = groups.agg(F.struct(*sums).alias("_t")).scalar()
        with_totals = groups.select("*", totals.alias("_t")).select("*", "_t._N", "_t._k", "_t._grand")
    dev = F.col("mean") - F.col("_grand")
    ss = _grouped(with_totals, by, [
        F.max("_k").alias("k"), F.max("_N").alias("n"),
        F.sum(F.col("n") * dev * dev).alias("_ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("_ssw"),
    ])
    df1 = F.col("k") - 1
    df2 = F.col("n") - F.col("k")
    f = F.try_divide(F.try_divide(F.col("_ssb"), df1), F.try_divide(F.col("_ssw"), df2))
    f = F.when((F.col("_ssw") == 0) & (F.col("_ssb") > 0) & (df1 > 0) & (df2 > 0), F.lit(INFINITY)).otherwise(f)
    out = ss.select(*by, "k", "n", df1.alias("df_between"), df2.alias("df_within"), "_ssb", "_ssw", f.alias("_f"))
    out = out.withColumn("_p", f_test_p(F.col("_f"), F.col("df_between"), F.col("df_within")))
    return out.select(*by, "k", "n", "df_between", "df_within", _r(F.col("_ssb"), scale).alias("ss_between"),
                      _r(F.col("_ssw"), scale).alias("ss_within"), _r(F.col("_f"), scale).alias("f"),
                      _r(F.col("_p"), scale).alias("p_value"), (F.col("_p") < alpha).alias("reject_null"))


def anova_oneway(df: DataFrame, value: str, group: str, groups: Sequence[object] | None = None,
                 by: Sequence[str] = (), alpha: float = 0.05, scale: int | None = None) -> DataFrame:
    """One-way ANOVA of ``value`` across the groups of ``group``.

    ``groups`` restricts the test to the named groups (others ignored).
    With ``by``, one ANOVA per segment runs in the same job.  SSB is formed
    from centred group means (never from raw sums of squares), SSW from the
    group variances; a one-member group contributes no within variance.
    """
    src = df if groups is None else df.where(F.col(group).isin(list(groups)))
    return _anova_from_groups(group_summary(src, value, group, by), by, alpha, scale)


def anova_columns(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), alpha: float = 0.05,
                  scale: int | None = None) -> DataFrame:
    """One-way ANOVA treating each of ``cols`` as a group (wide table → long)."""
    by = list(by)
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids=by, values=list(cols), variableColumnName="_column", valueColumnName="_value")
    return anova_oneway(long, "_value", "_column", by=by, alpha=alpha, scale=scale)


def check_assumptions(df: DataFrame, value: str, group: str, by: Sequence[str] = (), alpha: float = 0.05,
                      scale: int | None = None) -> DataFrame:
    """Assumption checks before an ANOVA/t-test, as long rows.

    * ``levene`` (one row per segment): equal variances — the ANOVA of
      ``|x - group mean|`` (Levene's original, mean-centred form);
    * ``jarque_bera`` (one row per group): normality —
      ``JB = n/6·(skew² + excess_kurtosis²/4)``, ``p = exp(-JB/2)``, with
      population skewness and excess kurtosis.

    Columns: ``by..., test, group, n, statistic, p_value, reject_null``.
    The group means (one row per group) are kept durably and joined back to
    the rows: broadcast if they measure small, so that the rows are not
    shuffled, and by a shuffle join (with skew splitting) otherwise.
    """
    by = list(by)
    clean = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    # one aggregate gives both the group means (for Levene) and the shape moments (for Jarque-Bera)
    shape = durable(clean.groupBy(*by, group).agg(F.count(value).alias("n"), F.avg(value).alias("_gmean"),
                                                  F.skewness(value).alias("_s"), F.kurtosis(value).alias("_k")))
    keyed = null_safe_join(clean, broadcast_if_small(shape.select(*by, group, "_gmean")), [*by, group])
    deviations = keyed.select(*by, group, F.abs(F.col(value) - F.col("_gmean")).alias("_dev"))
    lev = anova_oneway(deviations, "_dev", group, by=by, alpha=alpha, scale=None)
    levene = lev.select(*by, F.lit("levene").alias("test"), F.lit(None).cast("string").alias("group"), "n",
                        _r(F.col("f"), scale).alias("statistic"), _r(F.col("p_value"), scale).alias("p_value"),
                        "reject_null")
    jb = F.col("n") / 6.0 * (F.col("_s") * F.col("_s") + F.col("_k") * F.col("_k") / 4.0)
    jarque = shape.select(*by, F.lit("jarque_bera").alias("test"), F.col(group).cast("string").alias("group"), "n",
                          jb.alias("_jb")).withColumn("_p", F.exp(-F.col("_jb") / 2.0))
    jarque = jarque.select(*by, "test", "group", "n", _r(F.col("_jb"), scale).alias("statistic"),
                           _r(F.col("_p"), scale).alias("p_value"), (F.col("_p") < alpha).alias("reject_null"))
    return levene.unionByName(jarque)
