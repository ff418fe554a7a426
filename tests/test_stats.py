import math
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions.distributions import betainc_reg, f_upper_tail, t_tail
from cairn.operators.stats import (anova_columns, anova_oneway, check_assumptions, pearson_matrix, pearson_test,
                                   welch_t)
from frames import rows


def test_f_tail_closed_forms():
    # df1 = 2: p = (d2 / (d2 + 2F))^(d2/2); df1 = 4: x^(d2/2) (1 + d2/2 (1 - x))
    for f, d2 in [(6.1974, 75), (0.3, 10), (2.5, 59995), (1.0, 3)]:
        assert math.isclose(f_upper_tail(f, 2, d2), (d2 / (d2 + 2 * f)) ** (d2 / 2), rel_tol=1e-9)
        x = d2 / (d2 + 4 * f)
        assert math.isclose(f_upper_tail(f, 4, d2), x ** (d2 / 2) * (1 + d2 / 2 * (1 - x)), rel_tol=1e-9)
    assert round(f_upper_tail(2.5, 4, 59995), 6) == 0.040439
    assert round(f_upper_tail(6.1974, 2, 75), 6) == 0.003229


def test_t_tail_closed_forms():
    # df = 1 is Cauchy: two-sided p = 1 - 2 atan(|t|)/pi; df = 2: p = 1 - |t| / sqrt(2 + t^2)
    for t in (0.1, 1.0, 3.7, -2.2):
        assert math.isclose(t_tail(t, 1), 1 - 2 * math.atan(abs(t)) / math.pi, rel_tol=1e-9)
        assert math.isclose(t_tail(t, 2), 1 - abs(t) / math.sqrt(2 + t * t), rel_tol=1e-9)
    assert math.isclose(t_tail(2.0, 10, "greater") + t_tail(2.0, 10, "less"), 1.0, rel_tol=1e-12)
    assert t_tail(float("nan"), 3) is None and t_tail(1.0, 0) is None


def test_betainc_symmetry():
    for a, b, x in [(0.5, 3, 0.2), (30, 2, 0.9), (1000, 0.5, 0.999)]:
        assert math.isclose(betainc_reg(a, b, x), 1 - betainc_reg(b, a, 1 - x), rel_tol=1e-9, abs_tol=1e-14)


def _two_groups(spark, a, b):
    data = [("a", v) for v in a] + [("b", v) for v in b]
    return spark.createDataFrame(data, "g string, x double")


def test_anova_with_two_groups_equals_pooled_t_squared(spark):
    rnd = random.Random(1)
    a = [rnd.gauss(10, 2) for _ in range(30)]
    b = [rnd.gauss(11, 2) for _ in range(20)]
    row = anova_oneway(_two_groups(spark, a, b), "x", "g", scale=None).collect()[0]
    na, nb = len(a), len(b)
    ma, mb = sum(a) / na, sum(b) / nb
    va = sum((v - ma) ** 2 for v in a) / (na - 1)
    vb = sum((v - mb) ** 2 for v in b) / (nb - 1)
    sp2 = ((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)
    t = (ma - mb) / math.sqrt(sp2 * (1 / na + 1 / nb))
    assert math.isclose(row["f"], t * t, rel_tol=1e-9)
    assert math.isclose(row["p_value"], t_tail(t, na + nb - 2), rel_tol=1e-7)
    assert (row["k"], row["n"], row["df_between"], row["df_within"]) == (2, 50, 1, 48)


def test_anova_one_member_group_and_named_groups(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 4.0), ("c", 5.0), ("c", 7.0), ("z", 100.0), ("a", None)]
    df = spark.createDataFrame(data, "g string, x double")
    row = anova_oneway(df, "x", "g", groups=["a", "b", "c"], scale=None).collect()[0]
    # SSB by hand: grand = 22/6; SSW = 2 + 0 + 2
    grand = 22 / 6
    ssb = 3 * (2 - grand) ** 2 + (4 - grand) ** 2 + 2 * (6 - grand) ** 2
    assert math.isclose(row["ss_between"], ssb, rel_tol=1e-12)
    assert math.isclose(row["ss_within"], 4.0, rel_tol=1e-12)
    assert math.isclose(row["f"], (ssb / 2) / (4.0 / 3), rel_tol=1e-12)


def test_anova_by_segment_runs_one_test_per_segment(spark):
    data = [(s, g, float(i % 7 + (3 if g == "x" and s == "s1" else 0))) for s in ("s1", "s2") for g in ("x", "y")
            for i in range(40)]
    df = spark.createDataFrame(data, "s string, g string, v double")
    out = {r["s"]: r for r in anova_oneway(df, "v", "g", by=["s"]).collect()}
    assert out["s1"]["reject_null"] and not out["s2"]["reject_null"]
    assert out["s2"]["f"] == 0.0 and out["s2"]["p_value"] == 1.0


def test_anova_columns_matches_long_form(spark):
    wide = spark.createDataFrame([(1, 3, 5, 2), (2, 4, 1, 2), (3, 9, 2, 2), (4, 1, 1, 3)], "id int, a int, b int, c int")
    long = wide.select(F.expr("stack(3, 'a', cast(a as double), 'b', cast(b as double), 'c', cast(c as double)) "
                              "as (g, v)"))
    assert anova_columns(wide, ["a", "b", "c"]).collect()[0].asDict() == anova_oneway(long, "v", "g").collect()[0].asDict()


def test_welch_identical_and_zero_variance(spark):
    same = welch_t(_two_groups(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0]), "x", "g", "a", "b").collect()[0]
    assert same["t"] == 0.0 and same["p_value"] == 1.0 and same["reject_null"] is False
    flat = welch_t(_two_groups(spark, [2.0, 2.0], [2.0, 2.0]), "x", "g", "a", "b").collect()[0]
    assert flat["t"] is None and flat["p_value"] is None


def test_welch_sign_and_df_against_formula(spark):
    a, b = [20.0, 22.0, 19.0, 24.0, 25.0], [30.0, 28.0, 35.0, 31.0]
    row = welch_t(_two_groups(spark, a, b), "x", "g", "a", "b", scale=None).collect()[0]
    ma, mb = sum(a) / 5, sum(b) / 4
    va = sum((v - ma) ** 2 for v in a) / 4
    vb = sum((v - mb) ** 2 for v in b) / 3
    se2 = va / 5 + vb / 4
    assert math.isclose(row["t"], (ma - mb) / math.sqrt(se2), rel_tol=1e-12) and row["t"] < 0
    assert math.isclose(row["df"], se2 ** 2 / ((va / 5) ** 2 / 4 + (vb / 4) ** 2 / 3), rel_tol=1e-12)


def test_pearson_constant_column_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 3.0), (3.0, 5.0, None)], "x double, c double, y double")
    cells = {(r["x"], r["y"]): r for r in pearson_matrix(df, ["x", "c", "y"], scale=6).collect()}
    assert cells[("x", "c")]["r"] is None
    assert cells[("x", "y")]["n"] == 2 and cells[("x", "y")]["r"] == 1.0
    assert cells[("x", "x")]["r"] == 1.0 and len(cells) == 9


def test_pearson_test_alternatives(spark):
    rnd = random.Random(3)
    data = [(x, x + rnd.gauss(0, 3)) for x in (rnd.uniform(0, 10) for _ in range(200))]
    df = spark.createDataFrame(data, "x double, y double")
    two = pearson_test(df, "x", "y").collect()[0]
    greater = pearson_test(df, "x", "y", alternative="greater").collect()[0]
    less = pearson_test(df, "x", "y", alternative="less").collect()[0]
    assert two["r"] > 0.5 and two["reject_null"] and greater["reject_null"] and not less["reject_null"]
    assert two["df"] == 198


def test_assumption_checks_rows(spark):
    rnd = random.Random(5)
    data = [("n", rnd.gauss(0, 1)) for _ in range(400)] + [("e", rnd.expovariate(1.0)) for _ in range(400)]
    out = check_assumptions(spark.createDataFrame(data, "g string, x double"), "x", "g").collect()
    by = {(r["test"], r["group"]): r for r in out}
    assert set(by) == {("levene", None), ("jarque_bera", "n"), ("jarque_bera", "e")}
    assert by[("jarque_bera", "e")]["reject_null"] and not by[("jarque_bera", "n")]["reject_null"]


def test_stats_core_aggregate_has_no_python(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("x"))
    plan = anova_oneway(df, "x", "g")._jdf.queryExecution().executedPlan().toString()
    # python appears only once, after the aggregate (the p-value finisher)
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")


def test_pearson_matrix_wide_shape(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0), (2.0, 4.0, 7.0), (3.0, 7.0, 1.0)], "a double, b double, c double")
    wide = {r["x"]: r for r in pearson_matrix(df, ["a", "b", "c"], shape="wide").collect()}
    assert set(wide) == {"a", "b", "c"} and wide["a"]["a"] == 1.0 and wide["a"]["b"] == wide["b"]["a"]


def test_anova_empty_group_is_ignored(spark):
    data = [("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 5.0), ("c", None), ("c", None)]
    row = anova_oneway(spark.createDataFrame(data, "g string, x double"), "x", "g").collect()[0]
    assert (row["k"], row["n"], row["df_between"], row["df_within"]) == (2, 4, 1, 2)


def test_single_row_correlation_is_null(spark):
    out = pearson_test(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "x", "y").collect()[0]
    assert out["n"] == 1 and out["r"] is None and out["p_value"] is None


def test_pearson_matrix_listwise_vs_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.5, None), (3.0, 5.0, 2.0), (4.0, 9.0, 7.0)],
                               "a double, b double, c double")
    pair = {(r["x"], r["y"]): r for r in pearson_matrix(df, ["a", "b", "c"], scale=6).collect()}
    lw = {(r["x"], r["y"]): r for r in pearson_matrix(df, ["a", "b", "c"], missing="listwise", scale=6).collect()}
    assert pair[("a", "b")]["n"] == 4 and lw[("a", "b")]["n"] == 3
    sub = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0), (4.0, 9.0)], "a double, b double")
    assert lw[("a", "b")]["r"] == {(r["x"], r["y"]): r for r in pearson_matrix(sub, ["a", "b"], scale=6).collect()}[("a", "b")]["r"]
    assert pair[("a", "c")]["r"] == pair[("c", "a")]["r"] and pair[("b", "b")]["r"] == 1.0


def test_critical_r_reproduces_reference_value():
    from cairn.functions.distributions import r_critical, t_critical

    # the reference quotes r_c = 0.024 for n = 4600, alpha = .05, right tail
    assert round(r_critical(4600, 0.05, "greater"), 5) == 0.02426
    assert round(r_critical(4600, 0.05, "greater"), 3) == 0.024
    assert math.isclose(t_tail(t_critical(10, 0.05), 10), 0.05, rel_tol=1e-9)
    assert math.isclose(t_critical(10, 0.05), 2.228138852, rel_tol=1e-8)


def test_pearson_test_critical_column(spark):
    rnd = random.Random(11)
    df = spark.createDataFrame([(rnd.random(), rnd.random()) for _ in range(4600)], "x double, y double")
    row = pearson_test(df, "x", "y", alternative="greater", critical=True).collect()[0]
    from cairn.functions.distributions import r_critical

    assert abs(row["r_critical"] - r_critical(4600, 0.05, "greater")) < 1e-6
    assert row["reject_null"] == (row["r"] > row["r_critical"])


def test_perfect_evidence_is_decided(spark):
    from cairn.operators.stats import anova_oneway, pearson_test, welch_t

    line = spark.range(100).selectExpr("double(id) AS x", "2.0D * id + 1 AS y", "-0.1D * id + 0.3 AS z", "1.0D AS c")
    up = pearson_test(line, "x", "y").first()
    down = pearson_test(line, "x", "z").first()
    assert up.p_value == 0.0 and up.reject_null and down.p_value < 1e-300 and down.reject_null
    assert pearson_test(line, "x", "c").first().p_value is None
    steps = spark.range(9).selectExpr("id % 3 AS g", "double(id % 3) AS x", "1.0D AS same")
    row = anova_oneway(steps, "x", "g").first()
    assert row.f == float("inf") and row.p_value == 0.0 and row.reject_null
    assert anova_oneway(steps, "same", "g").first().p_value is None
    t = welch_t(steps, "x", "g", 0, 1).first()
    assert t.t == float("-inf") and t.p_value == 0.0 and t.reject_null
    assert welch_t(steps, "same", "g", 0, 1).first().p_value is None


def test_small_p_values_are_not_rounded_away(spark):
    from cairn.operators.stats import welch_t

    df = spark.range(200).selectExpr("id % 2 AS g", "double(id % 2) + double(id % 7) / 10 AS x")
    assert 0 < welch_t(df, "x", "g", 0, 1).first().p_value < 1e-9


def test_wide_matrix_against_numpy(spark):
    import numpy as np

    from cairn.operators.stats import pearson_matrix

    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 5] = 3.0
    names = list("abcdef")
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) + (i % 2 or None,) for i, r in enumerate(x)],
                               ", ".join(f"{n} double" for n in names) + ", g int")
    for missing in ("pairwise", "listwise"):
        for r in pearson_matrix(df, names, missing=missing).collect():
            i, j = names.index(r.x), names.index(r.y)
            both = ~np.isnan(x if missing == "listwise" else x[:, [i, j]]).any(axis=1)
            assert r.n == both.sum()
            if 5 in (i, j):
                assert r.r is None
            else:
                assert abs(r.r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    parts = pearson_matrix(df, ["a", "b"], by=["g"]).where("x = 'a' and y = 'b'").collect()
    assert {r.g for r in parts} == {1, None} and sum(r.n for r in parts) == (~np.isnan(x[:, :2]).any(axis=1)).sum()


def test_few_columns_agree_with_the_matrix_product(spark, monkeypatch):
    from cairn.operators import stats

    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, float("nan"), *[rng.random() * 9] * 6]), rng.random() + 1e6,
             rng.choice([None, 2.0]), float(k % 7)) for k in range(400)]
    df = spark.createDataFrame(data, "g string, x double, y double, z double, w double")
    for by, missing in (((), "pairwise"), (("g",), "pairwise"), ((), "listwise")):
        few = rows(pearson_matrix(df, ["x", "y", "z", "w"], by=by, scale=9, missing=missing))
        monkeypatch.setattr(stats, "FEW", 0)
        monkeypatch.setattr(stats, "HELD_SUMS", 1)  # every segment is passed on at once
        assert few == rows(pearson_matrix(df, ["x", "y", "z", "w"], by=by, scale=9, missing=missing))
        monkeypatch.undo()
    assert "Python" not in pearson_matrix(df, ["x", "y"])._jdf.queryExecution().toString()


def test_missing_values_can_be_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "x double, y double")
    assert pearson_matrix(df, ["x", "y"], missing="error").where("x = 'x' AND y = 'y'").first().r == pytest.approx(0.7205766921)
    for bad in (None, float("nan")):
        worse = df.unionByName(spark.createDataFrame([(4.0, bad)], "x double, y double"))
        with pytest.raises(Exception, match="a value of y is missing"):
            pearson_matrix(worse, ["x", "y"], missing="error").collect()
        assert pearson_matrix(worse, ["x", "y"]).where("x = 'x' AND y = 'y'").first().n == 3
