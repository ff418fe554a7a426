"""Values recorded in the survey for the sf 0.01 test tables (independently verified there)."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def test_welch_view_vs_purchase(spark):
    row = entry.queries()["welch_t"](spark, SF).collect()[0]
    assert (row["t"], round(row["df"], 3), row["p_value"]) == (0.187139, 3958.389, 0.851561)


def test_anova_priorities_and_subset(spark):
    long = entry.queries()["anova_long"](spark, SF).collect()[0]
    assert (long["k"], long["n"], long["f"]) == (5, 15000, 1.473848)
    subset = entry.queries()["anova_subset"](spark, SF).collect()[0]
    assert (subset["n"], subset["f"]) == (6002, 1.150781)


def test_frequency_topk_tie_at_the_cut(spark):
    # counts 25, 21, 21, then three customers share 20 for the last two places: lowest keys win
    rows = entry.queries()["frequency_topk"](spark, SF).collect()
    counts = [r["n_orders"] for r in rows]
    assert counts[:3] == [25, 21, 21] and counts[3:] == [20, 20]
    assert rows[3]["o_custkey"] < rows[4]["o_custkey"]
