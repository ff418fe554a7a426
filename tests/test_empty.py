"""Every operator on an empty input: no exception, sensible empty or null results."""

from cairn.operators.aggregate import category_counts, frequency_topk
from cairn.operators.cleaning import dedupe_first
from cairn.operators.combine import lookup_enrich, outer_merge
from cairn.operators.ranking import rank_within, top_k
from cairn.operators.stats import anova_oneway, check_assumptions, pearson_matrix, pearson_test, welch_t


def test_operators_on_empty_input(spark):
    df = spark.createDataFrame([], "k string, g string, v double, id int")
    assert dedupe_first(df, ["k"], ["v"]).count() == 0
    assert dedupe_first(df, ["k"], [("v", False), ("id", True)], strategy="aggregate").count() == 0
    assert rank_within(df, ["g"], "v").count() == 0
    assert rank_within(df, [], "v").count() == 0
    assert category_counts(df, ["k"], "g", ["a", "b"]).count() == 0
    assert frequency_topk(df, ["k"], 3).count() == 0
    assert top_k(df, ["v"], 3).count() == 0
    dim = spark.createDataFrame([], "k string, name string")
    assert lookup_enrich(df, dim, on="k", take="name", default="?").count() == 0
    assert outer_merge([df.select("k", "v"), df.select("k", "id")], ["k"]).count() == 0
    w = welch_t(df, "v", "g", "a", "b").collect()[0]
    assert w["n_a"] == 0 and w["t"] is None and w["p_value"] is None
    p = pearson_test(df, "v", "id").collect()[0]
    assert p["n"] == 0 and p["r"] is None
    assert all(r["r"] is None for r in pearson_matrix(df, ["v", "id"]).collect())
    a = anova_oneway(df, "v", "g").collect()
    assert len(a) <= 1 and all(r["f"] is None for r in a)
    assert check_assumptions(df, "v", "g").where("test = 'jarque_bera'").count() == 0
