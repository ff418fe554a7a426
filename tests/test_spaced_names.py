"""Column names with spaces (as in the reference's files) through every operator."""

from pyspark.sql import functions as F

from cairn.functions.numeric import band, difference
from cairn.operators.aggregate import category_counts, frequency_topk
from cairn.operators.cleaning import dedupe_first, fill_missing, replace_token
from cairn.operators.combine import lookup_enrich, outer_merge
from cairn.operators.ranking import rank_within
from cairn.operators.stats import anova_columns, anova_oneway, check_assumptions, pearson_matrix, welch_t
from frames import rows


def _df(spark):
    data = [("Ann", "A", 80.0, 77.5, 1950, "Gold"), ("Bo", "B", 90.0, 85.25, 2001, None),
            ("Ann", "A", 81.0, 70.0, 1960, "NO"), ("Cy", "C", 70.0, 69.0, 1899, "Gold"),
            ("Di", "B", 60.0, 52.0, 1999, "Silver"), ("Ed", "C", 75.0, 74.0, 1975, "NO")]
    return spark.createDataFrame(data, "`Full Name` string, `Diet Type` string, `Weight` double, "
                                       "`Weight After` double, `Year built` int, `Medal Won` string")


def test_operators_accept_spaced_names(spark):
    df = _df(spark)
    d = difference(df, "Weight", "Weight After", "Weight Lost")
    assert sorted(r["Weight Lost"] for r in d.collect()) == [1.0, 1.0, 2.5, 4.75, 8.0, 11.0]
    b = band(df, "Year built", [(1900, 1950, "first half"), (1951, 2000, "second half")], "Built Band")
    assert sorted(r["Built Band"] or "" for r in b.collect()) == ["", "", "first half", "second half",
                                                                  "second half", "second half"]
    f = fill_missing(df, {"Medal Won": "NO"})
    assert rows(f.where(F.col("Medal Won") == "NO"), "Full Name") == [("Ann",), ("Bo",), ("Ed",)]
    r = replace_token(df, "Medal Won", "NO", "None Won")
    assert ("None Won",) in rows(r, "Medal Won")
    first = dedupe_first(df, ["Full Name"], [("Year built", False), ("Weight After", True)])
    assert rows(first.where(F.col("Full Name") == "Ann"), "Year built") == [(1960,)]
    cc = category_counts(df, ["Diet Type"], "Medal Won", ["Gold", "NO"], ["Gold Count", "No Count"])
    assert rows(cc) == [("A", 1, 1), ("C", 1, 1)]
    top = frequency_topk(df, ["Diet Type"], 1, label="Diet Label")
    assert [r["Diet Type"] for r in top.collect()] == ["A"]
    ranked = rank_within(df, ["Diet Type"], "Weight After")
    assert rows(ranked.where(F.col("Diet Type") == "B"), "Full Name", "rank") == [("Bo", 1), ("Di", 2)]
    merged = outer_merge([cc.select("Diet Type", "Gold Count"), cc.select("Diet Type", "No Count")], ["Diet Type"])
    assert rows(merged) == rows(cc)
    dim = spark.createDataFrame([("A", "Atkins"), ("B", "Banting")], "`Diet Type` string, `Diet Name` string")
    enriched = lookup_enrich(df, dim, on="Diet Type", take="Diet Name", default="?")
    assert sorted(set(r["Diet Name"] for r in enriched.collect())) == ["?", "Atkins", "Banting"]
    pm = pearson_matrix(df, ["Weight", "Weight After", "Year built"])
    assert pm.count() == 9
    assert anova_oneway(df, "Weight After", "Diet Type").count() == 1
    assert anova_columns(df, ["Weight", "Weight After"]).count() == 1
    assert welch_t(df, "Weight After", "Diet Type", "A", "B").count() == 1
    assert check_assumptions(df, "Weight After", "Diet Type").count() == 4
