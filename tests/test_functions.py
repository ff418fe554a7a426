from pyspark.sql import functions as F

from cairn.functions.numeric import add_total, band, difference, mean_from_totals, rounded
from frames import rows

BANDS = [(1900, 1950, "20th c - first half"), (1951, 2000, "20th c - second half"), (2001, None, "21th")]


def test_band_edges_below_first_and_null(spark):
    years = [(1900,), (1950,), (1951,), (2000,), (2001,), (2024,), (1899,), (None,)]
    df = band(spark.createDataFrame(years, "y int"), "y", BANDS, "old")
    got = dict((r["y"], r["old"]) for r in df.collect())
    assert got[1900] == got[1950] == "20th c - first half"
    assert got[1951] == got[2000] == "20th c - second half"
    assert got[2001] == got[2024] == "21th"
    assert got[1899] is None and got[None] is None
    with_default = band(spark.createDataFrame(years, "y int"), "y", BANDS, "old", default="other")
    assert dict((r["y"], r["old"]) for r in with_default.collect())[None] == "other"


def test_rounded_is_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-2.5,), (None,)], "x double")
    got = [r["r"] for r in df.select(rounded("x", 2).alias("r")).collect()]
    assert got == [1.01, 2.68, 0.13, -2.5, None]
    assert [r["r"] for r in df.select(rounded("x", 0).alias("r")).collect()][3] == -3.0


def test_difference_total_and_ratio(spark):
    df = spark.createDataFrame([(80.5, 78.25, 3, None), (60.0, 61.004, None, 2)], "w double, wa double, a int, b int")
    out = add_total(difference(df, "w", "wa", "diff"), ["a", "b"], "total")
    assert rows(out, "diff", "total") == [(-1.0, 2), (2.25, 3)]
    ratio = spark.createDataFrame([(10.0, 4), (5.0, 0)], "s double, n bigint").select(
        mean_from_totals("s", "n").alias("m"))
    assert [r["m"] for r in ratio.collect()] == [2.5, None]


def test_not_equal_drops_null_category_unless_null_safe(spark):
    df = spark.createDataFrame([("Gold",), ("NO",), (None,)], "medal string")
    assert rows(df.where(F.col("medal") != "NO")) == [("Gold",)]
    assert rows(df.where(~F.col("medal").eqNullSafe("NO"))) == [("Gold",), (None,)]


def test_or_and_precedence(spark):
    # a OR (b AND c): Gold rows kept even with the -1 sentinel, NO rows only with a real age
    df = spark.createDataFrame([("Gold", -1), ("NO", -1), ("NO", 30), ("Silver", 30)], "medal string, age int")
    keep = (F.col("medal") == "Gold") | (F.col("medal") == "NO") & (F.col("age") != -1)
    assert rows(df.where(keep)) == [("Gold", -1), ("NO", 30)]


def test_rounded_passes_huge_and_special_values_through(spark):
    df = spark.createDataFrame([(1.27e254,), (float("inf"),), (float("nan"),), (-1e16,), (123.456,), (2.5e15,)],
                               "x double")
    got = [r["r"] for r in df.select(rounded("x", 2).alias("r")).collect()]
    assert got[0] == 1.27e254 and got[1] == float("inf") and got[2] != got[2] and got[3] == -1e16
    assert got[4] == 123.46 and got[5] == 2.5e15
    assert df.select(rounded(F.lit(2.5e15 + 0.5), 0).alias("r")).first()["r"] == 2.5e15 + 1


def test_tails_tend_to_their_limits():
    import math

    from cairn.functions.distributions import f_upper_tail, t_tail

    for t in (0.5, 2.0, 6.0, 30.0):
        limit = math.erfc(t / math.sqrt(2))
        for df in (1e9, 1e10, 1e12, 1e13, 1e15):
            if t == 30.0 and df < 1e12:
                continue  # the second correction counts there
            # the first correction of the t tail, (t**3 + t) phi(t) / (2 df)
            first = (t ** 3 + t) * math.exp(-t * t / 2) / math.sqrt(2 * math.pi) / (2 * df)
            assert abs(t_tail(t, df) / (limit + first) - 1) < 1e-9
    for f, d2 in ((0.3, 1e9), (3.0, 1e12), (40.0, 1e15)):
        two = math.exp(-d2 / 2 * math.log1p(2 * f / d2))
        four = math.exp(-d2 / 2 * math.log1p(4 * f / d2)) * (1 + d2 / 2 * (4 * f / (d2 + 4 * f)))
        assert abs(f_upper_tail(f, 2, d2) / two - 1) < 1e-9 and abs(f_upper_tail(f, 4, d2) / four - 1) < 1e-9
    assert abs(f_upper_tail(1.0, 1e6, 1e9) - 0.49981) < 1e-4
    assert t_tail(float("inf"), 5) == 0.0 and f_upper_tail(float("inf"), 2, 5) == 0.0
    assert abs(t_tail(1.0, 1) - 0.5) < 1e-12 and abs(t_tail(0.3, 2) - (1 - 0.3 / math.sqrt(2.09))) < 1e-12


def test_rounded_keeps_the_scale_it_is_asked_for(spark):
    from pyspark.sql import functions as F

    from cairn.functions.numeric import rounded

    df = spark.createDataFrame([(1.23456789012,), (123456.123456789,), (1e30,), (None,)], "x double")
    assert [r[0] for r in df.select(rounded("x", 10)).collect()] == [1.2345678901, 123456.123456789, 1e30, None]
    assert df.select(rounded(F.lit(2.675), 2)).first()[0] == 2.68
