"""Known figures of the well-known 891 passengers, and tail probabilities."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from statloom.functions import probability as pr, scalars
from statloom.operators import association, bins, clean, describe

# public counts (level, survived 0, survived 1)
BY_CLASS = [(1, 80, 136), (2, 97, 87), (3, 372, 119)]
BY_SEX = [("female", 81, 233), ("male", 468, 109)]
BY_ALONE = [(0, 175, 179), (1, 374, 163)]
BY_TITLE = [("Mr", 436, 82), ("Miss", 55, 130), ("Mrs", 26, 99), ("Master", 17, 23), ("Rare", 15, 8)]


def people(spark, counts):
    cells = [(level, s, n) for level, died, lived in counts for s, n in ((0, died), (1, lived))]
    df = spark.createDataFrame(cells, ["level", "survived", "n"])
    return df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "i")


def test_anova_with_whole_averages(spark):
    rows = association.anova(people(spark, BY_CLASS), "level", "survived", integer_avg=True, all_rows=True).collect()
    f = {r["source"]: r["f"] for r in rows}
    assert f["Between groups"] == pytest.approx(299.544827586207)
    assert f["Within groups"] is None
    true_mean = association.anova(people(spark, BY_CLASS), "level", "survived").where("f IS NOT NULL").first()
    assert true_mean["f"] == pytest.approx(115.03, abs=0.01)
    assert true_mean["p_value"] == pytest.approx(2.5370473879804202e-25, rel=1e-6)


@pytest.mark.parametrize(
    "counts,want,dof", [(BY_SEX, 260.660376192108, 1), (BY_ALONE, 36.6390704858139, 1), (BY_TITLE, 286.240354290757, 4)]
)
def test_chi_square_rounded(spark, counts, want, dof):
    got = association.chi_square(people(spark, counts), "level", "survived", rounded_expected=True).first()
    assert got["chi_squared"] == pytest.approx(want, rel=1e-12)
    assert got["dof"] == dof


def test_yates(spark):
    got = association.chi_square(people(spark, BY_SEX), "level", "survived", yates=True).first()
    assert got["chi_squared"] == pytest.approx(260.71702016732104)
    assert got["p_value"] == pytest.approx(1.1973570627755645e-58)


def test_exact_chi_square_counts_absent_cells(spark):
    df = spark.createDataFrame([("a", "x")] * 6 + [("b", "y")] * 4, ["p", "q"])
    assert association.chi_square(df, "p", "q").first()["chi_squared"] == pytest.approx(10.0)


@pytest.mark.parametrize(
    "got,want",
    [
        (pr.chi2_tail(3.841458820694124, 1), 0.05),
        (pr.chi2_tail(15.50731305586545, 8), 0.05),
        (pr.chi2_tail(7.814727903251179, 3), 0.05),
        (pr.f_tail(4.102821015303716, 2, 10), 0.05),
        (pr.t_two_sided(2.2281388519649385, 10), 0.05),
        (pr.beta_lower(2, 3, 0.4), 0.5248),
    ],
)
def test_tails(got, want):
    assert got == pytest.approx(want, rel=1e-9)


def test_even_p_value_agrees(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 8.0, 30.0)], ["x"])
    a, b = pr.even_chi2_p_value(F.col("x"), 8), pr.chi2_p_value(F.col("x"), F.lit(8))
    for r in df.select(a.alias("a"), b.alias("b")).collect():
        assert r["a"] == pytest.approx(r["b"])


def test_leading_digit_edges(spark):
    amounts = [0.0, -3.7, 9.99, 10.0, 99.9, 123456789.0, 1e9, 9.99e9, 2.5e10]
    df = spark.createDataFrame([(a,) for a in amounts], ["a"])
    got = [r[0] for r in df.select(scalars.leading_digit(F.col("a"))).collect()]
    assert got == [0, -3, 9, 1, 9, 1, 1, 9, 25]


def test_distance(spark):
    df = spark.createDataFrame([(40.763958, -73.973373, 40.782139, -73.977303), (40.0, -74.0, 40.0, -74.0)], ["a", "b", "c", "d"])
    got = [r[0] for r in df.select(scalars.great_circle_miles(*[F.col(c) for c in "abcd"])).collect()]
    assert got[0] == pytest.approx(1.273, abs=0.01)
    assert got[1] == 0


def test_week_starts_on_sunday(spark):
    # January 1, 2022 is a Saturday, so January 2 opens week 2
    df = spark.createDataFrame([(dt.datetime(2022, 1, 1),), (dt.datetime(2022, 1, 2),), (dt.datetime(2022, 12, 31, 0, 5),)], ["ts"])
    parts = scalars.datetime_parts(F.col("ts"))
    assert [r[0] for r in df.select(parts["week"]).collect()] == [1, 2, 53]
    assert df.select(parts["hour12"]).collect()[2][0] == 0


def test_titles(spark):
    df = spark.createDataFrame([("Kelly, Mr. James",), ("Oliva y Ocana, Dona. Fermina",), ("Rothes, the Countess. of",), ("none",)], ["n"])
    got = [tuple(r) for r in df.select(scalars.title_between(F.col("n")), scalars.title_word(F.col("n"))).collect()]
    assert got == [("Mr", "Mr"), ("Dona", "Dona"), ("the Countess", "Countess"), (None, None)]


def test_constant_column(spark):
    df = spark.range(10).select(F.lit(3.0).alias("c"), F.col("id").cast("double").alias("v"))
    assert association.covariance_pearson(df, "c", "v").first()["pearson"] is None
    e = describe.entropy(df, "c").first()
    assert e["entropy"] == 0 and e["pct_of_max"] is None
    assert describe.histogram(df, "c", 5).count() == 1


def test_custom_bins_and_nulls(spark):
    df = spark.createDataFrame([(8.0,), (8.1,), (35.0,), (36.0,), (None,)], "v double")
    assert [r[0] for r in df.select(bins.custom_bins(F.col("v"), [8, 14.5, 35])).collect()] == [0, 1, 2, 3, 3]


def test_equal_width_labels(spark):
    df = spark.createDataFrame([(0.0,), (59.9,), (60.0,)], "v double")
    assert [r["bin"] for r in bins.equal_width_bins(df, "v", 6, whole_start=True).collect()] == ["0.00 - 10.00", "50.00 + ", "50.00 + "]


def test_delete_and_bad_rows_keep_unknown(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    kept, removed = clean.split_bad_rows(df, [F.col("v") > 3])
    assert kept.count() == 2 and removed.count() == 1


def test_fill_mode_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert sorted(r["v"] for r in clean.fill_mode(df, "v").collect()) == ["a", "a", "a", "b", "b"]
