"""Association measures and hypothesis tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.aggregates import pearson
from statloom.functions.probability import (
    chi2_p_value,
    f_p_value,
    normal_p_value,
    normal_quantile,
    t_p_value,
)
from statloom.functions.scalars import select_matching, truncate
from statloom.operators.ordered import ROWS_PER_SPLIT, average_rank, dense_rank, join_small, running, with_row
from statloom.session import materialise

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def covariance_pearson(df: DataFrame, a: str, b: str, all_rows: bool = False) -> DataFrame:
    """Population covariance and correlation over complete pairs.

    ``all_rows`` divides by all rows and takes means and deviations over each full
    column, as a query over totals would.
    """
    if not all_rows:
        return df.agg(F.covar_pop(a, b).alias("covar"), pearson(a, b).alias("pearson"))
    means = df.agg(F.avg(a).alias("a"), F.avg(b).alias("b"))
    product = (F.col(a) - F.col("_m.a")) * (F.col(b) - F.col("_m.b"))
    return (
        with_row(df, means, "_m")
        .withColumn("_p", product)
        .agg(
            (F.sum("_p") / F.count(F.lit(1))).alias("covar"),
            (F.stddev_pop(a) * F.stddev_pop(b)).alias("_d"),
        )
        .select("covar", F.try_divide(F.col("covar"), F.col("_d")).alias("pearson"))
    )


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows (a, b, r): all pairs in one aggregate, each over its complete pairs."""
    wide = df.agg(*[pearson(a, b).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(F.explode(rows).alias("p")).select("p.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlations of all pairs of numeric columns, each pair once."""
    names = list(columns or select_matching(df, types=NUMERIC))
    return correlations(df, [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]])


def top_correlated(df: DataFrame, target: str, k: int, exclude: Sequence[str] = ()) -> DataFrame:
    """The ``k`` columns most correlated with the target; constant columns have no correlation."""
    names = [c for c in select_matching(df, types=NUMERIC, exclude=exclude) if c != target]
    rows = correlations(df, [(c, target) for c in names])
    return (
        rows.select(F.col("a").alias("variable"), F.col("r"), F.abs("r").alias("strength"))
        .where("strength IS NOT NULL")
        .orderBy(F.col("strength").desc(), "variable")
        .limit(k)
    )


def _cells(df: DataFrame, x: str, y: str) -> DataFrame:
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def spearman(df: DataFrame, x: str, y: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Correlation of tie-averaged ranks, over counted (x, y) cells, with its p-value."""
    cells = materialise(_cells(df, x, y))
    middle = (F.col("total") + 1) / 2
    rank_x = average_rank(cells, "x", "rank", rows_per_split, "n").select("x", (F.col("rank") - middle).alias("u"))
    rank_y = average_rank(cells, "y", "rank", rows_per_split, "n").select("y", (F.col("rank") - middle).alias("v"))
    # the planner measures the rank tables when they are there, and splits frequent values otherwise
    ranked = cells.join(rank_x, "x").join(rank_y, "y")
    u, v, n = F.col("u"), F.col("v"), F.col("n")
    sums = ranked.agg(
        F.sum("n").alias("n"), F.sum(n * u * v).alias("uv"), F.sum(n * u * u).alias("uu"), F.sum(n * v * v).alias("vv")
    )
    rho = sums.select("n", F.try_divide(F.col("uv"), F.sqrt(F.col("uu") * F.col("vv"))).alias("rho"))
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("rho") * F.col("rho")))
    return rho.select("rho", F.col("n").cast("long").alias("n"), t_p_value(t, F.col("n") - 2).alias("p_value"))


def kendall(df: DataFrame, x: str, y: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Tau-b with its p-value for large samples, without forming pairs.

    Positions of y are compared by their highest differing bit: for each bit,
    rows that share the higher bits are ordered by x, and a running count tells
    for every row with the bit set how many rows without it lie below.  A row
    takes part once per bit, so the work grows with rows times log(levels).
    """
    cells = materialise(_cells(df, x, y))
    levels = cells.agg(F.countDistinct("y").alias("m")).first()["m"] or 1
    bits = max(1, int(levels - 1).bit_length())
    coded = join_small(cells, dense_rank(cells, "y", "_code", rows_per_split), ["y"]).withColumn("_code", F.col("_code") - 1)
    per_bit = coded.select(
        "x", "n", "_code", F.explode(F.array(*[F.lit(b) for b in range(bits)])).alias("level")
    ).withColumn("prefix", F.expr("shiftright(_code, level + 1)"))
    is_one = F.expr("shiftright(_code, level) % 2 = 1")
    at_x = per_bit.groupBy("level", "prefix", "x").agg(
        F.sum(F.when(is_one, 0.0).otherwise(F.col("n"))).alias("zeros"),
        F.sum(F.when(is_one, F.col("n")).otherwise(0.0)).alias("ones"),
    )
    below = running(at_x, ["level", "prefix"], ["x"], {"upto": ("sum", "zeros")}, rows_per_split, reuse=True)
    groups = below.groupBy("level", "prefix").agg(
        F.sum(F.col("ones") * (F.col("upto") - F.col("zeros"))).alias("concordant"),
        F.sum(F.col("ones") * F.col("upto")).alias("not_above"),
        F.sum("zeros").alias("z"),
        F.sum("ones").alias("o"),
    )
    pairs = groups.agg(
        F.coalesce(F.sum("concordant"), F.lit(0.0)).alias("concordant"),
        F.coalesce(F.sum(F.col("z") * F.col("o") - F.col("not_above")), F.lit(0.0)).alias("discordant"),
    )

    def ties(column: str) -> Column:
        t = F.col("t")
        counts = cells.groupBy(column).agg(F.sum("n").alias("t"))
        return counts.agg(
            F.struct(
                F.sum(t).alias("n"),
                F.sum(t * (t - 1) / 2).alias("pairs"),
                F.sum(t * (t - 1) * (t - 2)).alias("triples"),
                F.sum(t * (t - 1) * (2 * t + 5)).alias("spread"),
            ).alias("s")
        ).scalar()

    wide = pairs.withColumns({"_x": ties("x"), "_y": ties("y")}).withColumn("n", F.col("_x.n"))
    n, diff = F.col("n"), F.col("concordant") - F.col("discordant")
    total = n * (n - 1) / 2
    tau = F.try_divide(diff, F.sqrt((total - F.col("_x.pairs")) * (total - F.col("_y.pairs"))))
    m = n * (n - 1)
    variance = (
        (m * (2 * n + 5) - F.col("_x.spread") - F.col("_y.spread")) / 18
        + F.try_divide(2 * F.col("_x.pairs") * F.col("_y.pairs"), m)
        + F.try_divide(F.col("_x.triples") * F.col("_y.triples"), 9 * m * (n - 2))
    )
    return wide.select(
        tau.alias("tau"),
        "concordant",
        "discordant",
        normal_p_value(F.try_divide(diff, F.sqrt(variance))).alias("p_value"),
    )


def contingency(df: DataFrame, a: str, b: str, rounded_expected: bool = False) -> DataFrame:
    """Observed and expected counts of the combinations that occur, with their margins."""
    cells = df.groupBy(F.col(a).alias("on_rows"), F.col(b).alias("on_cols")).agg(F.count(F.lit(1)).alias("observed"))
    rows = cells.groupBy(F.col("on_rows").alias("_r")).agg(F.sum("observed").alias("observed_on_rows"))
    cols = cells.groupBy(F.col("on_cols").alias("_c")).agg(F.sum("observed").alias("observed_on_cols"))
    total = cells.agg(F.sum("observed").alias("n")).scalar()
    expected = F.col("observed_on_rows").cast("double") * F.col("observed_on_cols") / F.col("observed_total")
    if rounded_expected:
        expected = F.round(expected, 0).cast("long")
    return (
        cells.join(rows, F.col("on_rows").eqNullSafe(F.col("_r")))
        .join(cols, F.col("on_cols").eqNullSafe(F.col("_c")))
        .withColumn("observed_total", total)
        .withColumn("expected", expected)
        .select("on_rows", "on_cols", "observed", "observed_on_rows", "observed_on_cols", "observed_total", "expected")
    )


def chi_square(df: DataFrame, a: str, b: str, rounded_expected: bool = False, yates: bool = False) -> DataFrame:
    """Degrees of freedom, statistic and p-value.

    The exact statistic covers the full grid: a combination that never occurs adds
    its expected count.  With ``rounded_expected`` expected counts are whole
    numbers and absent combinations are left out.  ``yates`` moves every
    difference up to one half toward zero in a table with one degree of freedom.
    """
    if not rounded_expected:
        df = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = contingency(df, a, b, rounded_expected)
    gap = F.col("observed") - F.col("expected")
    sums = cells.agg(
        ((F.countDistinct("on_rows") - 1) * (F.countDistinct("on_cols") - 1)).alias("dof"),
        F.sum(F.try_divide((gap * gap).cast("double"), F.col("expected"))).alias("plain"),
        F.sum(F.try_divide(F.pow(F.abs(gap) - F.least(F.lit(0.5), F.abs(gap)), F.lit(2.0)), F.col("expected"))).alias("moved"),
        F.sum("expected").alias("_expected"),
        F.max("observed_total").alias("_n"),
        F.count(F.lit(1)).alias("_cells"),
        (F.countDistinct("on_rows") * F.countDistinct("on_cols")).alias("_grid"),
    )
    statistic = F.col("plain")
    if not rounded_expected:
        absent = F.when(F.col("_cells") < F.col("_grid"), F.col("_n") - F.col("_expected")).otherwise(F.lit(0.0))
        statistic = statistic + absent
        if yates:
            statistic = F.when((F.col("dof") == 1) & (F.col("_cells") == 4), F.col("moved")).otherwise(statistic)
    found = sums.select("dof", statistic.alias("chi_squared"))
    return found.withColumn("p_value", chi2_p_value(F.col("chi_squared"), F.col("dof")))


def screen_features(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Exact chi-square of every feature with the target, all features in one pass.

    ``relevant`` is false for features with a single level.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in features])
    long = df.select(F.col(target).alias("class"), F.explode(pairs).alias("p")).select("class", "p.*")
    cells = long.where("level IS NOT NULL AND class IS NOT NULL").groupBy("feature", "level", "class").agg(
        F.count(F.lit(1)).alias("o")
    )
    by_level = cells.groupBy("feature", "level").agg(F.sum("o").alias("r"))
    by_class = cells.groupBy("feature", "class").agg(F.sum("o").alias("c"))
    size = by_class.groupBy("feature").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("classes"))
    expected = F.col("r").cast("double") * F.col("c") / F.col("n")
    joined = cells.join(by_level, ["feature", "level"]).join(by_class, ["feature", "class"]).join(size, "feature")
    gap = F.col("o") - F.col("e")
    sums = (
        joined.withColumn("e", expected)
        .groupBy("feature")
        .agg(
            F.countDistinct("level").alias("levels"),
            F.max("classes").alias("classes"),
            F.sum(gap * gap / F.col("e")).alias("s"),
            F.sum("e").alias("e"),
            F.max("n").alias("n"),
            F.count(F.lit(1)).alias("k"),
        )
    )
    absent = F.when(F.col("k") < F.col("levels") * F.col("classes"), F.col("n") - F.col("e")).otherwise(F.lit(0.0))
    dof = (F.col("levels") - 1) * (F.col("classes") - 1)
    found = sums.select(
        "feature", "levels", (F.col("levels") > 1).alias("relevant"), dof.alias("dof"), (F.col("s") + absent).alias("chi_squared")
    )
    return found.withColumn("p_value", chi2_p_value(F.col("chi_squared"), F.col("dof")))


def anova(df: DataFrame, value: str, group: str, integer_avg: bool = False, all_rows: bool = False) -> DataFrame:
    """One-way table: between and within rows with SS, df, MS, F and p-value.

    ``integer_avg`` cuts every mean to a whole number.  ``all_rows`` lets rows
    without a value count in the sizes, and a NULL group is a group.
    """
    if not all_rows:
        df = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    v = F.col(value).cast("double")
    groups = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("n"),
        F.sum(v).alias("s"),
        F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"),
    )
    overall = F.try_divide(F.sum("s"), F.sum("n").cast("double"))
    used = F.col("mean")
    if integer_avg:
        overall, used = truncate(overall), truncate(F.col("mean"))
    total = groups.agg(overall.cast("double").alias("overall")).scalar()
    rows = groups.withColumns({"used": used.cast("double"), "overall": total})
    between = F.col("rows") * F.pow(F.col("used") - F.col("overall"), F.lit(2.0))
    within = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("used"), F.lit(2.0))
    sums = rows.agg(
        F.sum(between).alias("ssb"),
        F.sum(within).alias("ssw"),
        (F.count(F.lit(1)) - 1).alias("dfb"),
        (F.sum("rows") - F.count(F.lit(1))).alias("dfw"),
    )
    msb, msw = F.try_divide(F.col("ssb"), F.col("dfb")), F.try_divide(F.col("ssw"), F.col("dfw"))
    ratio = F.try_divide(msb, msw)
    none = F.lit(None).cast("double")
    table = F.array(
        F.struct(
            F.lit("Between groups").alias("source"), F.col("ssb").alias("ss"), F.col("dfb").alias("df"), msb.alias("ms"), ratio.alias("f")
        ),
        F.struct(
            F.lit("Within groups").alias("source"), F.col("ssw").alias("ss"), F.col("dfw").alias("df"), msw.alias("ms"), none.alias("f")
        ),
    )
    long = sums.select(F.explode(table).alias("t"), "dfb", "dfw").select("t.*", "dfb", "dfw")
    return long.withColumn("p_value", f_p_value(F.col("f"), F.col("dfb"), F.col("dfw"))).drop("dfb", "dfw")


def jarque_bera(df: DataFrame, column: str) -> DataFrame:
    """Normality by skewness and kurtosis, chi-square with two degrees of freedom."""
    n = F.count(column)
    jb = n / 6 * (F.pow(F.skewness(column), F.lit(2.0)) + F.pow(F.kurtosis(column), F.lit(2.0)) / 4)
    return df.agg(jb.alias("statistic")).withColumn("p_value", F.exp(-F.col("statistic") / 2))


def kolmogorov_smirnov(df: DataFrame, column: str) -> DataFrame:
    """Distance to the normal law with the sample's mean and deviation."""
    rows = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    fit = rows.agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).first()  # two parameters
    result = KolmogorovSmirnovTest.test(rows, "v", "norm", fit["m"], fit["s"])
    return result.select(F.col("statistic"), F.col("pValue").alias("p_value"))


def qq_points(df: DataFrame, column: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Distinct values with the normal quantile of their middle rank."""
    ranks = average_rank(df, column, "rank", rows_per_split)
    p = (F.col("rank") - 0.5) / F.col("total")
    return ranks.select(column, "n", normal_quantile(p).alias("theoretical"))
