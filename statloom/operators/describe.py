"""Descriptive statistics of one or several columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.scalars import text_bar, truncate
from statloom.operators.ordered import ROWS_PER_SPLIT, join_small, quantiles, running, with_row
from statloom.operators.relational import levels_of


def describe(df: DataFrame, column: str, keys: Sequence[str] = (), integer_avg: bool = False) -> DataFrame:
    """Minimum, maximum, range, mean, count, deviation, variation, missing and distinct values.

    ``integer_avg`` cuts the mean, though not the one inside the variation, to a whole number.
    """
    c = F.col(column)
    mean = truncate(F.avg(c)).cast("double") if integer_avg else F.avg(c)
    return df.groupBy(*keys).agg(
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        (F.max(c) - F.min(c)).alias("range"),
        mean.alias("mean"),
        F.count(c).alias("count"),
        F.stddev_samp(c).alias("stdev"),
        F.try_divide(F.stddev_samp(c), F.avg(c)).alias("cv"),
        F.count_if(c.isNull()).alias("missing"),
        F.countDistinct(c).alias("distinct"),
    )


def summarise(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean, deviation, minimum, maximum and missing count per column, in long form."""
    aggs = {}
    for c in columns:
        aggs[c] = F.struct(
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stdev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.count_if(F.col(c).isNull()).alias("missing"),
        )
    wide = df.groupBy(*keys).agg(*[s.alias("_s_" + c) for c, s in aggs.items()])
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col("_s_" + c).alias("s")) for c in columns])
    return wide.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.variable", "p.s.*")


def mode(df: DataFrame, column: str, drop_null: bool = False) -> DataFrame:
    """All most frequent values with their count."""
    rows = df.where(F.col(column).isNotNull()) if drop_null else df
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("number"))
    return counts.where(F.col("number") == counts.agg(F.max("number")).scalar())


def frequency_table(df: DataFrame, column: str, rows_per_split: int = ROWS_PER_SPLIT, width: int = 50) -> DataFrame:
    """Absolute, percent and cumulative frequencies with a text histogram of at most ``width`` marks.

    NULL forms the first row with frequency 0; percentages are of all rows.
    """
    counts = df.groupBy(column).agg(F.count(column).alias("abs_freq"))
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = counts.withColumn("abs_perc", F.round(F.lit(100.0) * F.col("abs_freq") / total, 0).cast("long"))
    summed = running(
        counts, [], [column], {"cum_freq": ("sum", "abs_freq"), "cum_perc": ("sum", "abs_perc")}, rows_per_split, True
    )
    return summed.select(
        column, "abs_freq", "cum_freq", "abs_perc", "cum_perc", text_bar(F.col("abs_perc"), width).alias("histogram")
    )


def median_and_iqr(df: DataFrame, column: str, keys: Sequence[str] = (), rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    q = quantiles(df, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys, rows_per_split=rows_per_split)
    return q.withColumn("iqr", F.col("q3") - F.col("q1"))


def _adjusted_skewness(column: str) -> Column:
    n = F.count(column)
    return F.skewness(column) * F.try_divide(F.sqrt(n * (n - 1)), (n - 2))


def _adjusted_kurtosis(column: str) -> Column:
    n = F.count(column)
    return F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(column) + 6)


def shape(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sample-adjusted skewness and excess kurtosis."""
    return df.groupBy(*keys).agg(
        _adjusted_skewness(column).alias("skewness"), _adjusted_kurtosis(column).alias("kurtosis")
    )


def entropy(df: DataFrame, column: str, count_null_rows: bool = False) -> DataFrame:
    """Entropy in bits, its maximum and their ratio in percent.

    NULL never forms a level.  With ``count_null_rows`` shares are first taken of
    all rows and then rescaled to one, which gives the same entropy.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    base = df if count_null_rows else df.where(F.col(column).isNotNull())
    share = F.col("n") / base.agg(F.count(F.lit(1))).scalar()
    # with shares s: H = log2(sum s) - sum(s log2 s) / sum s
    bits = counts.withColumn("s", share).agg(
        F.log2(F.count(F.lit(1)).cast("double")).alias("max_entropy"),
        (F.log2(F.sum("s")) - F.sum(F.col("s") * F.log2("s")) / F.sum("s")).alias("entropy"),
    )
    return bits.select(
        F.lit(column).alias("variable"),
        "max_entropy",
        "entropy",
        (F.lit(100.0) * F.try_divide(F.col("entropy"), F.col("max_entropy"))).alias("pct_of_max"),
    )


def class_share(df: DataFrame, column: str | Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Count and percentage per level, of all rows or of the rows of ``within``."""
    columns = [column] if isinstance(column, str) else list(column)
    counts = df.groupBy(*within, *columns).agg(F.count(F.lit(1)).alias("cnt"))
    if not within:
        total = counts.agg(F.sum("cnt").alias("n")).scalar()
        return counts.withColumn("pct", F.lit(100.0) * F.col("cnt") / total)
    totals = counts.groupBy(*within).agg(F.sum("cnt").alias("_total"))
    return (
        counts.join(totals, on=list(within))
        .withColumn("pct", F.lit(100.0) * F.col("cnt") / F.col("_total"))
        .drop("_total")
    )


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str] = (), low: float | None = None, high: float | None = None) -> DataFrame:
    """Counts of equal-width bins between the smallest and largest value, or between ``low`` and ``high``.

    Values outside the limits given are counted in bin -1 (below) and bin ``bins`` (above),
    whose outer limit is NULL.
    """
    rows = df.where(F.col(column).isNotNull())
    limits = rows.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo = F.lit(float(low)) if low is not None else F.col("_l.lo")
    hi = F.lit(float(high)) if high is not None else F.col("_l.hi")
    width = (hi - lo) / F.lit(bins)
    inside = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col(column) - lo, width))).cast("int")
    bin_ = F.when(F.col(column) < lo, -1).when(F.col(column) > hi, bins).otherwise(F.coalesce(inside, F.lit(0)))
    placed = with_row(rows, limits, "_l").withColumn("bin", bin_)
    counts = placed.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    return with_row(counts, limits, "_l").select(
        *keys,
        "bin",
        F.when(F.col("bin") >= 0, lo + F.col("bin") * width).alias("lower"),
        F.when(F.col("bin") < bins, lo + (F.col("bin") + 1) * width).alias("upper"),
        "n",
    )


def density(df: DataFrame, column: str, points: int = 50, keys: Sequence[str] = ()) -> DataFrame:
    """Gaussian kernel density per key at equally spaced points (``x``, ``density``).

    The bandwidth is 0.9 times the deviation (or the quartile distance / 1.34, if smaller)
    times n^-0.2, per key.  Values are counted on a grid of ten cells a point first, so the
    sums run over cells, not rows.
    """
    rows = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_v"))
    limits = rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_s"))
    quartiles = quantiles(rows, "_v", {"_low": 0.25, "_high": 0.75}, keys, discrete=True)
    per = join_small(per, quartiles, keys) if keys else with_row(per, quartiles, "_q").select("*", "_q.*")
    spread = F.least("_s", F.coalesce(F.nullif((F.col("_high") - F.col("_low")) / 1.34, F.lit(0.0)), F.col("_s")))
    per = per.select(*keys, "_n", (0.9 * spread * F.pow("_n", F.lit(-0.2))).alias("_w"))
    cells = 10 * points
    cell = F.least(F.lit(cells - 1), F.floor(F.try_divide((F.col("_v") - F.col("_l.lo")) * cells, F.col("_l.hi") - F.col("_l.lo"))))
    counted = with_row(rows, limits, "_l").groupBy(*keys, F.coalesce(cell, F.lit(0)).alias("_cell")).agg(F.count(F.lit(1)).alias("_c"), F.avg("_v").alias("_m"))
    joined = counted.join(per, list(keys)) if keys else with_row(counted, per, "_p").select("*", "_p.*")
    steps = F.sequence(F.lit(0), F.lit(points - 1))
    at = F.transform(steps, lambda i: F.col("_l.lo") + i * (F.col("_l.hi") - F.col("_l.lo")) / F.lit(float(max(1, points - 1))))
    each = with_row(joined, limits, "_l").withColumn("x", F.explode(at))
    z = F.try_divide(F.col("x") - F.col("_m"), F.col("_w"))
    share = F.sum(F.col("_c") * F.exp(-z * z / 2)) / F.max(F.col("_n") * F.col("_w") * math.sqrt(2 * math.pi))
    return each.groupBy(*keys, "x").agg(share.alias("density"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts in long form."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, a: str, b: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Contingency table with one column per level of ``b``: those named, or else all there are."""
    chosen = levels_of(df, b) if levels is None else list(levels)
    return df.groupBy(a).pivot(b, chosen).agg(F.count(F.lit(1))).na.fill(0)


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    kept = df.dropna(subset=list(columns) if columns else None)
    return kept.agg(F.count(F.lit(1)).alias("complete"))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
