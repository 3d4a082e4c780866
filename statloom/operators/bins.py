"""Binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statloom.operators.ordered import ROWS_PER_SPLIT, ntile, with_row

MONEY = "decimal(18,2)"


def equal_width_bins(df: DataFrame, column: str, bins: int, name: str = "bin", whole_start: bool = False) -> DataFrame:
    """Label ``lo - hi`` per row, the last bin ``lo + ``.

    ``whole_start`` cuts the minimum to a whole number; then values below it, like
    NULL, are labelled as the last bin.
    """
    lo, hi = F.min(column).cast("double"), F.max(column).cast("double")
    low = (lo.cast("long") if whole_start else lo).cast(MONEY)
    limits = df.agg(low.alias("low"), ((hi - lo) / F.lit(bins)).cast(MONEY).alias("width"))
    rows = with_row(df, limits, "_l")

    def edge(i: int) -> Column:
        return (F.col("_l.low") + F.lit(i) * F.col("_l.width")).cast(MONEY)

    label = None
    for i in range(bins - 1):
        inside = F.col(column) < edge(i + 1).cast("double")
        if whole_start or i > 0:
            inside = (F.col(column) >= edge(i).cast("double")) & inside
        text = F.concat_ws(" - ", edge(i).cast("string"), edge(i + 1).cast("string"))
        label = (F if label is None else label).when(inside, text)
    last = F.concat(edge(bins - 1).cast("string"), F.lit(" + "))
    label = label.otherwise(last) if label is not None else last
    return rows.withColumn(name, label).drop("_l")


def equal_height_bins(
    df: DataFrame, column: str, bins: int, name: str = "bin", rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Rows with their equal-count bin."""
    return ntile(df, [column], bins, name, rows_per_split)


def bin_summary(df: DataFrame, column: str, name: str = "bin") -> DataFrame:
    return df.groupBy(name).agg(F.min(column).alias("min"), F.max(column).alias("max"), F.count(F.lit(1)).alias("cnt"))


def custom_bins(column: Column, cuts: Sequence[float], null_bin: int | None = None) -> Column:
    """Bin number with inclusive upper cuts; NULL goes to the last bin unless named."""
    out = F.when(column.isNull(), F.lit(len(cuts) if null_bin is None else null_bin))
    for i, cut in enumerate(cuts):
        out = out.when(column <= F.lit(cut), F.lit(i))
    return out.otherwise(F.lit(len(cuts)))
