"""Imputation, bad rows and outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.scalars import nearest_half
from statloom.operators.describe import mode
from statloom.operators.ordered import ROWS_PER_SPLIT, join_small, quantiles, with_row


def fill_constant(df: DataFrame, values: dict[str, object], flag_suffix: str | None = None) -> DataFrame:
    """Replace NULL; with ``flag_suffix`` keep a 0/1 column telling where."""
    columns = {}
    for name, value in values.items():
        if flag_suffix:
            columns[name + flag_suffix] = F.when(F.col(name).isNull(), 1).otherwise(0)
        columns[name] = F.coalesce(F.col(name), F.lit(value))
    return df.withColumns(columns)


def fill_group_median(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    discrete: bool = True,
    round_half: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Replace NULL by the median of the row's group."""
    medians = quantiles(df, column, {"_median": 0.5}, keys, discrete, rows_per_split)
    fill = nearest_half(F.col("_median")) if round_half else F.col("_median")
    joined = join_small(df, medians, keys, "left")
    return joined.withColumn(column, F.coalesce(F.col(column), fill)).drop("_median")


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Replace NULL by the smallest of the most frequent values."""
    common = mode(df, column, drop_null=True).agg(F.min(column).alias("m")).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), common))


def fill_median(df: DataFrame, column: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    median = quantiles(df, column, {"m": 0.5}, rows_per_split=rows_per_split).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), median))


def bad_row(rules: Sequence[Column]) -> Column:
    """True when any rule holds; an unknown rule does not condemn a row."""
    return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules])


def split_bad_rows(df: DataFrame, rules: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, removed rows)."""
    return df.where(~bad_row(rules)), df.where(bad_row(rules))


def mark_outliers(df: DataFrame, columns: Sequence[str], k: float = 3, name: str = "outlier") -> DataFrame:
    """Flag values outside mean -/+ k deviations.

    Adds the text column ``name`` (NULL without outliers) and the array
    ``name + "_columns"`` for filters.
    """
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    bounded, stats = with_row(df, row, "_stats"), F.col("_stats")
    texts, flags = [], []
    for i, c in enumerate(columns):
        low, high = stats[f"m{i}"] - k * stats[f"s{i}"], stats[f"m{i}"] + k * stats[f"s{i}"]
        outside = (F.col(c) < low) | (F.col(c) > high)
        bounds = F.format_string("(%d, %d)", F.round(low).cast("long"), F.round(high).cast("long"))
        texts.append(F.when(outside, F.concat(F.lit(f"[{c}] outside "), bounds)))
        flags.append(F.when(outside, F.lit(c)))
    text = F.concat_ws("; ", *texts)
    return bounded.withColumns(
        {name: F.nullif(text, F.lit("")), name + "_columns": F.array_compact(F.array(*flags))}
    ).drop("_stats")


def drop_outliers(df: DataFrame, columns: Sequence[str], name: str = "outlier") -> DataFrame:
    """Remove rows that are outliers in all listed columns."""
    wanted = F.array(*[F.lit(c) for c in columns])
    return df.where(F.size(F.array_except(wanted, F.col(name + "_columns"))) > 0)


def clip_outliers(df: DataFrame, column: str, bound: float, name: str = "outlier") -> DataFrame:
    """Set flagged values over the bound to the bound."""
    flagged = F.array_contains(F.col(name + "_columns"), F.lit(column))
    return df.withColumn(
        column, F.when(flagged & (F.col(column) > bound), F.lit(float(bound))).otherwise(F.col(column))
    )
