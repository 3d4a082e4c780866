"""Scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.scalars import SIGMOID_BASE
from statloom.operators.ordered import ROWS_PER_SPLIT, quantiles, with_row


def _shifted(df: DataFrame, row: DataFrame, column: str, name: str, start: Column, width: Column) -> DataFrame:
    """Distance from ``start`` in ``width``; both come from the one-row table."""
    return with_row(df, row, "_s").withColumn(name, F.try_divide(F.col(column) - start, width)).drop("_s")


def min_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """To 0..1; a constant column gives NULL."""
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    return _shifted(df, row, column, name, F.col("_s.lo"), F.col("_s.hi") - F.col("_s.lo"))


def quartile_scale(df: DataFrame, column: str, name: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Distance from the first quartile in interquartile ranges."""
    q = quantiles(df, column, {"q1": 0.25, "q3": 0.75}, rows_per_split=rows_per_split)
    return _shifted(df, q, column, name, F.col("_s.q1"), F.col("_s.q3") - F.col("_s.q1"))


def sigmoid_scale(column: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(SIGMOID_BASE), -column))


def log_scale(column: Column) -> tuple[Column, Column]:
    """Natural and decimal logarithm."""
    return F.ln(column), F.log10(column)


def standardise(df: DataFrame, column: str, name: str, population: bool = False) -> DataFrame:
    """Distance from the mean in sample (or population) deviations."""
    deviation = F.stddev_pop if population else F.stddev_samp
    row = df.agg(F.avg(column).alias("m"), deviation(column).alias("d"))
    return _shifted(df, row, column, name, F.col("_s.m"), F.col("_s.d"))


@dataclass
class MinMaxModel:
    """Ranges learnt on the training rows; constant columns are left out everywhere."""

    ranges: dict[str, tuple[float, float]]
    dropped: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {c: (F.col(c) - F.lit(lo)) / F.lit(hi - lo) for c, (lo, hi) in self.ranges.items()}
        return df.withColumns(scaled).drop(*self.dropped)


def fit_min_max(df: DataFrame, columns: Sequence[str]) -> MinMaxModel:
    """One row of ranges; a column with a single value, or none, is dropped."""
    row = df.agg(
        *[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    ranges, dropped = {}, []
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        if lo is None or lo == hi:
            dropped.append(c)
        else:
            ranges[c] = (lo, hi)
    return MinMaxModel(ranges, dropped)
