"""Loan risk: staging, balancing, what-if comparison and portfolio tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from statloom.operators.relational import differing, hash_order, union_all
from statloom.session import materialise


def stage_to_train(df: DataFrame, bad_statuses: Sequence[str], is_train: bool) -> DataFrame:
    """Derive the target from the loan status and mark the purpose of the rows."""
    return df.withColumns(
        {
            "is_bad": F.when(F.col("loan_status").isin(*bad_statuses), 1).otherwise(0),
            "is_train": F.lit(int(is_train)),
        }
    )


def undersample_good(df: DataFrame, key: str, percent: int = 10, seed: int = 0) -> DataFrame:
    """All bad loans and a stable share of the good ones."""
    bucket = F.conv(F.substring(hash_order(key, seed), 1, 4), 16, 10).cast("long") % 100
    return df.where((F.col("is_bad") == 1) | (bucket < percent))


def what_if(df: DataFrame, changes: dict[str, float]) -> DataFrame:
    """Shift columns before scoring."""
    return df.withColumns({c: F.col(c) + F.lit(by) for c, by in changes.items()})


def scenario_summary(scenarios: dict[str, DataFrame], column: str = "predicted") -> DataFrame:
    """Mean and deviation of the predictions of every scenario."""
    return union_all(
        [
            df.agg(F.avg(column).alias("average"), F.stddev_samp(column).alias("st_deviation")).select(
                F.lit(name).alias("scenario"), "average", "st_deviation"
            )
            for name, df in scenarios.items()
        ]
    )


def portfolio(loans: DataFrame, predictions: DataFrame) -> DataFrame:
    """Loans and amounts by status, state and predicted risk."""
    band = F.when(F.col("predicted") == 1, "High").otherwise("Low")
    return (
        loans.join(predictions.select("id", "predicted"), "id")
        .groupBy("loan_status", "addr_state", band.alias("charge_off_probability"))
        .agg(F.count(F.lit(1)).alias("loans"), F.sum("funded_amnt").alias("amount"))
    )


def compare_scenarios(
    loans: DataFrame, score: Callable[[DataFrame], DataFrame], changes: dict[str, float]
) -> dict[str, DataFrame]:
    """Score as is and changed; return flips, averages and both portfolios.

    ``score`` returns ``id`` and ``predicted``.
    """
    base, changed = materialise(score(loans)), materialise(score(what_if(loans, changes)))
    return {
        "flips": differing(base, changed, "id", "predicted"),
        "summary": scenario_summary({"what_if": changed, "base": base}),
        "base": portfolio(loans, base),
        "what_if": portfolio(loans, changed),
    }
