"""Comparing models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from statloom.learn.scoring import transform_all
from statloom.operators.association import top_correlated
from statloom.operators.ordered import row_index, with_row
from statloom.operators.relational import union_all
from statloom.operators.sampling import fold_number
from statloom.session import materialise

Fit = Callable[[DataFrame], object]
Evaluate = Callable[[DataFrame], DataFrame]


def measured(model, df: DataFrame, evaluate: Evaluate) -> DataFrame:
    """Metrics of a model, with ``unscored``: rows that have no prediction, as a feature is missing."""
    found = transform_all(model, df) if isinstance(model, PipelineModel) else model.transform(df)
    missing = found.agg(F.count_if(F.col("prediction").isNull()).alias("unscored"))
    return with_row(evaluate(found), missing, "_u").withColumn("unscored", F.col("_u.unscored")).drop("_u")


def combine_metrics(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row per model."""
    return union_all([m.select(F.lit(name).alias("name"), "*") for name, m in metrics.items()])


def rank_metrics(metrics: dict[str, DataFrame], by: str, descending: bool = True) -> DataFrame:
    """Model rows with their place, best first."""
    order = ("-" if descending else "") + by
    return row_index(combine_metrics(metrics), [], [order, "name"], "rn")


def cross_validate(df: DataFrame, key, folds: int, fit: Fit, evaluate: Evaluate, seed: int = 0) -> DataFrame:
    """Metrics per fold; each fold is scored by a model that has not seen it."""
    rows = materialise(df.withColumn("_fold", fold_number(key, folds, seed)))
    parts = []
    for i in range(folds):
        model = fit(rows.where(F.col("_fold") != i).drop("_fold"))
        parts.append(measured(model, rows.where(F.col("_fold") == i).drop("_fold"), evaluate).select(F.lit(i).alias("fold"), "*"))
    return union_all(parts)


def fold_summary(folds: DataFrame, metric: str) -> DataFrame:
    return folds.agg(F.avg(metric).alias("mean"), F.stddev_samp(metric).alias("st_deviation"), F.count(F.lit(1)).alias("folds"))


def generalisation(model, train: DataFrame, test: DataFrame, evaluate: Evaluate) -> DataFrame:
    """The same metrics on training and test rows."""
    return union_all(
        [measured(model, d, evaluate).select(F.lit(n).alias("part"), "*") for n, d in (("train", train), ("test", test))]
    )


def model_factory(
    train: DataFrame,
    test: DataFrame,
    target: str,
    top_variables: int,
    learners: dict[str, Callable[[list[str]], object]],
    evaluate: Evaluate,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Fit every learner on the most correlated columns; one metrics row per learner.

    A learner is a function from the chosen features to an estimator.
    """
    train, test = materialise(train), materialise(test)
    chosen = [r["variable"] for r in top_correlated(train, target, top_variables, exclude).collect()]
    metrics = {}
    for name, make in learners.items():
        model = make(chosen).fit(train)
        # a metrics row is final once computed; no later step fits the model again
        row = measured(model, test, evaluate)
        metrics[name] = train.sparkSession.createDataFrame(row.collect(), row.schema)
    return combine_metrics(metrics).withColumn("variables", F.lit(len(chosen)))


def tune(
    train: DataFrame,
    test: DataFrame,
    combinations: DataFrame,
    make: Callable[[dict], object],
    evaluate: Evaluate,
    metric: str,
    parallel: int = 4,
) -> DataFrame:
    """One row per tried combination with its metric on training and test rows, best test first."""
    train, test = materialise(train), materialise(test)
    tried = [r.asDict() for r in combinations.collect()]  # the sampled combinations

    def one(params: dict) -> tuple:
        model = make(params).fit(train)
        scores = [measured(model, d, evaluate).first()[metric] for d in (train, test)]
        return (*params.values(), *scores)

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(one, tried))
    types = ", ".join(f"{n} {t}" for n, t in combinations.dtypes)
    board = train.sparkSession.createDataFrame(rows, f"{types}, train_{metric} double, test_{metric} double")
    return board.orderBy(F.col(f"test_{metric}").desc())


def count_reaching(board: DataFrame, column: str, at_least: float) -> DataFrame:
    return board.where(F.col(column) >= at_least).agg(F.count(F.lit(1)).alias("models"))
