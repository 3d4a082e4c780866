"""One model per group without collecting a group anywhere.

Each pass sums products of columns per group, which Spark combines before the
shuffle, so a group of any size becomes one short row; only those rows are solved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType

from statloom.functions.scalars import sigmoid
from statloom.operators.ordered import join_small
from statloom.session import materialise

SMALL_TABLE = 50_000


@pandas_udf(ArrayType(DoubleType()))
def _solve(gram: pd.Series, right: pd.Series) -> pd.Series:
    out = []
    for g, r in zip(gram, right):
        n = len(r)
        a = np.zeros((n, n))
        a[np.triu_indices(n)] = g
        a = a + np.triu(a, 1).T
        out.append(np.linalg.lstsq(a, np.asarray(r, dtype=float), rcond=None)[0].tolist())
    return pd.Series(out)


def _terms(features: Sequence[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(c).cast("double") for c in features]]


def _gram(terms: list[Column], weight: Column) -> Column:
    n = len(terms)
    return F.array(*[F.sum(weight * terms[i] * terms[j]) for i in range(n) for j in range(i, n)])


def group_linear(df: DataFrame, group: str, features: Sequence[str], label: str) -> DataFrame:
    """Rows (group, n, coefficients): intercept first, then one per feature."""
    terms = _terms(features)
    rows = df.dropna(subset=[*features, label])
    sums = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        _gram(terms, F.lit(1.0)).alias("gram"),
        F.array(*[F.sum(t * F.col(label)) for t in terms]).alias("right"),
    )
    return sums.select(group, "n", _solve("gram", "right").alias("coefficients"))


def _linear_score(features: Sequence[str], coefficients: str) -> Column:
    b = F.col(coefficients)
    return sum((b[i + 1] * F.col(c).cast("double") for i, c in enumerate(features)), b[0])


def _fixed(model: DataFrame, few: bool) -> DataFrame:
    """The model computed once: a local, broadcast table for few groups, a written one for many."""
    if few:
        return F.broadcast(model.sparkSession.createDataFrame(model.collect(), model.schema))
    return materialise(model)


def group_logistic(
    df: DataFrame, group: str, features: Sequence[str], label: str, iterations: int = 25, ridge: float = 1e-6
) -> DataFrame:
    """Rows (group, coefficients, converged) of one logistic model per group, by Newton steps over all groups at once.

    A step is held to 5 deviations per coefficient: a group whose classes can be told apart
    without error has no finite fit and ends with ``converged`` false, as does one that
    needs more than ``iterations``.
    """
    rows = df.dropna(subset=[group, *features, label])
    means = rows.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    centre = [means[f"m{i}"] for i in range(len(features))]
    spread = [means[f"s{i}"] or 1.0 for i in range(len(features))]
    scaled = materialise(
        rows.select(
            group,
            F.col(label).cast("double").alias("_y"),
            *[((F.col(c) - F.lit(centre[i])) / F.lit(spread[i])).alias(f"_x{i}") for i, c in enumerate(features)],
        )
    )
    names = [f"_x{i}" for i in range(len(features))]
    size = len(features) + 1
    diagonal = [float(i == j) * ridge for i in range(size) for j in range(i, size)]
    groups = scaled.select(group).distinct()
    few = groups.count() <= SMALL_TABLE
    model = _fixed(groups.withColumns({"_b": F.array(*[F.lit(0.0)] * size), "_move": F.lit(float("inf"))}), few)
    for _ in range(iterations):
        p = sigmoid(_linear_score(names, "_b"))
        terms = _terms(names)
        step = (
            scaled.join(model.drop("_move"), group)
            .withColumn("_p", p)
            .groupBy(group)
            .agg(
                F.first("_b").alias("_b"),
                _gram(terms, F.col("_p") * (1 - F.col("_p"))).alias("gram"),
                F.array(*[F.sum(t * (F.col("_y") - F.col("_p"))) for t in terms]).alias("right"),
            )
        )
        gram = F.zip_with("gram", F.array(*[F.lit(d) for d in diagonal]), lambda a, b: a + b)
        moved = step.withColumn("_d", _solve(gram, F.col("right")))
        held = F.transform("_d", lambda d: F.greatest(F.lit(-5.0), F.least(F.lit(5.0), d)))
        next_ = moved.select(
            group,
            F.zip_with("_b", held, lambda a, b: a + b).alias("_b"),
            F.array_max(F.transform("_d", lambda d: F.abs(d))).alias("_move"),
        )
        if few:
            found = next_.collect()  # at most SMALL_TABLE short rows
            move = max((r["_move"] for r in found), default=0.0)
            model = F.broadcast(df.sparkSession.createDataFrame(found, next_.schema))
        else:
            done = materialise(next_)
            move = done.agg(F.max("_move").alias("m")).first()["m"]
            model = done
        if move is not None and move < 1e-8:
            break
    b = F.col("_b")
    slopes = [b[i + 1] / F.lit(spread[i]) for i in range(len(features))]
    intercept = b[0] - sum((s * F.lit(centre[i]) for i, s in enumerate(slopes)), F.lit(0.0))
    return model.select(group, F.array(intercept, *slopes).alias("coefficients"), (F.col("_move") < 1e-8).alias("converged"))


def score_groups(df: DataFrame, model: DataFrame, group: str, features: Sequence[str], name: str, logistic: bool = False) -> DataFrame:
    """Apply the model of the row's own group; groups without a model give NULL."""
    score = _linear_score(features, "coefficients")
    joined = join_small(df, model.select(group, "coefficients"), [group], "left")
    return joined.withColumn(name, sigmoid(score) if logistic else score).drop("coefficients")
