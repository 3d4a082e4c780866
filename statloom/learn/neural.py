"""Neural network regression with one or two hidden layers.

Every step is one pass over the rows, which are packed into blocks once: tasks add
up the gradient of their rows, Spark adds up the tasks, and the driver moves the
weights, whose number is fixed by the layer sizes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from statloom.session import materialise

#: Numbers in a stored block of rows: a task is handed 10,000 blocks at a time, which should stay a few MB.
BLOCK_NUMBERS = 128
#: Rows a gradient is taken over at a time: few enough for a core's cache, many enough to hide the cost of a call.
STEP_ROWS = 1_024


def _shapes(sizes: Sequence[int]) -> list[tuple[int, int]]:
    return [(a + 1, b) for a, b in zip(sizes, sizes[1:])]


def _unpack(weights: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _shapes(sizes):
        out.append(weights[at : at + shape[0] * shape[1]].reshape(shape))
        at += shape[0] * shape[1]
    return out


def _forward(x: np.ndarray, layers: list[np.ndarray]) -> list[np.ndarray]:
    values = [x]
    for i, w in enumerate(layers):
        z = values[-1] @ w[:-1]
        z += w[-1]
        values.append(z if i == len(layers) - 1 else np.tanh(z, out=z))
    return values


def _gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, float]:
    layers = _unpack(weights, sizes)
    values = _forward(x, layers)
    error = values[-1] - y[:, None]
    parts, back = [], error
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.vstack([values[i].T @ back, back.sum(axis=0)]).ravel())
        if i:
            back = back @ layers[i][:-1].T
            back *= 1 - values[i] * values[i]
    return np.concatenate(parts[::-1]), float((error**2).sum())


def packed(rows: DataFrame) -> DataFrame:
    """Rows of numbers as ``block``, the bytes of at most ``BLOCK_NUMBERS`` doubles, row after row.

    A pass then hands a task one value a block instead of one a number.
    """
    size = max(1, BLOCK_NUMBERS // len(rows.columns))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf.to_numpy(dtype=float)
            yield pd.DataFrame({"block": [values[i : i + size].tobytes() for i in range(0, len(values), size)]})

    return rows.mapInPandas(pack, "block binary")


@dataclass
class NetworkModel:
    features: list[str]
    sizes: list[int]
    weights: np.ndarray
    centre: list[float]
    spread: list[float]
    label_centre: float
    label_spread: float
    losses: list[float] = field(default_factory=list)

    def scaled(self) -> list[Column]:
        return [
            ((F.col(c).cast("double") - F.lit(m)) / F.lit(s)) for c, m, s in zip(self.features, self.centre, self.spread)
        ]

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        weights, sizes, centre, spread = self.weights, self.sizes, self.label_centre, self.label_spread

        @pandas_udf(DoubleType())
        def predict(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(_forward(x, _unpack(weights, sizes))[-1][:, 0] * spread + centre)

        return df.withColumn(name, predict(*self.scaled()))


@dataclass
class NetworkLearner:
    """Estimator form of ``fit_network`` for lists of learners."""

    features: Sequence[str]
    label: str
    options: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> NetworkModel:
        return fit_network(df, self.features, self.label, **self.options)


def fit_network(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    hidden: Sequence[int] = (20,),
    iterations: int = 100,
    rate: float = 0.2,
    momentum: float = 0.8,
    rate_reduction: float = 0.8,
    reduce_every: int = 25,
    seed: int = 1,
) -> NetworkModel:
    """Squared loss, gradient steps with Nesterov momentum over all rows, inputs standardised."""
    columns = [*features, label]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    fit = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    centre = [fit[f"m{i}"] for i in range(len(columns))]
    spread = [fit[f"s{i}"] or 1.0 for i in range(len(columns))]
    sizes = [len(features), *hidden, 1]
    rng = np.random.default_rng(seed)
    weights = np.concatenate([rng.normal(0, 1 / math.sqrt(a), size=a * b) for a, b in _shapes(sizes)])
    model = NetworkModel(list(features), sizes, weights, centre[:-1], spread[:-1], centre[-1], spread[-1])
    target = (F.col(label) - F.lit(centre[-1])) / F.lit(spread[-1])
    inputs = [c.alias(f"x{i}") for i, c in enumerate(model.scaled())]
    train = materialise(packed(rows.select(*inputs, target.alias("y"))))
    count, velocity = fit["n"], np.zeros_like(weights)
    for step in range(iterations):
        ahead = weights + momentum * velocity

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, loss = np.zeros_like(ahead), 0.0
            for pdf in batches:
                values = np.frombuffer(b"".join(pdf["block"])).reshape(-1, sizes[0] + 1)
                for i in range(0, len(values), STEP_ROWS):
                    part = values[i : i + STEP_ROWS]
                    g, l = _gradient(part[:, :-1], part[:, -1], ahead, sizes)
                    total, loss = total + g, loss + l
            yield pd.DataFrame({"i": np.arange(len(total) + 1), "g": np.append(total, loss)})

        summed = train.mapInPandas(partial, "i long, g double").groupBy("i").agg(F.sum("g").alias("g"))
        gradient = np.zeros(len(weights) + 1)
        for r in summed.collect():  # one number per weight
            gradient[r["i"]] = r["g"]
        model.losses.append(gradient[-1] / count)
        now = rate * rate_reduction ** (step // reduce_every)
        velocity = momentum * velocity - now * gradient[:-1] / count
        weights = weights + velocity
    model.weights = weights
    return model
