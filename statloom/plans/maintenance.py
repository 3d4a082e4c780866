"""Predictive maintenance: from sensor cycles to model tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from statloom.operators.relational import last_per_key
from statloom.operators.scale import MinMaxModel, fit_min_max
from statloom.operators.series import label_remaining_life, rolling_features


def train_features(cycles: DataFrame, sensors: Sequence[str], width: int = 5) -> DataFrame:
    """Labelled cycles with rolling means and deviations."""
    return rolling_features(label_remaining_life(cycles), "id", ["cycle"], sensors, width)


def test_features(cycles: DataFrame, sensors: Sequence[str], width: int = 5, truth: DataFrame | None = None) -> DataFrame:
    """The last cycle of every entity with its rolling features."""
    rows = label_remaining_life(cycles, truth)
    return last_per_key(rolling_features(rows, "id", ["cycle"], sensors, width), ["id"], ["cycle"])


def normalised(train: DataFrame, test: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame, MinMaxModel]:
    """Both tables scaled by the training ranges."""
    model = fit_min_max(train, features)
    return model.transform(train), model.transform(test), model
