"""Models fitted on bootstrap samples and combined."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from statloom.learn.scoring import complete, model_inputs
from statloom.learn.training import cell_columns, count_cells, fit_cells
from statloom.operators.sampling import hash_unit

# cumulative Poisson(1) probabilities, as far as a number of 28 bits can tell them from one
POISSON_STEPS = [sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(12)]


def times_drawn(key: str | Sequence[str], seed: int) -> Column:
    """How often a bootstrap sample has the row: a Poisson(1) number fixed by its key."""
    unit = hash_unit(key, seed)
    copies = None
    for n, limit in enumerate(POISSON_STEPS):
        copies = (F if copies is None else copies).when(unit < limit, F.lit(n))
    return copies.otherwise(F.lit(len(POISSON_STEPS)))


def bootstrap(df: DataFrame, key: str | Sequence[str], seed: int) -> DataFrame:
    """Every row ``times_drawn`` times; no row leaves its partition."""
    rows = df.withColumn("_copies", times_drawn(key, seed)).where("_copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


@dataclass
class Ensemble:
    models: list[PipelineModel]
    combine: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``: mean, majority vote, or class 1 from the mean probability; NULL where a member has none."""
        columns = df.columns
        # split once: a split a member would read the rows twice as often with each of them
        whole = complete([c for c in dict.fromkeys(c for m in self.models for c in model_inputs(m)) if c in columns])
        out, parts = df.where(whole), []
        for i, model in enumerate(self.models):
            scored = model.transform(out)
            if self.combine == "probability":
                part = vector_to_array("probability")[1]
            else:
                part = F.col("prediction")
            out = scored.select(*columns, *parts, part.alias(f"_p{i}"))
            parts.append(f"_p{i}")
        mean = sum((F.col(p) for p in parts), F.lit(0.0)) / len(parts)
        value = mean if self.combine == "average" else F.when(mean > 0.5, 1.0).when(mean.isNotNull(), 0.0)
        scored = out.withColumn("prediction", value).drop(*parts)
        return scored.unionByName(df.where(~whole), allowMissingColumns=True)


@dataclass
class EnsembleLearner:
    """Estimator form of ``fit_ensemble`` for lists of learners."""

    members: Sequence[Pipeline]
    key: str | Sequence[str]
    combine: str = "average"
    seed: int = 1

    def fit(self, df: DataFrame) -> Ensemble:
        return fit_ensemble(df, self.members, self.key, self.combine, self.seed)


def fit_ensemble(df: DataFrame, members: Sequence[Pipeline], key: str | Sequence[str], combine: str = "average", seed: int = 1) -> Ensemble:
    """``combine`` is ``average`` (regression), ``vote`` or ``probability`` (two classes)."""
    samples = sample_cells(df, members, key, seed)
    models = []
    for i, p in enumerate(members):
        rows = bootstrap(df, key, seed + i)
        models.append(fit_cells(p, rows, samples[i]) if i in samples else p.fit(rows))
    return Ensemble(models, combine)


def sample_cells(df: DataFrame, members: Sequence[Pipeline], key: str | Sequence[str], seed: int) -> dict[int, DataFrame]:
    """Distinct rows of a member's sample, ``_weight`` with how often they were drawn, by place in the list.

    Members that read the same columns are counted in one pass over the rows.  Missing are those without weights
    and those with few equal rows.
    """
    alike: dict[tuple[str, ...], list[int]] = {}
    for i, p in enumerate(members):
        names = cell_columns(p)
        if names:
            alike.setdefault(tuple(names), []).append(i)
    samples = {}
    for names, places in alike.items():
        cells = count_cells(df, names, {f"_draws{i}": times_drawn(key, seed + i) for i in places})
        if cells is not None:
            for i in places:
                drawn = F.col(f"_draws{i}")
                samples[i] = cells.where(drawn > 0).select(*names, drawn.alias("_weight"))
    return samples
