"""Scoring and the model registry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statloom.operators.ordered import join_small
from statloom.session import materialise
from statloom.sources.writers import upsert

REGISTRY_SCHEMA = (
    "name string, path string, trees int, per_split int, depth int, min_leaf int, train_f double, test_f double, trained timestamp"
)


def model_inputs(model: PipelineModel) -> list[str]:
    """Number columns that the pipeline assembles from its input; indexed text may be missing."""
    made = {s.getOutputCol() for s in model.stages if s.hasParam("outputCol")}
    assembled = [c for s in model.stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    return [c for c in dict.fromkeys(assembled) if c not in made]


def complete(names: Sequence[str]) -> Column:
    """Neither NULL nor NaN in any of the columns."""
    return reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in names], F.lit(True))


def transform_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform`` for complete rows; the others stay, with NULL in the new columns."""
    whole = complete([c for c in model_inputs(model) if c in df.columns])
    rest = df.where(~whole)
    return model.transform(df.where(whole)).unionByName(rest, allowMissingColumns=True)


@dataclass
class OncePerRow:
    """A costly model that scores each distinct row of ``columns`` once; equal rows share its prediction."""

    model: PipelineModel
    columns: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, NULL for a row with a missing number."""
        found = self.model.transform(df.select(*self.columns).distinct()).select(*self.columns, "prediction")
        return join_small(df, found, self.columns, "left")


@dataclass
class WrittenOnce:
    """A costly model whose predictions are written once, beside the ``keep`` columns, for figures that read them several times."""

    model: object
    keep: Sequence[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return materialise(self.model.transform(df).select(*self.keep, "prediction"))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str], classes: int = 0) -> DataFrame:
    """Kept columns, one probability per class and the prediction, for every row.

    A row with a missing number has NULL for all of them.
    """
    out = transform_all(model, df)
    probabilities = []
    if classes and "probability" in out.columns:
        array = vector_to_array("probability")
        known = F.col("probability").isNotNull()
        probabilities = [F.when(known, array[k]).alias(f"prob_{k}") for k in range(classes)]
    return out.select(*keep, *probabilities, "prediction")


def score_where(model: PipelineModel, df: DataFrame, condition: str, keep: Sequence[str], classes: int = 0) -> DataFrame:
    """Score the rows of a filter only."""
    return score(model, df.where(condition), keep, classes)


def score_one(model: PipelineModel, spark: SparkSession, values: dict, classes: int = 0) -> DataFrame:
    """Score a single row given by name."""
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return score(model, row, list(values), classes)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def register(registry: DataFrame, entry: dict) -> DataFrame:
    """Add the model or replace the one of the same name."""
    spark = registry.sparkSession
    names = [f.name for f in registry.schema.fields]
    row = spark.createDataFrame([tuple(entry.get(n) for n in names)], registry.schema)
    return upsert(registry, row.withColumn("trained", F.coalesce("trained", F.current_timestamp())), ["name"])


def set_test_score(registry: DataFrame, name: str, test_f: float) -> DataFrame:
    return registry.withColumn("test_f", F.when(F.col("name") == name, F.lit(float(test_f))).otherwise(F.col("test_f")))


def model_sizes(registry: DataFrame) -> DataFrame:
    """Registry rows with the size of the saved model in megabytes, from the files' listing."""
    spark = registry.sparkSession
    sizes = None
    for r in registry.select("name", "path").collect():  # one row per model
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(r["path"])
        own = files.agg((F.sum("length") / 2**20).alias("model_mb")).withColumn("name", F.lit(r["name"]))
        sizes = own if sizes is None else sizes.unionByName(own)
    return registry.withColumn("model_mb", F.lit(None).cast("double")) if sizes is None else registry.join(sizes, "name")
