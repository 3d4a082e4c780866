"""Named queries over the standard tables, each with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


@dataclass
class Entry:
    run: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def add(fn: Callable[["Tables"], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return add


class Tables:
    """Attribute access to the tables of one folder and to the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        from statloom.catalog.inputs import INPUTS

        if name.startswith("_"):
            raise AttributeError(name)
        if name in INPUTS:
            sources, text = INPUTS[name]
            return self.spark.sql(text, **{s: getattr(self, s) for s in sources})
        return self.read(name)


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Round double columns so two engines agree; adding 0.0 removes negative zero."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def load_all() -> dict[str, Entry]:
    from statloom.catalog import (  # noqa: F401
        association,
        cleaning,
        descriptive,
        jobs,
        models,
        relational,
        scalars,
        series,
        sampling,
        evaluation,
    )

    return REGISTRY
