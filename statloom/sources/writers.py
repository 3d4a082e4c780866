"""Writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statloom.session import ensure_checkpoint_dir


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``mode`` is ``overwrite`` or ``append``."""
    df.write.mode(mode).parquet(path)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    write_table(spark.read.parquet(source), target)


def truncate_table(spark: SparkSession, path: str) -> None:
    """Empty the table and keep its schema."""
    schema = spark.read.parquet(path).schema
    write_table(spark.createDataFrame([], schema), path)


def insert_rows(df: DataFrame, path: str) -> None:
    write_table(df, path, "append")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left by a delete: a NULL condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def upsert(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows with a known key, add the others."""
    keys = list(keys)
    others = [c for c in base.columns if c not in keys]
    fresh = rows.select(*keys, F.struct(*others).alias("_new"))
    old = base.select(*keys, F.struct(*others).alias("_old"))
    joined = old.join(fresh, keys, "full_outer").withColumn("_row", F.coalesce("_new", "_old"))
    return joined.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in base.columns])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, reachable by all executors."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def log_event(log: DataFrame | None, spark: SparkSession, session_id: int, run_time: str, note: str) -> DataFrame:
    """Append one entry to a run log."""
    row = spark.createDataFrame([(session_id, run_time, note)], "session_id int, run_time string, note string")
    row = row.withColumn("run_time", F.col("run_time").cast("timestamp"))
    return row if log is None else log.unionByName(row)


def latest(log: DataFrame, n: int = 2) -> DataFrame:
    return log.orderBy(F.col("run_time").desc()).limit(n)
