"""Sampling and splitting by stable hashes, so a repeated run gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statloom.operators.ordered import ROWS_PER_SPLIT, running
from statloom.operators.relational import hash_order


def hash_unit(key: str | Sequence[str], seed: int = 0) -> Column:
    """A number from 0 up to 1, fixed by the key."""
    return F.conv(F.substring(hash_order(key, seed), 1, 7), 16, 10).cast("long") / F.lit(float(16**7))


def train_test_split(df: DataFrame, key: str | Sequence[str], percent: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    in_train = hash_unit(key, seed) < percent / 100
    return df.where(in_train), df.where(~in_train)


def fold_number(key: str | Sequence[str], folds: int, seed: int = 0) -> Column:
    """Fold 0 .. folds - 1."""
    return F.floor(hash_unit(key, seed) * folds).cast("int")


def _ranked_in_group(df: DataFrame, group: str, key: str | Sequence[str], seed: int, rows_per_split: int) -> DataFrame:
    """Adds the place ``_ix`` in the hash order of the group and the group's size ``_n``."""
    one = F.lit(1).cast("long")
    hashed = df.withColumn("_h", hash_order(key, seed))
    return running(hashed, [group], ["_h"], {"_ix": ("sum", one), "_n": ("total", one)}, rows_per_split).drop("_h")


def stratified_split(
    df: DataFrame, group: str, key: str | Sequence[str], fraction: float, seed: int = 0, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Adds ``in_sample``: true for exactly round(fraction * n) rows of every group."""
    ranked = _ranked_in_group(df, group, key, seed, rows_per_split)
    return ranked.withColumn("in_sample", F.col("_ix") <= F.round(F.col("_n") * F.lit(fraction))).drop("_ix", "_n")


def resample_classes(
    df: DataFrame, label: str, key: str | Sequence[str], method: str, seed: int = 0, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Equal class sizes: ``under`` (smallest), ``over`` (largest) or ``both`` (mean class size).

    A class that must grow repeats each row equally often; the remainder, like the
    kept part of a class that must shrink, follows the hash order.
    """
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    wanted = {"under": F.min("_n"), "over": F.max("_n"), "both": F.floor(F.avg("_n"))}[method]
    target = sizes.agg(wanted.cast("long").alias("t")).scalar()
    ranked = _ranked_in_group(df, label, key, seed, rows_per_split).withColumn("_t", target)
    copies = F.expr("_t div _n + CASE WHEN _ix <= _t % _n THEN 1 ELSE 0 END")
    repeated = ranked.withColumn("_copies", copies.cast("int")).where("_copies > 0")
    return repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop(
        "_ix", "_n", "_t", "_copies", "_copy"
    )


def table_sample(df: DataFrame, percent: float, seed: int, key: str | Sequence[str] | None = None) -> DataFrame:
    """Each row with the given chance; with a ``key`` the same rows whatever the layout."""
    if key is not None:
        return df.where(hash_unit(key, seed) < percent / 100)
    return df.sample(False, percent / 100, seed)
