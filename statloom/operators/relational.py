"""Joins, limits, duplicates and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statloom.operators.ordered import ROWS_PER_SPLIT, average_rank, dense_rank, join_small, row_index, running, sort_columns


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """Join each (dimension, fact key, dimension key) in turn; sizes decide the join method."""
    out = fact
    for dim, fact_key, dim_key in dimensions:
        out = out.join(dim, F.col(fact_key) == F.col(dim_key), how)
    return out


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all columns the two sides share."""
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key as an aggregate, so large keys shrink before the shuffle."""
    row = F.struct(*df.columns)
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the order."""
    row = F.struct(*df.columns)
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def differing(a: DataFrame, b: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of two tables whose value differs; two columns of one table need only a filter."""
    left = a.select(key, F.col(column).alias("before"))
    right = b.select(key, F.col(column).alias("after"))
    return left.join(right, key).where("before <> after")


def ranked_ends(df: DataFrame, order: Sequence[str], top: int, bottom_from: int, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Rows ranked up to ``top`` or from ``bottom_from`` on."""
    ranked = row_index(df, [], order, "rn", rows_per_split)
    return ranked.where((F.col("rn") <= top) | (F.col("rn") >= bottom_from))


def in_top_or_bottom(df: DataFrame, column: str, n: int) -> DataFrame:
    """Rows whose value is among the ``n`` largest or ``n`` smallest rows' values."""
    # both lists hold at most n values
    high = df.select(column).orderBy(F.col(column).desc()).limit(n)
    low = df.select(column).orderBy(F.col(column).asc()).limit(n)
    return df.join(F.broadcast(high.union(low).distinct()), column, "left_semi")


def top(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*sort_columns(order)).limit(n)


def random_order(df: DataFrame, seed: int) -> DataFrame:
    return df.orderBy(F.rand(seed))


def hash_order(key: str | Sequence[str], seed: int = 0) -> Column:
    """A stable pseudo-random text per row."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def random_percent(df: DataFrame, key: str | Sequence[str], percent: float, seed: int = 0, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """The first ``percent`` (rounded up) of the rows in a random order fixed by the key."""
    one = F.lit(1).cast("long")
    hashed = df.withColumn("_h", hash_order(key, seed))
    indexed = running(hashed, [], ["_h"], {"_ix": ("sum", one), "_total": ("total", one)}, rows_per_split)
    wanted = F.ceil(F.col("_total") * F.lit(percent) / F.lit(100.0))
    return indexed.where(F.col("_ix") <= wanted).drop("_h", "_ix", "_total")


def axis(start: float, step: float, count: int) -> Column:
    """Array of ``count`` values from ``start`` on."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.lit(start) + i * F.lit(step))


def parameter_grid(spark: SparkSession, axes: dict[str, tuple[float, float, int]]) -> DataFrame:
    """All combinations of (start, step, count) sequences."""
    out = spark.range(1)
    for name, sequence in axes.items():
        out = out.withColumn(name, F.explode(axis(*sequence)))
    return out.drop("id")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def levels_of(df: DataFrame, column: str, most: int = 10_000) -> list:
    """The values of a column that names columns; too many of them is an error."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} levels")
    return sorted(r[0] for r in found)


def spread(df: DataFrame, ids: Sequence[str], key: str, value: str, levels: Sequence | None = None) -> DataFrame:
    """Long to wide, one column per level: those named, or else all there are."""
    chosen = levels_of(df, key) if levels is None else list(levels)
    return df.groupBy(*ids).pivot(key, chosen).agg(F.first(value, ignorenulls=True))


def gather(df: DataFrame, ids: Sequence[str], columns: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(columns), key, value)


def separate(df: DataFrame, column: str, into: Sequence[str], pattern: str = "[^A-Za-z0-9]+") -> DataFrame:
    """Split text into named pieces, which stay text."""
    pieces = F.split(F.col(column), pattern)
    return df.withColumns({n: F.get(pieces, F.lit(i)) for i, n in enumerate(into)}).drop(column)


def unite(df: DataFrame, columns: Sequence[str], name: str, separator: str = "_") -> DataFrame:
    parts = [F.col(c).cast("string") for c in columns]
    return df.withColumn("_united", F.concat_ws(separator, *parts)).drop(*columns).withColumnRenamed("_united", name)


def add_code(df: DataFrame, column: str, name: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Position of the row's value among the distinct values."""
    return join_small(df, dense_rank(df, column, name, rows_per_split), [column])


def rank_lowest(df: DataFrame, column: str, below: float, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Rows whose tie-averaged ascending rank is under ``below``."""
    ranks = average_rank(df, column, "rank", rows_per_split).where(F.col("rank") < below).drop("n", "total")
    return join_small(df, ranks, [column])
