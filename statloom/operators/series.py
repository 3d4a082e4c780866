"""Ordered series per entity: smoothing, rolling features, life labels, autocorrelation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from statloom.functions.aggregates import pearson
from statloom.operators.ordered import ROWS_PER_SPLIT, join_small, look_back, row_index, running


def moving_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, width: int = 5,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    return look_back(
        df, keys, order, width - 1,
        lambda w: {name: F.avg(column).over(w.rowsBetween(-(width - 1), 0))},
        rows_per_split,
    )


def weighted_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, weight: float = 0.7,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Current value and previous one; the first row is its own previous value."""

    def build(w):
        before = F.coalesce(F.lag(column).over(w), F.col(column))
        return {"prev_" + column: before, name: F.lit(weight) * F.col(column) + F.lit(1 - weight) * before}

    return look_back(df, keys, order, 1, build, rows_per_split)


def exponential_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, weight: float = 0.7,
    rows_per_split: int = ROWS_PER_SPLIT, digits: int | None = None,
) -> DataFrame:
    """e(0) = x(0), e(t) = weight x(t) + (1 - weight) e(t-1), for values without NULL;
    rounded on request.

    Rows are numbered, then handled in short blocks.  Inside a block the average is
    a running sum of x(j) / keep^j times keep^j, which stays in range because the
    block is short.  After a whole block the share of older history is about
    1e-40, so the end of the block before is all a block needs from the past.
    """
    keys = list(keys)
    keep = 1.0 - weight
    size = max(2, math.ceil(92 / -math.log(keep)))
    rows = row_index(df, keys, order, "_ix", rows_per_split)
    rows = rows.withColumns({"_block": F.expr(f"(_ix - 1) div {size}"), "_j": F.expr(f"(_ix - 1) % {size}")})
    share = F.when(F.col("_ix") == 1, F.lit(1.0)).otherwise(F.lit(weight))
    inside = Window.partitionBy(*keys, "_block").orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    grown = F.sum(share * F.col(column) * F.pow(F.lit(keep), -F.col("_j"))).over(inside)
    rows = rows.withColumn("_local", grown * F.pow(F.lit(keep), F.col("_j")))
    named = [F.col(k).alias("_e_" + k) for k in keys]
    ends = rows.groupBy(*named, (F.col("_block") + 1).alias("_e__block")).agg(F.max_by("_local", "_j").alias("_past"))
    match = reduce(and_, [rows[k].eqNullSafe(ends["_e_" + k]) for k in [*keys, "_block"]])
    joined = rows.join(ends, match, "left").drop(*["_e_" + k for k in [*keys, "_block"]])
    past = F.coalesce(F.pow(F.lit(keep), F.col("_j") + 1) * F.col("_past"), F.lit(0.0))
    value = F.col("_local") + past
    if digits is not None:
        value = F.round(value, digits)
    return joined.withColumn(name, value).drop("_ix", "_block", "_j", "_local", "_past")


def rolling_features(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], width: int = 5,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Mean ``aN`` and deviation ``sdN`` of the last rows for each ``sN``; one row has deviation 0."""

    def build(w):
        frame = w.rowsBetween(-(width - 1), 0)
        means = {c.replace("s", "a", 1): F.avg(c).over(frame) for c in columns}
        spread = {c.replace("s", "sd", 1): F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0)) for c in columns}
        return means | spread

    return look_back(df, [key], order, width - 1, build, rows_per_split)


def label_remaining_life(
    df: DataFrame, truth: DataFrame | None = None, key: str = "id", cycle: str = "cycle",
    soon: int = 30, urgent: int = 15,
) -> DataFrame:
    """Cycles left, a two-class and a three-class label.

    ``truth`` (key, rul) adds the cycles a test entity still ran after its last row; an
    entity without truth has NULL for all three.
    """
    last = df.groupBy(key).agg(F.max(cycle).alias("_last"))
    if truth is not None:
        last = last.join(truth.select(key, F.col("rul").alias("_extra")), key, "left").select(
            key, (F.col("_last") + F.col("_extra")).alias("_last")
        )
    rul = F.col("_last") - F.col(cycle)
    label1 = F.when(rul <= soon, 1).when(rul.isNotNull(), 0)
    return (
        join_small(df, last, [key])
        .withColumns({"rul": rul, "label1": label1, "label2": F.when(rul <= urgent, 2).otherwise(label1)})
        .drop("_last")
    )


def global_index(
    df: DataFrame, key: str, order: Sequence[str], name: str = "ix", rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Row number over all entities one after another; an entity may be larger than a split."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = running(sizes, [], [key], {"_end": ("sum", "_rows")}, rows_per_split, reuse=True)
    offsets = offsets.select(key, (F.col("_end") - F.col("_rows")).alias("_offset"))
    indexed = join_small(row_index(df, [key], order, name, rows_per_split), offsets, [key])
    return indexed.withColumn(name, F.col(name) + F.col("_offset")).drop("_offset")


def autocorrelation(
    df: DataFrame, order: Sequence[str], column: str, max_lag: int = 30, keys: Sequence[str] = (),
    rows_per_split: int = ROWS_PER_SPLIT, index: str | None = None,
) -> DataFrame:
    """Rows (keys, lag, acf), one pass for all lags; ``index`` as in ``look_back``."""
    keys = list(keys)
    if keys:
        means = df.groupBy(*keys).agg(F.avg(column).alias("_mean"))
        rows = join_small(df, means, keys)
    else:
        rows = df.withColumn("_mean", df.agg(F.avg(column).alias("m")).scalar())
    rows = rows.withColumn("_d", F.col(column) - F.col("_mean"))
    lagged = look_back(
        rows, keys, order, max_lag,
        lambda w: {f"_lag{k}": F.lag("_d", k).over(w) for k in range(1, max_lag + 1)},
        rows_per_split,
        index=index,
    )
    sums = [F.sum(F.col("_d") * F.col("_d")).alias("_p0")]
    sums += [F.coalesce(F.sum(F.col("_d") * F.col(f"_lag{k}")), F.lit(0.0)).alias(f"_p{k}") for k in range(1, max_lag + 1)]
    wide = lagged.groupBy(*keys).agg(*sums)
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_p{k}"), F.col("_p0")).alias("acf"))
            for k in range(max_lag + 1)
        ]
    )
    return wide.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*")


def partial_autocorrelation(acf: DataFrame) -> DataFrame:
    """Rows (lag, pacf) from the (lag, acf) rows of one series, by the Durbin-Levinson recursion."""
    r = [row["acf"] for row in acf.orderBy("lag").collect()]  # max_lag + 1 numbers
    result, phi = [], []
    for k in range(1, len(r)):
        top = r[k] - sum(p * r[k - 1 - j] for j, p in enumerate(phi))
        bottom = 1 - sum(p * r[j + 1] for j, p in enumerate(phi))
        last = top / bottom
        phi = [p - last * q for p, q in zip(phi, reversed(phi))] + [last]
        result.append((k, float(last)))
    return acf.sparkSession.createDataFrame(result, "lag int, pacf double")


def lagged_correlation(
    df: DataFrame, order: Sequence[str], x: str, y: str, max_lag: int, keys: Sequence[str] = (),
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Correlation of y with x of ``lag`` rows before, over all entities."""
    lagged = look_back(
        df, keys, order, max_lag,
        lambda w: {f"_lag{k}": F.lag(x, k).over(w) for k in range(max_lag + 1)},
        rows_per_split,
    )
    wide = lagged.agg(*[pearson(f"_lag{k}", y).alias(f"_r{k}") for k in range(max_lag + 1)])
    pairs = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.col(f"_r{k}").alias("correlation")) for k in range(max_lag + 1)]
    )
    return wide.select(F.explode(pairs).alias("p")).select("p.*")
