"""Shapley attribution by sampled permutations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from statloom.operators.relational import hash_order

ROWS_A_TASK = 20_000


def shapley(
    predict: Callable[[DataFrame], DataFrame],
    rows: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    key: str,
    samples: int = 100,
    seed: int = 1,
    prediction: str = "prediction",
) -> DataFrame:
    """Rows (key, feature, contribution) for every row to explain.

    Each sample pairs a background row with an order of the features; features
    change from the background value to the row's value one after another, and
    the change of the prediction is credited to the feature just moved.
    Background rows are drawn by the hash of ``key``, which ``background`` should have.
    Contributions of a row add up to its prediction less the mean prediction of
    the background rows drawn.
    """
    features = list(features)
    count = len(features)
    # by the hash of the key: that of the features would put equal rows side by side
    by = [key] if key in background.columns else features
    base = background.orderBy(hash_order(by, seed)).select(*features).limit(samples).collect()
    rng = np.random.default_rng(seed)
    # the prediction after a step counts for the feature just moved and against the next one; a mixed row is
    # known by the features moved and the background values of the others, so equal ones are predicted once
    start, weights = [], {}
    for row in base:
        place = rng.permutation(count)
        z = [float(row[f]) for f in features]
        start.append((*z, int(np.flatnonzero(place == 0)[0])))
        for step in range(1, count + 1):
            moved = place < step
            w = weights.setdefault((tuple(map(bool, moved)), tuple(0.0 if m else v for m, v in zip(moved, z))), np.zeros(count))
            w[place == step - 1] += 1
            w[place == step] -= 1
    spark, kind = rows.sparkSession, rows.schema[key].dataType
    # rows of the background alone are the same for every row explained: `samples` predictions in all
    schema = ", ".join([*[f"`{f}` double" for f in features], "_first int"])
    before = predict(spark.createDataFrame(start, schema).withColumn(key, F.lit(None).cast(kind)))
    taken = {r["_first"]: r["f"] or 0.0 for r in before.groupBy("_first").agg(F.sum(prediction).alias("f")).collect()}
    plan = [(s, list(moved), list(z), w.tolist()) for s, ((moved, z), w) in enumerate(weights.items())]
    # at most `samples` rows for each feature
    draws = F.broadcast(spark.createDataFrame(plan, "_s int, _moved array<boolean>, _z array<double>, _w array<double>"))
    # a row becomes many, so a small table is dealt out first; all of a row stays in one task
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))
    steps = (
        rows.select(key, *features)
        .repartition(tasks, key)
        .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(len(plan) - 1))))
        .join(draws, "_s")
    )
    mixed = steps.withColumns({f: F.when(F.col("_moved")[i], F.col(f).cast("double")).otherwise(F.col("_z")[i]) for i, f in enumerate(features)})
    sums = predict(mixed).groupBy(key).agg(*[F.sum(F.col(prediction) * F.col("_w")[i]).alias(f"_c{i}") for i in range(count)])
    each = [
        F.struct(F.lit(f).alias("feature"), ((F.col(f"_c{i}") - F.lit(float(taken.get(i, 0.0)))) / F.lit(float(len(base)))).alias("contribution"))
        for i, f in enumerate(features)
    ]
    return sums.select(key, F.explode(F.array(*each)).alias("m")).select(key, "m.feature", "m.contribution")
