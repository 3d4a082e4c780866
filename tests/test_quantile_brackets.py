"""Exact quantiles from brackets: only values near the wanted shares are ordered."""

import datetime as dt
import decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.operators.ordered import _outside_collapsed, quantiles

SHARES = {"least": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "near": 0.751, "most": 1.0}


@pytest.mark.parametrize("discrete", [False, True])
@pytest.mark.parametrize("kind", ["spread", "tied", "few"])
def test_brackets_give_exact_quantiles(spark, kind, discrete):
    rng = np.random.default_rng(11)
    values = {"spread": rng.normal(size=30_000) * 1e6, "tied": rng.integers(0, 4, 30_000).astype(float), "few": np.array([3.0, 1.0, 2.0])}[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 5, "v double").repartition(5)
    got = quantiles(df, "v", SHARES, discrete=discrete).first()
    ordered = np.sort(values)
    for name, p in SHARES.items():
        if discrete:
            assert got[name] == ordered[max(0, int(np.ceil(p * len(ordered))) - 1)]
        else:
            assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_only_a_small_part_is_ordered(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    counts = _outside_collapsed(df, "v", [0.25, 0.5, 0.75])
    # a single shuffle, of counted values
    assert counts._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    rows = counts.collect()
    assert sum(r["_n"] for r in rows) == 200_000
    assert len(rows) < 0.03 * 200_000 and sum(r["_v"] is None for r in rows) == 4


def test_other_types_and_odd_values(spark):
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i % 40), decimal.Decimal(i % 7) / 10, f"t{i % 9}", float("nan") if i % 10 == 0 else float(i), 2**60 + i) for i in range(1000)]
    df = spark.createDataFrame(days, "d date, x decimal(30,2), t string, f double, b bigint")
    for c in df.columns:
        wanted = sorted(r[c] for r in df.select(c).collect()) if c != "f" else None
        got = quantiles(df, c, {"m": 0.5}, discrete=True).first()["m"]
        assert got == (wanted[499] if wanted else 555.0)
    assert quantiles(df.limit(0), "b", {"m": 0.5}).first()["m"] is None
    assert quantiles(df.select(F.lit(None).cast("double").alias("z")), "z", {"m": 0.5}, discrete=True).first()["m"] is None
