"""Tails on large tables, rows with missing values, hard orders and NULL keys."""

import math
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.functions import probability as P
from statloom.learn import explain, scoring, training
from statloom.operators import describe, ordered, relational, series
from statloom.plans import mushrooms
from statloom.sources import readers


def even_chi2(x, dof):
    """Finite sum on the logarithmic scale."""
    logs = [-x / 2 + i * math.log(x / 2) - math.lgamma(i + 1) for i in range(dof // 2)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(v - top) for v in logs)


@pytest.mark.parametrize("x, dof", [(5, 8), (30, 20), (1600, 1600), (2000, 2000), (2000, 1800), (2_203_000, 2_200_000)])
def test_chi_square_tail(x, dof):
    assert float(P.chi2_tail(x, dof)) == pytest.approx(even_chi2(x, dof), rel=1e-6)


def test_tails_of_large_tables():
    normal = lambda z: math.erfc(z / math.sqrt(2))
    assert P.t_two_sided(2.0, np.array([1.0, 2.0])) == pytest.approx([0.29516723530086653, 0.18350341907227397])
    for dof, rel in ((1e4, 1e-3), (1e6, 1e-5), (9e7, 1e-6), (1e9, 1e-7), (1e12, 1e-9)):
        assert float(P.t_two_sided(2.0, dof)) == pytest.approx(normal(2), rel=rel)
        assert float(P.f_tail(5.0, 1, dof)) == pytest.approx(normal(math.sqrt(5)), rel=rel)
    assert float(P.f_tail(2.6, 3, 10)) == pytest.approx(0.1101936, rel=1e-6)
    assert float(P.chi2_tail(1e9, 1e9)) == pytest.approx(0.5, abs=1e-4)


def test_normal_quantile_column(spark):
    ps = [0.0, 1e-9, 0.01, 0.02425, 0.3, 0.5, 0.9, 0.999, 1.0]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select(P.normal_quantile(F.col("p")).alias("q")).collect()
    assert rows[0].q is None and rows[-1].q is None
    for p, r in list(zip(ps, rows))[1:-1]:
        assert 0.5 * math.erfc(-r.q / math.sqrt(2)) == pytest.approx(p, rel=1e-7)


def test_scoring_keeps_every_row(spark):
    rng = random.Random(1)
    rows = [(i, rng.random() if i % 4 else None, rng.random() if i % 7 else float("nan"), float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    model = training.model_pipeline("tree_classifier", ["a", "b"], "y").fit(df)
    scored = scoring.score(model, df, ["id"], classes=2).collect()
    assert len(scored) == 200
    for r in scored:
        missing = r.id % 4 == 0 or r.id % 7 == 0
        assert (r.prediction is None) == missing and (r.prob_1 is None) == missing
    scores = training.principal_components(df, ["a", "b"], 2)[2]
    assert scores.count() == 200 and scores.where("scores IS NULL").count() == sum(i % 4 == 0 or i % 7 == 0 for i in range(200))


def ranges_of(df, order, size):
    parted = ordered.split_hot_keys(df, [], order, size)
    return parted, Counter(r["_split"] for r in parted.df.select("_split").collect())


ORDERS = {
    "mostly null": ("n", lambda i: None if i % 10 else float(i), "double"),
    "all null": ("n", lambda i: None, "double"),
    "one text": ("t", lambda i: "the same text " * 30, "string"),
    "long common start": ("t", lambda i: "x" * 250 + str(i % 40), "string"),
    "few decimals": ("d", lambda i: Decimal(i % 3), "decimal(12,2)"),
    "long decimals": ("d", lambda i: Decimal(10) ** 25 + Decimal(i % 5) / 1000, "decimal(38,6)"),
}


@pytest.mark.parametrize("name", ORDERS)
def test_later_columns_cut_where_earlier_ones_are_equal(spark, name):
    column, value, kind = ORDERS[name]
    rows = [(value(i), (i * 7919) % 3000) for i in range(3000)]
    df = spark.createDataFrame(rows, f"{column} {kind}, id int")
    parted, sizes = ranges_of(df, [column, "id"], 200)
    assert parted.needed and max(sizes.values()) <= 400
    got = ordered.row_index(df, [], [column, "id"], "rn", 200).collect()
    key = lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1])
    assert [(r[0], r[1]) for r in sorted(got, key=lambda r: r["rn"])] == [tuple(r) for r in sorted(rows, key=key)]


def test_decimal_codes_keep_the_order(spark):
    values = [Decimal(s) for s in ("-5.000001", "-5", "-0.000002", "0", "0.000001", "12345678901234567890.000001", "12345678901234567890.000002", "-12345678901234567890.1")]
    df = spark.createDataFrame([(v,) for v in values], "d decimal(38,6)")
    codes = ordered._column_codes("d", df.schema["d"].dataType, 0)
    found = df.select("d", F.array(*codes).alias("c")).collect()
    assert [r.d for r in sorted(found, key=lambda r: r.c)] == sorted(r.d for r in found)
    assert len({tuple(r.c) for r in found}) == len(values)


def test_ntile_of_a_mostly_null_column(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("v"), "id")
    tiles = Counter(r.tile for r in ordered.ntile(df, ["v", "id"], 7, rows_per_split=60).collect())
    assert sorted(tiles.values()) == [142, 143, 143, 143, 143, 143, 143]


def test_wide_table_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BROADCAST_BYTES", 1000)
    table = spark.range(20).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200).alias("t"))
    joined = ordered.join_small(spark.range(100).select((F.col("id") % 25).alias("k")), table, ["k"])
    assert joined.count() == 80
    assert not (joined._jdf.queryExecution().optimizedPlan().toString()).count("broadcast")


def test_exponential_average_of_the_null_entity(spark):
    df = spark.range(200).select(F.lit(None).cast("int").alias("e"), "id", F.lit(10.0).alias("x"))
    got = series.exponential_average(df, ["e"], ["id"], "x", "ema").collect()
    assert len(got) == 200 and all(r.ema == pytest.approx(10) for r in got)


def test_no_label_without_truth(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id int, cycle int")
    truth = spark.createDataFrame([(1, 20.0)], "id int, rul double")
    got = {(r.id, r.cycle): (r.rul, r.label1, r.label2) for r in series.label_remaining_life(df, truth).collect()}
    assert got == {(1, 1): (21.0, 1, 1), (1, 2): (20.0, 1, 1), (2, 1): (None, None, None)}


def test_shapley_background_of_few_levels(spark):
    df = spark.range(1000).select("id", (F.col("id") % 5).cast("double").alias("x"))
    got = explain.shapley(lambda d: d.withColumn("prediction", F.col("x")), df, df, ["x"], "id", samples=100).collect()
    for r in got:
        assert r.contribution == pytest.approx(r.id % 5 - 2, abs=0.5)


def test_levels_are_all_there(spark):
    df = spark.createDataFrame([("a", "p", 1), ("a", "q", 2), ("b", "r", 3)], "id string, k string, v int")
    assert relational.spread(df, ["id"], "k", "v").columns == ["id", "p", "q", "r"]
    assert describe.crosstab_wide(df, "id", "k").columns == ["id", "p", "q", "r"]
    with pytest.raises(ValueError):
        relational.levels_of(df, "k", most=2)


def test_histogram_outside_its_limits(spark):
    df = spark.createDataFrame([(float(v),) for v in (-5, 0, 1, 9, 10, 11, 12)], "v double")
    got = {r.bin: (r.lower, r.upper, r.n) for r in describe.histogram(df, "v", 2, low=0, high=10).collect()}
    assert got == {-1: (None, 0.0, 1), 0: (0.0, 5.0, 2), 1: (5.0, 10.0, 2), 2: (10.0, None, 2)}


def test_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\n2,many\n")
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), "id int, v double", bad_record="bad").collect()
    assert [(r.id, r.v, r.bad) for r in got] == [(1, 2.5, None), (2, None, "2,many")]
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "a.csv"), "id int, v double", bad_record="fail").collect()


def test_stalk_colours():
    want = {"b": "buff", "c": "cinnamon", "e": "red", "g": "gray", "n": "brown", "o": "orange", "p": "pink", "w": "white", "y": "yellow"}
    assert mushrooms.LEVELS["stalk_color_above_ring"] == mushrooms.LEVELS["stalk_color_below_ring"] == want


def test_shapley_predicts_equal_mixed_rows_once(spark):
    """Contributions are those of every sample step by step, from at most a prediction a sample and feature beside the row's own."""
    df = spark.range(40).select("id", (F.col("id") % 4).cast("double").alias("x"), (F.col("id") * 1.5).alias("y"))
    seen = []

    def predict(d):
        seen.append(d.count())
        return d.withColumn("prediction", F.col("x") * F.col("y") + F.col("y"))

    found = explain.shapley(predict, df, df, ["x", "y"], "id", samples=20)
    got = {(r.id, r.feature): r.contribution for r in found.collect()}
    base = df.orderBy(relational.hash_order(["id"], 1)).limit(20).collect()
    rng, f = np.random.default_rng(1), lambda x, y: x * y + y
    want = {(i, n): 0.0 for i in range(40) for n in "xy"}
    for b in base:
        place = rng.permutation(2)
        for i in range(40):
            x, y = float(i % 4), i * 1.5
            middle = f(x, b.y) if place[0] == 0 else f(b.x, y)
            first, last = ("x", "y") if place[0] == 0 else ("y", "x")
            want[i, first] += (middle - f(b.x, b.y)) / 20
            want[i, last] += (f(x, y) - middle) / 20
    assert got == pytest.approx(want)
    assert seen[0] == 20 and seen[1] <= 40 * (1 + 20) and len(seen) == 2
