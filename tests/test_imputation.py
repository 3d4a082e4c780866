"""Chained mean matching beside a plain numpy version."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.learn import imputation


@pytest.fixture(scope="module")
def holes(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=400)
    b = 2 * a + rng.normal(size=400)
    c = a - b + rng.normal(size=400)
    rows = [
        (i, None if i % 5 == 0 else float(a[i]), None if i % 7 == 3 else float(b[i]), float(c[i]), None, f"t{i}")
        for i in range(400)
    ]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, empty double, _pred string")


def filled(df, **options):
    return [tuple(r) for r in imputation.impute_pmm(df, ["a", "b", "empty"], ["c"], **options).orderBy("id").collect()]


def test_ranges_fill_like_one_part(holes):
    """Spread over ranges of the prediction, every missing value takes the same donor."""
    df = holes.coalesce(2)
    one = filled(df, iterations=2)
    assert filled(df, iterations=2, rows_per_split=90) == one
    assert filled(df, iterations=2) == one  # and a second run repeats it
    for row, old in zip(one, df.orderBy("id").collect()):
        assert row[4] is None and row[5] == old["_pred"] and row[3] == old["c"]
        assert old["a"] is None or row[1] == old["a"]
        assert row[1] is not None and row[2] is not None


def test_rounds_equal_plain_regressions(holes):
    """Without draws and with one donor, the sums kept by the driver give the same chain as fits from scratch."""
    got = filled(holes, iterations=3, donors=1, seed=None)
    rows = holes.orderBy("id").collect()
    data = {n: np.array([np.nan if r[n] is None else r[n] for r in rows]) for n in ("a", "b", "c")}
    gone = {n: np.isnan(data[n]) for n in ("a", "b")}
    for n in gone:
        data[n][gone[n]] = np.nanmean(data[n])
    for _ in range(3):
        for n in ("a", "b"):
            x = np.column_stack([np.ones(400), *[data[o] for o in data if o != n]])
            beta = np.linalg.lstsq(x[~gone[n]], data[n][~gone[n]], rcond=None)[0]
            pred, seen = x @ beta, np.flatnonzero(~gone[n])
            for i in np.flatnonzero(gone[n]):
                data[n][i] = data[n][seen[np.argmin(np.abs(pred[seen] - pred[i]))]]
    assert [r[1] for r in got] == pytest.approx(list(data["a"]))
    assert [r[2] for r in got] == pytest.approx(list(data["b"]))


def test_donors_are_among_the_nearest():
    predicted, values = np.arange(0.0, 100.0, 10.0), np.arange(10.0)
    ids = np.arange(1000)
    drawn = imputation.drawn_values(np.full(1000, 42.0), ids, predicted, values, 3, zlib.crc32(b"x"))
    assert set(drawn) == {3.0, 4.0, 5.0}
    assert min(np.bincount(drawn.astype(int))[3:]) > 250
    assert imputation.drawn_values(np.array([45.0, -5.0, 1e9]), ids[:3], predicted, values, 1, 1).tolist() == [4.0, 0.0, 9.0]
    # fewer donors than asked for
    assert set(imputation.drawn_values(np.zeros(50), ids[:50], predicted[:2], values[:2], 5, 1)) == {0.0, 1.0}


def test_filled_values_keep_the_relation(holes):
    """Slopes of the filled columns are those of the complete rows, which means at the start are not."""
    rows = filled(holes, iterations=10)
    a, c = np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
    whole = np.array([(r["a"], r["c"]) for r in holes.collect() if r["a"] is not None])
    assert np.corrcoef(a, c)[0, 1] == pytest.approx(np.corrcoef(whole.T)[0, 1], abs=0.1)


def test_empty_and_complete_tables(holes):
    assert imputation.impute_pmm(holes.limit(0), ["a"], ["c"]).count() == 0
    whole = holes.select("id", "c").withColumnRenamed("c", "a")
    assert sorted(map(tuple, imputation.impute_pmm(whole, ["a"], []).collect())) == sorted(map(tuple, whole.collect()))


def test_rows_without_a_gap_stay_out_of_the_rounds(spark, monkeypatch):
    """A round writes the rows with a gap; equal rows without one are a single donor, and the chain is that of plain fits."""
    rng = np.random.default_rng(8)
    c = rng.integers(0, 6, 600).astype(float)
    a, b = c + rng.integers(0, 3, 600), 2 * c - rng.integers(0, 4, 600)
    rows = [(i, None if i % 10 == 0 else float(a[i]), None if i % 15 == 7 else float(b[i]), float(c[i])) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").coalesce(1)
    written, write = [], imputation.materialise
    monkeypatch.setattr(imputation, "materialise", lambda d: written.append(write(d)) or written[-1])
    whole = imputation.impute_pmm(df, ["a", "b"], ["c"], iterations=2, donors=3)
    got = [tuple(r) for r in whole.orderBy("id").collect()]
    assert max(t.count() for t in written[3:]) == 100 and written[2].count() < 80
    assert [tuple(r) for r in imputation.impute_pmm(df, ["a", "b"], ["c"], iterations=2, donors=3, rows_per_split=40).orderBy("id").collect()] == got

    data = {n: np.array([np.nan if r[1 + k] is None else r[1 + k] for r in rows]) for k, n in enumerate("abc")}
    gone = {n: np.isnan(data[n]) for n in "ab"}
    ids = np.arange(600)
    for n in gone:
        data[n][gone[n]] = np.nanmean(data[n])
    scale = {n: (np.nanmean([np.nan if r[1 + k] is None else r[1 + k] for r in rows]), np.nanstd([np.nan if r[1 + k] is None else r[1 + k] for r in rows])) for k, n in enumerate("abc")}
    for r in range(2):
        for n in "ab":
            z = np.column_stack([np.ones(600), *[(data[o] - scale[o][0]) / scale[o][1] for o in "abc"]])
            sums = {n: z[~gone[n]].T @ z[~gone[n]]}
            plain = imputation.Products(list("abc"), [n], {}, {}, sums, np.zeros((4, 4)))
            fitted, drawn = plain.coefficients(n, np.random.default_rng([1, r, zlib.crc32(n.encode())]))
            pred = np.round(np.where(gone[n], z @ drawn, z @ fitted), 9)
            order = np.lexsort((ids, data[n], pred))
            order = order[~gone[n][order]]
            seed = zlib.crc32(f"1:{r}:{n}".encode())
            data[n][gone[n]] = imputation.drawn_values(pred[gone[n]], ids[gone[n]], pred[order], data[n][order], 3, seed)
    same = [x[1] == a and x[2] == b for x, a, b in zip(got, data["a"], data["b"])]
    assert sum(same) >= 595  # rounding may turn a tie


def test_equal_predictions_are_spread(spark):
    """Without predictors all rows are predicted alike; no range takes them all."""
    df = spark.range(400).select("id", F.when(F.col("id") % 4 != 0, F.col("id").cast("double")).alias("a"))
    got = imputation.impute_pmm(df, ["a"], iterations=1, rows_per_split=100, seed=None)
    values = [r["a"] for r in got.collect()]
    assert len(values) == 400 and all(v % 4 != 0 for v in values)
    part = imputation._range_of(F.lit(1.0), [0.0, 1.0, 1.0, 1.0, 2.0], F.col("id"))
    assert {r[0] for r in spark.range(60).select(part).collect()} == {1, 2, 3}


@pytest.mark.parametrize("donors", [1, 4])
def test_blocks_in_ranges_fill_like_one_sorted_list(spark, monkeypatch, donors):
    """Rows without a gap lie in blocks, several ranges and blocks take the donors of one list, and a step writes the rows with a gap once."""
    rng = np.random.default_rng(12)
    b, c = rng.normal(size=900), rng.integers(0, 4, 900)
    rows = [(i, None if i % 6 == 0 else float(b[i] + c[i]), None if i % 10 == 3 else float(round(b[i], 1)), float(c[i])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").coalesce(3)
    run = lambda **o: [tuple(r) for r in imputation.impute_pmm(df, ["a", "b"], ["c"], iterations=3, donors=donors, **o).orderBy("id").collect()]
    one = run()
    monkeypatch.setattr(imputation, "BLOCK_ROWS", 50)
    written, write = [], imputation.materialise
    monkeypatch.setattr(imputation, "materialise", lambda d: written.append(write(d)) or written[-1])
    assert run(rows_per_split=60) == one
    gaps = sum(r[1] is None or r[2] is None for r in rows)
    assert written[3].count() > 3 and written[3].agg(F.sum("n")).first()[0] == written[2].count()
    assert [t.count() for t in written[4:]] == [gaps] * 6 and "_copies" not in written[-1].columns


def test_cuts_deal_rows_out_evenly():
    x = np.random.default_rng(2).normal(size=(2, 10_000))
    products = imputation.Products(["a", "b"], ["a"], {"a": 0.0, "b": 1.0}, {"a": 1.0, "b": 2.0}, {}, np.zeros((3, 3)))
    cuts = imputation._cuts(products, np.array([3.0, 0.0, -2.0]), x[:, ::10], 8)
    part = imputation._range_at(3 - 2 * ((x[1] - 1) / 2), np.array(cuts))
    assert np.bincount(part, minlength=8).min() > 1000 and (np.diff(cuts) > 0).all()
    assert np.bincount(imputation._range_at(np.ones(90), np.array([0.0, 1.0, 1.0, 1.0, 2.0]))).tolist() == [0, 30, 30, 30]
