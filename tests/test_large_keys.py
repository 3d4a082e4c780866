"""One key holds a third of the rows: the split way must agree with the plain way."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statloom.operators import association, describe, ordered, relational, sampling, series
from statloom.learn import evaluation

SMALL = 200


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 3000
    key = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 60, n))
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "key": key,
            "t": rng.integers(0, 5000, n),
            "x": np.round(rng.exponential(10, n), 1),
            "y": np.round(rng.normal(0, 1, n), 1),
        }
    )


@pytest.fixture(scope="module")
def df(spark, frame):
    # one NULL key as large as a split
    return spark.createDataFrame(frame).withColumn("key", F.when(F.col("key") == 3, None).otherwise(F.col("key"))).repartition(5).cache()


ORDER = ["t", "id"]


def rows(result, *columns):
    return sorted(tuple(r) for r in result.select(*columns).collect())


def test_split_is_used(df):
    assert ordered.split_hot_keys(df, ["key"], ORDER, SMALL).needed
    assert not ordered.split_hot_keys(df, ["key"], ORDER, 10_000).needed


def test_split_sizes_are_bounded(df):
    parts = ordered.split_hot_keys(df, ["key"], ORDER, SMALL).df.groupBy("key", "_split").count()
    assert parts.agg(F.max("count")).first()[0] <= 2 * SMALL


@pytest.mark.parametrize("keys,order", [(["key"], ORDER), ([], ORDER), ([], ["-x", "id"]), (["key"], ["-t", "id"])])
def test_running(df, keys, order):
    values = {"s": ("sum", F.lit(1)), "m": ("max", "x"), "l": ("min", "x")}
    plain = ordered.running(df, keys, order, values)
    split = ordered.running(df, keys, order, values, SMALL)
    assert rows(plain, "id", "s", "m", "l") == rows(split, "id", "s", "m", "l")


def test_running_skips_nulls(df):
    rare = df.withColumn("r", F.when(F.col("id") % 50 == 0, F.struct("t", "x")))
    plain = ordered.running(rare, [], ORDER, {"m": ("max", "r")})
    split = ordered.running(rare, [], ORDER, {"m": ("max", "r")}, SMALL)
    cols = ["id", F.coalesce(F.col("m.x"), F.lit(-1.0))]
    assert rows(plain, *cols) == rows(split, *cols)


@pytest.mark.parametrize("keys", [["key"], []])
def test_look_back(df, keys):
    def build(w):
        return {
            "lag": F.coalesce(F.lag("x", 3).over(w), F.lit(-1.0)),
            "low": F.min("x").over(w.rowsBetween(-6, 0)),
            "n": F.count("x").over(w.rowsBetween(-6, 0)),
        }

    plain = ordered.look_back(df, keys, ORDER, 6, build)
    split = ordered.look_back(df, keys, ORDER, 6, build, SMALL, block_rows=50)
    assert rows(plain, "id", "lag", "low", "n") == rows(split, "id", "lag", "low", "n")


def test_quantiles(df, frame):
    got = ordered.quantiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.9}, rows_per_split=20).first()
    assert list(got) == pytest.approx(list(frame.x.quantile([0.1, 0.5, 0.9])))
    by_key = {r["key"]: r["m"] for r in ordered.quantiles(df, "x", {"m": 0.5}, ["key"], rows_per_split=20).collect()}
    want = frame.assign(key=frame.key.where(frame.key != 3)).groupby("key", dropna=False).x.median()
    for k, m in want.items():
        assert by_key[None if pd.isna(k) else k] == pytest.approx(m)


def test_ntile_sizes(df):
    sizes = [r["count"] for r in ordered.ntile(df, ["x"], 7, rows_per_split=SMALL).groupBy("tile").count().orderBy("tile").collect()]
    assert sizes == [429] * 4 + [428] * 3


def test_exponential_average(df, frame):
    got = {r["id"]: r["e"] for r in series.exponential_average(df, ["key"], ORDER, "x", "e", 0.3, SMALL).collect()}
    for _, part in frame.sort_values(["t", "id"]).groupby("key"):
        e = None
        for i, x in zip(part.id, part.x):
            e = x if e is None else 0.3 * x + 0.7 * e
            assert got[i] == pytest.approx(e, rel=1e-12)


def test_spearman_and_kendall(df, frame):
    got = association.spearman(df, "x", "y", rows_per_split=20).first()
    assert got["rho"] == pytest.approx(frame.x.rank().corr(frame.y.rank()))
    part = frame.head(400)
    dx = np.sign(part.x.to_numpy()[:, None] - part.x.to_numpy()[None, :])
    dy = np.sign(part.y.to_numpy()[:, None] - part.y.to_numpy()[None, :])
    product = dx * dy
    want = product.sum() / np.sqrt((dx**2).sum() * (dy**2).sum())
    found = association.kendall(df.where("id < 400"), "x", "y", rows_per_split=20).first()
    assert found["tau"] == pytest.approx(want)
    assert found["concordant"] == (product > 0).sum() / 2
    assert found["discordant"] == (product < 0).sum() / 2


def test_frequency_and_ranks(df):
    plain = describe.frequency_table(df, "x")
    split = describe.frequency_table(df, "x", rows_per_split=20)
    assert rows(plain, "x", "cum_freq", "cum_perc") == rows(split, "x", "cum_freq", "cum_perc")
    a = relational.rank_lowest(df, "x", 50)
    b = relational.rank_lowest(df, "x", 50, rows_per_split=20)
    assert rows(a, "id", "rank") == rows(b, "id", "rank")


def test_stratified_sizes(df, frame):
    split = sampling.stratified_split(df, "key", "id", 0.3, rows_per_split=SMALL)
    kept = {r["key"]: r["count"] for r in split.where("in_sample").groupBy("key").count().collect()}
    hot = int((frame.key == 7).sum())
    assert kept[7] == int(np.floor(hot * 0.3 + 0.5))


def test_auc_is_the_pair_share(df, frame):
    labelled = df.withColumn("a", (F.col("y") > 0).cast("int"))
    got = evaluation.auc(labelled, "a", "x", rows_per_split=20).first()["auc"]
    pos, neg = frame.x[frame.y > 0].to_numpy(), frame.x[frame.y <= 0].to_numpy()
    want = ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())
    assert got == pytest.approx(want)


def test_same_answer_with_one_and_eight_partitions(spark, df):
    found = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows(ordered.row_index(df, ["key"], ORDER, "rn", SMALL), "id", "rn"))
    assert found[0] == found[1]


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_many_rows_share_an_order_value(df, keys):
    """A third of a key at one time, and copies equal in every order column."""
    tied = df.withColumn("t", F.when(F.col("id") % 3 == 0, F.lit(100)).otherwise(F.col("t")))
    parts = ordered.split_hot_keys(tied, keys, ORDER, SMALL).df.groupBy(*keys, "_split").count()
    assert parts.agg(F.max("count")).first()[0] <= 2 * SMALL
    a = ordered.row_index(tied, keys, ORDER)
    b = ordered.row_index(tied, keys, ORDER, rows_per_split=SMALL)
    assert rows(a, "id", "rn") == rows(b, "id", "rn")

    loose = ordered.split_hot_keys(tied, keys, ["t"], SMALL).df.groupBy(*keys, "_split").count()
    assert loose.agg(F.max("count")).first()[0] <= 2 * SMALL
    numbered = ordered.row_index(tied, keys, ["t"], rows_per_split=SMALL)
    again = numbered.groupBy(*keys).agg(F.max("rn").alias("m"), F.count_distinct("rn").alias("d"), F.count("*").alias("c"))
    assert again.where("m <> d OR m <> c").count() == 0


def test_text_order_with_a_long_common_start(spark):
    names = spark.range(2000).select(F.format_string("Customer#%09d", (F.col("id") * 7919) % 2000).alias("n"), "id")
    parts = ordered.split_hot_keys(names, [], ["n"], 100).df.groupBy("_split").count()
    assert parts.agg(F.max("count")).first()[0] <= 400
    a = ordered.row_index(names, [], ["n"])
    b = ordered.row_index(names, [], ["n"], rows_per_split=100)
    assert rows(a, "id", "rn") == rows(b, "id", "rn")


def test_totals_beside_running_sums(df):
    values = {"s": ("sum", F.lit(1)), "n": ("total", F.lit(1)), "top": ("max", "x")}
    plain = ordered.running(df, ["key"], ORDER, values)
    split = ordered.running(df, ["key"], ORDER, values, SMALL)
    assert rows(plain, "id", "s", "n", "top") == rows(split, "id", "s", "n", "top")


def test_sampled_cuts_keep_ranges_even(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_CUT", 10)
    monkeypatch.setattr(ordered, "CUTS_PER_BLOCK", 4)
    big = spark.range(40_000).select("id", (F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("v"))
    parts = ordered.split_hot_keys(big, ["k"], ["v"], 200).df.groupBy("k", "_split").count()
    assert parts.count() > 100
    assert parts.agg(F.max("count")).first()[0] <= 1000
    a = ordered.row_index(big, ["k"], ["v", "id"])
    b = ordered.row_index(big, ["k"], ["v", "id"], rows_per_split=200)
    assert a.exceptAll(b).count() == 0


def test_random_percent_over_ranges(df):
    """The order column of a random sample keeps its name while the table is cut into ranges."""
    plain = relational.random_percent(df, "id", 5, seed=7)
    assert rows(plain, "id") == rows(relational.random_percent(df, "id", 5, seed=7, rows_per_split=SMALL), "id")
    assert plain.count() == 150
