"""Forests of a tuning grid grown from histograms, beside a plain tree."""

import numpy as np
import pytest

from statloom.learn import forests


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b, c = int(rng.integers(0, 6)), float(rng.normal()), int(rng.integers(0, 3))
        y = int(a > 2 and b > 0 or c == 1 and rng.random() < 0.7)
        rows.append((i, a, None if i % 9 == 0 else b, c, None if i % 50 == 0 else y))
    return spark.createDataFrame(rows, "id long, a int, b double, c int, y int")


def plain_tree(bins, label, weight, depth, least):
    """One tree by recursion over the same bins; a feature order and cut break ties."""

    def impurity(w, p):
        return 2.0 * p * (w - p) / w if w else 0.0

    def node(rows, level):
        w, p = weight[rows].sum(), (weight * label)[rows].sum()
        best = (0.0, None)
        if level < depth and w >= least:
            for f in range(len(bins)):
                for cut in range(256):
                    left = rows[bins[f][rows] <= cut]
                    lw, lp = weight[left].sum(), (weight * label)[left].sum()
                    if lw in (0, w):
                        continue
                    gain = round(impurity(w, p) - impurity(lw, lp) - impurity(w - lw, p - lp), 9)
                    if gain > best[0]:
                        best = (gain, (f, cut))
        if best[1] is None:
            return p / max(w, 1)
        f, cut = best[1]
        inside = bins[f][rows] <= cut
        return f, cut, node(rows[inside], level + 1), node(rows[~inside], level + 1)

    def walk(tree, row):
        while isinstance(tree, tuple):
            f, cut, left, right = tree
            tree = left if bins[f][row] <= cut else right
        return tree

    grown = node(np.arange(len(label)), 0)
    return np.array([walk(grown, r) for r in range(len(label))])


def test_combinations_equal_plain_forests(spark, table):
    """Shared trees, cut at each depth and split size, vote like forests grown one by one."""
    features = ["a", "b", "c"]
    tried = [(1, 2, 3, 40), (4, 3, 3, 60), (3, 5, 9, 25), (2, 0, 3, 25)]
    combos = spark.createDataFrame(tried, "trees int, depth int, per_split int, min_split int")
    board = {tuple(r)[:4]: r for r in forests.tune_forests(table, table.limit(0), combos, features, "y", "id", bins=16, block_rows=100).collect()}
    cuts = forests.bin_cuts(table, features, 16)
    keys, label, bins = [], [], []
    for r in forests.packed_rows(table, "id", features, "y", cuts, 100).collect():
        k, y, b = forests._block(r["n"], r["key"], r["label"], r["bins"])
        keys.append(k), label.append(y), bins.append(b)
    keys, label, bins = np.concatenate(keys), np.concatenate(label).astype(int), np.concatenate(bins, axis=1)
    assert len(label) == 588  # rows without a label only
    for trees, depth, per_split, least in tried:
        votes = sum(plain_tree(bins, label, forests.draws(keys, t, 1), depth, least) for t in range(trees))
        yes = votes > trees / 2
        tp, wrong = (yes & (label == 1)).sum(), (yes != (label == 1)).sum()
        row = board[trees, depth, per_split, least]
        assert row["train_rows"] == 588 and row["test_rows"] == 0
        assert row["train_f_score"] == pytest.approx(2 * tp / (2 * tp + wrong) if tp + wrong else None)


def test_columns_tried_differ_by_node_and_tree():
    nodes, trees = np.arange(200), np.arange(200) % 5
    some = forests.allowed_features(trees, nodes, np.full(200, 2), 7, 1)
    assert (some.sum(axis=1) == 2).all() and some.any(axis=0).all()
    assert forests.allowed_features(trees, nodes, np.full(200, 7), 7, 1).all()


def test_draws_have_mean_one_and_repeat():
    keys = np.random.default_rng(1).integers(0, 1 << 62, 100_000).astype(np.uint64)
    drawn = forests.draws(keys, 3, 1)
    assert abs(drawn.mean() - 1) < 0.02 and (drawn == forests.draws(keys, 3, 1)).all()
    assert (drawn != forests.draws(keys, 4, 1)).any()


def test_driver_bound_and_empty_grid(spark, table):
    combos = spark.createDataFrame([(30, 3, 2, 10)], "trees int, depth int, per_split int, min_split int")
    with pytest.raises(ValueError, match="most_nodes"):
        forests.tune_forests(table, table, combos, ["a"], "y", "id", most_nodes=100)
    assert forests.tune_forests(table, table, combos.limit(0), ["a"], "y", "id").count() == 0


@pytest.mark.parametrize("sample", [True, False])
def test_equal_rows_count_once(spark, table, monkeypatch, sample):
    """Blocks of cells give the counts that blocks of rows give, from far fewer entries."""
    rows = table.select("id", "a", "c", "y")
    combos = spark.createDataFrame([(4, 3, 2, 30), (3, 5, 1, 25), (2, 4, 2, 60)], "trees int, depth int, per_split int, min_split int")
    made, pack = [], forests._packed
    monkeypatch.setattr(forests, "_packed", lambda *a: made.append(pack(*a)) or made[-1])
    tune = lambda: sorted(map(tuple, forests.tune_forests(rows, rows.where("id % 3 = 0"), combos, ["a", "c"], "y", "id", sample=sample, block_rows=100).collect()))
    cells = tune()
    # 6 x 3 x 2 cells without those that no row of label 1 reaches: a up to 2 and c not 1
    assert sum(r["n"] for r in made[0][0].collect()) == 30 and made[0][1] == 588
    monkeypatch.setattr(forests, "ROWS_A_CELL", 1000)
    assert tune() == cells and sum(r["n"] for r in made[2][0].collect()) == 588


def test_more_trees_than_the_driver_holds_at_once(spark, table, monkeypatch):
    """Without a limit of its own a call grows and counts in turns; blocks of cells and of rows agree with one turn."""
    rows = table.select("id", "a", "c", "y")
    combos = spark.createDataFrame([(7, 4, 1, 10), (5, 2, 1, 20), (6, 3, 2, 12)], "trees int, depth int, per_split int, min_split int")
    tune = lambda: sorted(map(tuple, forests.tune_forests(rows, rows.where("id % 3 = 0"), combos, ["a", "c"], "y", "id", block_rows=100).collect()))
    whole = tune()
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, v: sent.append(v) or broadcast(sc, v))
    monkeypatch.setattr(forests, "MOST_NODES", 40)
    assert tune() == whole and len(sent) > 4  # in pieces
    monkeypatch.setattr(forests, "CELLS_A_TASK", 0)
    assert tune() == whole
    monkeypatch.setattr(forests, "ROWS_A_CELL", 1000)
    assert tune() == whole


@pytest.mark.parametrize("tried", [1, 3])
def test_whole_tree_is_the_one_grown_by_levels(spark, table, tried):
    features = ["a", "b", "c"]
    cuts = forests.bin_cuts(table, features, 16)
    packed = forests.packed_rows(table, "id", features, "y", cuts, 100)
    rows = packed.selectExpr("*", "0 AS wide", "CAST(NULL AS BINARY) AS count", "CAST(NULL AS BINARY) AS weights")
    by_level = forests.grow(rows, [(0, tried), (1, tried), (2, tried)], 3, 6, 12, bins=17).by_tree()
    keys, label, bins = zip(*[forests._block(r["n"], r["key"], r["label"], r["bins"]) for r in packed.collect()])
    keys, label, bins = np.concatenate(keys), np.concatenate(label), np.concatenate(bins, axis=1)
    for t, want in enumerate(by_level):
        got = forests.grown_tree(bins, label, forests.draws(keys, t, 1), t, tried, 6, 12, 1).by_tree()[0]
        assert len(want[0]) > 5 and all(np.array_equal(g, w) for g, w in zip(got, want))
