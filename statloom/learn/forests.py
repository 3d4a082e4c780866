"""Many forests at once, grown level by level from histograms.

Features are binned once and rows are packed into blocks.  A level of all trees is one
pass over the blocks: every task adds up the weights and positives per (tree, node,
feature, bin) of its block, the sums are merged by tree, and each open node gets its best split.
The driver holds the split tables only, for ``MOST_NODES`` nodes at a time; trees of one number of columns
beyond that are grown in turns and go to the tasks that count the votes in pieces.

Forests of a tuning grid share their trees.  Tree t for a number of columns tried is the same in every
forest, because its row weights and the columns tried at a node come from hashes.  A forest of
n trees is the first n of them, one of smaller depth is the same trees cut there, and one
with a larger split size stops at the first node that is too small.  So thousands of
combinations need as many trees as the largest forest, once per number of columns tried.

Rows with equal bins and label take the same way through every tree.  Where rows are at least ``ROWS_A_CELL``
times as many as such cells, a block holds cells: their rows, and per tree the draws of their rows, added up once.
Up to ``CELLS_A_TASK`` of them a tree is grown by one task, all its levels in a row, and the trees are dealt over the tasks.

Missing features have a bin of their own, below the others; no row is left out but those without a label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from statloom.session import materialise

BINS = 64
BLOCK_ROWS = 16384
MOST_NODES = 2_000_000
ROWS_A_CELL = 4
CELLS_A_TASK = 500_000
NODES_AT_ONCE = 8192
ROWS_A_VOTE = 4096
#: Cumulative shares of 0, 1, 2, ... draws of a row into a sample of its table's size.
_DRAWS = np.array([0.36787944, 0.73575888, 0.9196986, 0.98101184, 0.99634015, 0.99940582, 0.99991676])


def bin_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper limits of the bins of each feature: quantiles, so columns with few values get one bin a value."""
    shares = [(i + 1) / bins for i in range(bins - 1)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10_000).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(cuts or [])) for cuts in row]


def packed_rows(df: DataFrame, key: str | Sequence[str], features: Sequence[str], label: str, cuts: list[list[float]], rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows: hash of the key, label 0 or 1, one byte per feature.  Bin 0 is the missing value."""
    keys = [key] if isinstance(key, str) else list(key)
    values = [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    narrow = df.where(F.col(label).isNotNull()).select(F.xxhash64(*keys).alias("key"), F.col(label).cast("int").alias("label"), *values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                plain = lambda c: part.column(c).to_numpy(zero_copy_only=False)
                binned = []
                for i, limits in enumerate(cuts):
                    v = plain(f"f{i}").astype(float)
                    binned.append(np.where(np.isnan(v), 0, 1 + np.searchsorted(limits, v, "left")).astype(np.uint8).tobytes())
                row = [[part.num_rows], [plain("key").astype(np.int64).tobytes()], [plain("label").astype(np.uint8).tobytes()], [b"".join(binned)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["n", "key", "label", "bins"])

    return narrow.mapInArrow(run, "n bigint, key binary, label binary, bins binary")


def _block(n: int, key: bytes, label: bytes, bins: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(key, np.uint64, n), np.frombuffer(label, np.uint8, n), np.frombuffer(bins, np.uint8).reshape(-1, n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the sample of a tree: the same in every task, pass and run."""
    start = np.uint64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    share = (_mixed(_mixed(keys + start)) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(_DRAWS, share, "right")


def _merged(cells: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells and their sums, one column a cell."""
    every, parts = np.concatenate(cells), np.concatenate(sums, axis=1)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(parts[:, order], first, axis=1) if len(first) else parts


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


_CELLS = "n bigint, key binary, label binary, bins binary, wide int, count binary, weights binary"


def _cell_block(cells: np.ndarray, sums: np.ndarray) -> pa.Table:
    plain = cells.view(np.uint8).reshape(len(cells), -1).T
    weights = _narrow(sums[1:])
    row = [len(cells), b"", plain[0].tobytes(), plain[1:].tobytes(), weights.dtype.itemsize, sums[0].astype(np.int64).tobytes(), weights.tobytes()]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=[c.split(" ")[0] for c in _CELLS.split(", ")])


def equal_rows(blocks: DataFrame, width: int, trees: int, seed: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of cells from blocks of rows: rows of each cell, and draws of its rows for the first ``trees`` trees."""
    size = width + 1
    buckets = max(1, 2 * blocks.sparkSession.sparkContext.defaultParallelism)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sums, held = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            every, total = _merged(cells, sums)
            bucket = _mixed(every.view(np.uint8).reshape(len(every), size).astype(np.uint64) @ np.arange(1, size + 1, dtype=np.uint64) ** np.uint64(7)) % np.uint64(buckets)
            for b in np.unique(bucket):
                mine = bucket == b
                small = _narrow(total[:, mine])
                row = [[int(b)], [every[mine].tobytes()], [small.dtype.itemsize], [small.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.binary(), pa.int32(), pa.binary()))], ["bucket", "cells", "wide", "sums"])

        for batch in batches:
            for row in batch.to_pylist():
                keys, label, binned = _block(row["n"], row["key"], row["label"], row["bins"])
                cell = np.ascontiguousarray(np.vstack([label[None, :], binned]).T).view(f"S{size}").ravel()
                found, at = np.unique(cell, return_inverse=True)
                drawn = [np.bincount(at, draws(keys, t, seed), len(found)).astype(np.int64) for t in range(trees)]
                cells.append(found), sums.append(np.stack([np.bincount(at, minlength=len(found)).astype(np.int64), *drawn]))
                held += len(found)
                if held > 4 * rows:
                    every, total = _merged(cells, sums)
                    cells, sums, held = [every], [total], len(every)
                    if held > 2 * rows:
                        yield from send()
                        cells, sums, held = [], [], 0
        if cells:
            yield from send()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        cells = [np.frombuffer(c, f"S{size}") for c in table.column("cells").to_pylist()]
        wide = table.column("wide").to_pylist()
        sums = [np.frombuffer(b, f"u{w}").reshape(trees + 1, -1).astype(np.int64) for b, w in zip(table.column("sums").to_pylist(), wide)]
        every, total = _merged(cells, sums)
        return pa.concat_tables([_cell_block(every[i : i + rows], total[:, i : i + rows]) for i in range(0, len(every), rows)])

    sent = blocks.mapInArrow(collect, "bucket bigint, cells binary, wide int, sums binary")
    return sent.groupBy("bucket").applyInArrow(merge, _CELLS)


def _joined_cells(blocks: DataFrame, width: int, trees: int, cells: int, rows: int) -> DataFrame:
    """Small blocks of cells put together into ones of about ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for batch in batches for r in batch.to_pylist()]
        if held:
            label = np.concatenate([np.frombuffer(r["label"], np.uint8) for r in held])
            bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(width, -1) for r in held], axis=1)
            count = np.concatenate([np.frombuffer(r["count"], np.int64) for r in held])
            drawn = np.concatenate([np.frombuffer(r["weights"], f"u{r['wide']}").reshape(trees, r["n"]).astype(np.int64) for r in held], axis=1)
            cell = np.ascontiguousarray(np.vstack([label[None, :], bins]).T).view(f"S{width + 1}").ravel()
            yield from _cell_block(cell, np.concatenate([count[None, :], drawn])).to_batches()

    return blocks.repartition(-(-cells // rows), F.xxhash64("bins")).mapInArrow(run, _CELLS)


def _packed(df: DataFrame, key: str | Sequence[str], features: Sequence[str], label: str, cuts: list[list[float]], trees: int, seed: int, block_rows: int) -> tuple[DataFrame, int, int]:
    """Blocks of cells where there are few of them, else blocks of rows, and the numbers of rows and cells (0 for rows); ``trees`` is 0 where no tree draws."""
    plain = materialise(packed_rows(df, key, features, label, cuts, block_rows))
    rows = plain.agg(F.sum("n")).first()[0] or 0
    cells = materialise(equal_rows(plain, len(features), 0, seed, block_rows))
    found = cells.agg(F.sum("n")).first()[0] or 0
    if not found or ROWS_A_CELL * found > rows:
        return plain.withColumns({"wide": F.lit(0), "count": F.lit(None).cast("binary"), "weights": F.lit(None).cast("binary")}), rows, 0
    if trees:
        cells = materialise(equal_rows(plain, len(features), trees, seed, block_rows))
    # blocks small enough for four tasks a core
    size = max(1, min(block_rows, -(-found // _tasks(df))))
    return materialise(_joined_cells(cells, len(features), trees, found, size)), rows, found


def _tasks(df: DataFrame) -> int:
    return max(1, 4 * df.sparkSession.sparkContext.defaultParallelism)


def _row_counts(row: dict) -> np.ndarray:
    return np.ones(row["n"], np.int64) if row["count"] is None else np.frombuffer(row["count"], np.int64)


def _tree_weights(row: dict, tree: int, seed: int, sample: bool) -> np.ndarray:
    if not sample:
        return _row_counts(row)
    if row["count"] is None:
        return draws(np.frombuffer(row["key"], np.uint64), tree, seed)
    return np.frombuffer(row["weights"], f"u{row['wide']}", row["n"], tree * row["n"] * row["wide"]).astype(np.int64)


@dataclass
class Splits:
    """Nodes of several trees; the first ones are the roots.  A feature of -1 marks a leaf; values up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    weight: np.ndarray
    positive: np.ndarray
    tree: np.ndarray

    @staticmethod
    def roots(trees: int) -> Splits:
        return Splits(np.full(trees, -1, np.int16), *[np.zeros(trees, t) for t in (np.uint8, np.int64, np.int64, np.int64)], np.arange(trees))

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What a broadcast may hold: executors need not have this module."""
        return self.feature, self.cut, self.left, self.weight, self.positive, self.tree

    def step(self, at: np.ndarray, bins: np.ndarray, rows: np.ndarray, least: int = 0) -> np.ndarray:
        """The next node of each row; it stays at leaves and at nodes lighter than ``least``."""
        feature = self.feature[at]
        goes = feature >= 0 if not least else (feature >= 0) & (self.weight[at] >= least)
        return np.where(goes, self.left[at] + (bins[feature, rows] > self.cut[at]), at)

    def share(self) -> np.ndarray:
        """Share of positives in each node; an empty one has none."""
        return self.positive / np.maximum(self.weight, 1)

    def by_tree(self) -> list[tuple[np.ndarray, ...]]:
        """Feature, cut, left, weight and share of the nodes of each tree, numbered within it."""
        order = np.argsort(self.tree, kind="stable")
        first = np.searchsorted(self.tree[order], np.arange(self.tree.max(initial=-1) + 2))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order)) - first[self.tree[order]]
        columns = self.feature, self.cut, place[self.left], self.weight, self.share()
        return [tuple(c[order[a:b]] for c in columns) for a, b in zip(first[:-1], first[1:])]


def allowed_features(trees: np.ndarray, nodes: np.ndarray, tried: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Which features each node tries: the ``tried`` ones with the smallest hashes."""
    if not len(nodes):
        return np.zeros((0, width), bool)
    base = _mixed(np.uint64(seed) + trees.astype(np.uint64) * np.uint64(1000003) + _mixed(nodes.astype(np.uint64)))
    order = np.argsort(np.argsort(_mixed(base[:, None] + np.arange(1, width + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)), axis=1), axis=1)
    return order < tried[:, None]


def best_splits(weight: np.ndarray, positive: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, cut, gain and the left sums of each node, from (node, feature, bin) sums.

    The gain is the fall of the weighted Gini impurity; of equal gains the first feature and cut is taken.
    """
    lw, lp = np.cumsum(weight, axis=2), np.cumsum(positive, axis=2)
    tw, tp = lw[:, :, -1:], lp[:, :, -1:]
    rw, rp = tw - lw, tp - lp
    impurity = lambda w, p: np.divide(2.0 * p * (w - p), w, out=np.zeros(w.shape), where=w > 0)
    gain = impurity(tw, tp) - impurity(lw, lp) - impurity(rw, rp)
    gain[(lw == 0) | (rw == 0) | ~allowed[:, :, None]] = -1
    flat = np.round(gain, 9).reshape(len(gain), -1)
    best = np.argmax(flat, axis=1)
    rows = np.arange(len(best))
    feature, cut = np.divmod(best, weight.shape[2])
    return feature, cut, flat[rows, best], lw[rows, feature, cut], lp[rows, feature, cut]


def _sums(splits, open_nodes: np.ndarray, depth: int, groups: list[np.ndarray], trees_of: np.ndarray, seed: int, sample: bool, bins: int):  # noqa: ANN001, ANN202
    """Sums of the open nodes of one group of trees in one block, non-zero cells only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Splits(*splits.value)
        slot = np.full(len(s.feature), -1)
        slot[open_nodes] = np.arange(len(open_nodes))
        for batch in batches:
            for row in batch.to_pylist():
                label, binned = np.frombuffer(row["label"], np.uint8), np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
                places = np.arange(row["n"])
                found: list[tuple] = []
                for tree in groups[row["group"]].tolist():
                    at = np.full(row["n"], tree)
                    for _ in range(depth):
                        at = s.step(at, binned, places)
                    weight = _tree_weights(row, int(trees_of[tree]), seed, sample)
                    used = (slot[at] >= 0) & (weight > 0)
                    if not used.any():
                        continue
                    here, weight = slot[at[used]], weight[used]
                    first = here.min()
                    for f in range(len(binned)):
                        cell = ((here - first) * len(binned) + f) * bins + binned[f][used]
                        w = np.bincount(cell, weight)
                        p = np.bincount(cell, weight * label[used], len(w))
                        filled = np.flatnonzero(w)
                        found.append((filled + first * len(binned) * bins, w[filled], p[filled]))
                if found:
                    cells, w, p = (np.concatenate(x) for x in zip(*found))
                    body = cells.astype(np.int64).tobytes() + w.astype(np.int64).tobytes() + p.astype(np.int64).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([row["group"]], pa.int64()), pa.array([body], pa.binary())], ["group", "sums"])

    return run


_SPLIT = "node bigint, feature bigint, cut bigint, gain double, left_weight bigint, left_positive bigint, weight bigint, positive bigint"


def _chosen(open_nodes: np.ndarray, trees: np.ndarray, ordinals: np.ndarray, tried: np.ndarray, width: int, bins: int, seed: int):  # noqa: ANN202
    """Best split of each open node of a group, its blocks merged one after the other."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, np.int64).reshape(3, -1) for b in table.column("sums").to_pylist()]
        low = min(p[0].min() for p in parts) // (width * bins)
        high = max(p[0].max() for p in parts) // (width * bins) + 1
        cells = (high - low) * width * bins
        w, p = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        for part in parts:
            at = part[0] - low * width * bins
            np.add.at(w, at, part[1])
            np.add.at(p, at, part[2])
        w, p = w.reshape(-1, width, bins), p.reshape(-1, width, bins)
        mine = np.arange(low, high)
        allowed = allowed_features(trees[mine], ordinals[mine], tried[mine], width, seed)
        feature, cut, gain, lw, lp = best_splits(w, p, allowed)
        columns = [open_nodes[mine], feature, cut, gain, lw, lp, w[:, 0].sum(axis=1), p[:, 0].sum(axis=1)]
        types = [pa.float64() if i == 3 else pa.int64() for i in range(8)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split(" ")[0] for c in _SPLIT.split(", ")])

    return run


def grow(
    blocks: DataFrame, trees: Sequence[tuple[int, int]], width: int, depth: int, least: int, seed: int = 1, sample: bool = True, bins: int = BINS
) -> Splits:
    """The trees (number, columns tried), each to ``depth`` levels; nodes lighter than ``least`` stay leaves."""
    spark = blocks.sparkSession
    numbers, tried = (np.array(x) for x in zip(*trees))
    splits = Splits.roots(len(trees))
    ordinals = np.zeros(len(trees), np.int64)  # place of a node in its tree, as in a heap
    open_nodes = np.arange(len(trees))
    parts = max(1, min(len(trees), 2 * spark.sparkContext.defaultParallelism))
    for level in range(depth + 1):
        if not len(open_nodes):
            break
        # nodes of one tree are next to each other, so a group covers a run of open nodes
        open_nodes = open_nodes[np.argsort(splits.tree[open_nodes], kind="stable")]
        groups = np.array_split(np.unique(splits.tree[open_nodes]), parts)
        of = splits.tree[open_nodes]
        sent = spark.sparkContext.broadcast(splits.arrays())
        dealt = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition("group", "bins")
        sums = dealt.mapInArrow(_sums(sent, open_nodes, level, groups, numbers, seed, sample, bins), "group bigint, sums binary")
        pick = _chosen(open_nodes, numbers[of], ordinals[open_nodes], tried[of], width, bins, seed)
        found = sums.groupBy("group").applyInArrow(pick, _SPLIT).toArrow()  # one short row per open node
        sent.unpersist()
        f = {c: found.column(c).to_numpy() for c in found.column_names}
        node = f["node"]
        splits.weight[node], splits.positive[node] = f["weight"], f["positive"]
        split = (f["gain"] > 0) & (f["weight"] >= least) if level < depth else np.zeros(len(node), bool)
        if not split.any():
            break
        order = np.flatnonzero(split)[np.argsort(node[split])]
        node, size = node[order], len(splits.feature)
        splits.feature[node], splits.cut[node] = f["feature"][order], f["cut"][order]
        splits.left[node] = size + 2 * np.arange(len(node))
        lw, lp = f["left_weight"][order], f["left_positive"][order]
        both = lambda a, b: np.stack([a, b], axis=1).ravel()
        splits = Splits(
            np.append(splits.feature, np.full(2 * len(node), -1, np.int16)),
            np.append(splits.cut, np.zeros(2 * len(node), np.uint8)),
            np.append(splits.left, np.zeros(2 * len(node), np.int64)),
            np.append(splits.weight, both(lw, f["weight"][order] - lw)),
            np.append(splits.positive, both(lp, f["positive"][order] - lp)),
            np.append(splits.tree, np.repeat(splits.tree[node], 2)),
        )
        ordinals = np.append(ordinals, both(2 * ordinals[node] + 1, 2 * ordinals[node] + 2))
        new = np.arange(size, len(splits.feature))
        # a node that cannot be split needs no sums
        open_nodes = new[(splits.weight[new] >= least) & (splits.positive[new] > 0) & (splits.positive[new] < splits.weight[new])]
    return splits


def grown_tree(binned: np.ndarray, label: np.ndarray, weight: np.ndarray, tree: int, tried: int, depth: int, least: int, seed: int) -> Splits:
    """The tree that ``grow`` makes, from all its cells in one place."""
    kept = np.flatnonzero(weight)
    binned, weight = binned[:, kept], weight[kept].astype(float)
    positive = weight * label[kept]
    splits, sizes = Splits.roots(1), binned.max(axis=1, initial=0).astype(np.int64) + 1
    splits.weight[:], splits.positive[:] = weight.sum(), positive.sum()
    open_nodes, ordinals = np.zeros(1, np.int64), np.zeros(1, np.int64)  # ordinals: place in the tree, as in a heap
    at = np.zeros(len(kept), np.int64)  # which of the open nodes a cell is in
    for _ in range(depth):
        if not len(open_nodes):
            break
        allowed = allowed_features(np.full(len(open_nodes), tree), ordinals, np.full(len(open_nodes), tried), len(binned), seed)
        gain = np.full(len(open_nodes), -1.0)
        feature, cut, lw, lp = (np.zeros(len(open_nodes), np.int64) for _ in range(4))
        for f, bins in enumerate(sizes):
            asking = np.flatnonzero(allowed[:, f])
            for start in range(0, len(asking), NODES_AT_ONCE):
                mine = asking[start : start + NODES_AT_ONCE]
                slot = np.full(len(open_nodes), -1)
                slot[mine] = np.arange(len(mine))
                here = slot[at]
                used = np.flatnonzero(here >= 0)
                cell = here[used] * bins + binned[f, used]
                w, p = (np.bincount(cell, x[used], len(mine) * bins).reshape(-1, 1, bins) for x in (weight, positive))
                _, c, g, a, b = best_splits(w, p, np.ones((len(mine), 1), bool))
                better = g > gain[mine]  # of equal gains the first feature stays
                mine = mine[better]
                gain[mine], feature[mine], cut[mine], lw[mine], lp[mine] = g[better], f, c[better], a[better], b[better]
        split = (gain > 0) & (splits.weight[open_nodes] >= least)
        node, size = open_nodes[split], len(splits.feature)
        if not len(node):
            break
        splits.feature[node], splits.cut[node], splits.left[node] = feature[split], cut[split], size + 2 * np.arange(len(node))
        both = lambda a, b: np.stack([a, b], axis=1).ravel()
        w, p = (both(x[split], every[node] - x[split]) for x, every in ((lw, splits.weight), (lp, splits.positive)))
        goes_on = (w >= least) & (p > 0) & (p < w)  # a node that cannot be split needs no sums
        place, follows = np.full(len(open_nodes), -1), np.full(len(w), -1)
        place[split], follows[goes_on] = np.arange(len(node)), np.arange(goes_on.sum())
        right = binned[feature[at], np.arange(len(at))] > cut[at]
        at = np.where(place[at] >= 0, follows[2 * place[at] + right], -1)
        stays = np.flatnonzero(at >= 0)
        binned, weight, positive, at = binned[:, stays], weight[stays], positive[stays], at[stays]
        ordinals = both(2 * ordinals[split] + 1, 2 * ordinals[split] + 2)[goes_on]
        open_nodes = size + np.flatnonzero(goes_on)
        splits = Splits(
            np.append(splits.feature, np.full(len(w), -1, np.int16)),
            np.append(splits.cut, np.zeros(len(w), np.uint8)),
            np.append(splits.left, np.zeros(len(w), np.int64)),
            np.append(splits.weight, w),
            np.append(splits.positive, p),
            np.zeros(size + len(w), np.int64),
        )
    return splits


_TREE = "width int, tree int, nodes bigint, body binary"
_NODE = (np.int16, np.uint8, np.int32, np.int64, np.float64)


def grow_whole(blocks: DataFrame, sizes: dict[int, int], depths: dict[int, int], least: int, seed: int, sample: bool) -> DataFrame:
    """Trees from blocks of cells: ``sizes`` trees for each number of columns tried, each grown to its depth by one task.

    A task gets all cells, with the draws for its own trees only.
    """
    most = max(sizes.values())
    numbers = np.array_split(np.arange(most), min(most, _tasks(blocks)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group", "n", "label", "bins", "wide", "count", "weights"]
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        for batch in batches:
            for r in batch.to_pylist():
                for g, mine in enumerate(numbers):
                    a_tree = r["n"] * r["wide"]
                    drawn = r["weights"][mine[0] * a_tree : (mine[-1] + 1) * a_tree] if sample else b""
                    row = (g, r["n"], r["label"], r["bins"], r["wide"], r["count"], drawn)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[dict]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                groups.setdefault(r["group"], []).append(r)
        for g, held in groups.items():
            label = np.concatenate([np.frombuffer(r["label"], np.uint8) for r in held])
            binned = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, r["n"]) for r in held], axis=1)
            for i, tree in enumerate(numbers[g].tolist()):
                weight = np.concatenate([_tree_weights(r, i, seed, sample) for r in held])
                for width, size in sizes.items():
                    if tree < size:
                        s = grown_tree(binned, label, weight, tree, width, depths[width], least, seed)
                        columns = s.by_tree()[0]
                        body = b"".join(c.astype(t).tobytes() for c, t in zip(columns, _NODE))
                        row = zip((width, tree, len(s.feature), body), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in row], ["width", "tree", "nodes", "body"])

    dealt = blocks.mapInArrow(deal, "group int, n bigint, label binary, bins binary, wide int, count binary, weights binary")
    return dealt.repartitionById(len(numbers), "group").mapInArrow(run, _TREE)


def _unpacked(nodes: int, body: bytes) -> tuple[np.ndarray, ...]:
    columns, at = [], 0
    for t in _NODE:
        columns.append(np.frombuffer(body, t, nodes, at))
        at += nodes * np.dtype(t).itemsize
    return tuple(columns)


def _pieces(grown: DataFrame, width: int, most_nodes: int) -> list:
    """Broadcasts of the trees of one number of columns, in their order, about ``most_nodes`` nodes each."""
    sc, own = grown.sparkSession.sparkContext, grown.where(F.col("width") == width)
    sizes = sorted((r["tree"], r["nodes"]) for r in own.select("tree", "nodes").collect())  # one row per tree
    turn = np.cumsum([n for _, n in sizes]) // most_nodes
    out = []
    for t in np.unique(turn):
        mine = [tree for (tree, _), own_turn in zip(sizes, turn) if own_turn == t]
        rows = own.where(F.col("tree").between(mine[0], mine[-1])).collect()  # split tables
        out.append(sc.broadcast([_unpacked(r["nodes"], r["body"]) for r in sorted(rows, key=lambda r: r["tree"])]))
    return out


def _path(tree: tuple[np.ndarray, ...], binned: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight and share of the nodes on the way of each row, one line a level; it stays at its leaf."""
    feature, cut, left, weight, share = tree
    rows, at = np.arange(binned.shape[1]), np.zeros(binned.shape[1], np.int32)
    weights, shares = np.empty((depth + 1, len(rows)), np.int64), np.empty((depth + 1, len(rows)))
    for level in range(depth + 1):
        weights[level], shares[level] = weight[at], share[at]
        if level < depth:
            f = feature[at]
            at = np.where(f >= 0, left[at] + (binned[f, rows] > cut[at]), at)
    return weights, shares


def _counted(pieces: list, mine: list[tuple[int, dict]]):  # noqa: ANN202
    """Hits and misses of every combination of one number of columns tried in each block.

    A forest stops at the first node lighter than its split size.  Nodes get lighter on the way down, so one way through
    a tree tells where each split size and depth ends, and the votes are added up tree by tree.
    """
    slots = sorted({(int(c["min_split"]), int(c["depth"])) for _, c in mine})
    after: dict[int, list[tuple[int, int, int]]] = {}  # combinations that are complete after so many trees
    for at, (_, c) in enumerate(mine):
        after.setdefault(int(c["trees"]), []).append((at, slots.index((int(c["min_split"]), int(c["depth"]))), int(c["trees"])))
    numbers = [i for i, _ in mine]
    depth, trees = max(d for _, d in slots), max(after)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                label, binned = np.frombuffer(row["label"], np.uint8), np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
                count = _row_counts(row)
                sums = np.zeros((4, len(numbers)), np.int64)
                for start in range(0, row["n"], ROWS_A_VOTE):  # a bounded number of rows at a time
                    y, own = label[start : start + ROWS_A_VOTE] == 1, binned[:, start : start + ROWS_A_VOTE]
                    own_count, places = count[start : start + ROWS_A_VOTE], np.arange(own.shape[1])
                    votes = np.zeros((len(slots), len(y)))
                    done = 0
                    for tree in (t for piece in pieces for t in piece.value):
                        if done == trees:
                            break
                        weights, shares = _path(tree, own, depth)
                        size = None
                        for s, (least, level) in enumerate(slots):
                            if least != size:
                                size, steps = least, (weights[:depth] >= least).sum(axis=0)
                            votes[s] += shares.ravel()[np.minimum(steps, level) * len(y) + places]
                        done += 1
                        for at, s, n in after.get(done, ()):
                            yes = votes[s] > n / 2
                            sums[:, at] += [int(own_count[c].sum()) for c in (yes & y, yes & ~y, ~yes & y, ~yes & ~y)]
                columns = [pa.array(numbers, pa.int64()), *[pa.array(c, pa.int64()) for c in sums], pa.array([row["part"]] * len(numbers))]
                yield pa.RecordBatch.from_arrays(columns, ["number", "tp", "fp", "fn", "tn", "part"])

    return run


def tune_forests(
    train: DataFrame,
    test: DataFrame,
    combinations: DataFrame,
    features: Sequence[str],
    label: str,
    key: str | Sequence[str],
    seed: int = 1,
    sample: bool = True,
    bins: int = BINS,
    block_rows: int = BLOCK_ROWS,
    most_nodes: int | None = None,
) -> DataFrame:
    """One row per combination with counts and F-score on training and test rows.

    ``combinations`` has the whole columns ``trees``, ``depth``, ``per_split`` (columns tried at a node) and
    ``min_split`` (lightest node that is split).  Votes are mean leaf shares; a tie is class 0.  With
    ``sample`` a tree draws its rows with replacement, else it takes each once.  ``most_nodes`` makes it an error
    that the trees for one number of columns tried may have more nodes; without it the driver takes them in turns.
    """
    spark = train.sparkSession
    if bins > 255:
        raise ValueError("a bin is one byte")
    tried = [r.asDict() for r in combinations.select("trees", "depth", "per_split", "min_split").collect()]  # the sampled parameters
    for c in tried:
        c["width"] = max(1, min(int(c["per_split"]), len(features)))
    if not tried:
        return spark.createDataFrame([], "trees int, depth int, per_split int, min_split int, train_f_score double, test_f_score double, train_rows long, test_rows long")
    by_width = {w: [(i, c) for i, c in enumerate(tried) if c["width"] == w] for w in sorted({c["width"] for c in tried})}
    sizes = {w: max(int(c["trees"]) for _, c in mine) for w, mine in by_width.items()}
    depths = {w: max(int(c["depth"]) for _, c in mine) for w, mine in by_width.items()}
    cuts = bin_cuts(train, features, bins)
    drawn = max(sizes.values()) if sample else 0
    packed = {name: _packed(d, key, features, label, cuts, n, seed, block_rows) for name, d, n in (("train", train, drawn), ("test", test, 0))}
    blocks, rows, cells = packed["train"]
    least = max(2, min(int(c["min_split"]) for c in tried))
    a_tree = min(2 ** (max(depths.values()) + 1), 2 * max(1, int(rows) // least) * 2)
    if most_nodes is not None and max(sizes.values()) * a_tree > most_nodes:
        raise ValueError(f"{max(sizes.values())} trees of {a_tree} nodes are more than most_nodes={most_nodes}")
    scored = [d.select("n", "label", "bins", "count", F.lit(name).alias("part")) for name, (d, _, _) in packed.items()]
    scored = scored[0].unionByName(scored[1])
    counts = []
    if 0 < cells <= CELLS_A_TASK:
        grown = materialise(grow_whole(blocks, sizes, depths, least, seed, sample))
        for w, mine in by_width.items():
            counts.append(_votes(scored, _pieces(grown, w, MOST_NODES), mine))
    else:
        trees = [(t, w) for w, size in sizes.items() for t in range(size)]
        at_once = max(1, MOST_NODES // a_tree)  # as many trees as the driver may hold split tables for
        pieces: dict[int, list] = {w: [] for w in sizes}
        for start in range(0, len(trees), at_once):
            turn = trees[start : start + at_once]
            tables = grow(blocks, turn, len(features), max(depths[w] for _, w in turn), least, seed, sample, bins + 1).by_tree()
            for w in dict.fromkeys(w for _, w in turn):
                pieces[w].append(spark.sparkContext.broadcast([x for x, (_, own) in zip(tables, turn) if own == w]))
                if (sizes[w] - 1, w) in turn:  # the last one
                    counts.append(_votes(scored, pieces.pop(w), by_width[w]))
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    sums = every.groupBy("number").pivot("part", ["train", "test"]).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    listed = [(i, int(c["trees"]), int(c["depth"]), int(c["per_split"]), int(c["min_split"])) for i, c in enumerate(tried)]
    named = spark.createDataFrame(listed, "number long, trees int, depth int, per_split int, min_split int")
    f = lambda p: F.try_divide(2.0 * F.col(f"{p}_tp"), 2.0 * F.col(f"{p}_tp") + F.col(f"{p}_fp") + F.col(f"{p}_fn")).alias(f"{p}_f_score")
    n = lambda p: sum((F.coalesce(f"{p}_{c}", F.lit(0)) for c in ("fp", "fn", "tn")), F.coalesce(f"{p}_tp", F.lit(0))).alias(f"{p}_rows")
    return named.join(sums, "number", "left").select("trees", "depth", "per_split", "min_split", f("train"), f("test"), n("train"), n("test"))


def _votes(scored: DataFrame, pieces: list, mine: list[tuple[int, dict]]) -> DataFrame:
    """Hits and misses of the combinations for one number of columns tried; written, so the trees can go."""
    dealt = scored.repartition(_tasks(scored), "part", "bins")
    found = dealt.mapInArrow(_counted(pieces, mine), "number bigint, tp bigint, fp bigint, fn bigint, tn bigint, part string")
    out = materialise(found.groupBy("number", "part").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]))
    for piece in pieces:
        piece.destroy()
    return out
