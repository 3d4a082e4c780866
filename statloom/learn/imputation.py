"""Chained imputation with predictive mean matching.

A round visits the columns in turn.  Each is regressed on the others over its observed rows,
from sums of products that the driver keeps; after a column has changed, only its own products are
summed again.  Coefficients are drawn around the fitted ones, and a missing value takes the
observed value of one of the rows predicted most alike, all found in one ordered pass.

Rows without a gap never change.  Their products are summed once, and equal ones are one donor row with
its copies, packed into blocks of numbers.  A round moves the rows with a gap; of the blocks it sends the
predictions and values only, each range of the prediction in one piece.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from statloom.operators.ordered import CUTS_PER_BLOCK, MAX_SPLITS, ROWS_PER_SPLIT
from statloom.session import materialise

BLOCK_ROWS = 131_072
ROWS_A_RANGE_SHOWN = 1_000
MOST_SHOWN = 2_000_000

@dataclass
class Products:
    """Sums of products over the rows where a target is observed, per target; place 0 is the constant.

    ``fixed`` has those of the rows without a gap, which every target shares and no round changes.

    Columns enter less their first mean and divided by their first deviation, so sums stay well scaled.
    """

    names: list[str]
    targets: list[str]
    centre: dict[str, float]
    scale: dict[str, float]
    sums: dict[str, np.ndarray]
    fixed: np.ndarray

    def term(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.centre[name])) / F.lit(self.scale[name])

    def update(self, rows: DataFrame, flags: dict[str, str], changed: Sequence[str]) -> None:
        """Sum the products of the changed columns again, for targets other than the column itself."""
        wanted, found = [], []
        places = ["", *self.names]
        terms = {"": F.lit(1.0)} | {n: self.term(n) for n in self.names}
        for t in self.targets:
            for i, a in enumerate(places):
                for j in range(i, len(places)):
                    if any(c in (a, places[j]) and c != t for c in changed):
                        wanted.append((t, i, j))
                        found.append(F.sum(F.when(~F.col(flags[t]), terms[a] * terms[places[j]])).alias(f"s{len(found)}"))
        if not found:
            return
        row = rows.agg(*found).first()
        for (t, i, j), value in zip(wanted, row):
            self.sums[t][i, j] = self.sums[t][j, i] = self.fixed[i, j] + (value or 0.0)

    def coefficients(self, target: str, rng: np.random.Generator | None) -> tuple[np.ndarray, np.ndarray]:
        """Fitted weights and weights drawn around them (the same without a generator); the target's own is 0."""
        sums, own = self.sums[target], 1 + self.names.index(target)
        others = [i for i in range(len(sums)) if i != own]
        left, right = sums[np.ix_(others, others)], sums[others, own]
        inverse = np.linalg.pinv(left, hermitian=True)
        beta = inverse @ right
        drawn = beta
        if rng is not None:
            freedom = max(1.0, sums[0, 0] - len(others))
            error = max(0.0, float(sums[own, own] - beta @ right))
            sigma = np.sqrt(error / rng.chisquare(freedom))
            values, vectors = np.linalg.eigh(inverse)
            drawn = beta + sigma * (vectors * np.sqrt(np.maximum(values, 0))) @ rng.standard_normal(len(beta))
        return np.insert(beta, own, 0.0), np.insert(drawn, own, 0.0)

    def terms(self, weights: np.ndarray) -> list[tuple[int, float, float, float]]:
        """Place, weight, centre and scale of the columns a prediction adds up."""
        return [(i, float(w), self.centre[n], self.scale[n]) for i, (n, w) in enumerate(zip(self.names, weights[1:])) if w]


def _pick(ids: np.ndarray, seed: int, donors: int) -> np.ndarray:
    """Which of the nearest donors a row takes: the same whenever a task runs again."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(donors)).astype(np.int64)


def drawn_values(own: np.ndarray, ids: np.ndarray, predicted: np.ndarray, values: np.ndarray, donors: int, seed: int) -> np.ndarray:
    """For each ``own`` prediction the value of one of the ``donors`` nearest ``predicted``, which ascend.

    Of equally near donors the ones below come first.
    """
    at = np.searchsorted(predicted, own, "right")
    steps = np.array([s for k in range(donors) for s in (-1 - k, k)])
    places = at[:, None] + steps
    inside = (places >= 0) & (places < len(predicted))
    places = np.clip(places, 0, len(predicted) - 1)
    far = np.where(inside, np.abs(predicted[places] - own[:, None]), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    chosen = np.minimum(_pick(ids, seed, donors), inside.sum(axis=1) - 1)
    return values[np.take_along_axis(places, order, axis=1)[np.arange(len(own)), chosen]]


def _packed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Blocks of rows: the named columns one after the other, and the copies."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        body = b"".join(table.column(c).to_numpy().astype(np.float64).tobytes() for c in names)
        copies = table.column("_copies").to_numpy().astype(np.int64).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int64()), pa.array([body], pa.binary()), pa.array([copies], pa.binary())], ["n", "body", "copies"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    return rows.select(*names, "_copies").mapInArrow(run, "n bigint, body binary, copies binary")


def _unpacked(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["body"], np.float64).reshape(width, row["n"]), np.frombuffer(row["copies"], np.int64)


def _sum_of(terms: list[tuple[int, float, float, float]], constant: float, x: np.ndarray) -> np.ndarray:
    """Predictions of packed rows."""
    total = np.full(x.shape[1], constant)
    for i, w, centre, scale in terms:
        total = total + w * ((x[i] - centre) / scale)
    return total


def _range_at(p: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many cuts lie below each prediction; those equal to a cut that repeats are dealt over its ranges."""
    part = np.searchsorted(cuts, p, "left")
    values, times = np.unique(cuts, return_counts=True)
    for value, m in zip(values[times > 1], times[times > 1]):
        tied = np.flatnonzero(p == value)
        part[tied] += np.arange(len(tied)) % m
    return part


def _edges(part: np.ndarray, p: np.ndarray, v: np.ndarray, parts: int, donors: int) -> list[bytes]:
    """For each range the last donors before it and the first behind it; they are ordered by range, prediction and value."""
    first, last = np.searchsorted(part, np.arange(parts), "left"), np.searchsorted(part, np.arange(parts), "right")
    out = []
    for a, b in zip(first, last):
        low, high = slice(max(0, a - donors), a), slice(b, b + donors)
        out.append(np.concatenate([[a - low.start, len(p[high])], p[low], v[low], p[high], v[high]]).astype(np.float64).tobytes())
    return out


_PIECE = "part int, p binary, v binary, times binary, edges binary, rows binary"


def _order(p: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Places by prediction, then value; only equal predictions are sorted twice."""
    order = np.argsort(p)
    same = p[order[1:]] == p[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(p) else same
    own = order[tied]
    order[tied] = own[np.lexsort((v[own], p[own]))]
    return order


def _pieces(part: np.ndarray, p: np.ndarray, v: np.ndarray, times: np.ndarray, parts: int, donors: int) -> tuple[list[slice], list[bytes], np.ndarray]:
    """Where the donors of each range lie once in order, the edges of the ranges, and that order."""
    order = _order(p, v)
    if (np.diff(part[order]) < 0).any():  # equal predictions dealt over several ranges
        order = np.lexsort((v, p, part))
    part = part[order]
    ends = np.searchsorted(part, np.arange(parts + 1), "left")
    # a donor counts as often as it has copies; at an edge a few of them are enough
    near = ends[:, None] + np.arange(-donors, donors)[None, :]
    near = np.unique(near[(near >= 0) & (near < len(part))])
    edges = _edges(*(np.repeat(y, times[order[near]]) for y in (part[near], p[order[near]], v[order[near]])), parts, donors)
    return [slice(x, y) for x, y in zip(ends[:-1], ends[1:])], edges, order


def _piece(*row) -> pa.RecordBatch:  # noqa: ANN002
    types = (pa.int32(), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["part", "p", "v", "times", "edges", "rows"])


def _dealt_blocks(column: int, width: int, terms: list, constant: float, cuts: np.ndarray, donors: int):  # noqa: ANN202
    """Predictions and values of the packed rows by range of the prediction, with the edges of all ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, copies = _unpacked(row, width)
                p, v, times = _sum_of(terms, constant, x), x[column], np.minimum(copies, donors).astype(np.int8)
                places, edges, order = _pieces(_range_at(p, cuts), p, v, times, len(cuts) + 1, donors)
                p, v, times = p[order], v[order], times[order]
                for r, (own, edge) in enumerate(zip(places, edges)):
                    yield _piece(r, p[own].tobytes(), v[own].tobytes(), times[own].tobytes(), edge, None)

    return run


def _dealt_rows(column: int, flag: str, names: list[str], flags: list[str], fitted: tuple, drawn: tuple, cuts: np.ndarray, donors: int):  # noqa: ANN202
    """The rows with a gap by range of their prediction, and the edges that the donors among them give to all ranges."""

    def deal(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        plain = lambda c: table.column(c).to_numpy()
        x, ids, gone = np.array([plain(n) for n in names]), plain("_id"), np.array([plain(f) for f in flags]).astype(np.uint8)
        missing = plain(flag).astype(bool)
        p = np.where(missing, _sum_of(*drawn, x), _sum_of(*fitted, x))
        part = _range_at(p, cuts)
        seen = np.flatnonzero(~missing)
        _, edges, _ = _pieces(part[seen], p[seen], x[column, seen], np.ones(len(seen), np.int8), len(cuts) + 1, donors)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(len(cuts) + 2), "left")
        for r, edge in enumerate(edges):
            own = order[ends[r] : ends[r + 1]]
            yield _piece(r, None, None, None, edge, ids[own].tobytes() + p[own].tobytes() + x[:, own].tobytes() + gone[:, own].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield from deal(held)
                held, n = [], 0
        if n:
            yield from deal(held)

    return run


def _matched(column: int, flag: int, names: list[str], flags: list[str], donors: int, seed: int):  # noqa: ANN202
    """The rows with a gap of a range, flagged values replaced by values of donors."""

    def fill(held: list[dict]) -> pa.RecordBatch | None:
        number = lambda c, t: [np.frombuffer(b[c], t) for b in held if b[c] is not None]
        ids, own, x, gone = [], [], [], []
        for body in number("rows", np.uint8):
            n = len(body) // (8 * (2 + len(names)) + len(flags))
            ids.append(body[: 8 * n].view(np.int64))
            own.append(body[8 * n : 16 * n].view(np.float64))
            x.append(body[16 * n : 8 * n * (2 + len(names))].view(np.float64).reshape(len(names), n))
            gone.append(body[8 * n * (2 + len(names)) :].reshape(len(flags), n).astype(bool))
        if not sum(map(len, ids)):
            return None
        ids, own, x, gone = np.concatenate(ids), np.concatenate(own), np.concatenate(x, axis=1), np.concatenate(gone, axis=1)
        missing, values = gone[flag], x[column].copy()
        if missing.any():
            times = [m.astype(np.int64) for m in number("times", np.int8)]
            p = np.concatenate([own[~missing], *[np.repeat(y, m) for y, m in zip(number("p", np.float64), times)]])
            v = np.concatenate([values[~missing], *[np.repeat(y, m) for y, m in zip(number("v", np.float64), times)]])
            order = _order(p, v)
            sides: tuple[list, list] = [], []
            for e in number("edges", np.float64):
                a, b = int(e[0]), int(e[1])
                sides[0].append(e[2 : 2 + 2 * a].reshape(2, a))
                sides[1].append(e[2 + 2 * a :].reshape(2, b))
            before, behind = (np.concatenate([np.zeros((2, 0)), *y], axis=1) for y in sides)
            before, behind = (y[:, np.lexsort((y[1], y[0]))] for y in (before, behind))
            p, v = (np.concatenate([before[i, -donors:], y[order], behind[i, :donors]]) for i, y in enumerate((p, v)))
            if len(p):
                values[missing] = drawn_values(own[missing], ids[missing], p, v, donors, seed)
        columns = [ids, *[values if i == column else c for i, c in enumerate(x)], *gone]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_id", *names, *flags])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ranges.setdefault(row["part"], []).append(row)
        for held in ranges.values():
            found = fill(held)
            if found is not None:
                yield found

    return run


def _match(rows: DataFrame, blocks: DataFrame, products: Products, column: str, flags: dict[str, str], donors: int, seed: int, cuts: list[float], weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The rows with a gap, flagged values replaced by values of donors: rows of these or packed ones without a gap.

    The donors are dealt out by ranges of the prediction, between ``cuts``, and every range learns the last donors
    before it and the first ones behind it.
    """
    names, all_flags = products.names, list(flags.values())
    fitted, drawn = ((products.terms(w), float(w[0])) for w in weights)
    place, limits = names.index(column), np.array(cuts)
    moved = rows.mapInArrow(_dealt_rows(place, flags[column], names, all_flags, fitted, drawn, limits, donors), _PIECE)
    given = blocks.mapInArrow(_dealt_blocks(place, len(names), *fitted, limits, donors), _PIECE)
    dealt = moved.unionByName(given).repartitionById(len(cuts) + 1, "part")
    return dealt.mapInArrow(_matched(place, all_flags.index(flags[column]), names, all_flags, donors, seed), rows.schema)


def _shown_rows(rows: DataFrame, names: list[str], every: int) -> np.ndarray:
    """One in so many rows with a gap, which tell with ``_shown_blocks`` where to cut ranges of about the same size."""
    found = rows.where(F.pmod(F.xxhash64("_id"), F.lit(every)) == 0).select(*names).toArrow()  # about MOST_SHOWN rows at most
    return np.array([found.column(c).to_numpy() for c in names])


def _shown_blocks(blocks: DataFrame, names: list[str], every: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = _unpacked(row, len(names))[0][:, ::every]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in x], [f"c{i}" for i in range(len(x))])

    found = blocks.mapInArrow(run, ", ".join(f"c{i} binary" for i in range(len(names)))).collect()  # as above
    return np.array([np.frombuffer(b"".join(r[i] for r in found), np.float64) for i in range(len(names))])


def _cuts(products: Products, weights: np.ndarray, shown: np.ndarray, parts: int) -> list[float]:
    p = np.sort(_sum_of(products.terms(weights), float(weights[0]), shown))
    return [float(p[len(p) * i // parts]) for i in range(1, parts)] if len(p) else []


def _range_of(value: Column, cuts: list[float], spread: Column) -> Column:
    """How many cuts lie below the value; rows equal to a cut that repeats are dealt over its ranges by ``spread``."""
    blocks = [cuts[i : i + CUTS_PER_BLOCK] for i in range(0, len(cuts), CUTS_PER_BLOCK)]
    heads = F.lit([b[0] for b in blocks[1:]]) if len(blocks) > 1 else F.array().cast("array<double>")
    block = F.size(F.filter(heads, lambda c: c < value))
    inside = F.size(F.filter(F.get(F.array(*[F.lit(b) for b in blocks]), block), lambda c: c < value))
    place = block * CUTS_PER_BLOCK + inside
    tied = {c: m for c, m in Counter(cuts).items() if m > 1}
    if tied:
        times = F.try_element_at(F.create_map(*[F.lit(x) for pair in tied.items() for x in pair]), value)
        place = place + F.coalesce(F.pmod(spread, times), F.lit(0))
    return place.cast("long")


def impute_pmm(
    df: DataFrame,
    columns: Sequence[str],
    predictors: Sequence[str] = (),
    iterations: int = 5,
    rows_per_split: int = ROWS_PER_SPLIT,
    donors: int = 5,
    seed: int | None = 1,
) -> DataFrame:
    """Fill the listed numeric columns from observed values of rows predicted alike.

    Missing values start at the column mean.  In every round each column is
    regressed, on its observed rows, on the other columns and ``predictors``
    (which must be complete).  Observed rows are predicted with the fitted coefficients, missing ones with
    coefficients drawn around them, and take the value of one of the ``donors`` observed rows that lie
    nearest.  ``seed`` None draws nothing; with one donor that is the closest row.

    A round writes the numeric columns of the rows with a gap once per column to fill; the other columns and
    rows wait and are joined at the end.  Beyond ``rows_per_split`` rows with a gap and distinct rows without one
    the ordered pass is spread over ranges of the prediction.  A column without any observed value stays NULL.
    """
    columns = list(columns)
    whole = materialise(df.withColumn("_id", F.monotonically_increasing_id()))
    names = [*columns, *[p for p in predictors if p not in columns]]
    stats = whole.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(names)],
    ).first()
    known = [c for i, c in enumerate(names) if stats[f"m{i}"] is not None]
    filled = [c for c in columns if c in known]
    if not filled:
        return whole.drop("_id")
    centre = {c: float(stats[f"m{i}"]) for i, c in enumerate(names) if c in known}
    scale = {c: float(stats[f"s{i}"] or 0) or 1.0 for i, c in enumerate(names) if c in known}
    flags = {c: f"_missing_{i}" for i, c in enumerate(filled)}
    start = {c: F.coalesce(F.col(c).cast("double"), F.lit(centre[c])).alias(c) if c in filled else F.col(c).cast("double").alias(c) for c in known}
    gap = reduce(or_, [F.col(c).isNull() for c in filled])
    numbers = whole.select("_id", *start.values(), *[F.col(c).isNull().alias(f) for c, f in flags.items()], gap.alias("_gap"))
    rows = materialise(numbers.where("_gap").drop("_gap"))
    # equal rows without a gap are one donor with its copies
    static = materialise(numbers.where("NOT _gap").groupBy(*known).agg(F.count(F.lit(1)).alias("_copies")))
    size = 1 + len(known)
    products = Products(known, filled, centre, scale, {t: np.zeros((size, size)) for t in filled}, np.zeros((size, size)))
    _all_products(products, rows, static, flags)
    gaps, distinct = rows.count(), static.count()
    cores = whole.sparkSession.sparkContext.defaultParallelism
    parts = min(MAX_SPLITS, max(1, -(-(gaps + distinct) // rows_per_split)))
    if parts > 1:
        parts = max(parts, 2 * cores)
        static = static.repartition(max(2 * cores, -(-distinct // BLOCK_ROWS)))
    blocks = materialise(_packed(static, known))
    steady = None
    for r in range(iterations):
        if parts > 1:
            wanted = min(MOST_SHOWN, ROWS_A_RANGE_SHOWN * parts)
            every = max(1, (gaps + distinct) // wanted)
            if steady is None:  # the packed rows stay as they are
                steady = _shown_blocks(blocks, known, every)
            shown = np.concatenate([_shown_rows(rows, known, every), steady], axis=1)
        for c in filled:
            rng = None if seed is None else np.random.default_rng([seed, r, zlib.crc32(c.encode())])
            weights = products.coefficients(c, rng)
            cuts = _cuts(products, weights[0], shown, parts) if parts > 1 else []
            rows = materialise(_match(rows, blocks, products, c, flags, donors, zlib.crc32(f"{seed}:{r}:{c}".encode()), cuts, weights))
            products.update(rows, flags, [c])
    done = rows.select("_id", *[F.col(c).alias(f"_new_{i}") for i, c in enumerate(filled)])
    joined = whole.join(done, "_id", "left").withColumns({c: F.coalesce(f"_new_{i}", F.col(c).cast("double")) for i, c in enumerate(filled)})
    return joined.drop("_id", *[f"_new_{i}" for i in range(len(filled))])


def _all_products(products: Products, rows: DataFrame, static: DataFrame, flags: dict[str, str]) -> None:
    places = ["", *products.names]
    terms = {"": F.lit(1.0)} | {n: products.term(n) for n in products.names}
    pairs = [(i, j) for i in range(len(places)) for j in range(i, len(places))]
    product = lambda i, j: terms[places[i]] * terms[places[j]]
    found = static.agg(*[F.sum(product(i, j) * F.col("_copies")).alias(f"s{k}") for k, (i, j) in enumerate(pairs)]).first()
    for (i, j), value in zip(pairs, found):
        products.fixed[i, j] = products.fixed[j, i] = value or 0.0
    for t in products.targets:
        row = rows.where(~F.col(flags[t])).agg(*[F.sum(product(i, j)).alias(f"s{k}") for k, (i, j) in enumerate(pairs)]).first()
        for (i, j), value in zip(pairs, row):
            products.sums[t][i, j] = products.sums[t][j, i] = products.fixed[i, j] + (value or 0.0)
