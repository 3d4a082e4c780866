"""Toxic texts by a support vector machine over a subsequence string kernel.

A unit is a word with everything but its letters taken out, so marks set into an insult
vanish, a run of single letters put together whatever marks or blanks stand between them,
up to four short neighbours put together, or a window of a very long word.  The kernel
of two units counts the letter triples they share, gaps allowed: a triple that spans s
letters weighs DECAY^s, up to SPAN letters.  Inserted letters only lower the weight of
some triples.  The kernel is scaled by what a unit of its length can reach.

Training.  Labelled sentences come from a bounded sample of labelled documents (at most
``most_docs`` per class, one of each family of copies).  Clean sentences are clean in all
their units; of a toxic document the units tied to the label by a likelihood ratio count
as toxic, with spelled-apart variants.  Landmarks of the Nyström map are the toxic units
and the commonest clean ones; a squared-hinge machine is fitted on the map, then again
with the clean units it found hardest.  The machine is linear in the triples, so it
folds into one weight per triple, and a text is scored by its highest unit.

Defined results
    NULL and empty texts get the score of a text without any unit, which is low.
    Without labels of both kinds every score is the share of toxic labels (0 without
    any).  Repeated rows score alike.  An empty table gives no rows.  Other columns are
    never read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from statloom.llm.near_dedup import mixed, shingles
from statloom.llm.text import SPACES, filled, give_back, in_portions
from statloom.session import materialise

DECAY = 0.92
SPAN = 8
WINDOW = 24
#: So many neighbours of at most so many letters are also read as one word.
PIECES = 4
SHORT = 3
ALPHABET = 32
PORTION = 2 << 20
MOST_DOCS = 6000
LANDMARKS = 256
#: Likelihood ratio from which a unit counts as tied to the label: chance reaches it once in two million.
TIED = 25.0

_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _codes() -> dict[int, int]:
    return {ord(c): i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}


_LETTERS = _codes()


def letters(word: str) -> str:
    low = word.lower()
    return low if low.isalpha() else "".join(c for c in low if c.isalpha())


def coded(units: list[str], length: int) -> np.ndarray:
    """(units, length): letters as numbers; letters beyond a-z share five."""
    return np.array([[_LETTERS.get(ord(c), 27 + ord(c) % 5) for c in u] for u in units], np.int32).reshape(len(units), length)


def windows(unit: str) -> list[str]:
    if len(unit) <= WINDOW:
        return [unit]
    half = WINDOW // 2
    return [unit[i : i + WINDOW] for i in range(0, len(unit) - half, half)]


def _reach(length: int) -> float:
    return math.sqrt(sum(max(0, length - b) * DECAY ** (2 * (b + 1)) for _, b in _STEPS)) or 1.0


def triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Numbers of the letter triples at each step, with their weight."""
    length = codes.shape[1]
    for a, b in _STEPS:
        if length > b:
            first, second, third = codes[:, : length - b], codes[:, a : length - b + a], codes[:, b:]
            yield (first * ALPHABET + second) * ALPHABET + third, DECAY ** (b + 1)


def vectors(units: list[str]) -> np.ndarray:
    """(units, triples): the scaled feature vectors; for landmarks and training only."""
    out = np.zeros((len(units), ALPHABET**3), np.float32)
    for i, unit in enumerate(units):
        for numbers, weight in triples(coded([unit], len(unit))):
            np.add.at(out[i], numbers.ravel(), weight)
        out[i] /= _reach(len(unit))
    return out


def folded_scores(units: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Decision of each unit; of a long one, the highest of its windows."""
    best = np.full(len(units), -np.inf)
    by_length: dict[int, list[tuple[int, str]]] = defaultdict(list)
    for i, unit in enumerate(units):
        for part in windows(unit):
            if len(part) > 2:
                by_length[len(part)].append((i, part))
    for length, parts in by_length.items():
        at = np.array([i for i, _ in parts])
        for start in range(0, len(parts), 20_000):
            codes = coded([p for _, p in parts[start : start + 20_000]], length)
            total = np.zeros(len(codes))
            for numbers, weight in triples(codes):
                total += weights[numbers].sum(axis=1) * weight
            np.maximum.at(best, at[start : start + 20_000], total / _reach(length) + bias)
    return np.where(np.isfinite(best), best, bias)


def _joined(left: np.ndarray, right: np.ndarray, names: list[str], units: dict[str, int]) -> np.ndarray:
    """Numbers of the units put together; each pair is looked up once."""
    n = len(names)
    pairs, at = np.unique(left * n + right, return_inverse=True)
    made = []
    for x, y in zip((pairs // n).tolist(), (pairs % n).tolist()):
        unit = names[x] + names[y]
        if unit not in units:
            names.append(unit)
        made.append(units[unit])
    return np.array(made, np.int64)[at]


def unit_lists(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """Distinct units and, per text, the numbers of its units.

    Words without letters are passed over.  Runs of three or more single letters are one
    piece, and up to ``PIECES`` neighbours of at most ``SHORT`` letters (or such runs) are
    units together, beside their own.
    """
    number: dict[str, int] = defaultdict(count().__next__)
    rows = []
    for text in texts:
        for c in SPACES[1:]:
            text = text.replace(c, " ")
        found = text.split(" ")
        rows.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    flat = [letters(w) for w in number]
    units: dict[str, int] = defaultdict(count().__next__)
    unit_of = np.array([units[u] for u in flat], np.int64)
    names = list(units)
    size_of = np.array([len(u) for u in names], np.int64)
    own, places, brief, owners = [], [], [], []
    for i, row in enumerate(rows):
        row = unit_of[row]
        own.append(row)
        row = row[size_of[row] > 0]
        short = size_of[row] <= SHORT
        alone = size_of[row] == 1
        if alone.sum() > 2:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], alone.astype(np.int8), [0]])))
            pieces, shorts, done, made = [], [], 0, []
            for s, e in zip(edges[::2], edges[1::2]):
                if e - s > 2:
                    unit = "".join(names[x] for x in row[s:e])
                    if unit not in units:
                        names.append(unit)
                    made.append(units[unit])
                    pieces += [row[done:s], made[-1:]]
                    shorts += [short[done:s], [len(unit) <= WINDOW // 2]]
                    done = e
            if made:
                own[i] = np.append(own[i], made).astype(np.int64)
                row = np.concatenate([*pieces, row[done:]]).astype(np.int64)
                short = np.concatenate([*shorts, short[done:]]).astype(bool)
        places.append(row)
        brief.append(short)
        owners.append(np.full(len(row), i))
    if texts:
        row, short, owner = np.concatenate(places), np.concatenate(brief), np.concatenate(owners)
        start, together = np.flatnonzero(short), row[short]
        for k in range(1, PIECES):
            far = start + k
            good = far < len(row)
            good[good] = short[far[good]] & (owner[far[good]] == owner[start[good]])
            start, together = start[good], together[good]
            if not len(start):
                break
            together = _joined(together, row[start + k], names, units)
            cut = np.searchsorted(owner[start], np.arange(1, len(texts)))
            own = [np.append(x, more) for x, more in zip(own, np.split(together, cut))]
    return names, [np.unique(x) for x in own]


class Model:
    """Weight per triple, bias, and the line that turns a decision into a chance."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def decisions(self, texts: list[str]) -> np.ndarray:
        units, rows = unit_lists(texts)
        value = folded_scores(units, self.weights, self.bias) if units else np.zeros(0)
        return np.array([value[r].max() if len(r) else self.bias for r in rows])

    def chances(self, texts: list[str]) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.slope * self.decisions(texts) + self.shift)))


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the bias) of min penalty |w|^2 + sum weight max(0, 1 - y f)^2, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = penalty / 100

    def loss(v: np.ndarray) -> float:
        return float(v @ ridge @ v + (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum())

    for _ in range(rounds):
        gap = 1 - y * (x @ w)
        on = gap > 0
        slope = 2 * ridge @ w - 2 * x[on].T @ (weight[on] * y[on] * gap[on])
        bend = 2 * ridge + 2 * (x[on] * weight[on, None]).T @ x[on]
        step = np.linalg.solve(bend, slope)
        size, before = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def platt(decision: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the chance of label 1, with smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([decision, np.ones(len(decision))])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, x.T @ (p - target) + 1e-6 * w)
        w -= np.clip(step, -3, 3)
    return float(w[0]), float(w[1])


def likelihood_ratio(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Of the unit's occurrences under the label against their share overall; 0 where it leans to clean."""
    n = toxic + clean
    share = all_toxic / (all_toxic + all_clean)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 2 * (np.where(toxic > 0, toxic * np.log(toxic / (n * share)), 0) + np.where(clean > 0, clean * np.log(clean / (n * (1 - share))), 0))
    return np.where(toxic > 3 * share / (1 - share) * clean, value, 0)


def spelled_apart(units: list[str], seed: int = 3) -> list[str]:
    """Variants with one and two letters put in."""
    rng = np.random.default_rng(seed)
    out = []
    for unit in units:
        for extra in (1, 1, 2):
            word = unit
            for _ in range(extra):
                at = int(rng.integers(1, len(word)))
                word = word[:at] + "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)] + word[at:]
            out.append(word)
    return out


def fit_units(toxic: list[str], clean: list[str], common: list[str], landmarks: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """Weight per triple and bias from toxic and clean units; ``common`` are the clean landmarks."""
    marks = vectors([*toxic, *common][:landmarks]).astype(float)
    gram = marks @ marks.T
    value, side = np.linalg.eigh(gram)
    good = value > 1e-6 * value.max()
    root = side[:, good] / np.sqrt(value[good])  # Nyström: k(x, landmarks) @ root
    more = spelled_apart(toxic)
    units = [*toxic, *more, *clean]
    y = np.array([1.0] * (len(toxic) + len(more)) + [-1.0] * len(clean))
    weight = np.array([1 / len(toxic)] * len(toxic) + [3 / len(more)] * len(more) + [3 / max(1, len(clean))] * len(clean))
    fold = marks.T @ root
    mapped = np.vstack([vectors(units[i : i + 64]) @ fold for i in range(0, len(units), 64)])
    w = squared_hinge(mapped, y, weight)
    weights = fold @ w[:-1]
    del marks, gram, fold, mapped
    give_back()
    return weights, float(w[-1])


def training_docs(docs: DataFrame, labels: DataFrame, most_docs: int, key: str, text: str, seed: int = 9) -> DataFrame:
    """``text`` and ``toxic`` of labelled rows that are not held out: at most ``most_docs`` per class, one of a family of copies."""
    open_rows = labels.where(F.crc32(F.col(key).cast("string")) % 5 != 0).where("toxic in (0, 1)")
    known = open_rows.groupBy(F.col(key).alias("_key")).agg(F.max("toxic").alias("toxic"))
    mixed_order = F.xxhash64(F.lit(seed), "_key")
    chosen = known.where("toxic = 1").orderBy(mixed_order, "_key").limit(most_docs)
    chosen = chosen.unionByName(known.where("toxic = 0").orderBy(mixed_order, "_key").limit(most_docs))
    rows = docs.select(F.col(key).alias("_key"), filled(text).alias("text")).join(F.broadcast(chosen), "_key")  # bounded by most_docs
    # a key that repeats is one document; written once, as training reads it several times
    rows = materialise(rows.groupBy("_key").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for t in batch.column(1):
                elements, _ = shingles(t.as_py())
                marks.append([int(mixed(elements + np.uint64(i)).min().astype(np.int64)) if len(elements) else 0 for i in range(4)])
            columns = [pa.array([m[i] for m in marks], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_key", "m0", "m1", "m2", "m3"])

    schema = T.StructType([rows.schema["_key"], *[T.StructField(f"m{i}", T.LongType()) for i in range(4)]])
    marks = rows.select("_key", "text").mapInArrow(least, schema).toPandas()  # a few numbers per sampled row
    first = marks.sort_values("_key", na_position="first")
    for i in range(4):
        marks = marks[marks["_key"].isin(first.drop_duplicates(f"m{i}")["_key"])]
    if marks.empty:
        return rows.where(F.lit(False))
    own = docs.sparkSession.createDataFrame(marks[["_key"]], T.StructType([rows.schema["_key"]]))
    return rows.join(F.broadcast(own), "_key", "left_semi")


def train(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, key: str = "doc_id", text: str = "text", hardest: int = 3000) -> Model:
    sample = training_docs(docs, labels, most_docs, key, text)

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = unit_lists(batch.column(0).to_pylist())
            toxic = np.array(batch.column(1).to_pylist(), np.int64)
            at = np.concatenate([np.unique(r) for r in rows]) if rows else np.zeros(0, np.int64)
            owner = np.repeat(toxic, [len(np.unique(r)) for r in rows])
            n1 = np.bincount(at[owner == 1], minlength=len(names))
            n0 = np.bincount(at[owner == 0], minlength=len(names))
            good = [i for i, u in enumerate(names) if 3 <= len(u) <= WINDOW]
            columns = [pa.array([names[i] for i in good], pa.string()), pa.array(n1[good], pa.int64()), pa.array(n0[good], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "n1", "n0"])

    parts = sample.select("text", "toxic").mapInArrow(units, "unit string, n1 long, n0 long")
    counted = materialise(parts.groupBy("unit").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    all_toxic, all_clean = sizes.get(1, 0), sizes.get(0, 0)
    nothing = Model(np.zeros(ALPHABET**3), 0.0, 0.0, math.inf if all_toxic else -math.inf)
    if not all_toxic or not all_clean:
        return nothing
    # the units most tied to the label; toxic ones are many times likelier in toxic documents
    share = all_toxic / (all_toxic + all_clean)
    leaning = counted.where((F.col("n1") > 3 * share / (1 - share) * F.col("n0")) & (F.col("n1") >= 2))
    top = leaning.orderBy(F.col("n1").desc(), "n0", "unit").limit(5000).toPandas()
    top["tied"] = likelihood_ratio(top["n1"].to_numpy(float), top["n0"].to_numpy(float), all_toxic, all_clean)
    top = top.sort_values(["tied", "unit"], ascending=[False, True])
    tied = top[top["tied"] >= TIED] if (top["tied"] >= TIED).sum() >= 5 else top.head(10)
    toxic = tied["unit"].tolist()[: LANDMARKS - 64]
    if not toxic:
        return nothing
    known = set(top["unit"])
    clean_rows = counted.where("n0 > 0")
    common = [u for u in clean_rows.orderBy(F.col("n0").desc(), "unit").limit(400).toPandas()["unit"] if u not in known]
    mixed_units = [u for u in clean_rows.orderBy(F.xxhash64("unit"), "unit").limit(6000).toPandas()["unit"] if u not in known]
    clean = [*common, *mixed_units]
    weights, bias = fit_units(toxic, clean, common)

    def hard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(score=folded_scores(batch["unit"].tolist(), weights, bias))

    scored = clean_rows.select("unit").mapInPandas(hard, "unit string, score double")
    worst = [u for u in scored.orderBy(F.col("score").desc(), "unit").limit(hardest).toPandas()["unit"] if u not in known]
    weights, bias = fit_units(toxic, list(dict.fromkeys([*clean, *worst])), common)
    raw = Model(weights, bias, 1.0, 0.0)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "decision": raw.decisions(batch["text"].tolist())})

    seen = sample.select("text", "toxic").mapInPandas(decide, "toxic int, decision double").toPandas()  # bounded by most_docs
    slope, shift = platt(seen["decision"].to_numpy(), seen["toxic"].to_numpy() == 1)
    return Model(weights, bias, slope, shift)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", score: str = "score") -> DataFrame:
    """``doc_id`` and ``score`` (chance of label 1) per row, from whole texts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField(score, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_portions(batches, 1, PORTION):
            give_back()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.chances(batch.column(1).to_pylist()), pa.float64())], schema.names)

    return docs.select(F.col(key).alias("doc_id"), filled(text).alias("_text")).mapInArrow(work, schema)


def keep_clean(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score under ``limit``, with the columns of ``docs``."""
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_portions(batches, at, PORTION):
            give_back()
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.chances(texts) < limit))

    return docs.mapInArrow(work, docs.schema)
