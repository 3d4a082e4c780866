"""Near duplicates by DartMinHash signatures and a banded join.

Signatures.  Every element (a five-word shingle) owns a region: its weight times all
ranks from 0 up.  Darts fall into it at hashed places, one per unit of area on average
and always the same for the same element.  A set throws the darts of rank up to
(k ln k + 2k) / total weight, so about k ln k + 2k of them whatever its size, each dart
belongs to one of k coordinates, and the earliest dart of a coordinate is its value.
Two sets share a coordinate with the probability of their weighted Jaccard similarity.

Joining.  Equal shingle sets collapse to one representative first, so copies cost
nothing later.  Representatives meet in buckets by bands of coordinates.  In each bucket
everyone is compared with one member, then with the best linked one; links make classes.
Members that still meet another class in some bucket are then joined over their rarest
cells: sets that share so much that they reach the similarity share one of the rarest
(1 - similarity) of each, and one that many own cells precede asks only for partners so
small that there are few or none.  So a large group of true copies takes a few comparisons
per member, and a large bucket that only shares a passage falls apart.  Every comparison is
exact, on whole shingle sets.

At similarity 0.8 a pair misses all 32 bands of 6 with a chance of 6e-5, whatever the size
of its buckets; no pair that shares one is lost.

Defined results
    Words are split at ASCII white space, in lower case.  Shorter texts are one shingle
    of all their words.  Texts without words (NULL, empty) are copies of each other.
    Rows that repeat a key with one text are one document.  Rows without a key are
    compared only as copies.  Very long texts are one set like others.  An empty table
    gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from statloom.llm.text import filled, free_name, in_portions, join_groups
from statloom.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 6
#: Members of a class that those of other classes meet in one task.
BLOCK_ROWS = 1000
BYTES_AT_ONCE = 2 << 20

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes, ascending, and how often each occurs."""
    found = text.lower().encode("utf-8", "surrogatepass").split()
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = min(size, len(one))
    rows = len(one) - n + 1
    key = np.full(rows, n, np.uint64)
    for i in range(n):
        key = mixed(key * _G + one[i : i + rows])
    return np.unique(key, return_counts=True)


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((x >> np.uint64(11)).astype(float) + 1) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Earliest rank and value of each coordinate, (sets, k); rank infinite where no dart fell.

    ``reach`` is the largest rank thrown per set.  A region is cut into cells of weight
    one; in the last, partial cell a dart counts if it falls under the weight.
    """
    whole = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), whole)
    level = np.arange(len(at)) - np.repeat(np.cumsum(whole) - whole, whole)
    cell = mixed(elements[at] + mixed(level.astype(np.uint64) * _G))
    room = np.minimum(weights[at] - level, 1.0)
    own = owner[at]
    rank = np.zeros(len(at))
    found_rank, found_slot, found_value = [], [], []
    step = np.zeros(1, np.uint64)
    while len(cell):
        # the next dart of each cell: ranks grow by exponential steps
        step += _G
        value = mixed(cell + step)
        rank = rank - np.log(_uniform(value))
        near = rank <= reach[own]
        cell, rank, own, room, value = cell[near], rank[near], own[near], room[near], value[near]
        place = mixed(value ^ _M1)
        hit = _uniform(mixed(value ^ _M2)) <= room
        found_rank.append(rank[hit])
        found_slot.append(own[hit] * k + (place[hit] % np.uint64(k)).astype(np.int64))
        found_value.append(value[hit])
    ranks, slots, values = (np.concatenate(x) if x else np.zeros(0) for x in (found_rank, found_slot, found_value))
    order = np.lexsort((ranks, slots))
    slots, ranks, values = slots[order].astype(np.int64), ranks[order], values[order]
    first = np.append(True, slots[1:] != slots[:-1])[: len(slots)]
    best, chosen = np.full(sets * k, np.inf), np.zeros(sets * k, np.uint64)
    best[slots[first]], chosen[slots[first]] = ranks[first], values[first]
    return best.reshape(sets, k), chosen.reshape(sets, k)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """(sets, k) values; sets that leave a coordinate empty throw on with twice the reach."""
    out = np.zeros((len(sets), k), np.uint64)
    todo = [i for i, (e, _) in enumerate(sets) if len(e)]
    reach = {i: (k * np.log(k) + 2 * k) / sets[i][1].sum() for i in todo}
    while todo:
        elements = np.concatenate([sets[i][0] for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo]).astype(float)
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        ranks, values = darts(elements, weights, owner, len(todo), k, np.array([reach[i] for i in todo]))
        done = np.isfinite(ranks).all(axis=1)
        out[[i for i, d in zip(todo, done) if d]] = values[done]
        todo = [i for i, d in zip(todo, done) if not d]
        reach |= {i: 2 * reach[i] for i in todo}
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands): one 64-bit key per band."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mixed(key * _G + parts[:, :, r])
    return key


def _weighted(found: tuple[np.ndarray, np.ndarray], weights: str) -> tuple[np.ndarray, np.ndarray]:
    elements, counts = found
    return elements, counts if weights == "counts" else np.ones(len(elements), np.int64)


def _cells(found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One number per unit of whole weight: weighted Jaccard is plain Jaccard of these."""
    elements, counts = found
    at = np.repeat(np.arange(len(elements)), counts)
    level = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return mixed(elements[at] + level.astype(np.uint64) * _G)


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: str = "presence", bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``set_a``/``set_b`` (128-bit digest of the weighted set), ``weight`` and ``bands`` (keys)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[key].dataType),
            T.StructField("set_a", T.LongType()),
            T.StructField("set_b", T.LongType()),
            T.StructField("weight", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for small in in_portions(batches, 1, BYTES_AT_ONCE):
            sets = [_weighted(shingles(t.as_py(), size), weights) for t in small.column(1)]
            keys = band_keys(signatures(sets, bands * rows), bands, rows).astype(np.int64)
            some = np.array([len(e) > 0 for e, _ in sets])
            raw = [e.tobytes() + c.tobytes() for e, c in sets]
            digests = [np.array([xxhash.xxh64_intdigest(r, seed) for r in raw], np.uint64).astype(np.int64) for seed in (0, 1)]
            bounds = np.append(0, np.cumsum(some * bands)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[some].ravel(), pa.int64()))
            weight = np.array([c.sum() for _, c in sets], np.int64)
            yield pa.RecordBatch.from_arrays([small.column(0), *map(pa.array, digests), pa.array(weight), lists], schema.names)

    return docs.select(F.col(key).alias("doc_id"), filled(text).alias("_text")).mapInArrow(work, schema)


def cell_sets(docs: DataFrame, key: str, text: str, weights: str, size: int) -> DataFrame:
    """``rep`` and ``cells``: the weighted set as numbers."""
    schema = T.StructType([T.StructField("rep", docs.schema[key].dataType), T.StructField("cells", T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for small in in_portions(batches, 1, BYTES_AT_ONCE):
            sets = [_cells(_weighted(shingles(t.as_py(), size), weights)).astype(np.int64) for t in small.column(1)]
            bounds = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([small.column(0), lists], ["rep", "cells"])

    return docs.select(F.col(key).alias("rep"), filled(text).alias("_text")).mapInArrow(work, schema)


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``) whose sets reach the similarity, with it."""
    left = sets.select(F.col("rep").alias("a"), F.col("cells").alias("cells_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("cells").alias("cells_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("cells_a", "cells_b"))
    value = shared / (F.size("cells_a") + F.size("cells_b") - shared)
    return both.select("a", "b", value.alias("similarity")).where(F.col("similarity") >= similarity)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``label`` (smallest node it is connected with) for the nodes of links (``a``, ``b``).

    Alternating large and small stars: every round ties each node to the smallest one
    known around it, first from above, then from below, until nothing changes.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(lowest.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after = materialise(small)
        same = _digest(after) == _digest(edges)
        edges = after
        if same:
            break
    else:
        raise RuntimeError("links did not settle into classes")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only classes that a link joins are worked on."""
    of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
    named = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    named = named.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    crossing = materialise(named.where("a <> b").distinct())
    if crossing.isEmpty():
        return labels
    top = components(crossing)
    above = top.select(F.col("node").alias("label"), F.col("label").alias("_top"))
    below = labels.join(above, "label", "left").select("node", F.coalesce("_top", "label").alias("label"))
    return materialise(below.unionByName(top))


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _mixed_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (``bucket``, ``rep``, ``weight``, ``label``) of buckets with two classes or more; ``outside`` counts
    the members that are not in the bucket's largest class, ``main``."""
    named = labels.select(F.col("node").alias("rep"), F.col("label").alias("_label"))
    members = buckets.select("bucket", "rep", "weight").join(named, "rep", "left")
    members = members.select("bucket", "rep", "weight", F.coalesce("_label", "rep").alias("label"))
    by_label = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_label.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("labels"),
        F.sum("n").alias("size"),
        F.max(F.struct("n", "label")).alias("most"),
    )
    mixed = sizes.where("labels > 1").select("bucket", "size", (F.col("size") - F.col("most.n")).alias("outside"), F.col("most.label").alias("main"))
    return members.join(mixed, "bucket")


def _fits(a: Column, b: Column, similarity: float) -> Column:
    """Sets of too different a weight cannot be similar."""
    return F.least(a, b) >= F.lit(similarity) * F.greatest(a, b)


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))


def _centre_pairs(members: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Everyone in another class than the bucket's best linked member, paired with that member."""
    known = members.join(_degrees(links), "rep", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    # copies collapse in the shuffle to one row a bucket
    centre = known.groupBy("bucket").agg(F.max(F.struct("degree", "rep", "weight", "label")).alias("c"))
    pairs = members.join(centre, "bucket").where("label <> c.label").where(_fits(F.col("weight"), F.col("c.weight"), similarity))
    return pairs.select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct()


def _size_class(n: Column) -> Column:
    """Grows with the size, one class per five percent."""
    return F.floor(F.log(n) / F.lit(math.log(1.05))).cast("int")


def _rare_cells(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The cells of each member (``rep``, ``label``) that a similar set of another class must meet it in first.

    Cells have one order: those of a single class, then the rarest, ties by number.  Similar sets share
    all but few cells, so their first shared one is among the first of either.  ``least`` and ``most``
    are the sizes a partner can have if it is met here first: all they share still follows.
    """
    sized = members.join(sets, "rep").select("rep", "label", F.size("cells").alias("n"), F.explode("cells").alias("cell"))
    cells = materialise(sized)
    common = cells.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("f"))
    crossing = join_groups(cells, materialise(common.where("lo <> hi").select("cell", "f")), ["cell"], "f")
    ordered = crossing.groupBy("rep", "label", "n").agg(F.sort_array(F.collect_list(F.struct("f", "cell"))).alias("cells"))
    need = F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-6))
    first = ordered.withColumn("own", F.col("n") - F.size("cells")).withColumn("length", (F.col("n") - need + 1 - F.col("own")).cast("int"))
    placed = first.where("length > 0").select("rep", "label", "n", "own", need.alias("least"), F.posexplode(F.slice("cells", F.lit(1), F.col("length"))))
    left = F.col("n") - F.col("own") - F.col("pos")
    most = F.floor(left * F.lit((1 + similarity) / similarity) - F.col("n") + F.lit(1e-6))
    return placed.select("rep", "label", "n", F.col("col.cell").alias("cell"), F.greatest("least", F.lit(1)).alias("least"), most.alias("most")).where("most >= least")


def _with_partner(rows: DataFrame) -> DataFrame:
    """Rows whose cell holds another class in one of the sizes they ask for."""
    columns = rows.columns
    there = rows.groupBy("cell", _size_class(F.col("n")).alias("z")).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    sizes = F.sequence(_size_class(F.col("least")), _size_class(F.col("most")))
    asked = materialise(rows.withColumn("z", F.explode(sizes)))
    found = asked.groupBy("cell", "z").agg(F.count(F.lit(1)).alias("askers")).join(there, ["cell", "z"])
    met = join_groups(asked, materialise(found), ["cell", "z"], "askers").where("lo <> label OR hi <> label")
    return materialise(met.select(*columns).distinct())


def _candidates(members: DataFrame, sets: DataFrame, similarity: float, block_rows: int) -> DataFrame:
    """Pairs (``a``, ``b``) of different classes, none that can be similar left out.

    Members leave a cell where no one of another class has a fitting size, twice, as the first to leave were
    partners of others.  In what is left those outside a cell's main class visit its blocks.
    """
    rows = _with_partner(_with_partner(_rare_cells(members, sets, similarity)))
    sizes = rows.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("cell").agg(F.sum("k").alias("size"), F.max_by("label", "k").alias("main"))
    known = materialise(join_groups(rows, materialise(sizes), ["cell"], "size").withColumn("blocks", F.ceil(F.col("size") / F.lit(block_rows)).cast("int")))
    all_in = known.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).alias("b")
    outside = known.where("label <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("a")
    fits = F.expr("a.label <> b.label AND a.n <= b.most AND b.n <= a.most AND (b.label = b.main OR a.rep < b.rep)")
    met = outside.join(all_in, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.block") == F.col("b.block")) & fits)
    return met.select(F.least("a.rep", "b.rep").alias("a"), F.greatest("a.rep", "b.rep").alias("b")).distinct()


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    weights: str = "presence",
    bands: int = BANDS,
    rows: int = ROWS,
    size: int = SHINGLE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest key of the class) and ``copy_of`` (smallest key with the same set) per row.

    ``weights``: "presence" gives every shingle weight one, so the similarity is that of
    the shingle sets; "counts" weighs by occurrences.
    """
    signs = materialise(signed(docs, key, text, weights, bands, rows, size))
    reps = signs.groupBy("set_a", "set_b", "weight").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    same_set = ["set_a", "set_b", "weight"]
    copies = materialise(join_groups(signs.select("doc_id", *same_set), materialise(reps), same_set, "n").select("doc_id", "rep", "weight"))
    # one row of each representative; rows may repeat a key
    own = copies.where("doc_id = rep").select("rep", "weight").distinct()
    keyed = signs.select(F.col("doc_id").alias("rep"), "weight", "bands").dropDuplicates(["rep", "weight"])
    keyed = keyed.join(own, ["rep", "weight"], "left_semi")
    exploded = keyed.select("rep", "weight", F.posexplode("bands").alias("band", "bucket"))
    shared = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("lead")).where("n > 1")
    buckets = materialise(exploded.join(shared.select("bucket", "lead"), "bucket"))

    met = buckets.select("rep").distinct()
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(met, "rep", "left_semi")
    sets = materialise(cell_sets(texts, "rep", "text", weights, size).dropDuplicates(["rep"]))

    stars = buckets.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    links = materialise(similar(stars, sets, similarity))
    labels = components(links)
    members = materialise(_mixed_members(buckets, labels))
    labels = merged(labels, materialise(similar(_centre_pairs(members, links, similarity), sets, similarity)))

    # whoever still meets another class in a bucket is compared with all it can be similar to
    members = _mixed_members(buckets, labels).select("rep", "label").distinct()
    pairs = _candidates(members, sets, similarity, block_rows)
    labels = merged(labels, materialise(similar(pairs, sets, similarity)))

    named = copies.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
    return named.select("doc_id", F.coalesce("label", "rep").alias("class_id"), F.col("rep").alias("copy_of"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose document is the first of its class, with the columns of ``docs``."""
    name = free_name(docs, "kept")
    kept = near_groups(docs, key, text).where("doc_id <=> class_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept[name]), "left_semi")
