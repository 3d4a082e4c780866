"""Prefix trie over conversations by truncation peeling.

Every sequence of first turns is a node, named by a chained 128-bit digest.  The trie is
peeled from its deepest level upwards: conversations that end at a level are merged with
the nodes that survive from below, the level's nodes are complete then, their last turn is
stripped and they are grouped again by what is left.  A band of levels (2 to 8, 9 to 64,
65 to 512 and so on) needs one shuffle: it is dealt out by the node above the band, and each
group is peeled level by level inside a task.  Groups of more than ``most_nodes`` nodes, and
the levels 0 and 1, are peeled by one aggregation a level instead, with partial sums before
the shuffle, so neither a common opening nor copies of one conversation fill a task.

Defined results
    Turns are ordered by turn number, NULL first; turns of one conversation with equal
    numbers (repeated rows too) follow in order of their digest.  NULL role or text is an empty one.
    Rows without ``conv_id`` belong to no conversation.  A text of any length moves as
    its digest.  An empty table gives no nodes, not even the root.  Other columns are ignored.
    A conversation's turns pass one task in order but are never held there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from statloom.llm.text import filled, join_groups
from statloom.session import materialise

#: Bands of levels end at 1, 8, 64, 512, ...
BAND_GROWTH = 8
MOST_NODES = 200_000
ROOT = hashlib.md5(b"").digest()
NONE = np.iinfo(np.int64).max

_STEP = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        T.StructField("band", T.BinaryType()),
        T.StructField("depth", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("ends", T.BooleanType()),
    ]
)
_DONE = T.StructType(
    [
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        *[T.StructField(n, T.LongType()) for n in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ended", "first_ended")],
    ]
)
#: What children hand to their parent.
_CARRIED = ("c_convs", "c_first", "c_children", "c_leaves", "c_saved")


def turn_rows(convs: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``digest`` of role and text, ``length`` of the text in code points."""
    role, text = filled("role"), filled("text")
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = convs.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.char_length(text).cast("long").alias("length")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "length")


def shared_openings(rows: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first turns taken from the first conversation of its block of ids.

    How many is the checksum of its id modulo ``most``.  Adds one row with ``pos`` 0 for
    every conversation, so one that is left without turns is still there.
    """
    rows = materialise(rows)
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    first = F.col("conv_id") - F.col("conv_id") % block
    convs = rows.where("pos = 1").select("conv_id", first.alias("base"), taken.alias("taken"))
    openings = rows.where((F.col("conv_id") % block == 0) & (F.col("pos") < most))
    openings = openings.select(F.col("conv_id").alias("base"), "pos", "digest", "length")
    heads = convs.join(openings, "base").where(F.col("pos") <= F.col("taken")).select("conv_id", "pos", "digest", "length")
    own = rows.where(F.col("pos") > taken)
    return heads.unionByName(own).unionByName(starts(rows))


def starts(rows: DataFrame) -> DataFrame:
    """One row with ``pos`` 0 per conversation."""
    nothing = F.lit(b"").alias("digest")
    return rows.where("pos = 1").select("conv_id", F.lit(0).cast("long").alias("pos"), nothing, F.lit(0).cast("long").alias("length"))


def _is_band_end(depth: int) -> bool:
    while depth > 1 and depth % BAND_GROWTH == 0:
        depth //= BAND_GROWTH
    return depth in (0, 1)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node after each turn; rows come by conversation and place."""
    names = _STEP.fieldNames()
    waiting = conv = None
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "digest", "length")]
        for conv_id, digest, length in zip(*columns):
            if conv_id != conv:
                if waiting:
                    out.append((*waiting, True))
                conv, node, depth, band = conv_id, ROOT, 0, ROOT
                waiting = (node, None, band, 0, 0, conv)
                continue
            out.append((*waiting, False))
            if _is_band_end(depth):
                band = node
            parent, depth = node, depth + 1
            node = hashlib.md5(parent + digest).digest()
            waiting = (node, parent, band, depth, length, conv)
        if out:
            yield _record(out, names)
    if waiting:
        yield _record([(*waiting, True)], names)


def _record(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.binary()] * 3 + [pa.int64()] * 3 + [pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _peel(table: pa.Table) -> pa.Table:
    """All levels of one group of a band, the deepest first."""
    names = table.column("node").to_pylist()
    number = {n: i for i, n in enumerate(names)}
    parents = table.column("parent").to_pylist()
    above = np.array([number.get(p, -1) for p in parents], np.int64)
    column = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
    depth, length, ended = column("depth"), column("length"), column("n_ended")
    first_ended = column("first_ended")
    first = np.minimum(first_ended, column("c_first"))
    convs, children, leaves, saved = ended + column("c_convs"), column("c_children"), column("c_leaves"), column("c_saved")
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        leaves[level] += children[level] == 0
        saved[level] += (convs[level] - 1) * length[level]
        inside = level[above[level] >= 0]
        up = above[inside]
        np.minimum.at(first, up, first[inside])
        for total, part in ((convs, convs), (leaves, leaves), (saved, saved)):
            np.add.at(total, up, part[inside])
        np.add.at(children, up, 1)
    counts = [pa.array(x, pa.int64()) for x in (depth, first, convs, children, leaves, saved, ended, first_ended)]
    return pa.Table.from_arrays([table.column("node"), table.column("parent"), *counts], names=_DONE.fieldNames())


def _finished(rows: DataFrame) -> DataFrame:
    """Nodes of one level whose children have been merged into them."""
    convs = F.col("n_ended") + F.col("c_convs")
    return rows.select(
        "node",
        "parent",
        "depth",
        F.least("first_ended", "c_first").alias("conv_id"),
        convs.alias("n_convs"),
        F.col("c_children").alias("n_children"),
        (F.col("c_leaves") + (F.col("c_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("c_saved") + (convs - 1) * F.col("length")).alias("saved_tokens"),
        "n_ended",
        "first_ended",
    )


def _stripped(done: DataFrame, depth: int) -> DataFrame:
    """Nodes of a level without their last turn, merged by what is left."""
    return (
        done.where(F.col("depth") == depth)
        .groupBy(F.col("parent").alias("node"))
        .agg(
            F.sum("n_convs").alias("c_convs"),
            F.min("conv_id").alias("c_first"),
            F.count(F.lit(1)).alias("c_children"),
            F.sum("n_leaves").alias("c_leaves"),
            F.sum("saved_tokens").alias("c_saved"),
        )
    )


def _joined(rows: DataFrame, carried: DataFrame | None) -> DataFrame:
    """Nodes with what their children handed up; both sides have one row per node."""
    empty: dict[str, Column] = {c: F.lit(NONE if c == "c_first" else 0).cast("long") for c in _CARRIED}
    if carried is None:
        return rows.withColumns(empty)
    return rows.join(carried, "node", "left").withColumns({c: F.coalesce(c, v) for c, v in empty.items()})


def _levels(rows: DataFrame, carried: DataFrame | None, low: int, high: int) -> list[DataFrame]:
    """One aggregation for each level from ``high`` down to ``low + 1``."""
    parts = []
    for depth in range(high, low, -1):
        done = materialise(_finished(_joined(rows.where(F.col("depth") == depth), carried)))
        carried = _stripped(done, depth)
        parts.append(done)
    return parts


def _band(rows: DataFrame, carried: DataFrame | None, low: int, high: int, most_nodes: int) -> DataFrame:
    if high - low == 1:
        return _levels(rows, carried, low, high)[0]
    joined = materialise(_joined(rows, carried))
    sizes = materialise(joined.groupBy("band").count().where(F.col("count") > most_nodes).select("band"))
    if sizes.isEmpty():
        return materialise(joined.groupBy("band").applyInArrow(_peel, _DONE))
    cold = joined.join(sizes, "band", "left_anti").groupBy("band").applyInArrow(_peel, _DONE)
    hot = joined.join(sizes, "band", "left_semi")
    done = materialise(cold)
    for part in _levels(materialise(hot.drop(*_CARRIED)), carried, low, high):
        done = done.unionByName(part)
    return done


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to 4096 ids of one node as text; rows come in order."""
    node, ids = None, []

    def record() -> pa.RecordBatch:
        text = ",".join(map(str, ids))
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([text])], ["node", "first", "ids"])

    for batch in batches:
        for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (n != node or len(ids) == 4096):
                yield record()
                ids = []
            node = n
            ids.append(c)
    if ids:
        yield record()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest over the runs of each node, which come in order; one digest is open at a time."""
    node = digest = None
    for batch in batches:
        out = []
        for n, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if digest and n == node:
                digest.update(b",")
            else:
                if digest:
                    out.append((node, digest.hexdigest()))
                node, digest = n, hashlib.sha256()
            digest.update(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out])], ["node", "digest"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], ["node", "digest"])


def ended_digests(steps: DataFrame) -> DataFrame:
    """Digest of the ids that end at a node, for nodes where at least two do.

    Ids are ordered by ranges of (node, id), so the ids of one node may lie in many
    tasks; only the digest itself runs over a node's text from its start to its end.
    """
    ends = steps.where("ends").select("node", "conv_id")
    runs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    runs = runs.mapInArrow(_listed, "node binary, first long, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, digest string")


def prefix_trie(rows: DataFrame, most_nodes: int = MOST_NODES) -> DataFrame:
    """One row per node of the trie over ``conv_id``, ``pos``, ``digest``, ``length``; ``pos`` 0 opens each conversation.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` and ``node``.
    """
    in_order = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    steps = materialise(in_order.mapInArrow(_chained, _STEP))
    # all but the ends follows from the node, so equal prefixes collapse before the shuffle
    ended = F.col("ends").cast("long")
    nodes = materialise(
        steps.groupBy("node", "parent", "band", "depth", "length").agg(
            F.sum(ended).alias("n_ended"), F.min(F.when(F.col("ends"), F.col("conv_id")).otherwise(F.lit(NONE))).alias("first_ended")
        )
    )
    deepest = nodes.agg(F.max("depth")).first()[0]
    bounds = [-1, 0, 1]
    while bounds[-1] < (deepest or 0):
        bounds.append(bounds[-1] * BAND_GROWTH)
    carried, done = None, None
    for low, high in reversed([*zip(bounds, bounds[1:])]):
        rows_here = nodes.where((F.col("depth") > low) & (F.col("depth") <= high))
        part = _band(rows_here, carried, low, high, most_nodes)
        carried = _stripped(part, low + 1)
        done = part if done is None else done.unionByName(part)
    none, one = F.sha2(F.lit(""), 256), F.sha2(F.col("first_ended").cast("string"), 256)
    ends = F.when(F.col("n_ended") == 0, none).when(F.col("n_ended") == 1, one).otherwise(F.col("digest"))
    full = materialise(done.join(ended_digests(steps), "node", "left").withColumn("ends_sha256", ends).drop("digest"))
    above = full.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("fan"))
    roots = full.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    below = join_groups(full.where("parent is not null"), above, ["parent"], "fan")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node"]
    return roots.select(*columns).unionByName(below.select(*columns))
