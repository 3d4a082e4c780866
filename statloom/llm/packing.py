"""Packing of token sequences: large-item matching, then best fit.

Pieces above a third of the capacity share a sequence with at most one other such
piece: going down in length, each is matched with the longest one that still fits.
Smaller pieces then go, longest first, to the tightest gap that takes them.

Only lengths matter for that, so the plan is made from the number of pieces of each
length: a table of at most ``capacity`` rows, whatever the size of the input.  Equal
bins are handled as one group with a count.  A visit to a group at least halves its
gap, so the plan has at most 12 x (groups) entries, some 100,000 at 4096.  Each piece
then finds its place by its length and its rank among the pieces of that length.

Defined results
    NULL and empty texts are documents of one token, the end mark.  Repeated rows are
    packed like others.  An empty table gives no rows.  Other columns stay with the
    piece; those that clash with a result column are replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from statloom.llm.bpe import BYTES_AT_ONCE, FinishedWords, Vocabulary, encode_batch
from statloom.llm.text import filled, give_back, in_portions
from statloom.session import materialise

ROWS_PER_TASK = 1_000_000


def tokenise(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit): documents
    with their end mark, the longer ones cut every ``capacity`` ids."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[key].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        finished = FinishedWords(vocabulary)
        for small in in_portions(batches, 1, BYTES_AT_ONCE):
            give_back()
            row, piece, start, length, ids = [], [], [], [], []
            for i, found in enumerate(encode_batch(vocabulary, small.column(1).to_pylist(), finished)):
                raw = np.append(found, end_id).astype("<u4").tobytes()
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(cut) // 4)
                    ids.append(cut)
            columns = [small.column(0).take(pa.array(row, pa.int64()))]
            columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(key).alias("doc_id"), filled(text).alias("text")).mapInArrow(work, schema)


class Plan:
    """Entries: of ``length``, ranks from ``rank`` on go to sequences from ``sequence`` on, ``each`` per sequence, from ``offset`` on."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.entries: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.ranks: dict[int, int] = {}
        self.groups: dict[int, list[tuple[int, int]]] = {}
        self.gaps: list[int] = []

    def _enter(self, length: int, items: int, sequence: int, each: int, offset: int) -> None:
        rank = self.ranks.get(length, 0)
        self.entries.append((length, rank, sequence, each, offset))
        self.ranks[length] = rank + items

    def _free(self, gap: int, sequence: int, n: int) -> None:
        if gap > 0 and n > 0:
            if gap not in self.groups:
                self.groups[gap] = []
                bisect.insort(self.gaps, gap)
            self.groups[gap].append((sequence, n))

    def match_large(self, counts: dict[int, int]) -> None:
        """Sequences of one or two pieces above a third of the capacity."""
        left = dict(counts)
        lengths = sorted(left)
        while lengths:
            longest = lengths[-1]
            n = left[longest]
            at = bisect.bisect_right(lengths, min(longest, self.capacity - longest)) - 1
            if at >= 0 and lengths[at] == longest and n < 2:
                at -= 1
            partner = lengths[at] if at >= 0 else 0
            bins = n if not partner else n // 2 if partner == longest else min(n, left[partner])
            self._enter(longest, bins, self.sequences, 1, 0)
            if partner:
                self._enter(partner, bins, self.sequences, 1, longest)
            self._free(self.capacity - longest - partner, self.sequences, bins)
            self.sequences += bins
            left[longest] -= bins
            if partner:
                left[partner] -= bins
            for used in {longest, partner}:
                if used and not left[used]:
                    lengths.remove(used)

    def fit_small(self, length: int, n: int) -> None:
        """Tightest gap first; equal pieces fill a gap before the next one is touched."""
        while n:
            at = bisect.bisect_left(self.gaps, length)
            if at == len(self.gaps):
                each = self.capacity // length
                bins = -(-n // each)
                self._free(self.capacity, self.sequences, bins)
                self.sequences += bins
                continue
            gap = self.gaps[at]
            sequence, bins = self.groups[gap].pop()
            if not self.groups[gap]:
                del self.groups[gap]
                self.gaps.pop(at)
            each, offset = gap // length, self.capacity - gap
            full = min(bins, n // each)
            rest = min(n - full * each, each - 1) if full < bins else 0
            if full:
                self._enter(length, full * each, sequence, each, offset)
                self._free(gap - each * length, sequence, full)
            if rest:
                self._enter(length, rest, sequence + full, rest, offset)
                self._free(gap - rest * length, sequence + full, 1)
            self._free(gap, sequence + full + bool(rest), bins - full - bool(rest))
            n -= full * each + rest


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Places for ``counts[length]`` pieces of each length from 1 to ``capacity``."""
    made = Plan(capacity)
    made.match_large({length: n for length, n in counts.items() if 3 * length > capacity})
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        made.fit_small(length, counts[length])
    return made


def _place(entries: np.ndarray):
    """Sequence and offset of the pieces with these lengths and ranks."""
    order = np.lexsort((entries[:, 1], entries[:, 0]))
    length, rank, sequence, each, offset = entries[order].T
    keys = length << 44 | rank

    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        own, r = lengths.to_numpy(), ranks.to_numpy()
        at = np.searchsorted(keys, own << 44 | r, "right") - 1
        past = r - rank[at]
        return pd.DataFrame({"sequence_id": sequence[at] + past // each[at], "offset": offset[at] + past % each[at] * own})

    return place


def ranked(pieces: DataFrame, counts: dict[int, int], order: list[str]) -> DataFrame:
    """``_rank`` from 0 within each length.  Lengths with many pieces are ranked in salted parts."""
    hot = {length: -(-n // ROWS_PER_TASK) for length, n in counts.items()}
    parts = pieces.sparkSession.createDataFrame([(k, v) for k, v in hot.items()], "length long, _parts long")
    salted = pieces.join(F.broadcast(parts), "length")  # at most ``capacity`` rows
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(*order), F.col("_parts"))).drop("_parts")
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    number = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order))
    numbered = salted.withColumn("_number", number)
    return numbered.join(starts, ["length", "_salt"]).withColumn("_rank", F.col("_start") + F.col("_number") - 1).drop("_start", "_number", "_salt")


def pack(pieces: DataFrame, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    pieces = pieces.drop(*[c for c in ("sequence_id", "offset") if c in pieces.columns])
    pieces = materialise(pieces)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    place = F.pandas_udf(_place(np.array(plan(counts, capacity).entries, np.int64)), "sequence_id long, offset long")
    placed = ranked(pieces, counts, [c for c in order]).withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and the joined ``ids`` of each sequence (at most the capacity)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    joined = F.aggregate("parts", F.expr("cast('' as binary)"), lambda acc, p: F.concat(acc, p["ids"]))
    return rows.select("sequence_id", "length", joined.alias("ids"))
