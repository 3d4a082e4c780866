"""Stupid-backoff scores of documents under the n-grams of the whole corpus.

    S(w | v) = c(v w) / c(v)          where the pair occurs ``least`` times or more
             = 0.4 c(w) / N           elsewhere, and for the first word of a text

Documents are gathered into blocks by a seeded hash.  A block counts its one- and
two-word grams and splits them by the leading bits of their 64-bit hash; one task adds
up the counts of a hash range over all blocks and answers each block with the totals;
a block then sums the logarithms per document.  These are a grouped count and a join
on the hash, with the rows of one block and range packed into arrays, because single
rows would take several times the room.  A gram of any frequency is one entry per block,
so frequent words are no hot keys.  Both sides read the same shuffle of the texts.

Defined results
    Words are split at ASCII white space, case kept.  NULL and empty texts have no
    words, a log score of 0 and no mean.  Copies count as often as they occur.  An
    empty table gives no rows.  Other columns are ignored.  Two grams of the same
    64-bit hash count as one.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from statloom.llm.text import filled, words

BACKOFF = 0.4
LEAST = 2
BLOCK_BYTES = 8 << 20
#: The gram that counts all words.
ALL_WORDS = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """Grams of some documents: ``hashes`` ascending, ``counts``, and where each word and pair of the text is among them."""

    def __init__(self, texts: list[str]):
        number: dict[bytes, int] = defaultdict(count().__next__)
        codes = []
        for text in texts:
            found = words(text)
            codes.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        self.lengths = np.array([len(c) for c in codes], np.int64)
        flat = np.concatenate([*codes, np.zeros(0, np.int32)])
        del codes
        one = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        first = np.zeros(len(flat), bool)
        starts = np.cumsum(self.lengths) - self.lengths
        first[starts[self.lengths > 0]] = True
        self.second = np.flatnonzero(~first)  # words with one before them
        both = flat[self.second - 1].astype(np.int64) * max(1, len(number)) + flat[self.second]
        keys, pair_of = np.unique(both, return_inverse=True)
        self.pair_of = pair_of.astype(np.int32)
        del both, pair_of
        left, right = np.divmod(keys, max(1, len(number)))
        two = _mixed(_mixed(one[left]) + (one[right] | np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        hashes = np.concatenate([one, two, [ALL_WORDS]])
        n = np.concatenate([np.bincount(flat, minlength=len(number)), np.bincount(self.pair_of, minlength=len(keys)), [len(flat)]])
        self.hashes, place = np.unique(hashes, return_inverse=True)
        self.counts = np.bincount(place, n, len(self.hashes)).astype(np.int64)
        place = place.astype(np.int32)
        self.word_at = place[: len(number)][flat]
        self.pair_at = place[len(number) : len(number) + len(keys)]

    def scores(self, totals: np.ndarray, least: int = LEAST, backoff: float = BACKOFF) -> np.ndarray:
        """Sum of log S per document."""
        if not len(self.word_at):
            return np.zeros(len(self.lengths))
        c = totals.astype(float)
        chance = np.log(c[self.word_at] / c[-1])
        pair, before = c[self.pair_at][self.pair_of], c[self.word_at[self.second - 1]]
        chance[self.second] = np.where(pair >= least, np.log(pair / before), np.log(backoff) + chance[self.second])
        ends = np.cumsum(self.lengths)
        run = np.append(0.0, np.cumsum(chance))
        return run[ends] - run[ends - self.lengths]


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers by their steps, byte planes apart, which packs well."""
    return np.diff(numbers, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


_COUNTS = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("part", T.LongType()), T.StructField("grams", T.BinaryType()), T.StructField("counts", T.BinaryType())]
)
_TOTALS = T.StructType([T.StructField("block", T.LongType()), T.StructField("part", T.LongType()), T.StructField("totals", T.BinaryType())])


def _texts(rows: pa.Table) -> tuple[pa.Table, list[str]]:
    """The rows of a block in an order that does not depend on their arrival."""
    rows = rows.sort_by([("_tie", "ascending"), ("doc_id", "ascending")])
    return rows, rows.column("text").to_pylist()


def _count(bits: int):
    def work(key: tuple, rows: pa.Table) -> pa.Table:
        block = Block(_texts(rows)[1])
        part = (block.hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(block.hashes), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        out = [(int(part[s]), packed(block.hashes[s:e]), block.counts[s:e].astype("<u4").tobytes()) for s, e in zip(cuts, cuts[1:])]
        columns = [pa.array([key[0].as_py()] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int64())]
        return pa.table([*columns, pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())], names=_COUNTS.names)

    return work


def _add_up(rows: pa.Table) -> pa.Table:
    """Totals of a hash range, for each block in the order of its grams."""
    grams = [unpacked(x.as_py()) for x in rows.column("grams")]
    counts = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in rows.column("counts")])
    _, place = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(place, counts)[place].astype("<i8")
    ends = np.cumsum([len(g) for g in grams])
    parts = [totals[e - len(g) : e].tobytes() for e, g in zip(ends, grams)]
    return pa.table([rows.column("block"), rows.column("part"), pa.array(parts, pa.binary())], names=_TOTALS.names)


def scored(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES, seed: int = 5
) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` (sum of natural logarithms) and ``mean_log`` per row."""
    total = docs.agg(F.sum(F.octet_length(filled(text)) + 64).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    bits = (blocks - 1).bit_length()
    tie = F.xxhash64(F.lit(seed), F.col(key), filled(text))
    placed = docs.select(F.pmod(tie, F.lit(blocks)).alias("block"), F.col(key).alias("doc_id"), filled(text).alias("text"), tie.alias("_tie"))
    counts = placed.groupBy("block").applyInArrow(_count(bits), _COUNTS)
    totals = counts.groupBy("part").applyInArrow(_add_up, _TOTALS)
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType())]
    )

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows, texts = _texts(rows)
        block = Block(texts)
        order = np.argsort(answers.column("part").to_numpy())
        parts = answers.column("totals").to_pylist()
        sums = np.concatenate([np.frombuffer(parts[i], "<i8") for i in order])
        values = [rows.column("doc_id"), pa.array(block.lengths), pa.array(block.scores(sums, least, backoff))]
        return pa.table(values, names=["doc_id", "n_words", "log_score"])

    found = placed.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, schema)
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return found.withColumn("mean_log", mean)
