"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces and words.  The longest grams are edges between overlapping nodes
(the gram without its last word and without its first), weighted by their count; a gram that
a piece cuts short is an edge to an empty word.  The count of a shorter gram is the flow out of
its node, the edges to the empty word included: these are the corrections for piece ends.
So one pass over the texts counts every length.  Nodes with one way in and one way out
are compacted, which gives the unary paths: passages that occur only as a whole.

Counting works on blocks: a task aggregates the edges of some megabytes of text, deals them
out by a hash of the whole gram and packs what goes to one bucket into one row.  A bucket's task
adds the packs up and hands node sums on, dealt out by node.  A gram is one entry
in a pack however often it occurs, and no node's edges are brought together, so a frequent word or pair fills
no task.  With many buckets the dealing takes several rounds of at most ``FAN`` ways.

Defined results
    NULL texts are empty and have no words; a NULL language is ``und``.  Texts, pieces and
    words of any length are read in blocks that go on where the last one stopped.
    Keys are not read: repeated rows count as often as they occur.  An empty table gives no rows.
    Other columns are ignored.  Equal scores follow in the order of a, then of the phrase.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from statloom.llm.text import filled, give_back, in_portions
from statloom.session import materialise

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
FAN = 256

_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t",
    b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ",
)

#: Packs on their way to a bucket, and the counted grams.
_ROW = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("pack", T.BinaryType()),
        T.StructField("gram", T.ArrayType(T.StringType())),
        T.StructField("n", T.LongType()),
        T.StructField("most", T.LongType()),
    ]
)


def tokens(data: bytes, most: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    r"""Words of lower-cased text in blocks; ``\n`` stands between pieces."""
    data = data.translate(_PLAIN)
    start = 0
    while start < len(data):
        end = min(start + most, len(data))
        if end < len(data):
            cut = max(data.rfind(b" ", start, end), data.rfind(b"\n", start, end))
            if cut < start:  # one long word
                ways = [p for p in (data.find(b" ", end), data.find(b"\n", end)) if p >= 0]
                cut = min(ways, default=len(data) - 1)
            end = cut + 1
        yield [t for t in data[start:end].replace(b"\n", b" \n ").split(b" ") if t]
        start = end


class Grams:
    """Distinct grams with counts: a column of word numbers per place, ``n``, and the largest edge ``most``.

    Word 0 is the empty one.
    """

    def __init__(self, words: list[bytes], columns: list[np.ndarray], n: np.ndarray, most: np.ndarray):
        self.words, self.columns, self.n, self.most = words, columns, n, most

    def added_up(self) -> Grams:
        """Equal grams become one."""
        if not len(self.n):
            return self
        key = self.columns[0].astype(np.int64)
        for column in self.columns[1:]:
            names, key = np.unique(key, return_inverse=True)
            key = key.astype(np.int64) << 32 | column
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        at = order[first]
        return Grams(self.words, [c[at] for c in self.columns], np.add.reduceat(self.n[order], first), np.maximum.reduceat(self.most[order], first))

    def shorter(self) -> Grams:
        """Node sums: flow out of each gram without its last word; ``most`` is its largest edge to a word."""
        inner = np.flatnonzero(self.columns[-2] != 0)
        if len(inner) < len(self.n):
            # a gram cut short by two words or more ends at its own piece end
            outer = np.flatnonzero(self.columns[-2] == 0)
            order = np.concatenate([inner, outer])
        else:
            order = inner
        to_word = np.where(self.columns[-1] != 0, self.n, 0)
        return Grams(self.words, [c[order] for c in self.columns[:-1]], self.n[order], to_word[order]).added_up()

    def hashes(self, lang: str) -> np.ndarray:
        """The same for a gram in every task."""
        each = np.fromiter(map(zlib.crc32, self.words), np.uint64, len(self.words))
        h = np.full(len(self.n), zlib.crc32(lang.encode()), np.uint64)
        for column in self.columns:
            h = (h ^ each[column]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def dealt(self, lang: str, ways: int) -> Iterator[tuple[int, bytes]]:
        """A pack per bucket."""
        buckets = (self.hashes(lang) % np.uint64(ways)).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        found = buckets[order]
        cuts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else []
        for start, end in zip(cuts, [*cuts[1:], len(found)]):
            at = order[start:end]
            yield int(found[start]), Grams(self.words, [c[at] for c in self.columns], self.n[at], self.most[at]).packed()

    def packed(self) -> bytes:
        stacked = np.concatenate(self.columns)
        used, numbers = np.unique(stacked, return_inverse=True)
        body = b"\n".join([self.words[i] for i in used.tolist()])
        wide = np.uint32 if max(self.n.max(), self.most.max()) < 1 << 32 else np.uint64
        head = np.array([len(body), len(self.n), len(self.columns), np.dtype(wide).itemsize], np.int64)
        raw = b"".join([head.tobytes(), body, numbers.astype(np.uint32).tobytes(), self.n.astype(wide).tobytes(), self.most.astype(wide).tobytes()])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

    @staticmethod
    def unpacked(packs: Sequence[bytes]) -> Grams:
        """Several packs as one, words numbered anew."""
        number: dict[bytes, int] = {b"": 0}
        columns, ns, mosts = [], [], []
        for pack in packs:
            raw = pa.decompress(pack[8:], int.from_bytes(pack[:8], "little"), "zstd", asbytes=True)
            text, rows, width, size = np.frombuffer(raw, np.int64, 4).tolist()
            words = raw[32 : 32 + text].split(b"\n")
            own = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
            at = 32 + text
            found = np.frombuffer(raw, np.uint32, rows * width, at)
            columns.append(own[found].reshape(width, rows))
            at += 4 * rows * width
            wide = np.uint32 if size == 4 else np.uint64
            ns.append(np.frombuffer(raw, wide, rows, at).astype(np.int64))
            mosts.append(np.frombuffer(raw, wide, rows, at + size * rows).astype(np.int64))
        return Grams(list(number), list(np.concatenate(columns, axis=1)), np.concatenate(ns), np.concatenate(mosts))


def longest_grams(data: bytes, longest: int) -> Iterator[Grams]:
    """Edges of one text block after the other; each word starts one gram."""
    before: list[bytes] = []
    blocks = tokens(data)
    block = next(blocks, None)
    while block is not None:
        after = next(blocks, None)
        found = before + block + ([b"\n"] * longest if after is None else [])
        known: dict[bytes, int] = {b"\n": 0}
        ids = np.array([known.setdefault(t, len(known)) for t in found], np.int64)
        size = max(0, len(ids) - longest + 1)
        columns = [ids[:size]]
        for k in range(1, longest):
            columns.append(np.where(columns[-1] == 0, 0, ids[k : k + size]))
        starts = columns[0] != 0
        columns = [c[starts] for c in columns]
        ones = np.ones(len(columns[0]), np.int64)
        yield Grams([b"", *list(known)[1:]], columns, ones, np.zeros_like(ones)).added_up()
        before, block = found[size:], after


def _edges(longest: int, ways: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in in_portions(batches, "text", BLOCK_BYTES):
            give_back()
            langs = portion.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = portion.filter(pc.equal(langs, lang)).column("text").cast(pa.binary()).to_pylist()
                for grams in longest_grams(b"\n".join(texts), longest):
                    packs = list(grams.dealt(lang, ways)) if len(grams.n) else []
                    if packs:
                        yield _pack_rows(lang, packs)

    return run


def _pack_rows(lang: str, packs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    buckets, bodies = zip(*packs)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(packs)), pa.array(buckets, pa.int64()), pa.array(bodies, pa.binary())], ["lang", "bucket", "pack"]
    )


def _merge(last: bool, ways: int, least: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Adds the packs of a group up; deals them out again, or, at the last round, gives counted grams and node sums."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        grams = Grams.unpacked(table.column("pack").to_pylist()).added_up()
        if not last:
            return _result(lang, grams.dealt(lang, ways))
        full = grams.columns[-1] != 0
        kept = np.flatnonzero(full & (grams.n >= least))
        names = [[grams.words[i].decode("utf-8", "replace") for i in c[kept].tolist()] for c in grams.columns]
        counted = [list(g) for g in zip(*names)], grams.n[kept].tolist(), grams.most[kept].tolist()
        if len(grams.columns) > 1:
            return _result(lang, grams.shorter().dealt(lang, ways), *counted)
        # the number of all words, beside the counted ones
        return _result(lang, [], [*counted[0], None], [*counted[1], int(grams.n.sum())], [*counted[2], 0])

    return run


def _result(lang: str, packs, grams: Sequence = (), n: Sequence = (), most: Sequence = ()) -> pa.Table:  # noqa: ANN001
    packs = list(packs)
    p, g = len(packs), len(grams)
    return pa.Table.from_arrays(
        [
            pa.array([lang] * (p + g), pa.string()),
            pa.array([b for b, _ in packs] + [None] * g, pa.int64()),
            pa.array([x for _, x in packs] + [None] * g, pa.binary()),
            pa.array([None] * p + list(grams), pa.list_(pa.string())),
            pa.array([None] * p + list(n), pa.int64()),
            pa.array([None] * p + list(most), pa.int64()),
        ],
        names=_ROW.fieldNames(),
    )


def gram_counts(
    docs: DataFrame, longest: int = 3, least: int = 10, lang: str = "lang", text: str = "text", bucket_bytes: int = BUCKET_BYTES, fan: int = FAN
) -> list[DataFrame]:
    """Counted grams of each length, from one word on: ``lang``, ``gram``, ``n`` of at least ``least``, ``most``.

    ``most`` is the count of the most frequent gram that goes on by one word.  The words
    come with one row more per language and bucket, without a gram: the number of all words there.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), filled(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length(filled(text)))).first()[0] or 0
    buckets = max(1, -(-int(size) // bucket_bytes))
    rounds = max(1, math.ceil(math.log(buckets) / math.log(fan) - 1e-9))
    ways = max(1, math.ceil(buckets ** (1 / rounds) - 1e-9))
    packs = texts.mapInArrow(_edges(longest, ways), "lang string, bucket bigint, pack binary")
    found = []
    for length in range(longest, 0, -1):
        for step in range(1, rounds + 1):
            last = step == rounds
            # packs of one bucket are spread over tasks as long as a bucket is larger than a task
            spread = 1 if last else max(1, -(-buckets // ways**step))
            salt = F.pmod(F.crc32("pack"), F.lit(spread)).alias("salt")
            groups = packs.select("lang", "bucket", salt, "pack").groupBy("lang", "bucket", "salt")
            merged = materialise(groups.applyInArrow(_merge(last, ways if last else ways ** (step + 1), least), _ROW))
            packs = merged.where("pack is not null").select("lang", "bucket", "pack")
        found.append(merged.where("pack is null").select("lang", "gram", "n", "most"))
    return found[::-1]


def _named(grams: DataFrame, length: int) -> DataFrame:
    words = [F.get("gram", F.lit(k)).alias(f"w{k + 1}") for k in range(length)]
    return grams.where("gram is not null").select("lang", *words, "n", "most")


def with_counts(rows: DataFrame, counts: DataFrame, on: Sequence[str], name: str, hot: int) -> DataFrame:
    """``rows`` with the count of the gram in columns ``on``.

    Grams that occur more than ``hot`` times, a thousandth of all words, could meet many rows.
    There are at most a thousand of them a length, so they are broadcast; the others are joined by shuffle.
    """
    words = [c for c in counts.columns if c.startswith("w")]
    table = counts.select("lang", *[F.col(w).alias(o) for w, o in zip(words, on)], F.col("n").alias(name))
    keys = ["lang", *on]
    frequent = F.broadcast(table.where(F.col(name) > hot))
    rare = rows.join(frequent.select(*keys), keys, "left_anti").join(table.where(F.col(name) <= hot), keys)
    return rows.join(frequent, keys).unionByName(rare)


def unary_paths(edges: DataFrame) -> DataFrame:
    """``lang``, ``w1`` to ``w3`` and ``path_words``: words of the unary path an edge belongs to.

    Input: three-word edges with ``a``, ``out_flow`` of the node before and ``in_flow`` of the
    one behind.  A node is passed on when one edge takes all of its flow on either side, so a link has one
    partner.  Paths are found by pointer doubling: the rounds grow with the logarithm of
    the longest path, and only linked edges take part.
    """
    edge = F.struct("lang", "w1", "w2", "w3")
    into = edges.where("a = in_flow").select(edge.alias("head"), "lang", F.col("w2").alias("v1"), F.col("w3").alias("v2"), F.col("a").alias("weight"))
    out = edges.where("a = out_flow").select(edge.alias("edge"), "lang", F.col("w1").alias("v1"), F.col("w2").alias("v2"), F.col("a").alias("weight"))
    links = materialise(into.join(out, ["lang", "v1", "v2", "weight"]).select("edge", "head", F.lit(1).cast("long").alias("steps")))
    total = links.count()
    while total:
        on = links.select(F.col("edge").alias("head"), F.col("head").alias("far"), F.col("steps").alias("more"))
        links = materialise(
            links.join(on, "head", "left").select(
                "edge", F.coalesce("far", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
            )
        )
        now = links.agg(F.sum("steps")).first()[0]
        if now == total:
            break
        total = now
    # a path's steps are 1, 2, ... from its head, which is no row of its own
    paths = links.groupBy("head").agg((F.max("steps") + 3).alias("path_words"))
    members = links.select("head", "edge").unionByName(paths.select("head", F.col("head").alias("edge")))
    return members.join(paths, "head").select("edge.*", "path_words")


def _score(a: str, left: str, right: str) -> Column:
    """Exact: counts below 10^15, products up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(15, 0))"
    return F.expr(f"cast((cast(1000000 as decimal(7, 0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)}) as bigint)")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """First rows of each language; ranked in many parts first, so a language is never one task's sort."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    few = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """The best phrases of two and three words of each language.

    ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the parts of its
    weakest cut), ``n`` (all words), ``score`` and ``path_words``: words of the unary path that a
    phrase of three words lies in, the number of its own words otherwise.
    """
    words, pairs, triples = gram_counts(docs, 3, least, lang, text)
    totals = words.where("gram is null").groupBy("lang").agg(F.sum("n").alias("n"))
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    hot = max(1, int(all_words) // 1000)
    one, two, three = _named(words, 1), _named(pairs, 2), _named(triples, 3).withColumnRenamed("n", "a").drop("most")
    edges = with_counts(three, two, ["w1", "w2"], "out_flow", hot)
    edges = materialise(with_counts(edges, two, ["w2", "w3"], "in_flow", hot))
    paths = unary_paths(edges)
    scored = with_counts(with_counts(edges, one, ["w1"], "first", hot), one, ["w3"], "third", hot)
    scored = scored.withColumns({"one": _score("a", "first", "in_flow"), "two": _score("a", "out_flow", "third")})
    at_one = F.col("one") <= F.col("two")
    long = scored.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(at_one, F.col("first")).otherwise(F.col("out_flow")).alias("l"),
        F.when(at_one, F.col("in_flow")).otherwise(F.col("third")).alias("r"),
        F.least("one", "two").alias("score"),
    )
    inside = edges.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("most_in"))
    short = two.withColumnRenamed("n", "a").join(inside, ["lang", "w1", "w2"], "left")
    longer = F.greatest("most", F.coalesce("most_in", F.lit(0)))
    short = short.where((longer < least) | (100 * longer < 50 * F.col("a")))
    short = with_counts(with_counts(short, one, ["w1"], "l", hot), one, ["w2"], "r", hot)
    short = short.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    best = _first(long.unionByName(short), top)
    path = paths.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "path_words")
    size = F.size(F.split("phrase", " ")).cast("long")
    best = best.join(path, ["lang", "phrase"], "left").withColumn("path_words", F.coalesce("path_words", size))
    return best.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words")
