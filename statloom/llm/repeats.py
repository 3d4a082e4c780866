"""Passages that repeat across documents: units are hashed, the earliest occurrence stays.

A unit is a line or, where a line has several sentences, a sentence of it: text up to and
with its end marks and line feed.  Units are compared in lower case with single blanks.
Occurrences are ranked by document key, then place; the first of each digest stays.
Later ones go, with their offsets in the original text, where they stand in a run of
neighbouring later ones of at least ``least_run`` words: a repeated line or paragraph of
so many words goes whole, whatever its sentences are, and a passage set into a longer
line is found by its sentences, but a short line or sentence that repeats by chance
stays.  Units of fewer than ``least_words`` words are left alone and end a run; units
without words do not.  ``least_run=0`` asks for no run.

With ``lines`` whole lines and paragraphs (lines without an empty one between them) of at
least ``least_words`` words are units of their own, and inside a line runs of short
sentences that have enough words together.  Any repeated line then goes, alone or not.
Short text between two removed places goes with them.

Only digests and offsets are shuffled, counts of a digest are added up before, and a
unit that many documents share is met by a join whose large keys can be split.

Defined results
    NULL and empty texts have no units.  A row is its key and text: different texts
    under one key are ranked by a 64-bit hash of the text and cut by their own offsets;
    rows equal in both are ranked alike, so the first stays whole in both.  An empty table
    gives no rows.  Other columns are ignored, or kept by ``remove_repeats``, where a column
    ``removed`` is replaced.  NULL keys rank first.  The units of one text pass one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from statloom.llm.text import filled, free_name
from statloom.session import materialise

_UNIT = re.compile(r"[^\n.!?]*[.!?]*\n?")
#: Words of the shortest unit that is compared where no run is asked for.
LEAST_WORDS = 5
#: Words of the shortest run that goes.
LEAST_RUN = 20


def units_of(text: str) -> Iterator[tuple[int, int, bytes, int]]:
    """Start, end, normalised form and number of words of each unit; together they are the text."""
    for m in _UNIT.finditer(text):
        if m.end() > m.start():
            words = m.group().lower().encode("utf-8", "surrogatepass").split()
            yield m.start(), m.end(), b" ".join(words), len(words)


_LINE = re.compile(r"[^\n]*\n?")


def nested_units(text: str, least_words: int = LEAST_WORDS) -> tuple[int, list[tuple[int, int, bytes]], list[tuple[int, int]]]:
    """Number of sentence units, the paragraphs, lines, sentences and runs long enough to be compared, and the short units."""
    n, found, short = 0, [], []
    block: list[tuple[int, int, bytes, int]] = []

    def end_block() -> None:
        if len(block) > 1 and sum(x[3] for x in block) >= least_words:
            found.append((block[0][0], block[-1][1], b"\n" + b" ".join(x[2] for x in block)))  # apart from lines
        block.clear()

    for m in _LINE.finditer(text):
        if m.end() == m.start():
            continue
        parts = [(m.start() + s, m.start() + e, flat, words) for s, e, flat, words in units_of(m.group())]
        n += len(parts)
        short += [(s, e) for s, e, _, words in parts if words < least_words]
        real = [x for x in parts if x[3]]
        if not real:
            end_block()
            continue
        line = (m.start(), m.end(), b" ".join(m.group().lower().encode("utf-8", "surrogatepass").split()), sum(x[3] for x in parts))
        block.append(line)
        if line[3] >= least_words:
            found.append(line[:3])
        if len(real) == 1:
            continue
        run: list[tuple[int, int, bytes, int]] = []
        for x in [*real, None]:
            if x and x[3] < least_words:
                run.append(x)
                continue
            if 1 < len(run) < len(real) and sum(r[3] for r in run) >= least_words:
                found.append((run[0][0], run[-1][1], b" ".join(r[2] for r in run)))
            run = []
            if x:
                found.append(x[:3])
    end_block()
    return n, found, short


def closed(removed: list[tuple[int, int]], short: list[tuple[int, int]], text: str, least_words: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Sorted spans without overlap, with the short units between two of them where these are too few words to be compared."""
    out: list[list[int]] = []
    ends = {s: e for s, e in short}
    for start, end in sorted(removed):
        if out and start > out[-1][1]:
            at = out[-1][1]
            while at < start and at in ends:
                at = ends[at]
            if at == start and len(text[out[-1][1] : start].encode("utf-8", "surrogatepass").split()) < least_words:
                out[-1][1] = start
        if out and start <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_PLACE = T.StructType([T.StructField("at", T.IntegerType()), *_SPAN.fields, T.StructField("words", T.IntegerType())])
_UNITS = T.ArrayType(T.StructType([T.StructField("digest", T.BinaryType()), *_PLACE.fields]))


def _row(text: str) -> Column:
    """What tells apart different texts under one key."""
    return F.xxhash64(filled(text))


def units(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 1, lines: bool = False) -> DataFrame:
    """``doc_id``, ``row`` (hash of the text), ``n_units`` and the hashed units (128 bits) long enough to be compared.

    A unit has its number among those with words (``at``), offsets and number of words.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[key].dataType), T.StructField("row", T.LongType()), T.StructField("n_units", T.IntegerType()), T.StructField("units", _UNITS)]
    )
    kind = pa.list_(pa.struct([("digest", pa.binary()), *[(name, pa.int32()) for name in _PLACE.names]]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_units, digests, places, bounds = [], [], [], [0]
            for value in batch.column(2):
                if lines:
                    n, nested, _ = nested_units(value.as_py(), least_words)
                    found = [(flat, 0, start, end, 0) for start, end, flat in nested]
                else:
                    every = list(units_of(value.as_py()))
                    n = len(every)
                    numbered = enumerate(x for x in every if x[3])
                    found = [(flat, at, start, end, words) for at, (start, end, flat, words) in numbered if words >= least_words]
                for flat, *place in found:
                    digests.append(hashlib.md5(flat, usedforsecurity=False).digest())
                    places.append(place)
                n_units.append(n)
                bounds.append(len(digests))
            columns = np.array(places, np.int32).reshape(-1, len(_PLACE)).T
            rows = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), *map(pa.array, columns)], fields=list(kind.value_type))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n_units, pa.int32()), lists], schema.names)

    return docs.select(F.col(key).alias("doc_id"), _row(text).alias("row"), filled(text).alias("text")).mapInArrow(work, schema)


def long_runs(lists: pa.ListArray, least_run: int) -> pa.ListArray:
    """Spans of those units (ascending lists of places) whose run of neighbours has so many words."""
    places, bounds = lists.flatten(), np.diff(lists.offsets.to_numpy()).cumsum()
    at, words = (places.field(name).to_numpy() for name in ("at", "words"))
    starts = np.diff(at, prepend=-2) != 1
    starts[np.append(0, bounds[:-1])[np.diff(bounds, prepend=0) > 0]] = True
    run = starts.cumsum() - 1
    stays = np.bincount(run, words, run[-1] + 1 if len(run) else 0)[run] >= least_run
    kept = np.append(0, stays.cumsum())
    spans = pa.StructArray.from_arrays([places.field("start"), places.field("end")], names=["start", "end"]).filter(pa.array(stays))
    return pa.ListArray.from_arrays(pa.array(kept[np.append(0, bounds)], pa.int32()), spans)


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int | None = None, lines: bool = False, least_run: int = LEAST_RUN
) -> DataFrame:
    """Per row ``doc_id``, ``row``, ``n_units`` and ``removed``: sorted (start, end) of the units that go; with ``lines`` they may overlap.

    ``least_words`` is one, or five with ``lines``, where ``least_run`` is not asked for.
    """
    least_words = least_words if least_words is not None else LEAST_WORDS if lines else 1
    hashed = materialise(units(docs, key, text, least_words, lines))
    rows = hashed.select("doc_id", "row", F.explode("units").alias("u")).select("doc_id", "row", "u.*")
    first = F.min(F.struct("doc_id", "row", "start")).alias("first")
    # written, so that the join reads both sides by a shuffle of their own and can split a digest of many rows
    shared = materialise(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), first).where("n > 1").select("digest", "first"))
    later = rows.join(shared, "digest").where(~F.struct("doc_id", "row", "start").eqNullSafe(F.col("first")))
    # equal rows name the same units again
    places = later.select("doc_id", "row", *_PLACE.names).groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct(*_PLACE.names))).alias("removed"))
    none = F.array().cast(T.ArrayType(_SPAN))
    if lines:
        removed = places.withColumn("removed", F.array_distinct(F.transform("removed", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))))
    else:
        schema = T.StructType([*places.schema.fields[:2], T.StructField("removed", T.ArrayType(_SPAN))])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], long_runs(batch.column(2), least_run)], schema.names)

        removed = places.mapInArrow(pick, schema)
    spans = hashed.select("doc_id", "row", "n_units").alias("d").join(removed.alias("r"), F.expr("d.doc_id <=> r.doc_id AND d.row = r.row"), "left")
    return spans.select("d.doc_id", "d.row", "n_units", F.coalesce("removed", none).alias("removed"))


def without_spans(text: str | None, removed: list) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for start, end in removed:
        out.append(text[at:start])
        at = end
    return "".join([*out, text[at:]])


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int | None = None, lines: bool = False, least_run: int = LEAST_RUN
) -> DataFrame:
    """``docs`` with the repeated units cut from ``text`` and their offsets in ``removed``."""
    docs = docs.drop("removed") if "removed" in docs.columns else docs
    least = least_words if least_words is not None else LEAST_WORDS
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.ArrayType(_SPAN))])

    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for value, found in zip(texts, spans):
            gone = [(x["start"], x["end"]) for x in found]
            if lines and gone:
                gone = closed(gone, nested_units(value, least)[2], value, least)
            out.append((without_spans(value, gone), [{"start": s, "end": e} for s, e in gone]))
        return pd.DataFrame(out, columns=["text", "removed"])

    names = {name: free_name(docs, name) for name in ("doc_id", "row", "done")}
    spans = repeated_spans(docs, key, text, least_words, lines, least_run).select("doc_id", "row", "removed").dropDuplicates(["doc_id", "row"])
    spans = spans.select(F.col("doc_id").alias(names["doc_id"]), F.col("row").alias(names["row"]), "removed")
    same = docs[key].eqNullSafe(spans[names["doc_id"]]) & (_row(text) == spans[names["row"]])
    done = docs.join(spans, same).withColumn(names["done"], F.pandas_udf(cut, kind)(F.col(text), F.col("removed")))
    columns = [F.col(f"{names['done']}.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*columns, F.col(f"{names['done']}.removed").alias("removed"))
