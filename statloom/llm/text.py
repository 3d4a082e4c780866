"""Shared rules on texts: missing texts, white space, words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def filled(name: str) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def one_space(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(F.translate(text, "\t\n\x0b\x0c\r", "     "), "  +", " ")


def words(text: str) -> list[bytes]:
    """Words between ASCII white space; ``bytes.split`` knows exactly that set."""
    return text.encode("utf-8", "surrogatepass").split()


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def in_portions(batches: Iterable[pa.RecordBatch], column: int | str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of Arrow batches with at most so many bytes in a text column, one row at least."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


def give_back() -> None:
    """Return freed memory to the machine: a worker lives on, and the next stage needs it elsewhere."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with this C library
        pass


#: Groups beyond this share of all rows are hot: at most a thousand can be.
HOT_SHARE = 0.001


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> DataFrame:
    """Inner join of ``rows`` with one row per group, where ``size`` counts the group's rows.

    A hot group would put all its rows into one task of a shuffle join.  At most a thousand
    groups hold more than a thousandth of the rows, so these few are broadcast.
    """
    limit = max(1000.0, HOT_SHARE * rows.count())
    hot = F.broadcast(groups.where(F.col(size) > limit))
    cold = rows.join(hot.select(*on), on, "left_anti").join(groups.where(F.col(size) <= limit), on)
    return rows.join(hot, on).unionByName(cold)
