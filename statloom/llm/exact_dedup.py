"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so, each chunk gets an identifier, and texts
are compared by their ordered identifier lists (recipes).  Chunk texts move once, for
the verification that no two different chunks share an identifier; long documents
themselves never move.

Defined results
    NULL texts count as empty and all empty texts are equal.  Rows that repeat a
    ``doc_id`` are one document and get the same answer; a NULL ``doc_id`` never
    stays when its group has another.  An empty table gives no rows.  Other columns
    are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from statloom.llm.text import filled, join_groups, one_space
from statloom.session import materialise

#: Seeds of the identifiers, tried in order until the chunks verify.
SEEDS = (11, 23, 47, 95)


def chunk_pattern(least: int = 256, most: int = 4096) -> str:
    """From ``least`` characters on, a chunk ends after the next sentence end; ``most`` bounds it.

    After a changed passage the cuts fall into step again at a later sentence end.
    """
    return rf"(?s).{{{least},{most}}}?(?:(?<=[.!?。！？]\x20)|\z)|.{{1,{most}}}"


def chunks_of(text: Column, least: int = 256, most: int = 4096) -> Column:
    """Chunks in order; joined they are the text again.  An empty text has none."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def _identifier(chunk: Column, seed: int) -> Column:
    """128 bits."""
    return F.struct(F.xxhash64(F.lit(seed), chunk).alias("a"), F.xxhash64(chunk, F.lit(seed)).alias("b"))


def unverified(chunks: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk text; input: ``chunk_id``, ``chunk``."""
    store = chunks.groupBy("chunk_id", "chunk").agg(F.lit(1).alias("one"))
    return store.groupBy("chunk_id").count().where(F.col("count") > 1)


def chunk_store(docs: DataFrame, text: str = "text", seed: int = SEEDS[0], least: int = 256, most: int = 4096) -> DataFrame:
    """One row per chunk occurrence: ``chunk_id`` and ``chunk``."""
    cut = chunks_of(one_space(filled(text)), least, most)
    rows = docs.select(F.explode(cut).alias("chunk"))
    return rows.select(_identifier(F.col("chunk"), seed).alias("chunk_id"), "chunk")


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEEDS[0], least: int = 256, most: int = 4096) -> DataFrame:
    """``doc_id``, the ordered list of chunk identifiers and the digest of the normalised text."""
    flat = docs.select(F.col(key).alias("doc_id"), one_space(filled(text)).alias("flat"))
    return flat.select(
        "doc_id",
        F.transform(chunks_of(F.col("flat"), least, most), lambda c: _identifier(c, seed)).alias("recipe"),
        F.sha2(F.encode("flat", "UTF-8"), 256).alias("text_sha256"),
    )


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 256, most: int = 4096, seeds: Sequence[int] = SEEDS
) -> DataFrame:
    """``doc_id``, ``keep_id`` (smallest of its group), ``group_size``, ``kept``, ``text_sha256`` per row."""
    for seed in seeds:
        if unverified(chunk_store(docs, text, seed, least, most)).isEmpty():
            break
    else:
        raise RuntimeError("chunk identifiers collide under every seed")
    lists = materialise(recipes(docs, key, text, seed, least, most))
    # copies collapse before the shuffle; a hot group is one row here
    groups = materialise(lists.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return join_groups(lists, groups, ["recipe"], "group_size").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, the one with the smallest key; the columns of ``docs``.

    Rows are met by key and text digest, so a key that repeats with different texts is
    judged text by text, and one row stays where a row itself repeats.
    """
    name = F.coalesce(F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.lit("null"))
    kept = exact_groups(docs, key, text).where("kept").select(name.alias("_key"), F.col("text_sha256").alias("_digest")).distinct()
    digest = F.sha2(F.encode(one_space(filled(text)), "UTF-8"), 256)
    own = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    marked = docs.withColumns({"_key": own, "_digest": digest})
    return marked.join(kept, ["_key", "_digest"], "left_semi").dropDuplicates(["_key", "_digest"]).drop("_key", "_digest")
