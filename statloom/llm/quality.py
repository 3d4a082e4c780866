"""Quality rules with thresholds that adapt to language and source.

Each text is measured in one pass.  The measures of the documents that pass the base
rule go into quantile sketches per (language, source): counts per logarithmic bucket,
which merge by addition in any order and give quantiles within one percent.  Sources
with few documents use the sketch of their language, small languages that of all
documents; these are the same counts added up.  A threshold is the upper quartile plus
``spread`` times the distance between the quartiles; where these are equal, the distance of
the ninth decile from the lower quartile.  The distance is never under the small width in
``WIDTHS``, so a uniform source loses nothing.  Documents are then joined with their
thresholds.

With ``own`` false the fixed cuts of ``MEASURES`` are floors, and the sketch only loosens
them.  Where there are too few documents anywhere for a sketch, they decide.

Defined results
    NULL texts have no words and fail the base rule.  NULL languages and sources are
    groups of their own.  Repeated rows are measured and counted like others.  Very long
    texts are measured whole, one at a time.  An
    empty table gives no rows.  Columns that clash with a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from statloom.llm.text import SPACES, filled, free_name, words
from statloom.session import materialise

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Measure and the floor of its threshold.
MEASURES = {"symbol_share": 0.03, "dup_line_share": 0.5, "repeat_share": 0.4, "long_words": 9.0}
#: Least distance that ``own`` thresholds take for the spread of a measure.
WIDTHS = {"symbol_share": 0.005, "dup_line_share": 0.02, "repeat_share": 0.02, "long_words": 0.1}
GROWTH = 1.02
LEAST_ROWS = 200


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(codes) < 4:
        return 0
    if distinct < 2_000_000:
        key = (codes[:-2] * distinct + codes[1:-1]) * distinct + codes[2:]
    else:  # three numbers would not fit 63 bits
        _, pair = np.unique(codes[:-1] * distinct + codes[1:], return_inverse=True)
        key = pair[:-1] * distinct + codes[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    starts = order[np.append(same, False) | np.append(False, same)]
    hit = np.zeros(len(codes), bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def measure(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS``."""
    found = words(text)
    number: dict[bytes, int] = {}
    codes = np.fromiter([number.setdefault(w, len(number)) for w in found], np.int64, len(found))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(found),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(codes, max(1, len(number))),
    )


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        values = [pa.array(v, pa.int64()) for v in (zip(*rows) if rows else [[]] * len(COUNTS))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], [*batch.schema.names[:-1], *COUNTS])


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the counts of ``COUNTS``, for whole texts."""
    schema = T.StructType([*[docs.schema[k] for k in keep], *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return docs.select(*keep, filled(text).alias("_text")).mapInArrow(_measure_batches, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shares() -> dict[str, Column]:
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n_words,
        "long_words": F.col("word_chars") / n_words,
    }


def sketches(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Counts per group, measure and bucket: values in (GROWTH^(b-1), GROWTH^b]; zero has no bucket number."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES])
    long = rows.select(*by, F.explode(values).alias("v")).select(*by, "v.*")
    # a small shift keeps powers themselves off the rounding of the logarithm
    bucket = F.when(F.col("value") > 0, F.ceil(F.log("value") / F.lit(math.log(GROWTH)) - F.lit(1e-9)))
    return long.groupBy(*by, "measure", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``by``, ``measure``, ``rows``, ``q1``, ``q3`` and ``d9``: the upper ends of the buckets that hold them."""
    group = [*by, "measure"]
    upto = Window.partitionBy(*group).orderBy(F.col("bucket").asc_nulls_first())
    whole = Window.partitionBy(*group)
    run = sketch.withColumns({"upto": F.sum("n").over(upto), "rows": F.sum("n").over(whole)})
    top = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(GROWTH), F.col("bucket")))
    at = {q: F.min(F.when(F.col("upto") >= p * F.col("rows"), top)).alias(q) for q, p in (("q1", 0.25), ("q3", 0.75), ("d9", 0.9))}
    return run.groupBy(*group).agg(F.max("rows").alias("rows"), *at.values())


def thresholds(rows: DataFrame, spread: float = 3.0, least_rows: int = LEAST_ROWS, own: bool = True) -> DataFrame:
    """Per ``lang`` and ``source`` that occurs: ``level`` used and one threshold per measure (NULL: none)."""
    by_source = materialise(sketches(rows.where(~base_failed()).withColumns(_shares()), ("lang", "source")))
    by_lang = merged(by_source, ("lang",))
    levels = {
        "source": quartiles(by_source, ("lang", "source")),
        "lang": quartiles(by_lang, ("lang",)),
        "all": quartiles(merged(by_lang, ()), ()),
    }
    wide = {}
    for name, q in levels.items():
        keys = [c for c in ("lang", "source") if c in q.columns]
        least = F.element_at(F.create_map(*[F.lit(x) for m in (WIDTHS if own else MEASURES).items() for x in m]), F.col("measure"))
        cut = F.greatest(F.col("q3") + spread * (F.col("q3") - F.col("q1")), least)
        if own:
            width = F.when(F.col("q3") > F.col("q1"), F.col("q3") - F.col("q1")).otherwise(F.col("d9") - F.col("q1"))
            cut = F.col("q3") + spread * F.greatest(width, least)
        columns = [F.max(F.when(F.col("measure") == m, F.col("cut"))).alias(f"{name}_{m}") for m in MEASURES]
        wide[name] = q.withColumn("cut", cut).groupBy(*keys).agg(F.max("rows").alias(f"{name}_rows"), *columns)
    groups = rows.select("lang", "source").distinct()
    found = groups.alias("g")
    for name, keys in (("source", ["lang", "source"]), ("lang", ["lang"])):
        side = wide[name].select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in wide[name].columns if c not in keys])
        match = F.col("lang").eqNullSafe(F.col("_lang"))
        if "source" in keys:
            match = match & F.col("source").eqNullSafe(F.col("_source"))
        found = found.join(side, match, "left").drop("_lang", "_source")
    found = found.join(F.broadcast(wide["all"]))  # one row
    enough = {n: F.coalesce(F.col(f"{n}_rows"), F.lit(0)) >= least_rows for n in levels}
    pick = lambda m: F.when(enough["source"], F.col(f"source_{m}")).when(enough["lang"], F.col(f"lang_{m}")).when(enough["all"], F.col(f"all_{m}"))
    level = F.when(enough["source"], "source").when(enough["lang"], "lang").when(enough["all"], "all").otherwise("none")
    return found.select("lang", "source", level.alias("level"), *[pick(m).alias(f"max_{m}") for m in MEASURES])


def judged(docs: DataFrame, text: str = "text", spread: float = 3.0, least_rows: int = LEAST_ROWS, own: bool = True) -> DataFrame:
    """Counts, shares, ``base_failed`` and ``kept`` per row of ``docs`` (``doc_id``, ``lang``, ``source``, text).

    Without a threshold (too few documents anywhere) the floors decide.
    """
    rows = materialise(measured(docs, text))
    limits = thresholds(rows, spread, least_rows, own).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    match = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    joined = rows.join(limits, match, "left").withColumns(_shares())
    good = F.lit(True)
    for m, floor in MEASURES.items():
        good = good & (F.col(m) <= F.coalesce(F.col(f"max_{m}"), F.lit(floor)))
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & good).drop("_lang", "_source")


def keep_good(docs: DataFrame, text: str = "text", own: bool = True) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the columns of ``docs``."""
    name = free_name(docs, "kept_id")
    good = judged(docs, text, own=own).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good[name]), "left_semi")
