"""Ordered computations that stay distributed when one key holds most of the rows.

A window over ``partitionBy(key).orderBy(t)`` puts a whole key into one task, and
a window without keys puts the whole table into one task.  The functions here
check the size of the largest key first.  While every key fits a split they use
the ordinary window.  Beyond that, large keys are cut into ranges of the order
columns, each range is processed on its own, and the small per-range totals are
carried from range to range.  Where ``order`` tells all rows of a key apart, results
are the same on both ways; rows equal in it may take either order, as in any window.

The number of ranges is at most ``MAX_SPLITS``, so beyond MAX_SPLITS x ROWS_PER_SPLIT
rows a range grows with the input: 20,000 tasks of 50 million rows at 10^12.

``order`` is a list of column names; a leading ``-`` means descending.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from statloom.session import materialise

ROWS_PER_SPLIT = 1_000_000
MAX_SPLITS = 20_000
ROWS_PER_CUT = 100
CUTS_PER_BLOCK = 64
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
AFTER_TIES = 1 << 30
INF = float("inf")


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Nulls first ascending, last descending."""
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def _decimal_codes(col: Column, precision: int, scale: int) -> list[Column]:
    """Groups of at most 15 digits from the left, each as a double with the sign of the number."""
    if precision <= 15:
        return [col.cast("double")]
    codes = []
    for power in (28, 14, 0, -15, -30):
        if -scale < power < precision - scale:
            below = col % F.expr(f"CAST('1e{power}' AS DECIMAL({abs(power) + 1}, {max(0, -power)}))")
            codes.append((col - below).cast("double"))
            col = below
    return [*codes, col.cast("double")]


def _column_codes(name: str, dtype: T.DataType, longest: int) -> list[Column]:
    """Doubles that order rows as the column does, coarse to fine; together they tell all values apart.

    ``longest`` is the length of the longest text in bytes.
    """
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        raw = F.encode(col, "UTF-8")
        codes = []
        for i in range(-(-longest // 6)):
            piece = F.rpad(F.hex(F.substring(raw, 6 * i + 1, 6)), 12, "0")
            codes.append(F.conv(piece, 16, 10).cast("double"))
        # texts that only differ in zero bytes at the end
        return [*codes, F.octet_length(col).cast("double")]
    if isinstance(dtype, T.DecimalType):
        return _decimal_codes(col, dtype.precision, dtype.scale)
    if isinstance(dtype, T.LongType):
        high = F.shiftright(col, 32)
        return [high.cast("double"), (col - F.shiftleft(high, 32)).cast("double")]
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return [F.unix_micros(col.cast("timestamp")).cast("double")]
    if isinstance(dtype, T.DateType):
        return [F.unix_date(col).cast("double")]
    if isinstance(dtype, T.BooleanType):
        return [col.cast("int").cast("double")]
    return [F.nanvl(col.cast("double"), F.lit(INF))]


def _order_codes(df: DataFrame, order: Sequence[str]) -> tuple[list[Column], list[int]]:
    """Codes of all order columns, and the place in ``order`` that each belongs to."""
    names = [o.lstrip("-") for o in order]
    texts = {n for n in names if isinstance(df.schema[n].dataType, T.StringType)}
    longest = df.agg(F.lit(0), *[F.max(F.octet_length(n)).alias(n) for n in texts]).first().asDict() if texts else {}
    codes, owner = [], []
    for i, (o, name) in enumerate(zip(order, names)):
        found = _column_codes(name, df.schema[name].dataType, longest.get(name) or 0)
        if o.startswith("-"):
            codes += [F.coalesce(-c, F.lit(INF)) for c in found]
        else:
            codes += [F.coalesce(c, F.lit(-INF)) for c in found]
        owner += [i] * len(found)
    return codes, owner


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column | None:
    cond = None
    for k in keys:
        eq = left[k].eqNullSafe(right[prefix + k])
        cond = eq if cond is None else cond & eq
    return cond


@dataclass
class Splits:
    """Input with its ``_split`` and ``_hot`` columns; ``needed`` is False when plain windows do."""

    df: DataFrame
    needed: bool
    helpers: list[str] = field(default_factory=list)


def _range_cuts(df: DataFrame, keys: Sequence[str], code: str, hot: DataFrame, size: int, parts: int) -> list[dict]:
    """Per hot key (columns ``keys`` and its rows ``_keyrows``) the cut points of ``code``, with repeats.

    Cut points only balance the ranges, so a sample of some rows per range will do.
    """
    share = ROWS_PER_CUT / size
    if share < 0.2:
        df = df.sample(share, seed=1)
    probabilities = [i / parts for i in range(1, parts)]
    cuts = F.percentile_approx(code, probabilities, 10 * parts)
    if not keys:
        return [{"n": None, "cuts": list(df.agg(cuts.alias("c")).first()["c"] or [])}]
    named = F.broadcast(hot.select(*[F.col(k).alias("_h_" + k) for k in keys], "_keyrows"))
    found = (
        df.join(named, _same(df, named, keys, "_h_"))
        .groupBy(*["_h_" + k for k in keys])
        .agg(F.max("_keyrows").alias("n"), cuts.alias("c"))
    )
    # a key a few splits long needs only some of the cuts
    step = F.greatest(F.lit(1), F.floor(F.lit(parts) / F.ceil(F.col("n") / F.lit(size)))).cast("int")
    thinned = found.withColumn("cuts", F.filter("c", lambda c, i: (i + 1) % step == 0)).drop("c")
    return [r.asDict() for r in thinned.collect()]


def _cut_column(df: DataFrame, keys: Sequence[str], code: str, rows: list[dict], name: str) -> DataFrame:
    """Add ``name``: the range of each row of a hot key, NULL for other rows."""
    fields = [T.StructField("_h_" + k, df.schema[k].dataType) for k in keys]
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([*fields, T.StructField("_heads", doubles), T.StructField("_cuts", T.ArrayType(doubles))])
    data = []
    for r in rows:
        cuts = sorted(set(r["cuts"]))
        blocks = [cuts[i : i + CUTS_PER_BLOCK] for i in range(0, len(cuts), CUTS_PER_BLOCK)]
        data.append((*[r["_h_" + k] for k in keys], [b[0] for b in blocks[1:]], blocks))
    # at most MAX_SPLITS keys and about twice as many cuts in all
    table = df.sparkSession.createDataFrame(data, schema)
    if keys:
        table = F.broadcast(table)
        joined = df.join(table, _same(df, table, keys, "_h_"), "left")
    else:
        row = "_cut_row"  # no name that a caller gives its order column
        joined = with_row(df, table, row).withColumns({c: F.col(f"{row}.{c}") for c in ("_heads", "_cuts")}).drop(row)
    # first the block of cuts, then the place in it
    joined = joined.withColumn("_at", F.size(F.filter("_heads", lambda c: c <= F.col(code))))
    inside = F.size(F.filter(F.get("_cuts", F.col("_at")), lambda c: c <= F.col(code)))
    place = F.when(F.size("_cuts") > 0, F.col("_at") * CUTS_PER_BLOCK + inside).otherwise(F.lit(0))
    return joined.withColumn(name, F.when(F.col("_cuts").isNotNull(), place)).drop(
        "_heads", "_cuts", "_at", *["_h_" + k for k in keys]
    )


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT,
    reuse: bool = False,
) -> Splits:
    """Number the ranges of keys with more than ``rows_per_split`` rows.

    The number of ranges over all keys is at most about twice ``MAX_SPLITS``, so
    the cut points are a small table whatever the input size.  Where many rows
    share an order value, they are cut along the next order column; rows equal in
    all of them may stand in any order and are cut at random.  ``reuse`` writes an
    expensive (aggregated) input once, before its size is checked.
    """
    keys = list(keys)
    if reuse:
        df = materialise(df)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_keyrows"))
    sizes = counts.agg(F.sum("_keyrows").alias("total"), F.max("_keyrows").alias("largest")).first()
    total, largest = sizes["total"] or 0, sizes["largest"] or 0
    size = max(rows_per_split, -(-total // MAX_SPLITS))
    if largest <= size:
        return Splits(df, False)
    # at most MAX_SPLITS keys can be larger than total / MAX_SPLITS rows
    hot = counts.where(F.col("_keyrows") > size)
    codes, owner = _order_codes(df, order)
    rows, group, ranges, helpers = df, list(keys), [], []
    level = 0
    while True:
        code, place = f"_code{level}", f"_range{level}"
        if level < len(codes):
            rows = rows.withColumn(code, codes[level])
        else:
            rows = materialise(rows.withColumn(code, F.rand(level)))
        parts = -(-largest // size)
        cuts = _range_cuts(rows, group, code, hot, size, parts)
        rows = _cut_column(rows, group, code, cuts, place)
        helpers += [code, place]
        ranges.append(place)
        if level >= len(codes):
            break
        # a cut that repeats marks a value with more rows than a range
        tied = [({k: r["_h_" + k] for k in group}, c) for r in cuts for c, m in Counter(r["cuts"]).items() if m > 1]
        if not tied:
            break
        schema = T.StructType([*[rows.schema[k] for k in group], rows.schema[code]])
        heavy = rows.sparkSession.createDataFrame([(*[g[k] for k in group], c) for g, c in tied], schema)
        heavy = heavy.select(*[F.col(k).alias("_t_" + k) for k in [*group, code]])
        group = [*group, code]
        table = F.broadcast(heavy)
        own = order[owner[level]].lstrip("-") if level < len(codes) else None
        one_value = F.min(own).eqNullSafe(F.max(own)) & F.count(own).isin(F.lit(0), F.count(F.lit(1))) if own else F.lit(True)
        hot = (
            rows.join(table, _same(rows, table, group, "_t_"))
            .groupBy(*["_t_" + k for k in group])
            .agg(F.count(F.lit(1)).alias("_keyrows"), one_value.alias("_one"))
            .toDF(*group, "_keyrows", "_one")
            .where(F.col("_keyrows") > size)
        )
        found = hot.collect()  # at most MAX_SPLITS rows
        if not found:
            break
        hot = rows.sparkSession.createDataFrame(found, hot.schema).drop("_one")
        largest = max(r["_keyrows"] for r in found)
        # where only equal values are left, go on with the next column at once
        done = all(r["_one"] for r in found)
        level += 1
        while done and own and level < len(codes) and owner[level] == owner[level - 1]:
            codes.pop(level)
            owner.pop(level)
    # rows after a tied value follow all its ranges
    parts_of_split = [F.coalesce(F.col(p), F.lit(AFTER_TIES if i else 0)) for i, p in enumerate(ranges)]
    split = F.struct(*[p.alias(f"r{i}") for i, p in enumerate(parts_of_split)])
    out = rows.withColumns({"_hot": F.col("_range0").isNotNull(), "_split": split}).drop(*helpers)
    return Splits(out, True, ["_hot", "_split"])


_AGG = {"sum": F.sum, "total": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, tuple[str, str | Column]],
    rows_per_split: int = ROWS_PER_SPLIT,
    reuse: bool = False,
    parted: Splits | None = None,
) -> DataFrame:
    """Running sum, max or min up to and with the current row, or the key's total.

    ``values`` maps the new column to (``sum`` | ``max`` | ``min`` | ``total``, column).
    """
    keys = list(keys)
    inputs = {f"_in{i}": (v if isinstance(v, Column) else F.col(v)) for i, (_, v) in enumerate(values.values())}
    named = dict(zip(values, inputs))
    parted = parted or split_hot_keys(df, keys, order, rows_per_split, reuse)
    base = parted.df.withColumns(inputs)
    by = sort_columns(order)

    def over(*partition: str) -> dict[str, Column]:
        whole = Window.partitionBy(*partition)
        frame = whole.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return {
            out: _AGG[kind](named[out]).over(whole if kind == "total" else frame) for out, (kind, _) in values.items()
        }

    if not parted.needed:
        return base.withColumns(over(*keys)).drop(*inputs)

    local = base.withColumns(over(*keys, "_split"))
    ranges = (
        base.where("_hot")
        .groupBy(*keys, "_split")
        .agg(*[_AGG[kind](named[out]).alias(out) for out, (kind, _) in values.items()])
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.select(
        *[F.col(k).alias("_c_" + k) for k in [*keys, "_split"]],
        *[
            _AGG[kind](out).over(whole if kind == "total" else before).alias("_carry_" + out)
            for out, (kind, _) in values.items()
        ],
    )
    # one row per range, see split_hot_keys for the bound
    carry = F.broadcast(carry)
    joined = local.join(carry, _same(local, carry, [*keys, "_split"], "_c_"), "left")
    combined = {}
    for out, (kind, _) in values.items():
        mine, prior = F.col(out), F.col("_carry_" + out)
        if kind == "sum":
            combined[out] = F.coalesce(mine + prior, mine, prior)
        elif kind == "total":
            combined[out] = F.coalesce(prior, mine)
        else:
            combined[out] = (F.greatest if kind == "max" else F.least)(mine, prior)
    return joined.withColumns(combined).drop(
        *inputs, *parted.helpers, *["_c_" + k for k in [*keys, "_split"]], *["_carry_" + o for o in values]
    )


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rn",
    rows_per_split: int = ROWS_PER_SPLIT,
    parted: Splits | None = None,
) -> DataFrame:
    """1-based row number."""
    out = running(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, rows_per_split, parted=parted)
    return out.withColumn(name, F.col(name).cast("long"))


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    rows_per_split: int = ROWS_PER_SPLIT,
    block_rows: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """Window columns that read at most ``rows`` earlier rows (lag, moving frames).

    Large keys are numbered and cut into blocks of rows; the last ``rows`` rows of
    a block are also sent to the next block, where they serve as history only.
    ``order`` must tell the rows of a key apart.  ``index`` names a row number
    1, 2, ... within the key that is there already.
    """
    keys = list(keys)
    size = max(block_rows or rows_per_split, rows + 1)
    if index:
        indexed = df.withColumn("_ix", F.col(index))
    else:
        parted = split_hot_keys(df, keys, order, rows_per_split)
        if not parted.needed:
            return df.withColumns(build(Window.partitionBy(*keys).orderBy(*sort_columns(order))))
        indexed = row_index(df, keys, order, "_ix", parted=parted)
    block = F.expr(f"(_ix - 1) div {size}")
    near_end = F.expr(f"(_ix - 1) % {size} >= {size - rows}")
    copies = indexed.withColumn("_own", block).withColumn(
        "_block",
        F.explode(F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))),
    )
    window = Window.partitionBy(*keys, "_block").orderBy("_ix")
    return copies.withColumns(build(window)).where("_own = _block").drop("_own", "_block", "_ix")


#: Half the width of a bracket around a wanted share of rows, and the error of the sketch that finds it.
BRACKET = 0.002
SKETCH_ACCURACY = 2_000


def _outside_collapsed(rows: DataFrame, column: str, shares: Sequence[float]) -> DataFrame | None:
    """Counted values (``_seg``, ``_v``, ``_n``) near the wanted shares; all values between two brackets are one row with ``_v`` NULL.

    A quantile sketch brackets each share: its error is below the bracket's half width, so the wanted
    ranks lie inside.  Order by (``_seg``, ``_v``).  None where the sketch does not apply: texts, NaN and numbers
    that a double does not hold.
    """
    dtype = rows.schema[column].dataType
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType)) or isinstance(dtype, T.DecimalType) and dtype.precision > 15:
        return None
    wanted = sorted({min(1.0, max(0.0, s + d)) for s in shares for d in (-BRACKET, BRACKET)})
    nan = F.count_if(F.isnan(column)) if isinstance(dtype, (T.FloatType, T.DoubleType)) else F.lit(0)
    found = rows.agg(F.percentile_approx(column, wanted, SKETCH_ACCURACY).alias("cuts"), nan.alias("nan"), F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if found["cuts"] is None or found["nan"]:
        return None
    if isinstance(dtype, T.LongType) and max(abs(found["lo"]), abs(found["hi"])) > 1 << 53:
        return None  # the sketch works in doubles
    at = dict(zip(wanted, found["cuts"]))
    spans: list[list] = []
    for share in sorted(shares):
        low = found["lo"] if share <= BRACKET else at[max(0.0, share - BRACKET)]
        high = found["hi"] if share >= 1 - BRACKET else at[min(1.0, share + BRACKET)]
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(high, spans[-1][1])
        else:
            spans.append([low, high])
    v, segment, inside = F.col(column), F.lit(2 * len(spans)), F.lit(False)
    for i, (low, high) in reversed([*enumerate(spans)]):
        within = (v >= F.lit(low).cast(dtype)) & (v <= F.lit(high).cast(dtype))
        segment = F.when(v < F.lit(low).cast(dtype), 2 * i).when(within, 2 * i + 1).otherwise(segment)
        inside = inside | within
    return rows.groupBy(segment.alias("_seg"), F.when(inside, v).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    discrete: bool = False,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Exact quantiles, one row per key, nulls ignored.

    Without keys a first scan brackets the wanted shares by a sketch and a second one counts: only values
    inside a bracket are shuffled and ordered, the rest are a few sums.  With keys (and for texts, NaN and
    numbers beyond a double) values are counted first, so only distinct values are ordered, and a key with
    many of them is spread over ranges instead of being held in one task.
    """
    keys = list(keys)
    rows = df.where(F.col(column).isNotNull())
    counts = None if keys else _outside_collapsed(rows, column, list(probabilities.values()))
    order = ["_v"] if counts is None else ["_seg", "_v"]
    if counts is None:
        counts = rows.groupBy(*keys, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(counts, keys, order, {"_cum": ("sum", "_n"), "_size": ("total", "_n")}, rows_per_split, reuse=True)

    def value(reached: Column) -> Column:
        """The first value in order; it must not lie outside the brackets."""
        if len(order) == 1:
            return F.min(F.when(reached, F.col("_v")))
        first = F.min(F.when(reached, F.struct("_seg", "_v")))
        lost = F.raise_error(F.lit(f"a quantile of {column} lies outside its bracket"))
        return F.when(first.isNotNull() & first["_v"].isNull(), lost.cast(df.schema[column].dataType)).otherwise(first["_v"])

    picks = []
    for name, p in probabilities.items():
        if discrete:
            picks.append(value(F.col("_cum") >= F.lit(p) * F.col("_size")).alias(name))
            continue
        position = F.lit(p) * (F.col("_size") - 1)
        picks.append(value(F.col("_cum") > F.floor(position)).cast("double").alias("_lo_" + name))
        picks.append(value(F.col("_cum") > F.ceil(position)).cast("double").alias("_hi_" + name))
        picks.append(F.max(position - F.floor(position)).alias("_part_" + name))
    result = ranked.groupBy(*keys).agg(*picks)
    if discrete:
        return result
    return result.select(
        *keys,
        *[
            (F.col("_lo_" + n) + F.col("_part_" + n) * (F.col("_hi_" + n) - F.col("_lo_" + n))).alias(n)
            for n in probabilities
        ],
    )


def average_rank(
    df: DataFrame,
    column: str,
    name: str = "rank",
    rows_per_split: int = ROWS_PER_SPLIT,
    weight: str | None = None,
) -> DataFrame:
    """One row per distinct value with its count ``n``, tie-averaged rank and the ``total`` count.

    ``weight`` names a column of counts when the rows are counted already.
    """
    number = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(number.alias("n"))
    ranked = running(
        counts, [], [column], {"_cum": ("sum", "n"), "total": ("total", "n")}, rows_per_split, reuse=True
    )
    return ranked.withColumn(name, F.col("_cum") - (F.col("n") - 1) / 2).drop("_cum")


def dense_rank(
    df: DataFrame, column: str, name: str = "code", rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """One row per distinct value with its 1-based position among the values."""
    return row_index(df.select(column).distinct(), [], [column], name, rows_per_split)


def ntile(
    df: DataFrame, order: Sequence[str], tiles: int, name: str = "tile", rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Exact equal-count tiles: the first ``total % tiles`` tiles hold one row more."""
    one = F.lit(1).cast("long")
    indexed = running(df, [], order, {"_ix": ("sum", one), "_total": ("total", one)}, rows_per_split)
    small, extra = F.expr(f"_total div {tiles}"), F.expr(f"_total % {tiles}")
    head = extra * (small + 1)
    zero = F.col("_ix") - 1
    in_head = F.floor(F.try_divide(zero, small + 1))
    in_tail = extra + F.floor(F.try_divide(zero - head, small))
    tile = F.when(zero < head, in_head).otherwise(in_tail) + 1
    return indexed.withColumn(name, tile.cast("int")).drop("_ix", "_total")


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Put the only row of ``row`` beside every row as the struct ``name``, computed once."""
    return df.withColumn(name, row.select(F.struct(*row.columns).alias("s")).scalar())


def _bytes_of(df: DataFrame) -> Column:
    """About how much room the rows take."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    sizes = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in texts]
    sizes += [F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in nested]
    return F.sum(reduce(add, sizes, F.lit(16 * len(df.columns)).cast("long")))


def join_small(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-key table of unknown size: computed once, measured, broadcast only when small.

    A larger table is joined by shuffle, where adaptive execution splits large keys.
    NULL keys match each other.
    """
    keys = list(keys)
    renamed = materialise(table.select(*[F.col(k).alias("_k_" + k) for k in keys], *[c for c in table.columns if c not in keys]))
    size = renamed.agg(F.count(F.lit(1)).alias("rows"), _bytes_of(renamed).alias("bytes")).first()
    if size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    return df.join(renamed, _same(df, renamed, keys, "_k_"), how).drop(*["_k_" + k for k in keys])
