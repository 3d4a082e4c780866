"""Table profiles: one pass of aggregation per table, results in long form."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def _statistics(field: T.StructField) -> dict[str, tuple[str, Column]]:
    """Statistic name to (kind of result, aggregate)."""
    c = F.col(field.name)
    text = "string"
    found = {
        "rows": ("count", F.count(F.lit(1))),
        "emptiness": ("count", F.count_if(c.isNull())),
    }
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return found | {"shortest": ("number", F.min(F.size(c))), "longest": ("number", F.max(F.size(c)))}
    if isinstance(field.dataType, _NESTED):
        return found
    if isinstance(field.dataType, T.NumericType):
        found |= {
            "minimum": ("number", F.min(c)),
            "maximum": ("number", F.max(c)),
            "average": ("number", F.avg(c)),
            "deviation": ("number", F.stddev_samp(c)),
            "zeros": ("count", F.count_if(c == 0)),
        }
    else:
        found |= {"minimum": (text, F.min(c)), "maximum": (text, F.max(c))}
    if isinstance(field.dataType, T.StringType):
        found |= {"shortest": ("number", F.min(F.length(c))), "longest": ("number", F.max(F.length(c)))}
    return found


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (position, distinct): exact, over narrow (column, value) pairs.

    Several distinct counts in one aggregate would copy every wide row once per
    column; here repeated values collapse before the shuffle.
    """
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, _NESTED)}
    # a nested or binary value stands for itself by a 256-bit digest of its text
    text = {c: F.sha2(F.to_json(F.struct(c)), 256) if c in nested else F.col(c).cast("string") for c in columns}
    value = {c: F.when(F.col(c).isNotNull(), text[c]) for c in columns}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), value[c].alias("v")) for i, c in enumerate(columns)])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where("v IS NOT NULL").distinct()
    found = values.groupBy("i").agg(F.count(F.lit(1)).alias("distinct"))
    everything = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("i"))
    return everything.join(found, "i", "left").na.fill(0, ["distinct"])


def profile_table(df: DataFrame) -> DataFrame:
    """Rows (column, statistic, numeric result, string result, count, percent of rows)."""
    aggs, rows = [], []
    for i, field in enumerate(df.schema.fields):
        for name, (kind, agg) in _statistics(field).items():
            alias = f"_{i}_{name}"
            cast = {"count": "long", "number": "double", "string": "string"}[kind]
            aggs.append(agg.cast(cast).alias(alias))
            value = F.col(alias)
            rows.append(
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.lit(name).alias("statistic"),
                    (value if kind == "number" else F.lit(None)).cast("double").alias("numeric_result"),
                    (value if kind == "string" else F.lit(None)).cast("string").alias("string_result"),
                    (value if kind == "count" else F.lit(None)).cast("long").alias("counts"),
                )
            )
    wide = df.agg(F.count(F.lit(1)).alias("_all"), *aggs)
    long = wide.select("_all", F.explode(F.array(*rows)).alias("r")).select("_all", "r.*")
    names = F.array(*[F.lit(f.name) for f in df.schema.fields])
    distinct = distinct_counts(df, [f.name for f in df.schema.fields]).select(
        df.agg(F.count(F.lit(1))).scalar().alias("_all"),
        F.element_at(names, F.col("i") + 1).alias("column_name"),
        F.lit("distinct").alias("statistic"),
        F.lit(None).cast("double").alias("numeric_result"),
        F.lit(None).cast("string").alias("string_result"),
        F.col("distinct").alias("counts"),
    )
    return (
        long.unionByName(distinct)
        .withColumn("rows_percentage", F.lit(100.0) * F.try_divide(F.col("counts").cast("double"), F.col("_all")))
        .drop("_all")
    )


def profile_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Profiles of several tables with their row count and the seconds the profile took."""
    parts = []
    for name, df in tables.items():
        start = time.monotonic()
        rows = profile_table(df).collect()  # statistics times columns, not data
        seconds = time.monotonic() - start
        result = df.sparkSession.createDataFrame(
            rows,
            "column_name string, statistic string, numeric_result double, string_result string, counts long, rows_percentage double",
        )
        total = max((r["counts"] for r in rows if r["statistic"] == "rows"), default=0)
        parts.append(
            result.select(
                F.lit(name).alias("table_name"),
                F.lit(total).cast("long").alias("rows"),
                F.lit(seconds).alias("profile_seconds"),
                "*",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def emptiness_ranking(df: DataFrame) -> DataFrame:
    """Percent of missing values per column, emptiest first."""
    return (
        profile_table(df)
        .where("statistic = 'emptiness'")
        .select("column_name", F.col("rows_percentage").alias("pct"))
        .orderBy(F.col("pct").desc(), "column_name")
    )


def data_status(df: DataFrame) -> DataFrame:
    """Zeros, missing, infinite, type, distinct values and their share, per column."""
    aggs, rows = [F.count(F.lit(1)).alias("_all")], []
    for i, field in enumerate(df.schema.fields):
        c = F.col(field.name)
        number = isinstance(field.dataType, T.NumericType)
        infinite = isinstance(field.dataType, (T.DoubleType, T.FloatType))
        aggs += [
            (F.count_if(c == 0) if number else F.lit(0)).cast("long").alias(f"_z{i}"),
            F.count_if(c.isNull()).alias(f"_m{i}"),
            (F.count_if(F.abs(c) == F.lit(float("inf"))) if infinite else F.lit(0)).cast("long").alias(f"_i{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(field.name).alias("variable"),
                F.col(f"_z{i}").alias("zeros"),
                F.col(f"_m{i}").alias("missing"),
                F.col(f"_i{i}").alias("infinite"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_all"),
                F.lit(i).alias("i"),
            )
        )
    status = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    unique = distinct_counts(df, [f.name for f in df.schema.fields]).withColumnRenamed("distinct", "unique")
    return (
        status.join(unique, "i")
        .withColumn("unique_ratio", F.try_divide(F.col("unique").cast("double"), F.col("_all")))
        .drop("i", "_all")
    )


def column_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, type, nullability and non-missing count of every column, with the rows of its table."""
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        rows = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(i).alias("position"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.nullable).alias("nullable"),
                F.col(f"_{i}").alias("present"),
            )
            for i, f in enumerate(fields, 1)
        ]
        counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(f.name).alias(f"_{i}") for i, f in enumerate(fields, 1)])
        parts.append(
            counts.select(F.lit(name).alias("table_name"), "rows", F.explode(F.array(*rows)).alias("c")).select(
                "table_name", "rows", "c.*"
            )
        )
    return reduce(DataFrame.unionByName, parts)
