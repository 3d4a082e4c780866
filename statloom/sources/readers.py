"""Reading delimited files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statloom.operators.ordered import row_index


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str,
    null_token: str = "",
    header: bool = True,
    skip_prefix: str | None = None,
    bad_record: str | None = None,
) -> DataFrame:
    """Typed scan; ``skip_prefix`` names lines (such as a notes line) to leave out.

    A value that does not fit its type becomes NULL; ``bad_record`` names a column that then
    holds the line, or is ``"fail"`` to stop at the first such line.
    """
    reader = spark.read.schema(schema).option("header", header).option("nullValue", null_token)
    if bad_record == "fail":
        reader = reader.option("mode", "FAILFAST")
    elif bad_record is not None:
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        kept = StructType([*fields.fields, StructField(bad_record, StringType())])
        reader = reader.schema(kept).option("columnNameOfCorruptRecord", bad_record)
    if skip_prefix is not None:
        reader = reader.option("comment", skip_prefix)
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def read_headerless(spark: SparkSession, path: str, names: Sequence[str], null_token: str = "") -> DataFrame:
    """Text columns named by position."""
    schema = ", ".join(f"`{n}` STRING" for n in names)
    return read_csv(spark, path, schema, null_token, header=False)


def scan(source: DataFrame, columns: Sequence[str | Column], where: str | Column | None = None) -> DataFrame:
    """Selected columns of selected rows; both reach the file scan."""
    rows = source if where is None else source.where(where)
    return rows.select(*columns)


def load_staging(
    spark: SparkSession, paths: Sequence[str], schema: StructType | str, null_token: str, zero_fill: Sequence[str]
) -> DataFrame:
    """All files through the same cleaning step, with the name of the file a row came from."""
    rows = read_csv(spark, paths, schema, null_token)
    return rows.na.fill(0, list(zero_fill)).withColumn("source_file", F.input_file_name())


def number_rows(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Row numbers that do not depend on the layout of the files."""
    return row_index(df, [], order, name)
