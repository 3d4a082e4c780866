"""Scalar expressions over columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MILES_RADIUS = 3958.75  # fixed value
DEGREES_PER_RADIAN = 57.2958  # fixed value
SIGMOID_BASE = 2.718281828  # fixed value


def title_between(name: Column) -> Column:
    """Text between ``, `` and the next ``.``; NULL when either is absent."""
    return F.nullif(F.regexp_extract(name, r",.([^.]*)\.", 1), F.lit(""))


def title_word(name: Column) -> Column:
    """First word of letters that follows a blank and ends in a dot."""
    return F.nullif(F.regexp_extract(name, r" ([A-Za-z]+)\.", 1), F.lit(""))


def truncate(value: Column) -> Column:
    """Toward zero."""
    return F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value))


def leading_digit(amount: Column) -> Column:
    """First digit of amounts from 10 up to 10^10; smaller amounts are only truncated.

    Zero and negative amounts keep their truncated value and amounts of 10^10 or
    more keep more than one digit.
    """
    a = amount.cast("double")
    step = F.when(a < 10, F.lit(1.0))
    for power in range(1, 9):
        step = step.when(a < 10.0 ** (power + 1), F.lit(10.0**power))
    return truncate(a / step.otherwise(F.lit(1e9))).cast("long")


def great_circle_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance from the cosine of the central angle, held to ten decimals; 0 when the cosine is 0."""
    r = [c / F.lit(DEGREES_PER_RADIAN) for c in (lat1, lon1, lat2, lon2)]
    cosine = F.sin(r[0]) * F.sin(r[2]) + F.cos(r[0]) * F.cos(r[2]) * F.cos(r[3] - r[1])
    c = F.round(cosine, 10)
    # rounding may leave a cosine just over 1
    rest = F.greatest(F.lit(1.0) - c * c, F.lit(0.0))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.lit(MILES_RADIUS) * F.atan(F.sqrt(rest) / c))


def datetime_parts(ts: Column) -> dict[str, Column]:
    """Calendar features; weeks start on Sunday and week 1 holds January 1."""
    weekday = F.dayofweek(ts)
    first = F.dayofweek(F.trunc(ts, "year"))
    hour = F.hour(ts)
    return {
        "year": F.year(ts),
        "day_of_year": F.dayofyear(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "week": (F.floor((F.dayofyear(ts) + first - 2) / 7) + 1).cast("int"),
        "day": F.dayofmonth(ts),
        "weekday": weekday,
        "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
        "am": F.when(hour >= 12, 0).otherwise(1),
        "hour12": F.when(hour > 12, hour - 12).otherwise(hour),
        "minute": F.minute(ts),
        "second": F.second(ts),
    }


def indicators(col: Column, names: dict[str, str]) -> dict[str, Column]:
    """One 0/1 column per value; NULL gives 0 everywhere. ``names`` maps value to column."""
    return {out: F.when(col == F.lit(value), 1).otherwise(0) for value, out in names.items()}


def encode(col: Column, mapping: dict, default=None) -> Column:
    """Value to code; unmapped values and NULL take ``default``."""
    result = None
    for value, code in mapping.items():
        result = (F if result is None else result).when(col == F.lit(value), F.lit(code))
    return result.otherwise(F.lit(default))


def generalise(col: Column, groups: dict[str, Sequence[str]], rest: str | None = None, keep: bool = False) -> Column:
    """Merge levels into groups; others become ``rest`` or, with ``keep``, stay."""
    result = None
    for group, members in groups.items():
        result = (F if result is None else result).when(col.isin(*members), F.lit(group))
    return result.otherwise(col if keep else F.lit(rest))


def integer_divide(a: Column, b: int) -> Column:
    """Truncating division of whole numbers."""
    return truncate(a / F.lit(b)).cast("long")


def threshold_class(probability: Column, cut: float) -> Column:
    """1 above the cut; the cut itself belongs to 0."""
    return F.when(probability <= cut, 0).otherwise(1)


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def family_size(siblings: Column, parents: Column) -> Column:
    return siblings + parents + 1


def is_alone(siblings: Column, parents: Column) -> Column:
    return F.when(siblings + parents == 0, 1).otherwise(0)


def nearest_half(value: Column) -> Column:
    """Nearest multiple of 0.5, halves of that step upward."""
    return F.floor(value / F.lit(0.5) + F.lit(0.5)) * F.lit(0.5)


def text_bar(length: Column, width: int = 50, mark: str = "*") -> Column:
    """Row of marks cut at ``width``."""
    return F.substring(F.repeat(F.lit(mark), length.cast("int")), 1, width)


def select_matching(df: DataFrame, pattern: str | None = None, types: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Column names by regular expression, by type name and without listed ones."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in exclude
        and (pattern is None or re.search(pattern, f.name))
        and (not types or f.dataType.simpleString() in types)
    ]
