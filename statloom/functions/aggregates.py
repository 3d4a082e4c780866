"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pearson(a: str, b: str) -> Column:
    """Correlation over complete pairs; NULL, not an error, for a constant column."""
    x, y = F.col(a), F.col(b)
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), spread)
