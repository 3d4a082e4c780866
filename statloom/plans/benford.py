"""First-digit screening of vendor invoices."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions.probability import even_chi2_p_value
from statloom.functions.scalars import leading_digit
from statloom.session import materialise

DIGITS = range(1, 10)
EXPECTED = {d: math.log10(1 + 1 / d) for d in DIGITS}


def digit_name(d: int) -> str:
    return f"digit{d}"


def vendor_digits(invoices: DataFrame, vendor=None) -> DataFrame:
    """Counts per first digit, chi-square against the expected shares and p-value, per vendor.

    Amounts without a first digit from 1 to 9 are left out.  ``vendor`` restricts
    the result to one vendor.
    """
    rows = invoices if vendor is None else invoices.where(F.col("vendor") == F.lit(vendor))
    digit = leading_digit(F.col("amount"))
    counted = (
        rows.withColumn("_d", digit)
        .where(F.col("_d").between(1, 9))
        .groupBy("vendor")
        .agg(*[F.count_if(F.col("_d") == d).alias(digit_name(d)) for d in DIGITS])
    )
    total = sum((F.col(digit_name(d)) for d in DIGITS), F.lit(0))

    def term(d: int) -> Column:
        wanted = F.lit(EXPECTED[d]) * F.col("_n")
        return F.pow(F.col(digit_name(d)) - wanted, F.lit(2.0)) / wanted

    statistic = sum((term(d) for d in DIGITS), F.lit(0.0))
    return (
        counted.withColumn("_n", total)
        .withColumn("chi_squared", statistic)
        .withColumn("p_value", even_chi2_p_value(F.col("chi_squared"), len(DIGITS) - 1))
        .drop("_n")
    )


def suspects(invoices: DataFrame, p: float = 0.1) -> DataFrame:
    """Vendors whose digits are unlikely, least likely first."""
    return vendor_digits(invoices).where(F.col("p_value") < p).orderBy("p_value", "vendor")


def digit_distribution(invoices: DataFrame, vendor=None) -> DataFrame:
    """Rows (vendor, digit, n, share, expected share) for charts."""
    wide = vendor_digits(invoices, vendor)
    pairs = F.array(
        *[
            F.struct(F.lit(d).alias("digit"), F.col(digit_name(d)).alias("n"), F.lit(EXPECTED[d]).alias("expected_share"))
            for d in DIGITS
        ]
    )
    total = sum((F.col(digit_name(d)) for d in DIGITS), F.lit(0))
    return wide.select("vendor", total.alias("_n"), F.explode(pairs).alias("p")).select(
        "vendor", "p.digit", "p.n", (F.col("p.n") / F.col("_n")).alias("share"), "p.expected_share"
    )


def fraud_report(invoices: DataFrame, p: float = 0.1) -> DataFrame:
    """Suspects by 1 - p with the average of that figure and the number of vendors screened."""
    # the rows and their average come from one table
    found = materialise(vendor_digits(invoices).where(F.col("p_value") < p))
    share = F.lit(1.0) - F.col("p_value")
    average = found.agg(F.avg(share).alias("a")).scalar()
    vendors = invoices.agg(F.countDistinct("vendor").alias("n")).scalar()
    return (
        found.select("vendor", *[digit_name(d) for d in DIGITS], share.alias("percentage"))
        .withColumns({"average": average, "total_vendors": vendors})
        .orderBy(F.col("percentage").desc(), "vendor")
    )
