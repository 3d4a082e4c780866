"""Customer segments from their returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RATIOS = ["order_ratio", "items_ratio", "monetary_ratio", "frequency"]


def return_profile(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per customer the share of orders, items and money returned, and the number of orders with returns.

    ``lines`` holds (order_id, amount, returned 0/1), ``orders`` (order_id, customer).
    Lines are summed per order before the join, which then needs no further shuffle
    of them, and no distinct count is needed.
    """
    sums = lines.groupBy("order_id").agg(
        F.max("returned").alias("any_return"),
        F.count(F.lit(1)).alias("items"),
        F.sum("returned").alias("items_returned"),
        F.sum("amount").alias("amount"),
        F.sum(F.col("amount") * F.col("returned")).alias("amount_returned"),
    )
    return orders.join(sums, "order_id").groupBy("customer").agg(
        (F.sum("any_return") / F.count(F.lit(1))).alias("order_ratio"),
        (F.sum("items_returned") / F.sum("items")).alias("items_ratio"),
        F.coalesce(F.try_divide(F.sum("amount_returned"), F.sum("amount")), F.lit(0.0)).alias("monetary_ratio"),
        F.sum("any_return").cast("double").alias("frequency"),
    )


def campaign_list(customers: DataFrame, clusters: DataFrame, cluster: int) -> DataFrame:
    """Customers of one segment."""
    wanted = clusters.where(F.col("cluster") == cluster).select("customer")
    return customers.join(wanted, F.col("c_custkey") == F.col("customer")).drop("customer")
