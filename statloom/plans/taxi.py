"""Taxi trips: plausibility and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statloom.functions.scalars import great_circle_miles
from statloom.operators.clean import split_bad_rows


def keep_plausible(trips: DataFrame) -> DataFrame:
    """Trips with possible amounts, distances and times; a trip must not end before it starts."""
    c = F.col
    rules = [
        c("tip_amount") < 0,
        c("total_amount") < 0,
        c("total_amount") > 200,
        c("trip_distance") < 0,
        c("tip_amount") > c("total_amount"),
        c("pickup") > c("dropoff"),
        c("trip_time_in_secs") < 1,
        c("trip_time_in_secs") > 20000,
    ]
    return split_bad_rows(trips, rules)[0]


def trip_features(trips: DataFrame) -> DataFrame:
    """Model columns with the direct distance between the end points."""
    ends = [F.col(c).cast("double") for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")]
    return trips.select(
        "medallion",
        "payment_type",
        "tipped",
        "fare_amount",
        "passenger_count",
        "trip_time_in_secs",
        "trip_distance",
        great_circle_miles(*ends).alias("direct_distance"),
    )
