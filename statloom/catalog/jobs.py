"""Domain jobs."""

import math

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.plans import benford, customers, passengers, taxi

I, P = cte("invoices"), cte("passengers")

_TERM = " + ".join(f"(digit{d} - {math.log10(1 + 1 / d)!r} * n) ** 2 / ({math.log10(1 + 1 / d)!r} * n)" for d in range(1, 10))
DIGITS = (
    I
    + """, d AS (SELECT vendor, CAST(floor(amount / 10 ** floor(log10(amount))) AS INT) AS d FROM invoices),
    w AS (SELECT vendor, count(*) AS n, """
    + ", ".join(f"count(*) FILTER (d = {d}) AS digit{d}" for d in range(1, 10))
    + f""" FROM d GROUP BY 1), x AS (SELECT *, {_TERM} AS chi_squared FROM w),
    v AS (SELECT *, exp(-chi_squared / 2) * (1 + chi_squared / 2 + (chi_squared / 2) ** 2 / 2 + (chi_squared / 2) ** 3 / 6) AS p_value FROM x) """
)
NAMES = ", ".join(f"digit{d}" for d in range(1, 10))


@query("f1_vendor_digits", DIGITS + f"SELECT vendor, {NAMES}, round(chi_squared, 4) AS chi_squared, round(p_value, 4) AS p_value FROM v")
def _(t: Tables):
    return rounded(benford.vendor_digits(t.invoices), 4)


@query("f1_one_vendor_digits", DIGITS + f"SELECT vendor, {NAMES}, round(chi_squared, 4) AS chi_squared, round(p_value, 4) AS p_value FROM v WHERE vendor = 7")
def _(t: Tables):
    return rounded(benford.vendor_digits(t.invoices, vendor=7), 4)


@query("f2_suspects", DIGITS + f"SELECT vendor, {NAMES}, round(chi_squared, 4) AS chi_squared, round(p_value, 4) AS p_value FROM v WHERE p_value < 0.1")
def _(t: Tables):
    return rounded(benford.suspects(t.invoices, 0.1), 4)


@query(
    "f3_digit_distribution",
    DIGITS
    + " UNION ALL ".join(
        f"SELECT vendor, {d} AS digit, digit{d} AS n, round(digit{d} / n, 6) AS share, round({math.log10(1 + 1 / d)!r}::DOUBLE, 6) AS expected_share FROM v"
        for d in range(1, 10)
    ),
)
def _(t: Tables):
    return rounded(benford.digit_distribution(t.invoices))


@query(
    "f4_fraud_report",
    DIGITS
    + f""", s AS (SELECT vendor, {NAMES}, 1 - p_value AS percentage FROM v WHERE p_value < 0.1)
    SELECT vendor, {NAMES}, round(percentage, 4) AS percentage, round(avg(percentage) OVER (), 4) AS average,
    (SELECT count(DISTINCT vendor) FROM invoices) AS total_vendors FROM s""",
)
def _(t: Tables):
    return rounded(benford.fraud_report(t.invoices, 0.1), 4)


@query(
    "f5_trip_features",
    cte("trips")
    + """, r AS (SELECT *, pickup_lat / 57.2958 AS a, pickup_lon / 57.2958 AS b, dropoff_lat / 57.2958 AS c, dropoff_lon / 57.2958 AS d FROM trips),
    k AS (SELECT *, round(sin(a) * sin(c) + cos(a) * cos(c) * cos(d - b), 10) AS k FROM r)
    SELECT payment_type, tipped, count(*) AS trips, round(avg(passenger_count), 4) AS passengers, round(sum(fare_amount), 2) AS fare,
      round(avg(CASE WHEN k = 0 THEN 0 ELSE 3958.75 * atan(sqrt(greatest(1 - k * k, 0)) / k) END), 4) AS direct_distance FROM k GROUP BY ALL""",
)
def _(t: Tables):
    rows = taxi.trip_features(t.trips)
    out = rows.groupBy("payment_type", "tipped").agg(
        F.count("*").alias("trips"),
        F.avg("passenger_count").alias("passengers"),
        F.sum("fare_amount").alias("fare"),
        F.avg("direct_distance").alias("direct_distance"),
    )
    return rounded(rounded(out, 4, "passengers", "direct_distance"), 2, "fare")


@query(
    "f6_passenger_view",
    P
    + """, l AS (SELECT *, substr(name, strpos(name, ',') + 2, strpos(name, '.') - strpos(name, ',') - 2) AS w,
      quantile_disc(age, 0.5) OVER (PARTITION BY sex) AS med FROM passengers WHERE survived IS NOT NULL)
    SELECT passenger_id, CASE WHEN w IN ('Mme', 'Mr') THEN 'Mr' WHEN w IN ('Mlle', 'Ms', 'Miss') THEN 'Miss' WHEN w = 'Mrs' THEN 'Mrs'
      WHEN w = 'Master' THEN 'Master' ELSE 'Rare' END AS title, CASE embarked WHEN 'S' THEN 0 WHEN 'C' THEN 1 ELSE 2 END AS embarked,
      round(fare, 6) AS fare, pclass, sex, coalesce(age, med) AS age, sibsp + parch + 1 AS family_size,
      CASE WHEN sibsp + parch = 0 THEN 1 ELSE 0 END AS is_alone, survived FROM l""",
)
def _(t: Tables):
    return rounded(passengers.prepared_view(t.passengers))


@query(
    "f6_passenger_model_input",
    P
    + """, m AS (SELECT *, regexp_extract(name, ' ([A-Za-z]+)\\.', 1) AS w, quantile_cont(age, 0.5) OVER (PARTITION BY sex, pclass) AS med FROM passengers),
    c AS (SELECT embarked AS e FROM passengers WHERE embarked IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    f AS (SELECT quantile_cont(fare, 0.5) AS f FROM passengers)
    SELECT passenger_id, CASE WHEN w = 'Mr' THEN 1 WHEN w IN ('Mlle', 'Ms', 'Miss') THEN 2 WHEN w IN ('Mrs', 'Mme') THEN 3 WHEN w = 'Master' THEN 4 ELSE 0 END AS title,
      CASE coalesce(embarked, e) WHEN 'S' THEN 0 WHEN 'C' THEN 1 ELSE 2 END AS embarked,
      CASE WHEN coalesce(fare, f) <= 7.91 THEN 0 WHEN coalesce(fare, f) <= 14.454 THEN 1 WHEN coalesce(fare, f) <= 31 THEN 2 ELSE 3 END AS fare,
      pclass, CASE sex WHEN 'female' THEN 1 ELSE 0 END AS sex, CAST(trunc(coalesce(age, floor(med / 0.5 + 0.5) * 0.5)) AS INT) AS age,
      CASE WHEN sibsp + parch = 0 THEN 1 ELSE 0 END AS is_alone, survived FROM m, c, f""",
)
def _(t: Tables):
    return passengers.model_input(t.passengers)


def return_lines(t: Tables):
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("amount"), returned.alias("returned")
    )
    return lines, t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"))


@query(
    "l20_return_profile",
    """WITH o AS (SELECT o_custkey AS customer, o_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS a, count(*) AS i,
      count(*) FILTER (l_returnflag = 'R') AS ir, sum(l_extendedprice) AS m, coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'R'), 0) AS mr
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    SELECT customer, round(sum(a) / count(*), 6) AS order_ratio, round(sum(ir) / sum(i), 6) AS items_ratio,
      round(sum(mr) / sum(m), 6) AS monetary_ratio, CAST(sum(a) AS DOUBLE) AS frequency FROM o GROUP BY 1""",
)
def _(t: Tables):
    return rounded(customers.return_profile(*return_lines(t)))
