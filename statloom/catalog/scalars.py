"""Projections, filters and scalar expressions."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.functions import scalars as S

P, T_, R = cte("passengers"), cte("trips"), cte("readings")


@query("p1_project", "SELECT o_orderkey AS id, o_totalprice AS price, 0 AS flagged FROM orders")
def _(t: Tables):
    o = t.orders.withColumn("flagged", F.lit(0)).drop("o_orderdate", "o_custkey")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), "flagged")


@query(
    "p2_filters",
    """SELECT p_partkey, p_brand FROM part WHERE p_size BETWEEN 5 AND 20 AND p_type IN ('ECONOMY', 'STANDARD')
    AND p_name LIKE '%ring%' AND p_retailprice IS NOT NULL AND p_brand <> 'Brand#1'""",
)
def _(t: Tables):
    return t.part.where(
        F.col("p_size").between(5, 20)
        & F.col("p_type").isin("ECONOMY", "STANDARD")
        & F.col("p_name").like("%ring%")
        & F.col("p_retailprice").isNotNull()
        & (F.col("p_brand") != "Brand#1")
    ).select("p_partkey", "p_brand")


@query(
    "p3_bad_rows",
    T_
    + """SELECT payment_type, count(*) AS kept, round(sum(total_amount), 2) AS total FROM trips WHERE NOT (
    coalesce(tip_amount < 0, false) OR total_amount < 0 OR total_amount > 200 OR trip_distance < 0
    OR tip_amount > total_amount OR pickup > dropoff OR trip_time_in_secs < 1 OR trip_time_in_secs > 20000) GROUP BY 1""",
)
def _(t: Tables):
    from statloom.plans.taxi import keep_plausible

    kept = keep_plausible(t.trips).groupBy("payment_type").agg(F.count("*").alias("kept"), F.sum("total_amount").alias("total"))
    return rounded(kept, 2)


@query(
    "p4_title",
    P
    + """SELECT passenger_id, substr(name, strpos(name, ',') + 2, strpos(name, '.') - strpos(name, ',') - 2) AS title,
    regexp_extract(name, ' ([A-Za-z]+)\\.', 1) AS word FROM passengers""",
)
def _(t: Tables):
    name = F.col("name")
    return t.passengers.select("passenger_id", S.title_between(name).alias("title"), S.title_word(name).alias("word"))


@query(
    "p5_leading_digit",
    """SELECT l_orderkey, l_extendedprice, CAST(trunc(CASE WHEN l_extendedprice >= 100000 THEN l_extendedprice / 100000
    WHEN l_extendedprice >= 10000 THEN l_extendedprice / 10000 WHEN l_extendedprice >= 1000 THEN l_extendedprice / 1000
    WHEN l_extendedprice >= 100 THEN l_extendedprice / 100 WHEN l_extendedprice >= 10 THEN l_extendedprice / 10
    ELSE l_extendedprice END) AS BIGINT) AS digit, CAST(trunc(l_discount - l_quantity) AS BIGINT) AS negative FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_extendedprice",
        S.leading_digit(F.col("l_extendedprice")).alias("digit"),
        S.leading_digit(F.col("l_discount") - F.col("l_quantity")).alias("negative"),
    )


@query(
    "p6_great_circle_miles",
    T_
    + """, r AS (SELECT medallion, pickup_lat / 57.2958 AS a, pickup_lon / 57.2958 AS b, dropoff_lat / 57.2958 AS c,
      dropoff_lon / 57.2958 AS d FROM trips),
    k AS (SELECT medallion, round(sin(a) * sin(c) + cos(a) * cos(c) * cos(d - b), 10) AS k FROM r)
    SELECT medallion, count(*) AS trips, round(sum(CASE WHEN k = 0 THEN 0 ELSE 3958.75 * atan(sqrt(greatest(1 - k * k, 0)) / k) END), 3) AS miles
    FROM k GROUP BY 1""",
)
def _(t: Tables):
    miles = S.great_circle_miles(*[F.col(c) for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")])
    return rounded(t.trips.groupBy("medallion").agg(F.count("*").alias("trips"), F.sum(miles).alias("miles")), 3)


@query(
    "p7_arithmetic_features",
    P
    + """SELECT passenger_id, sibsp + parch + 1 AS family_size, CASE WHEN sibsp + parch = 0 THEN 1 ELSE 0 END AS is_alone,
    round(fare * age, 6) AS product, round(fare - age, 6) AS difference, fare > age AS is_larger FROM passengers""",
)
def _(t: Tables):
    fare, age = F.col("fare"), F.col("age")
    return rounded(
        t.passengers.select(
            "passenger_id",
            S.family_size(F.col("sibsp"), F.col("parch")).alias("family_size"),
            S.is_alone(F.col("sibsp"), F.col("parch")).alias("is_alone"),
            (fare * age).alias("product"),
            (fare - age).alias("difference"),
            (fare > age).alias("is_larger"),
        )
    )


@query(
    "p8_datetime_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(dayofyear(ts) AS INT) AS day_of_year, CAST(quarter(ts) AS INT) AS quarter,
    CAST(month(ts) AS INT) AS month,
    CAST(floor((dayofyear(ts) + dayofweek(date_trunc('year', ts)) - 1) / 7) + 1 AS INT) AS week,
    CAST(day(ts) AS INT) AS day, CAST(dayofweek(ts) + 1 AS INT) AS weekday,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, CASE WHEN hour(ts) >= 12 THEN 0 ELSE 1 END AS am,
    CAST(CASE WHEN hour(ts) > 12 THEN hour(ts) - 12 ELSE hour(ts) END AS INT) AS hour12, CAST(minute(ts) AS INT) AS minute,
    CAST(second(ts) AS INT) AS second FROM events""",
)
def _(t: Tables):
    return t.events.select("event_id", *[c.alias(n) for n, c in S.datetime_parts(F.col("ts")).items()])


@query(
    "p9_one_hot",
    P
    + """SELECT passenger_id, CASE WHEN embarked = 'S' THEN 1 ELSE 0 END AS southampton,
    CASE WHEN embarked = 'C' THEN 1 ELSE 0 END AS cherbourg, CASE WHEN embarked = 'Q' THEN 1 ELSE 0 END AS queenstown FROM passengers""",
)
def _(t: Tables):
    names = {"S": "southampton", "C": "cherbourg", "Q": "queenstown"}
    return t.passengers.select("passenger_id", *[c.alias(n) for n, c in S.indicators(F.col("embarked"), names).items()])


@query(
    "p10_label_encode",
    P
    + """SELECT passenger_id, CASE embarked WHEN 'S' THEN 0 WHEN 'C' THEN 1 ELSE 2 END AS embarked_code,
    CASE sex WHEN 'female' THEN 1 WHEN 'male' THEN 0 END AS sex_code FROM passengers""",
)
def _(t: Tables):
    return t.passengers.select(
        "passenger_id",
        S.encode(F.col("embarked"), {"S": 0, "C": 1}, 2).alias("embarked_code"),
        S.encode(F.col("sex"), {"female": 1, "male": 0}).alias("sex_code"),
    )


@query(
    "p11_generalise",
    P
    + """, t AS (SELECT regexp_extract(name, ' ([A-Za-z]+)\\.', 1) AS w FROM passengers)
    SELECT CASE WHEN w IN ('Mme', 'Mr') THEN 'Mr' WHEN w IN ('Mlle', 'Ms', 'Miss') THEN 'Miss' WHEN w = 'Mrs' THEN 'Mrs'
      WHEN w = 'Master' THEN 'Master' ELSE 'Rare' END AS title,
      CASE WHEN w = 'Mr' THEN 1 WHEN w IN ('Mlle', 'Ms', 'Miss') THEN 2 WHEN w IN ('Mrs', 'Mme') THEN 3 WHEN w = 'Master' THEN 4
      ELSE 0 END AS code, count(*) AS cnt FROM t GROUP BY 1, 2""",
)
def _(t: Tables):
    from statloom.plans.passengers import TITLE_CODES, TITLE_GROUPS, TITLE_GROUPS_SHORT

    word = S.title_word(F.col("name"))
    short = S.generalise(word, TITLE_GROUPS_SHORT, "Rare")
    code = S.encode(S.generalise(word, TITLE_GROUPS, keep=True), TITLE_CODES, 0)
    return t.passengers.groupBy(short.alias("title"), code.alias("code")).agg(F.count("*").alias("cnt"))


@query(
    "p12_level_renaming",
    """SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END AS flag,
    CASE l_linestatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def _(t: Tables):
    flag = S.encode(F.col("l_returnflag"), {"A": "accepted", "N": "none", "R": "returned"})
    status = S.encode(F.col("l_linestatus"), {"F": "filled", "O": "open"})
    return t.lineitem.groupBy(flag.alias("flag"), status.alias("status")).agg(F.count("*").alias("n"))


@query(
    "p14_rounding_units",
    T_ + "SELECT medallion, round(fare_amount) AS fare, trip_time_in_secs // 60 AS mins FROM trips",
)
def _(t: Tables):
    return t.trips.select(
        "medallion", F.round("fare_amount", 0).alias("fare"), S.integer_divide(F.col("trip_time_in_secs"), 60).alias("mins")
    )


@query(
    "p16_what_if_shift",
    cte("loans") + "SELECT id, round(int_rate + 9, 6) AS int_rate FROM loans",
)
def _(t: Tables):
    from statloom.plans.loans import what_if

    return rounded(what_if(t.loans, {"int_rate": 9.0}).select("id", F.col("int_rate").cast("double")))


@query(
    "p17_threshold_class",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount <= 0.04 THEN 0 ELSE 1 END AS predicted FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", S.threshold_class(F.col("l_discount"), 0.04).alias("predicted"))


@query("p18_sigmoid", "SELECT c_custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 6) AS probability FROM customer")
def _(t: Tables):
    return rounded(t.customer.select("c_custkey", S.sigmoid(F.col("c_acctbal") / 1000).alias("probability")))


@query(
    "p19_text_functions",
    """SELECT p_partkey, concat('Part V', p_partkey) AS label, repeat('*', p_size)[1:50] AS bar, left(p_name, 5) AS head FROM part""",
)
def _(t: Tables):
    return t.part.select(
        "p_partkey",
        F.concat(F.lit("Part V"), F.col("p_partkey").cast("string")).alias("label"),
        S.text_bar(F.col("p_size")).alias("bar"),
        F.substring("p_name", 1, 5).alias("head"),
    )


@query("p20_select_matching", "SELECT event_id, s1, s2, s3 FROM (SELECT event_id, value AS s1, CAST(event_id % 13 AS DOUBLE) AS s2, CAST(5 AS DOUBLE) AS s3 FROM events)")
def _(t: Tables):
    rows = t.sensors
    return rows.select("event_id", *S.select_matching(rows, pattern=r"^s\d+$", types=["double"]))


@query(
    "p21_casts",
    R + "SELECT event_id, TRY_CAST(kind AS INT) AS not_a_number, CAST(trunc(value) AS INT) AS whole, CAST(user_id AS VARCHAR) AS factor FROM readings",
)
def _(t: Tables):
    return t.readings.select(
        "event_id",
        F.col("kind").try_cast("int").alias("not_a_number"),
        F.col("value").cast("int").alias("whole"),
        F.col("user_id").cast("string").alias("factor"),
    )
