"""Missing values, outliers, bins and scaling."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.catalog.sampling import unit
from statloom.operators import bins as B, clean as C, scale as X
from statloom.operators.sampling import train_test_split

P, T_, R = cte("passengers"), cte("trips"), cte("readings")


@query(
    "c1_p15_fill_constant",
    P
    + """SELECT passenger_id, coalesce(embarked, 'S') AS embarked, CASE WHEN embarked IS NULL THEN 1 ELSE 0 END AS embarked_is_missing,
    coalesce(age, 0) AS age, CASE WHEN age IS NULL THEN 1 ELSE 0 END AS age_is_missing FROM passengers""",
)
def _(t: Tables):
    rows = t.passengers.select("passenger_id", "embarked", "age")
    return C.fill_constant(rows, {"embarked": "S", "age": 0}, flag_suffix="_is_missing")


@query(
    "c2_fill_group_median",
    P
    + """SELECT passenger_id, sex, coalesce(age, quantile_disc(age, 0.5) OVER (PARTITION BY sex)) AS age FROM passengers""",
)
def _(t: Tables):
    return C.fill_group_median(t.passengers.select("passenger_id", "sex", "age"), "age", ["sex"])


@query(
    "c3_fill_two_key_median",
    P
    + """SELECT passenger_id, CAST(trunc(coalesce(age, floor(quantile_cont(age, 0.5) OVER (PARTITION BY sex, pclass) / 0.5 + 0.5) * 0.5)) AS INT) AS age
    FROM passengers""",
)
def _(t: Tables):
    rows = t.passengers.select("passenger_id", "sex", "pclass", "age")
    filled = C.fill_group_median(rows, "age", ["sex", "pclass"], discrete=False, round_half=True)
    return filled.select("passenger_id", F.col("age").cast("int").alias("age"))


@query(
    "c4_fill_mode_and_median",
    P
    + """SELECT passenger_id, coalesce(embarked, (SELECT embarked FROM passengers WHERE embarked IS NOT NULL GROUP BY 1
      ORDER BY count(*) DESC, 1 LIMIT 1)) AS embarked,
    round(coalesce(fare, (SELECT quantile_cont(fare, 0.5) FROM passengers)), 6) AS fare FROM passengers""",
)
def _(t: Tables):
    rows = C.fill_mode(t.passengers, "embarked")
    return rounded(C.fill_median(rows, "fare").select("passenger_id", "embarked", "fare"))


@query("c5_drop_missing", P + "SELECT passenger_id, survived, age FROM passengers WHERE survived IS NOT NULL AND age IS NOT NULL")
def _(t: Tables):
    return t.passengers.dropna(subset=["survived", "age"]).select("passenger_id", "survived", "age")


_OUT = (
    T_
    + """, s AS (SELECT avg(trip_distance) AS m1, stddev_samp(trip_distance) AS d1, avg(total_amount) AS m2, stddev_samp(total_amount) AS d2,
       avg(tip_amount) AS m3, stddev_samp(tip_amount) AS d3 FROM trips),
    f AS (SELECT trips.*, CASE WHEN abs(trip_distance - m1) > 1.5 * d1 THEN concat('[trip_distance] outside (',
        CAST(round(m1 - 1.5 * d1) AS BIGINT), ', ', CAST(round(m1 + 1.5 * d1) AS BIGINT), ')') END AS o1,
      CASE WHEN abs(total_amount - m2) > 1.5 * d2 THEN concat('[total_amount] outside (',
        CAST(round(m2 - 1.5 * d2) AS BIGINT), ', ', CAST(round(m2 + 1.5 * d2) AS BIGINT), ')') END AS o2,
      CASE WHEN abs(tip_amount - m3) > 1.5 * d3 THEN concat('[tip_amount] outside (',
        CAST(round(m3 - 1.5 * d3) AS BIGINT), ', ', CAST(round(m3 + 1.5 * d3) AS BIGINT), ')') END AS o3 FROM trips, s) """
)
_COLUMNS = ["trip_distance", "total_amount", "tip_amount"]


@query("c7_mark_outliers", _OUT + "SELECT nullif(concat_ws('; ', o1, o2, o3), '') AS outlier, count(*) AS n FROM f GROUP BY 1")
def _(t: Tables):
    return C.mark_outliers(t.trips, _COLUMNS, 1.5).groupBy("outlier").agg(F.count("*").alias("n"))


@query(
    "c8_remove_and_clip_outliers",
    _OUT
    + """SELECT medallion, round(CASE WHEN o1 IS NOT NULL AND trip_distance > 9 THEN 9.0 ELSE trip_distance END, 6) AS trip_distance, round(total_amount, 6) AS total_amount
    FROM f WHERE NOT (o1 IS NOT NULL AND o2 IS NOT NULL)""",
)
def _(t: Tables):
    marked = C.mark_outliers(t.trips, _COLUMNS, 1.5)
    kept = C.drop_outliers(marked, ["trip_distance", "total_amount"])
    clipped = C.clip_outliers(kept, "trip_distance", 9)
    return rounded(clipped.select("medallion", "trip_distance", "total_amount"))


@query(
    "b1_equal_width_bins",
    P
    + """, l AS (SELECT CAST(CAST(trunc(min(fare)) AS BIGINT) AS DECIMAL(18,2)) AS lo,
      CAST((max(fare) - min(fare)) / 6 AS DECIMAL(18,2)) AS w FROM passengers),
    b AS (SELECT CASE """
    + " ".join(
        f"""WHEN fare >= CAST(lo + {i} * w AS DOUBLE) AND fare < CAST(lo + {i + 1} * w AS DOUBLE)
        THEN concat(CAST(lo + {i} * w AS DECIMAL(18,2)), ' - ', CAST(lo + {i + 1} * w AS DECIMAL(18,2)))"""
        for i in range(5)
    )
    + """ ELSE concat(CAST(lo + 5 * w AS DECIMAL(18,2)), ' + ') END AS bin FROM passengers, l)
    SELECT bin, count(*) AS cnt FROM b GROUP BY 1""",
)
def _(t: Tables):
    binned = B.equal_width_bins(t.passengers.select("fare"), "fare", 6, whole_start=True)
    return binned.groupBy("bin").agg(F.count("*").alias("cnt"))


@query(
    "b2_equal_height_bins",
    P
    + """SELECT bin, min(fare) AS min, max(fare) AS max, count(*) AS cnt FROM
    (SELECT fare, CAST(ntile(6) OVER (ORDER BY fare NULLS FIRST) AS INT) AS bin FROM passengers) GROUP BY 1""",
)
def _(t: Tables):
    return B.bin_summary(B.equal_height_bins(t.passengers.select("fare"), "fare", 6), "fare")


@query(
    "b3_custom_bins",
    P
    + """SELECT CASE WHEN fare <= 8 THEN 0 WHEN fare <= 14.5 THEN 1 WHEN fare <= 35 THEN 2 ELSE 3 END AS bin, count(*) AS cnt
    FROM passengers GROUP BY 1""",
)
def _(t: Tables):
    return t.passengers.groupBy(B.custom_bins(F.col("fare"), [8, 14.5, 35]).alias("bin")).agg(F.count("*").alias("cnt"))


@query(
    "x1_min_max",
    R + "SELECT event_id, round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()), 6) AS scaled FROM readings",
)
def _(t: Tables):
    return rounded(X.min_max(t.readings, "value", "scaled").select("event_id", "scaled"))


@query(
    "x2_quartile_scale",
    R
    + """, q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM readings)
    SELECT event_id, round((value - a) / (b - a), 6) AS scaled FROM readings, q""",
)
def _(t: Tables):
    return rounded(X.quartile_scale(t.readings, "value", "scaled").select("event_id", "scaled"))


@query(
    "x3_x4_sigmoid_log",
    R
    + """SELECT event_id, round(1 / (1 + pow(2.718281828, -value)), 6) AS sigmoid, round(ln(value), 6) AS loge, round(log10(value), 6) AS log10
    FROM readings""",
)
def _(t: Tables):
    loge, log10 = X.log_scale(F.col("value"))
    return rounded(
        t.readings.select("event_id", X.sigmoid_scale(F.col("value")).alias("sigmoid"), loge.alias("loge"), log10.alias("log10"))
    )


@query(
    "x5_standardise",
    R + "SELECT event_id, round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS scaled FROM readings",
)
def _(t: Tables):
    return rounded(X.standardise(t.readings, "value", "scaled").select("event_id", "scaled"))


@query(
    "x6_fit_and_apply_min_max",
    cte("sensors")
    + f""", tr AS (SELECT * FROM sensors WHERE {unit('event_id')} < 0.5),
    r AS (SELECT min(s1) AS l1, max(s1) AS h1, min(s2) AS l2, max(s2) AS h2 FROM tr)
    SELECT event_id, round((s1 - l1) / (h1 - l1), 6) AS s1, round((s2 - l2) / (h2 - l2), 6) AS s2 FROM sensors, r""",
)
def _(t: Tables):
    train, _ = train_test_split(t.sensors, "event_id", 50)
    model = X.fit_min_max(train, ["s1", "s2", "s3"])
    return rounded(model.transform(t.sensors.select("event_id", "s1", "s2", "s3")))
