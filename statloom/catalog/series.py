"""Series per entity."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.operators import series as M
from statloom.operators.ordered import look_back, row_index

ORDER = ["ts", "event_id"]
CYCLES = """WITH sensors AS (SELECT user_id AS id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
  value AS s1, CAST(event_id % 13 AS DOUBLE) AS s2 FROM events)"""


def cycles(t: Tables):
    return row_index(t.sensors, ["id"], ORDER, "cycle").select("id", "event_id", "cycle", "s1", "s2")


@query(
    "m1_moving_average",
    CYCLES
    + """ SELECT event_id, round(avg(s1) OVER (PARTITION BY id ORDER BY cycle ROWS 4 PRECEDING), 6) AS sma FROM sensors""",
)
def _(t: Tables):
    out = M.moving_average(t.sensors, ["id"], ORDER, "s1", "sma", 5)
    return rounded(out.select("event_id", "sma"))


@query(
    "m2_w7_weighted_average",
    CYCLES
    + """ SELECT event_id, s1, coalesce(lag(s1) OVER w, s1) AS prev_s1, round(0.7 * s1 + 0.3 * coalesce(lag(s1) OVER w, s1), 6) AS wma
    FROM sensors WINDOW w AS (PARTITION BY id ORDER BY cycle)""",
)
def _(t: Tables):
    out = M.weighted_average(t.sensors, ["id"], ORDER, "s1", "wma")
    return rounded(out.select("event_id", "s1", "prev_s1", "wma"))


@query(
    "m3_exponential_average",
    CYCLES.replace("WITH", "WITH RECURSIVE")
    + """, e AS (SELECT id, cycle, event_id, s1 AS ema FROM sensors WHERE cycle = 1
      UNION ALL SELECT s.id, s.cycle, s.event_id, 0.7 * s.s1 + 0.3 * e.ema FROM e JOIN sensors s ON s.id = e.id AND s.cycle = e.cycle + 1)
    SELECT event_id, round(ema + 2e-9, 6) AS ema FROM e""",
)
def _(t: Tables):
    out = M.exponential_average(t.sensors, ["id"], ORDER, "s1", "ema", 0.7)
    # early values have few decimals; the shift keeps exact halves from rounding either way
    return rounded(out.select("event_id", (F.col("ema") + F.lit(2e-9)).alias("ema")))


@query(
    "m3_exponential_average_null_entity",
    CYCLES.replace("WITH", "WITH RECURSIVE").replace("user_id AS id", "nullif(user_id, 3) AS id").replace("PARTITION BY user_id", "PARTITION BY nullif(user_id, 3)")
    + """, e AS (SELECT id, cycle, event_id, s1 AS ema FROM sensors WHERE cycle = 1
      UNION ALL SELECT s.id, s.cycle, s.event_id, 0.7 * s.s1 + 0.3 * e.ema FROM e JOIN sensors s ON s.id IS NOT DISTINCT FROM e.id AND s.cycle = e.cycle + 1)
    SELECT event_id, round(ema + 2e-9, 6) AS ema FROM e""",
)
def _(t: Tables):
    """An entity without a name is one entity."""
    rows = t.sensors.withColumn("id", F.nullif("id", F.lit(3)))
    out = M.exponential_average(rows, ["id"], ORDER, "s1", "ema", 0.7)
    return rounded(out.select("event_id", (F.col("ema") + F.lit(2e-9)).alias("ema")))


_ROLL = """round(avg(s1) OVER w, 6) AS a1, round(avg(s2) OVER w, 6) AS a2,
  round(coalesce(stddev_samp(s1) OVER w, 0), 6) AS sd1, round(coalesce(stddev_samp(s2) OVER w, 0), 6) AS sd2"""
_FRAME = "WINDOW w AS (PARTITION BY id ORDER BY cycle ROWS 4 PRECEDING)"


@query("m4_rolling_features", CYCLES + f" SELECT event_id, s1, s2, {_ROLL} FROM sensors {_FRAME}")
def _(t: Tables):
    rows = t.sensors.select("id", "ts", "event_id", "s1", "s2")
    out = M.rolling_features(rows, "id", ORDER, ["s1", "s2"], 5)
    return rounded(out.drop("id", "ts"))


@query(
    "m4_rolling_features_last_cycle",
    CYCLES + f", f AS (SELECT id, cycle, {_ROLL} FROM sensors {_FRAME}) SELECT * FROM f QUALIFY cycle = max(cycle) OVER (PARTITION BY id)",
)
def _(t: Tables):
    from statloom.plans.maintenance import test_features

    return rounded(test_features(cycles(t), ["s1", "s2"], 5).select("id", "cycle", "a1", "a2", "sd1", "sd2"))


_LABEL = """, l AS (SELECT event_id, id, max(cycle) OVER (PARTITION BY id) {extra} - cycle AS rul FROM sensors)
  SELECT event_id, rul, CASE WHEN rul <= 30 THEN 1 ELSE 0 END AS label1,
  CASE WHEN rul <= 15 THEN 2 WHEN rul <= 30 THEN 1 ELSE 0 END AS label2 FROM l"""


@query("m5_label_remaining_life", CYCLES + _LABEL.format(extra=""))
def _(t: Tables):
    return M.label_remaining_life(cycles(t)).select("event_id", "rul", "label1", "label2")


@query("m5_label_with_truth", CYCLES + _LABEL.format(extra="+ id % 40"))
def _(t: Tables):
    truth = t.sensors.select("id").distinct().withColumn("rul", F.col("id") % 40)
    return M.label_remaining_life(cycles(t), truth).select("event_id", "rul", "label1", "label2")


@query(
    "h14_autocorrelation",
    """WITH g AS (SELECT value - avg(value) OVER () AS d, row_number() OVER (ORDER BY user_id, ts, event_id) AS ix FROM events)
    SELECT CAST(k AS INT) AS lag, round(sum(a.d * coalesce(b.d, 0)) / (SELECT sum(d * d) FROM g), 6) AS acf
    FROM g a CROSS JOIN range(0, 31) r(k) LEFT JOIN g b ON b.ix = a.ix - k GROUP BY k""",
)
def _(t: Tables):
    rows = M.global_index(t.events, "user_id", ORDER, "ix")
    return rounded(M.autocorrelation(rows, ["ix"], "value", 30, index="ix"))


@query(
    "h14_autocorrelation_by_entity",
    """WITH g AS (SELECT event_type, value - avg(value) OVER (PARTITION BY event_type) AS d,
      row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS ix FROM events)
    SELECT a.event_type, CAST(k AS INT) AS lag, round(sum(a.d * coalesce(b.d, 0)) / sum(CASE WHEN k >= 0 THEN a.d * a.d END), 6) AS acf
    FROM g a CROSS JOIN range(0, 6) r(k) LEFT JOIN g b ON b.ix = a.ix - k AND a.event_type = b.event_type GROUP BY a.event_type, k""",
)
def _(t: Tables):
    return rounded(M.autocorrelation(t.events, ORDER, "value", 5, ["event_type"]))


@query("h14_partial_autocorrelation")
def _(t: Tables):
    rows = M.global_index(t.events, "user_id", ORDER, "ix")
    return rounded(M.partial_autocorrelation(M.autocorrelation(rows, ["ix"], "value", 30, index="ix")))


@query(
    "h15_lagged_correlation",
    CYCLES
    + ", k AS (SELECT "
    + ", ".join(f"lag(s1, {k}) OVER w AS x{k}" for k in range(9))
    + ", max(cycle) OVER (PARTITION BY id) - cycle AS rul FROM sensors WINDOW w AS (PARTITION BY id ORDER BY cycle)) "
    + " UNION ALL ".join(f"SELECT {k} AS lag, round(corr(x{k}, rul), 6) AS correlation FROM k" for k in range(9)),
)
def _(t: Tables):
    labelled = M.label_remaining_life(cycles(t))
    return rounded(M.lagged_correlation(labelled, ["cycle"], "s1", "rul", 8, ["id"]))


@query(
    "w6_moving_frame",
    """SELECT event_id, round(avg(value) OVER w, 6) AS mean, min(value) OVER w AS low, max(value) OVER w AS high FROM events
    WINDOW w AS (ORDER BY ts, event_id ROWS 4 PRECEDING)""",
)
def _(t: Tables):
    def build(w):
        frame = w.rowsBetween(-4, 0)
        return {"mean": F.avg("value").over(frame), "low": F.min("value").over(frame), "high": F.max("value").over(frame)}

    out = look_back(t.events, [], ORDER, 4, build)
    return rounded(out.select("event_id", "mean", "low", "high"))


@query(
    "w8_percentile_beside_rows",
    """SELECT event_id, round(value - (SELECT quantile_cont(value, 0.5) FROM events), 6) AS from_median FROM events""",
)
def _(t: Tables):
    from statloom.operators.ordered import quantiles

    median = quantiles(t.events, "value", {"m": 0.5}).scalar()
    return rounded(t.events.select("event_id", (F.col("value") - median).alias("from_median")))
