"""Sources, joins, limits, set operations and reshaping."""

from pyspark.sql import Window, functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.operators import relational as R
from statloom.operators.ordered import join_small, ntile, row_index, running
from statloom.sources import readers, writers

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query(
    "s1_read_csv",
    """SELECT o_orderstatus, count(*) AS n, count(o_totalprice) AS priced, round(sum(o_totalprice), 2) AS total FROM
    (SELECT o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders) GROUP BY 1""",
)
def _(t: Tables):
    folder = writers.scratch_folder(t.spark, "csv")
    price = F.when(F.col("o_orderkey") % 10 == 0, None).otherwise(F.col("o_totalprice"))
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"), "o_orderpriority")
    rows.write.option("header", True).option("nullValue", "NULL").csv(folder)
    read = readers.read_csv(t.spark, folder, ORDERS, null_token="NULL")
    return rounded(
        read.groupBy("o_orderstatus").agg(
            F.count("*").alias("n"), F.count("o_totalprice").alias("priced"), F.sum("o_totalprice").alias("total")
        ),
        2,
    )


@query("s2_headerless_csv", "SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t: Tables):
    folder = writers.scratch_folder(t.spark, "plain")
    t.lineitem.select("l_returnflag", "l_linestatus").write.csv(folder)
    return readers.read_headerless(t.spark, folder, ["flag", "status"]).groupBy("flag", "status").agg(F.count("*").alias("n"))


@query("s3_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 49 AND l_discount > 0.05")
def _(t: Tables):
    return readers.scan(t.lineitem, ["l_orderkey", "l_quantity"], "l_quantity >= 49 AND l_discount > 0.05")


@query(
    "s4_table_sink",
    """SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1""",
)
def _(t: Tables):
    folder = writers.scratch_folder(t.spark, "sink")
    writers.write_table(t.events, folder)
    writers.insert_rows(t.events, folder)
    return t.spark.read.parquet(folder).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "s5_delete_where",
    cte("readings") + "SELECT event_id, value FROM readings WHERE value <= 50 OR value IS NULL",
)
def _(t: Tables):
    return writers.delete_where(t.readings, F.col("value") > 50).select("event_id", "value")


@query(
    "s5_copy_truncate_insert",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1",
)
def _(t: Tables):
    folder = writers.scratch_folder(t.spark, "copy")
    writers.copy_table(t.spark, f"{t.folder}/orders.parquet", folder)
    writers.truncate_table(t.spark, folder)
    writers.insert_rows(t.orders.where("o_orderstatus <> 'P'"), folder)
    return t.spark.read.parquet(folder).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "s6_upsert",
    """SELECT coalesce(c_custkey, k) AS name, CASE WHEN k IS NULL THEN c_acctbal ELSE spent END AS score
    FROM customer FULL JOIN (SELECT o_custkey + 1000 AS k, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
    ON c_custkey = k""",
)
def _(t: Tables):
    base = t.customer.select(F.col("c_custkey").alias("name"), F.col("c_acctbal").alias("score"))
    new = t.orders.groupBy((F.col("o_custkey") + 1000).alias("name")).agg(F.sum("o_totalprice").alias("score"))
    return writers.upsert(base, rounded(new, 2), ["name"])


@query(
    "s7_staging_load",
    """SELECT quarter(o_orderdate) AS part, count(*) AS n, round(sum(CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_totalprice END), 2) AS total
    FROM orders GROUP BY 1""",
)
def _(t: Tables):
    folder = writers.scratch_folder(t.spark, "quarters")
    price = F.when(F.col("o_orderkey") % 10 == 0, None).otherwise(F.col("o_totalprice"))
    quarters = t.orders.select("o_orderkey", price.alias("o_totalprice"), F.quarter("o_orderdate").alias("part"))
    quarters.write.partitionBy("part").option("header", True).option("nullValue", "NULL").csv(folder)
    loaded = readers.load_staging(
        t.spark, [f"{folder}/part={q}" for q in range(1, 5)], "o_orderkey long, o_totalprice double", "NULL", ["o_totalprice"]
    )
    part = F.regexp_extract("source_file", r"part=(\d)", 1).cast("long").alias("part")
    return rounded(loaded.groupBy(part).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query(
    "s8_stage_to_train",
    """SELECT CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END AS is_bad, 1 AS is_train, count(*) AS n FROM orders GROUP BY 1""",
)
def _(t: Tables):
    from statloom.plans.loans import stage_to_train

    return stage_to_train(t.loans, ["F", "P"], True).groupBy("is_bad", "is_train").agg(F.count("*").alias("n"))


@query(
    "s9_run_log",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY day DESC) AS INT) AS back, CAST(day AS VARCHAR) AS day, 'Loaded ' || n || ' orders' AS note
    FROM d QUALIFY back <= 20""",
)
def _(t: Tables):
    """One entry per day that orders were loaded on, appended to a log table; its latest entries read back."""
    path = writers.scratch_folder(t.spark, "run-log")
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    note = F.concat(F.lit("Loaded "), F.col("n").cast("string"), F.lit(" orders"))
    writers.insert_rows(days.select(F.lit(1).alias("session_id"), F.col("day").cast("timestamp").alias("run_time"), note.alias("note")), path)
    last = writers.latest(t.spark.read.parquet(path), 20)
    back = F.row_number().over(Window.orderBy(F.col("run_time").desc()))  # twenty rows
    return last.select(back.alias("back"), F.col("run_time").cast("date").cast("string").alias("day"), "note")


@query(
    "j1_inner_join_campaign",
    """SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE o_orderpriority = '1-URGENT' AND c_nationkey % 4 = 1""",
)
def _(t: Tables):
    """Customers of a segment table that was written before, with their urgent orders."""
    from statloom.plans.customers import campaign_list

    path = writers.scratch_folder(t.spark, "segments")
    segments = t.customer.select(F.col("c_custkey").alias("customer"), (F.col("c_nationkey") % 4).alias("cluster"))
    writers.write_table(segments, path)
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    listed = campaign_list(t.customer, t.spark.read.parquet(path), 1)
    return listed.join(urgent, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "o_orderkey")


@query(
    "j2_star_join",
    """SELECT r_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def _(t: Tables):
    joined = R.star_join(
        t.orders,
        [(t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")],
    )
    return rounded(joined.groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2)


@query(
    "j3_left_join_shared",
    """SELECT c_custkey, c_mktsegment, orders_n FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS orders_n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""",
)
def _(t: Tables):
    counts = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders_n"))
    return R.natural_left_join(t.customer.select("c_custkey", "c_mktsegment"), counts)


@query(
    "j4_join_row_numbers",
    """SELECT s_suppkey, s_acctbal, l.vendor_lines FROM (SELECT *, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS rn FROM supplier)
    JOIN (SELECT l_linenumber AS id, count(*) AS vendor_lines FROM lineitem GROUP BY 1) l ON rn = l.id""",
)
def _(t: Tables):
    truth = readers.number_rows(t.supplier, ["s_acctbal", "s_suppkey"])
    lines = t.lineitem.groupBy(F.col("l_linenumber").alias("rn")).agg(F.count("*").alias("vendor_lines"))
    return truth.join(lines, "rn").select("s_suppkey", "s_acctbal", "vendor_lines")


@query(
    "j6_differing_predictions",
    """SELECT o_orderkey AS id, CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS before,
    CASE WHEN o_totalprice * 1.2 > 300000 THEN 1 ELSE 0 END AS "after" FROM orders
    WHERE (o_totalprice > 300000) <> (o_totalprice * 1.2 > 300000)""",
)
def _(t: Tables):
    price = F.col("o_totalprice")
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.when(price > 300000, 1).otherwise(0).alias("predicted"))
    b = t.orders.select(F.col("o_orderkey").alias("id"), F.when(price * 1.2 > 300000, 1).otherwise(0).alias("predicted"))
    return R.differing(a, b, "id", "predicted")


@query(
    "j7_last_per_entity",
    """SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t: Tables):
    return R.last_per_key(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query(
    "j8_top_or_bottom_values",
    """SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IN (SELECT c_acctbal FROM customer ORDER BY c_acctbal DESC LIMIT 10)
    OR c_acctbal IN (SELECT c_acctbal FROM customer ORDER BY c_acctbal LIMIT 10)""",
)
def _(t: Tables):
    return R.in_top_or_bottom(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 10)


@query(
    "j9_exists",
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)",
)
def _(t: Tables):
    big = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey")


@query(
    "w1_row_number_ends",
    """SELECT event_id, value, rn FROM (SELECT event_id, value, row_number() OVER (ORDER BY value DESC, event_id) AS rn FROM events)
    WHERE rn <= 5 OR rn > (SELECT count(*) - count(*) // 100 FROM events)""",
)
def _(t: Tables):
    n = t.events.count()
    return R.ranked_ends(t.events, ["-value", "event_id"], 5, n - n // 100 + 1).select("event_id", "value", "rn")


@query(
    "w2_dense_rank",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) AS code FROM orders",
)
def _(t: Tables):
    return R.add_code(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "code").drop("o_orderpriority")


@query("w3_ntile", "SELECT event_id, CAST(ntile(6) OVER (ORDER BY value, event_id) AS INT) AS tile FROM events")
def _(t: Tables):
    return ntile(t.events, ["value", "event_id"], 6).select("event_id", "tile")


@query(
    "w4_totals_beside_rows",
    """SELECT l_suppkey AS vendor, l_extendedprice AS amount, count(*) OVER (PARTITION BY l_suppkey) AS transactions,
    round(l_extendedprice / max(l_extendedprice) OVER (), 6) AS of_max FROM lineitem""",
)
def _(t: Tables):
    counts = t.invoices.groupBy("vendor").agg(F.count("*").alias("transactions"))
    peak = t.invoices.agg(F.max("amount").alias("m")).scalar()
    return rounded(join_small(t.invoices, counts, ["vendor"]).withColumn("of_max", F.col("amount") / peak))


@query(
    "w5_running_sum",
    """SELECT event_id, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS total,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events""",
)
def _(t: Tables):
    out = running(
        t.events, ["event_type"], ["ts", "event_id"], {"total": ("sum", "value"), "n": ("sum", F.lit(1))}
    )
    return rounded(out.select("event_id", "total", "n"), 2)


@query(
    "w9_average_rank",
    """SELECT event_id, value, rank FROM (SELECT event_id, value,
    rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS rank FROM events) WHERE rank < 20""",
)
def _(t: Tables):
    return R.rank_lowest(t.events.select("event_id", "value"), "value", 20)


@query("o1_multi_key_order", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t: Tables):
    first = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy(first, F.col("o_totalprice").desc(), "o_orderkey")


@query("o2_top", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(t: Tables):
    return R.top(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 5)


@query(
    "o3_top_with_ties",
    "SELECT l_partkey, n FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) QUALIFY rank() OVER (ORDER BY n DESC) = 1",
)
def _(t: Tables):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") == counts.agg(F.max("n").alias("m")).scalar())


@query(
    "o4_random_percent",
    """SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat_ws(':', '7', CAST(o_orderkey AS VARCHAR)))) AS ix,
    count(*) OVER () AS n FROM orders) WHERE ix <= ceil(n * 5.0 / 100)""",
)
def _(t: Tables):
    return R.random_percent(t.orders.select("o_orderkey"), "o_orderkey", 5, seed=7)


@query("o5_random_order", "SELECT o_orderkey FROM orders")
def _(t: Tables):
    return R.random_order(t.orders.select("o_orderkey"), seed=3)


@query(
    "o6_union_distinct",
    "SELECT l_returnflag AS flag FROM lineitem UNION SELECT o_orderstatus FROM orders",
)
def _(t: Tables):
    return R.union_distinct([t.lineitem.select(F.col("l_returnflag").alias("flag")), t.orders.select(F.col("o_orderstatus").alias("flag"))])


@query(
    "o7_union_all",
    """SELECT 'F' AS part, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'other', count(*) FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(t: Tables):
    n = F.count("*").alias("n")
    return R.union_all(
        [
            t.orders.where("o_orderstatus = 'F'").agg(n).select(F.lit("F").alias("part"), "n"),
            t.orders.where("o_orderstatus <> 'F'").agg(n).select(F.lit("other").alias("part"), "n"),
        ]
    )


@query(
    "o8_set_difference",
    "SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
)
def _(t: Tables):
    return t.customer.select("c_custkey").subtract(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query(
    "o9_dedup",
    """SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL""",
)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return R.first_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


_LONG = """, y AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n FROM orders
  JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""

def _by_year(t: Tables):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), F.year("o_orderdate").cast("string").alias("year"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "r1_spread",
    "WITH " + _LONG[2:] + " SELECT nation, " + ", ".join(f"max(n) FILTER (year = '{y}') AS \"{y}\"" for y in range(1995, 2002)) + " FROM y GROUP BY nation",
)
def _(t: Tables):
    return R.spread(_by_year(t), ["nation"], "year", "n")


@query(
    "r2_gather",
    """SELECT event_id, 's1' AS sensor, value AS reading FROM events UNION ALL SELECT event_id, 's2', CAST(event_id % 13 AS DOUBLE) FROM events""",
)
def _(t: Tables):
    return R.gather(t.sensors.select("event_id", "s1", "s2"), ["event_id"], ["s1", "s2"], "sensor", "reading")


@query(
    "r3_separate",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS level,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'NOT' ELSE split_part(o_orderpriority, '-', 2) END AS label FROM orders""",
)
def _(t: Tables):
    return R.separate(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["level", "label"])


@query(
    "r4_unite",
    "SELECT l_orderkey, concat(l_returnflag, l_linestatus) AS state, l_quantity FROM lineitem",
)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    return R.unite(rows, ["l_returnflag", "l_linestatus"], "state", "")


@query(
    "r5_alternate_ratio",
    "WITH " + _LONG[2:] + """ SELECT nation, round(10000.0 * max(n) FILTER (year = '1999') / max(n) FILTER (year = '2000'), 6) AS rate FROM y GROUP BY 1""",
)
def _(t: Tables):
    wide = R.spread(_by_year(t), ["nation"], "year", "n")
    return rounded(wide.select("nation", (F.try_divide(F.col("1999").cast("double"), F.col("2000")) * 10000).alias("rate")))


@query(
    "p13_factor_code",
    "SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) AS type_code, dense_rank() OVER (ORDER BY p_brand) AS brand_code FROM part",
)
def _(t: Tables):
    rows = R.add_code(t.part.select("p_partkey", "p_type", "p_brand"), "p_type", "type_code")
    return R.add_code(rows, "p_brand", "brand_code").select("p_partkey", "type_code", "brand_code")


@query(
    "w1_row_index_by_key",
    "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle FROM events",
)
def _(t: Tables):
    return row_index(t.events, ["user_id"], ["ts", "event_id"], "cycle").select("event_id", "cycle")
