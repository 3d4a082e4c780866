"""Sampling and splitting."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.operators import describe as D, relational as R, sampling as G
from statloom.operators.ordered import with_row

P = cte("passengers")


def unit(key: str, seed: int = 0) -> str:
    return f"CAST(concat('0x', substr(md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR))), 1, 7)) AS BIGINT) / {float(16**7)}"


def order_text(key: str, seed: int = 0) -> str:
    return f"md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR)))"


@query(
    "g1_train_test_split",
    f"SELECT o_orderkey, CASE WHEN {unit('o_orderkey')} < 0.7 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def _(t: Tables):
    train, test = G.train_test_split(t.orders.select("o_orderkey"), "o_orderkey", 70)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "g2_stratified_split",
    P
    + f"""SELECT passenger_id, sex, row_number() OVER (PARTITION BY sex ORDER BY {order_text('passenger_id', 13)}, passenger_id)
      <= round(count(*) OVER (PARTITION BY sex) * 0.1) AS in_sample FROM passengers""",
)
def _(t: Tables):
    rows = t.passengers.select("passenger_id", "sex")
    return G.stratified_split(rows, "sex", "passenger_id", 0.1, seed=13)


@query(
    "g2_split_keeps_shares",
    P
    + f""", s AS (SELECT sex, survived, row_number() OVER (PARTITION BY sex ORDER BY {order_text('passenger_id', 123)}, passenger_id)
      <= round(count(*) OVER (PARTITION BY sex) * 0.7) AS in_sample FROM passengers)
    SELECT in_sample, sex, count(*) AS cnt, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY in_sample), 6) AS pct FROM s GROUP BY 1, 2""",
)
def _(t: Tables):
    split = G.stratified_split(t.passengers, "sex", "passenger_id", 0.7, seed=123)
    return rounded(D.class_share(split, "sex", ["in_sample"]))


def _balanced(target: str) -> str:
    return (
        P
        + f""", p AS (SELECT *, row_number() OVER (PARTITION BY sex ORDER BY {order_text('passenger_id', 1)}, passenger_id) AS ix,
      count(*) OVER (PARTITION BY sex) AS n FROM passengers), t AS (SELECT {target} AS t FROM (SELECT count(*) AS n FROM passengers GROUP BY sex)),
    c AS (SELECT passenger_id, sex, t // n + CASE WHEN ix <= t % n THEN 1 ELSE 0 END AS k FROM p, t)
    SELECT passenger_id, sex, k AS copies FROM c WHERE k > 0"""
    )


def _copies(t: Tables, method: str):
    out = G.resample_classes(t.passengers.select("passenger_id", "sex"), "sex", "passenger_id", method, seed=1)
    return out.groupBy("passenger_id", "sex").agg(F.count("*").alias("copies"))


@query("g3_balance_under", _balanced("min(n)"))
def _(t: Tables):
    return _copies(t, "under")


@query("g3_balance_over", _balanced("max(n)"))
def _(t: Tables):
    return _copies(t, "over")


@query("g3_balance_both", _balanced("CAST(floor(avg(n)) AS BIGINT)"))
def _(t: Tables):
    return _copies(t, "both")


@query(
    "g4_undersample_good",
    cte("loans")
    + "SELECT id, is_bad FROM loans WHERE is_bad = 1 OR CAST(concat('0x', substr(md5(concat_ws(':', '0', CAST(id AS VARCHAR))), 1, 4)) AS BIGINT) % 100 < 10",
)
def _(t: Tables):
    from statloom.plans.loans import undersample_good

    return undersample_good(t.loans, "id", 10).select("id", "is_bad")


@query("g5_table_sample", f"SELECT o_orderkey FROM orders WHERE {unit('o_orderkey', 42)} < 0.2")
def _(t: Tables):
    return G.table_sample(t.orders, 20, seed=42, key="o_orderkey").select("o_orderkey")


@query("g6_fold_number", f"SELECT o_orderkey, CAST(floor({unit('o_orderkey', 12)} * 10) AS INT) AS fold FROM orders")
def _(t: Tables):
    return t.orders.select("o_orderkey", G.fold_number("o_orderkey", 10, seed=12).alias("fold"))


AXES = {"n_tree": (30, 2, 20), "min_split": (100, 20, 20), "max_depth": (2, 2, 10), "m_try": (1, 1, 10)}
_GRID = """, g AS (SELECT 30 + 2 * a AS n_tree, 100 + 20 * b AS min_split, 2 + 2 * c AS max_depth, 1 + d AS m_try
  FROM range(20) a(a), range(20) b(b), range(10) c(c), range(10) d(d))"""


@query(
    "g8_parameter_grid",
    "WITH n AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)"
    + _GRID
    + """ SELECT o_orderpriority, max_depth, m_try, count(*) AS combinations, CAST(sum(least(CAST(2 ** max_depth AS BIGINT), n // min_split)) AS BIGINT) AS leaves
    FROM g, n GROUP BY ALL""",
)
def _(t: Tables):
    """Largest leaf counts the data of each priority allows, over the whole tuning grid."""
    sizes = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    values = {name: R.axis(*axis) for name, axis in AXES.items()}
    grid = sizes
    for name, column in values.items():
        grid = grid.withColumn(name, F.explode(column))
    leaves = F.least(F.pow(F.lit(2.0), F.col("max_depth")).cast("long"), F.expr("n div min_split"))
    return grid.groupBy("o_orderpriority", "max_depth", "m_try").agg(
        F.count("*").alias("combinations"), F.sum(leaves).alias("leaves")
    )


@query(
    "g7_random_combinations",
    "WITH n AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1), "
    + _GRID[2:]
    + """, r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '5', CAST(n_tree AS VARCHAR), CAST(min_split AS VARCHAR),
      CAST(max_depth AS VARCHAR), CAST(m_try AS VARCHAR)))) AS ix FROM g)
    SELECT o_orderpriority, count(*) AS tried, count(*) FILTER (n // min_split >= 2) AS can_split FROM r, n WHERE ix <= 2000 GROUP BY 1""",
)
def _(t: Tables):
    """Five percent of the tuning grid, and how many of them can split the data of each priority."""
    grid = R.parameter_grid(t.spark, AXES)
    tried = R.random_percent(grid, list(AXES), 5, seed=5)
    sizes = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    # equal split sizes are counted first; the grid has twenty of them
    counted = tried.groupBy("min_split").agg(F.count("*").alias("c"))
    each = with_row(sizes, counted.agg(F.collect_list(F.struct("min_split", "c")).alias("g")), "_g").withColumn("g", F.explode("_g.g"))
    splits = F.floor(F.col("n") / F.col("g.min_split")) >= 2
    return each.groupBy("o_orderpriority").agg(F.sum("g.c").alias("tried"), F.sum(F.when(splits, F.col("g.c")).otherwise(0)).alias("can_split"))
