"""Aggregations, descriptive statistics and profiling."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.operators import describe as D, profile as P
from statloom.operators.ordered import quantiles

R = cte("readings")


@query(
    "a1_describe",
    R
    + """SELECT min(value) AS min, max(value) AS max, round(max(value) - min(value), 6) AS range,
    round(avg(value), 6) AS mean, count(value) AS count, round(stddev_samp(value), 6) AS stdev,
    round(stddev_samp(value) / avg(value), 6) AS cv, count(*) - count(value) AS missing,
    count(DISTINCT value) AS "distinct" FROM readings""",
)
def _(t: Tables):
    return rounded(D.describe(t.readings, "value"))


@query(
    "a1_describe_integer_average",
    cte("passengers")
    + """SELECT min(age) AS min, max(age) AS max, max(age) - min(age) AS range, trunc(avg(age)) AS mean, count(age) AS count,
    round(stddev_samp(age), 6) AS stdev, round(stddev_samp(age) / avg(age), 6) AS cv, count(*) - count(age) AS missing,
    count(DISTINCT age) AS "distinct" FROM passengers""",
)
def _(t: Tables):
    return rounded(D.describe(t.passengers, "age", integer_avg=True))


@query(
    "a1_summary_by_type",
    R
    + """SELECT event_type, 'value' AS variable, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stdev,
    min(value) AS min, max(value) AS max, count(*) - count(value) AS missing FROM readings GROUP BY event_type""",
)
def _(t: Tables):
    return rounded(D.summarise(t.readings, ["value"], ["event_type"]))


@query("a2_group_count", "SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem WHERE l_quantity > 10 GROUP BY ALL")
def _(t: Tables):
    return t.lineitem.where("l_quantity > 10").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("cnt"))


@query(
    "a3_class_share",
    "SELECT l_returnflag, count(*) AS cnt, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 6) AS pct FROM lineitem GROUP BY 1",
)
def _(t: Tables):
    return rounded(D.class_share(t.lineitem, "l_returnflag"))


@query(
    "a3_class_share_within",
    """SELECT l_linestatus, l_returnflag, count(*) AS cnt,
    round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus), 6) AS pct FROM lineitem GROUP BY 1, 2""",
)
def _(t: Tables):
    return rounded(D.class_share(t.lineitem, "l_returnflag", ["l_linestatus"]))


@query("a4_distinct_count", "SELECT count(DISTINCT l_suppkey) AS vendors, count(DISTINCT l_partkey) AS parts FROM lineitem")
def _(t: Tables):
    return t.lineitem.agg(F.countDistinct("l_suppkey").alias("vendors"), F.countDistinct("l_partkey").alias("parts"))


@query(
    "a5_mode",
    R
    + """, c AS (SELECT value, count(*) AS number FROM readings GROUP BY 1)
    SELECT * FROM c WHERE number = (SELECT max(number) FROM c)""",
)
def _(t: Tables):
    return D.mode(t.readings, "value")


@query(
    "a5_mode_without_null",
    R
    + """, c AS (SELECT value, count(*) AS number FROM readings WHERE value IS NOT NULL GROUP BY 1)
    SELECT * FROM c WHERE number = (SELECT max(number) FROM c)""",
)
def _(t: Tables):
    return D.mode(t.readings, "value", drop_null=True)


@query(
    "a6_frequency_table",
    R
    + """, f AS (SELECT value, count(value) AS abs_freq,
      CAST(round(100.0 * count(value) / (SELECT count(*) FROM readings), 0) AS BIGINT) AS abs_perc FROM readings GROUP BY 1)
    SELECT value, abs_freq, CAST(sum(abs_freq) OVER w AS BIGINT) AS cum_freq, abs_perc,
      CAST(sum(abs_perc) OVER w AS BIGINT) AS cum_perc, repeat('*', CAST(abs_perc AS INT))[1:50] AS histogram
    FROM f WINDOW w AS (ORDER BY value NULLS FIRST ROWS UNBOUNDED PRECEDING)""",
)
def _(t: Tables):
    return D.frequency_table(t.readings, "value")


@query(
    "a6_frequency_table_levels",
    R
    + """, f AS (SELECT kind, count(kind) AS abs_freq,
      CAST(round(100.0 * count(kind) / (SELECT count(*) FROM readings), 0) AS BIGINT) AS abs_perc FROM readings GROUP BY 1)
    SELECT kind, abs_freq, CAST(sum(abs_freq) OVER w AS BIGINT) AS cum_freq, abs_perc,
      CAST(sum(abs_perc) OVER w AS BIGINT) AS cum_perc, repeat('*', CAST(abs_perc AS INT))[1:50] AS histogram
    FROM f WINDOW w AS (ORDER BY kind NULLS FIRST ROWS UNBOUNDED PRECEDING)""",
)
def _(t: Tables):
    return D.frequency_table(t.readings, "kind")


@query(
    "a7_median_iqr",
    """SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
    round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
    round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 6) AS iqr FROM lineitem""",
)
def _(t: Tables):
    return rounded(D.median_and_iqr(t.lineitem, "l_extendedprice"))


@query(
    "a7_median_by_group",
    R
    + """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
    round(quantile_cont(value, 0.75), 6) AS q3, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr
    FROM readings GROUP BY 1""",
)
def _(t: Tables):
    return rounded(D.median_and_iqr(t.readings, "value", ["event_type"]))


@query(
    "a8_percentile_disc_by_group",
    R + "SELECT user_id, quantile_disc(value, 0.5) AS median FROM readings WHERE value IS NOT NULL GROUP BY 1",
)
def _(t: Tables):
    return quantiles(t.readings, "value", {"median": 0.5}, ["user_id"], discrete=True)


@query(
    "a9_a10_skewness_kurtosis",
    R + "SELECT round(skewness(value), 6) AS skewness, round(kurtosis(value), 6) AS kurtosis FROM readings",
)
def _(t: Tables):
    return rounded(D.shape(t.readings, "value"))


_ENTROPY = """, c AS (SELECT {col} AS v, count(*) AS n FROM readings WHERE {col} IS NOT NULL GROUP BY 1),
  p AS (SELECT n / sum(n) OVER () AS p FROM c)
  SELECT '{col}' AS variable, round(log2(count(*)), 6) AS max_entropy, round(-sum(p * log2(p)), 6) AS entropy,
    round(100 * -sum(p * log2(p)) / log2(count(*)), 6) AS pct_of_max FROM p"""


@query("a11_entropy", R + _ENTROPY.format(col="value"))
def _(t: Tables):
    return rounded(D.entropy(t.readings, "value"))


@query("a11_entropy_all_rows", R + _ENTROPY.format(col="kind"))
def _(t: Tables):
    return rounded(D.entropy(t.readings, "kind", count_null_rows=True))


@query(
    "a12_group_means",
    """SELECT label, CAST(place AS INT) AS place, round(avg(CAST(x AS DOUBLE)), 6) AS mean, count(*) AS n
    FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM embeddings) GROUP BY ALL""",
)
def _(t: Tables):
    """Centre of each label in all dimensions."""
    long = t.embeddings.select("label", F.posexplode("embedding").alias("at", "x"))
    means = long.groupBy("label", (F.col("at") + 1).alias("place")).agg(F.avg(F.col("x").cast("double")).alias("mean"), F.count("*").alias("n"))
    return rounded(means)


@query("a13_group_min_max", "SELECT user_id, min(value) AS low, max(value) AS high FROM events GROUP BY 1")
def _(t: Tables):
    return t.events.groupBy("user_id").agg(F.min("value").alias("low"), F.max("value").alias("high"))


_HIST = """, l AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / {bins} AS w FROM readings),
  b AS (SELECT {keys} CAST(least({bins} - 1, floor((value - lo) / w)) AS INT) AS bin, lo, w FROM readings, l WHERE value IS NOT NULL)
  SELECT {keys} bin, round(lo + bin * w, 6) AS lower, round(lo + (bin + 1) * w, 6) AS upper, count(*) AS n FROM b GROUP BY ALL"""


@query("a14_histogram", R + _HIST.format(bins=50, keys=""))
def _(t: Tables):
    return rounded(D.histogram(t.readings, "value", 50))


@query("a14_histogram_by_group", R + _HIST.format(bins=10, keys="event_type,"))
def _(t: Tables):
    return rounded(D.histogram(t.readings, "value", 10, ["event_type"]))


_KERNEL = """, p AS (SELECT {k} count(value) AS n, 0.9 * least(stddev_samp(value), coalesce(nullif((quantile_disc(value, 0.75) - quantile_disc(value, 0.25)) / 1.34, 0),
    stddev_samp(value))) * pow(count(value), -0.2) AS w FROM readings WHERE value IS NOT NULL GROUP BY ALL),
  l AS (SELECT min(value) AS lo, max(value) AS hi FROM readings),
  c AS (SELECT {k} least(499, floor((value - lo) * 500 / (hi - lo))) AS cell, count(*) AS c, avg(value) AS m FROM readings, l WHERE value IS NOT NULL GROUP BY ALL),
  x AS (SELECT lo + i * (hi - lo) / 49.0 AS x FROM l, range(50) r(i))
  SELECT {k2} round(x, 6) AS x, round(sum(c * exp(-0.5 * ((x - m) / w) ** 2)) / max(n * w * sqrt(2 * pi())), 6) AS density FROM c {join} x GROUP BY ALL"""


@query("a14_density", R + _KERNEL.format(k="", k2="", join="CROSS JOIN p CROSS JOIN"))
def _(t: Tables):
    return rounded(D.density(t.readings, "value", 50))


@query("a14_density_by_group", R + _KERNEL.format(k="event_type,", k2="event_type,", join="JOIN p USING (event_type) CROSS JOIN"))
def _(t: Tables):
    return rounded(D.density(t.readings, "value", 50, ["event_type"]))


@query("a15_crosstab", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t: Tables):
    return D.crosstab(t.lineitem, "l_returnflag", "l_linestatus")


@query(
    "a15_crosstab_wide",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS F, count(*) FILTER (l_linestatus = 'O') AS O
    FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    return D.crosstab_wide(t.lineitem, "l_returnflag", "l_linestatus")


@query("a18_complete_cases", R + "SELECT count(*) AS complete FROM readings WHERE value IS NOT NULL AND kind IS NOT NULL")
def _(t: Tables):
    return D.complete_cases(t.readings)


@query("a19_missing_counts", R + "SELECT count(*) - count(value) AS value, count(*) - count(kind) AS kind FROM readings")
def _(t: Tables):
    return D.missing_counts(t.readings, ["value", "kind"])


def _profile_sql(table: str, numeric: list[str], text: list[str], with_clause: str, kinds: dict[str, str] | None = None) -> str:
    rows = []
    for c in numeric + text:
        number = c in numeric
        kind = (kinds or {}).get(c, "string")
        stats = {
            "rows": (None, None, "count(*)"),
            "emptiness": (None, None, f"count(*) - count({c})"),
            "distinct": (None, None, f"count(DISTINCT {c})"),
        }
        if kind != "array<float>":
            stats["minimum"] = (f"min({c})", None, None) if number else (None, f"min({c})", None)
            stats["maximum"] = (f"max({c})", None, None) if number else (None, f"max({c})", None)
        if number:
            stats["average"] = (f"round(avg({c}), 6)", None, None)
            stats["deviation"] = (f"round(stddev_samp({c}), 6)", None, None)
            stats["zeros"] = (None, None, f"count(*) FILTER ({c} = 0)")
        elif kind != "timestamp_ntz":
            stats["shortest"] = (f"min(length({c}))", None, None)
            stats["longest"] = (f"max(length({c}))", None, None)
        for s, (num, txt, cnt) in stats.items():
            pct = f"round(100.0 * ({cnt}) / count(*), 6)" if cnt else "NULL"
            rows.append(
                f"SELECT '{c}' AS column_name, '{s}' AS statistic, CAST({num or 'NULL'} AS DOUBLE) AS numeric_result, "
                f"CAST({txt or 'NULL'} AS VARCHAR) AS string_result, CAST({cnt or 'NULL'} AS BIGINT) AS counts, "
                f"CAST({pct} AS DOUBLE) AS rows_percentage FROM {table}"
            )
    return with_clause + " UNION ALL ".join(rows)


@query("d1_profile_table", _profile_sql("readings", ["event_id", "user_id", "value"], ["event_type", "kind"], R))
def _(t: Tables):
    return rounded(P.profile_table(t.readings.select("event_id", "user_id", "value", "event_type", "kind")))


# columns of the standard tables: type as the dictionary shows it
SCHEMA = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}


def _profile_all_sql() -> str:
    parts = []
    for table, columns in SCHEMA.items():
        number = [c for c, ty in columns.items() if ty in ("int", "bigint", "double")]
        text = [c for c, ty in columns.items() if ty in ("string", "timestamp_ntz", "array<float>")]
        kinds = {c: columns[c] for c in text}
        parts.append(f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {table}) AS \"rows\", * FROM ({_profile_sql(table, number, text, '', kinds)})")
    return " UNION ALL ".join(parts)


@query("d2_profile_all", _profile_all_sql())
def _(t: Tables):
    """All tables; the seconds differ from run to run and stay out of the comparison."""
    return rounded(P.profile_all({n: getattr(t, n) for n in SCHEMA}).drop("profile_seconds"))


@query(
    "d3_emptiness_ranking",
    R
    + """SELECT 'value' AS column_name, round(100.0 * (count(*) - count(value)) / count(*), 6) AS pct FROM readings
    UNION ALL SELECT 'kind', round(100.0 * (count(*) - count(kind)) / count(*), 6) FROM readings
    UNION ALL SELECT 'event_id', round(100.0 * (count(*) - count(event_id)) / count(*), 6) FROM readings ORDER BY 2 DESC""",
)
def _(t: Tables):
    return rounded(P.emptiness_ranking(t.readings.select("event_id", "value", "kind")))


@query(
    "d4_data_status",
    R
    + """SELECT 'value' AS variable, count(*) FILTER (value = 0) AS zeros, count(*) - count(value) AS missing,
      count(*) FILTER (isinf(value)) AS infinite, 'double' AS type, count(DISTINCT value) AS "unique",
      round(count(DISTINCT value) / count(*), 6) AS unique_ratio FROM readings
    UNION ALL SELECT 'kind', 0, count(*) - count(kind), 0, 'string', count(DISTINCT kind),
      round(count(DISTINCT kind) / count(*), 6) FROM readings""",
)
def _(t: Tables):
    return rounded(P.data_status(t.readings.select("value", "kind")))


@query(
    "d5_column_dictionary",
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, count(*) AS "rows", '{c}' AS column_name, {i} AS position, '{ty}' AS type, true AS nullable,
        count({c}) AS present FROM {table}"""
        for table, columns in SCHEMA.items()
        for i, (c, ty) in enumerate(columns.items(), 1)
    ),
)
def _(t: Tables):
    return P.column_dictionary({n: getattr(t, n) for n in SCHEMA})
