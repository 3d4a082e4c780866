"""Association measures and hypothesis tests."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.functions import probability as prob
from statloom.functions.probability import decision
from statloom.operators import association as H, scale

P, R = cte("passengers"), cte("readings")


def _simpson(density: str, start: str, length: str, dof: str = "1", steps: int = 4000) -> str:
    """SQL for the integral of ``density`` (of ``u`` and ``deg``) over ``length`` from ``start`` on."""
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return (
        f"(SELECT sum({weight} * ({density}) * span) / {3 * steps} FROM (SELECT i, deg, span, start + i * span / {steps} AS u "
        f"FROM range({steps + 1}) r(i), (SELECT {start} AS start, {length} AS span, CAST({dof} AS DOUBLE) AS deg)))"
    )


def chi2_tail(x: str, dof: str) -> str:
    """SQL for P(X > x) by integration."""
    log = "(deg / 2 - 1) * ln(greatest(u, 1e-300)) - u / 2 - deg / 2 * ln(2) - lgamma(deg / 2)"
    return _simpson(f"exp({log})", x, f"(60 + 20 * sqrt(2.0 * {dof}))", dof)


def t_tail(t: str, dof: str) -> str:
    """SQL for P(|T| > t) by integration, for many degrees of freedom (ratio of the gamma functions by its series)."""
    log = "ln(deg / 2) / 2 - 1 / (4 * deg) - ln(deg * pi()) / 2 - (deg + 1) / 2 * ln(1 + u * u / deg)"
    return _simpson(f"2 * exp({log})", t, "12", dof)


def normal_tail(z: str) -> str:
    """SQL for P(|Z| > z) by integration."""
    return _simpson("2 * exp(-u * u / 2) / sqrt(2 * pi())", z, "12")


@query("h1_covariance_pearson", "SELECT round(covar_pop(l_quantity, l_extendedprice), 4) AS covar, round(corr(l_quantity, l_extendedprice), 6) AS pearson FROM lineitem")
def _(t: Tables):
    out = H.covariance_pearson(t.lineitem, "l_quantity", "l_extendedprice")
    return rounded(rounded(out, 6, "pearson"), 4, "covar")


@query(
    "h1_covariance_all_rows",
    P
    + """, m AS (SELECT avg(age) AS a, avg(fare) AS b FROM passengers)
    SELECT round(sum((age - a) * (fare - b)) / count(*), 6) AS covar,
    round(sum((age - a) * (fare - b)) / count(*) / (stddev_pop(age) * stddev_pop(fare)), 6) AS pearson FROM passengers, m""",
)
def _(t: Tables):
    return rounded(H.covariance_pearson(t.passengers, "age", "fare", all_rows=True))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "h2_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]
    ),
)
def _(t: Tables):
    return rounded(H.correlation_matrix(t.lineitem, _NUM))


_CAND = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query(
    "h3_top_correlated",
    "SELECT variable, round(r, 6) AS r, round(abs(r), 6) AS strength FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS variable, corr({c}, l_extendedprice) AS r FROM lineitem" for c in _CAND if c != "l_orderkey")
    + ") WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, variable LIMIT 3",
)
def _(t: Tables):
    rows = t.lineitem.withColumn("constant", F.lit(1.0))
    return rounded(H.top_correlated(rows, "l_extendedprice", 3, exclude=["l_orderkey"]))


@query(
    "h4_spearman",
    """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS a,
      rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS b FROM lineitem)
    , s AS (SELECT corr(a, b) AS rho, count(*) AS n FROM r)
    SELECT round(rho, 6) AS rho, n, round("""
    + t_tail("abs(rho) * sqrt((n - 2) / (1 - rho * rho))", "n - 2")
    + """, 6) AS p_value FROM s""",
)
def _(t: Tables):
    return rounded(H.spearman(t.lineitem, "l_quantity", "l_extendedprice").select("rho", "n", "p_value"))


@query(
    "h5_kendall",
    """WITH c AS (SELECT l_quantity AS x, l_discount AS y, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL),
    p AS (SELECT sum(CASE WHEN (b.x > a.x AND b.y > a.y) THEN a.n * b.n END) AS c, sum(CASE WHEN (b.x > a.x AND b.y < a.y) THEN a.n * b.n END) AS d FROM c a, c b),
    tx AS (SELECT sum(t * (t - 1) / 2) AS tx, sum(t) AS n FROM (SELECT sum(n) AS t FROM c GROUP BY x)),
    ty AS (SELECT sum(t * (t - 1) / 2) AS ty FROM (SELECT sum(n) AS t FROM c GROUP BY y))
    SELECT round((c - d) / sqrt((n * (n - 1) / 2 - tx) * (n * (n - 1) / 2 - ty)), 8) AS tau, c AS concordant, d AS discordant FROM p, tx, ty""",
)
def _(t: Tables):
    found = H.kendall(t.lineitem, "l_quantity", "l_discount")
    return rounded(found.select("tau", "concordant", "discordant"), 8)


_CTE = """, o AS (SELECT survived AS on_rows, {b} AS on_cols, count(*) AS observed FROM passengers GROUP BY ALL),
  e AS (SELECT *, CAST(sum(observed) OVER (PARTITION BY on_rows) AS BIGINT) AS observed_on_rows,
    CAST(sum(observed) OVER (PARTITION BY on_cols) AS BIGINT) AS observed_on_cols, CAST(sum(observed) OVER () AS BIGINT) AS observed_total FROM o),
  x AS (SELECT *, CAST(round(CAST(observed_on_rows AS DOUBLE) * observed_on_cols / observed_total, 0) AS BIGINT) AS expected FROM e) """


@query("h6_contingency", P + _CTE.format(b="sex") + "SELECT * FROM x")
def _(t: Tables):
    return H.contingency(t.passengers, "survived", "sex", rounded_expected=True)


_CHI = """SELECT dof, round(chi_squared, 6) AS chi_squared, round(exp(-chi_squared / 2), 6) AS p_value FROM (WITH o AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY ALL),
  e AS (SELECT *, round(sum(o) OVER (PARTITION BY a) * sum(1.0 * o) OVER (PARTITION BY b) / sum(1.0 * o) OVER (), 0) AS e FROM o)
  SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof, sum((o - e) * (o - e) / e) AS chi_squared FROM e)"""


@query("h7_chi_square_rounded", _CHI)  # two degrees of freedom: the tail is an exponential
def _(t: Tables):
    out = H.chi_square(t.lineitem, "l_returnflag", "l_linestatus", rounded_expected=True)
    return rounded(out.select("dof", "chi_squared", "p_value"))


@query(
    "h7_chi_square_exact",
    """WITH a AS (SELECT p_type AS a, count(*) AS r FROM part GROUP BY 1), b AS (SELECT p_size AS b, count(*) AS c FROM part GROUP BY 1),
    o AS (SELECT p_type AS a, p_size AS b, count(*) AS o FROM part GROUP BY ALL), n AS (SELECT count(*) AS n FROM part),
    g AS (SELECT coalesce(o, 0) AS o, r * c / n AS e FROM a CROSS JOIN b CROSS JOIN n LEFT JOIN o USING (a, b))
    , x AS (SELECT ((SELECT count(*) FROM a) - 1) * ((SELECT count(*) FROM b) - 1) AS dof, sum((o - e) * (o - e) / e) AS chi_squared FROM g)
    SELECT dof, round(chi_squared, 6) AS chi_squared, round("""
    + chi2_tail("chi_squared", "dof")
    + """, 6) AS p_value FROM x""",
)
def _(t: Tables):
    return rounded(H.chi_square(t.part, "p_type", "p_size").select("dof", "chi_squared", "p_value"))


@query(
    "h7_chi_square_yates",
    P
    + """, s AS (SELECT * FROM passengers WHERE survived IS NOT NULL), o AS (SELECT sex AS a, survived AS b, count(*) AS o FROM s GROUP BY ALL),
    e AS (SELECT *, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM o)
    , x AS (SELECT CAST(1 AS BIGINT) AS dof, sum((abs(o - e) - least(0.5, abs(o - e))) ** 2 / e) AS chi_squared FROM e)
    SELECT dof, round(chi_squared, 6) AS chi_squared, round("""
    + normal_tail("sqrt(chi_squared)")
    + """, 6) AS p_value FROM x""",
)
def _(t: Tables):
    return rounded(H.chi_square(t.passengers, "sex", "survived", yates=True).select("dof", "chi_squared", "p_value"))


@query(
    "h8_screen_features",
    "SELECT feature, levels, relevant, dof, round(x, 6) AS chi_squared, CASE WHEN dof > 0 THEN round("
    + chi2_tail("x", "dof")
    + ", 6) END AS p_value FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, count(DISTINCT a) AS levels, count(DISTINCT a) > 1 AS relevant,
        (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof, sum((o - e) * (o - e) / e) AS x
        FROM (SELECT *, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM
        (SELECT {x} AS a, l_returnflag AS b, count(*) AS o FROM lineitem GROUP BY ALL))"""
        for f, x in {"l_linestatus": "l_linestatus", "l_linenumber": "l_linenumber", "l_discount": "l_discount", "constant": "'c'"}.items()
    )
    + ")",
)
def _(t: Tables):
    rows = t.lineitem.withColumn("constant", F.lit("c"))
    found = H.screen_features(rows, ["l_linestatus", "l_linenumber", "l_discount", "constant"], "l_returnflag")
    return rounded(found)


_ANOVA = """, w AS (SELECT {v} AS v, {g} AS g, {avg_g} AS mg, {avg_all} AS m FROM passengers {where}),
  s AS (SELECT sum(({m1}) ** 2) AS ssb, sum((v - mg) ** 2) AS ssw, count(DISTINCT coalesce(CAST(g AS VARCHAR), '?')) AS k, count(*) AS n FROM w)
  SELECT 'Between groups' AS source, round(ssb, 4) AS ss, k - 1 AS df, round(ssb / (k - 1), 4) AS ms, round((ssb / (k - 1)) / (ssw / (n - k)), 4) AS f, {p} AS p_value FROM s
  UNION ALL SELECT 'Within groups', round(ssw, 4), n - k, round(ssw / (n - k), 4), NULL, NULL FROM s"""
# between two groups the root of F is Student's t
_TWO_GROUPS = "round(" + t_tail("sqrt(ssb / (ssw / (n - k)))", "(n - k)") + ", 4)"
# between three groups Fisher's tail is a power
_THREE_GROUPS = "round(pow(1 + ssb / ssw, -(n - k) / 2.0), 4)"


@query(
    "h9_anova",
    P
    + _ANOVA.format(
        v="fare", g="survived", avg_g="avg(fare) OVER (PARTITION BY survived)", avg_all="avg(fare) OVER ()", m1="mg - m",
        where="WHERE fare IS NOT NULL AND survived IS NOT NULL", p=_TWO_GROUPS,
    ),
)
def _(t: Tables):
    return rounded(H.anova(t.passengers, "fare", "survived"), 4)


@query(
    "h9_anova_integer_average",
    P
    + _ANOVA.format(
        v="age", g="survived", avg_g="trunc(avg(age) OVER (PARTITION BY survived))", avg_all="trunc(avg(age) OVER ())", m1="mg - m", where="", p=_THREE_GROUPS,
    ),
)
def _(t: Tables):
    return rounded(H.anova(t.passengers, "age", "survived", integer_avg=True, all_rows=True), 4)


_JB = """WITH m AS (SELECT count(*) AS n, avg(value) AS m FROM events), k AS (SELECT n, avg((value - m) ** 2) AS a, avg((value - m) ** 3) AS b,
  avg((value - m) ** 4) AS c FROM events, m GROUP BY n)
  , x AS (SELECT n / 6 * ((b / a ** 1.5) ** 2 + (c / a ** 2 - 3) ** 2 / 4) AS statistic FROM k)
  SELECT round(statistic, 4) AS statistic, round(exp(-statistic / 2), 4) AS p_value FROM x"""


@query("h10_jarque_bera", _JB)
def _(t: Tables):
    return rounded(H.jarque_bera(t.events, "value").select("statistic", "p_value"), 4)


@query("h10_kolmogorov_smirnov")
def _(t: Tables):
    return H.kolmogorov_smirnov(t.lineitem, "l_extendedprice")


def _horner(coefficients: tuple[float, ...], x: str) -> str:
    text = repr(coefficients[0]) + "::DOUBLE"
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


_FAR = "sqrt(-2 * ln(least(p, 1 - p)))"
_TAIL = f"{_horner(prob.TAIL_TOP, _FAR)} / {_horner(prob.TAIL_BOTTOM, _FAR)}"
_MIDDLE = f"{_horner(prob.MIDDLE_TOP, '((p - 0.5) * (p - 0.5))')} * (p - 0.5) / {_horner(prob.MIDDLE_BOTTOM, '((p - 0.5) * (p - 0.5))')}"


@query(
    "h11_qq_points",
    cte("readings")
    + f""", c AS (SELECT value, count(*) AS n FROM readings WHERE value IS NOT NULL GROUP BY 1),
    r AS (SELECT value, n, (sum(n) OVER (ORDER BY value) - (n - 1) / 2 - 0.5) / sum(n) OVER () AS p FROM c)
    SELECT value, n, round(CASE WHEN least(p, 1 - p) >= 0.02425 THEN {_MIDDLE} WHEN p < 0.5 THEN {_TAIL} ELSE -({_TAIL}) END, 6) AS theoretical FROM r""",
)
def _(t: Tables):
    return rounded(H.qq_points(t.readings, "value"))


@query("h12_z_score", "SELECT event_id, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS z FROM events")
def _(t: Tables):
    return rounded(scale.standardise(t.events, "value", "z", population=True).select("event_id", "z"))


@query(
    "h13_decision",
    P
    + _CTE.format(b="sex")
    + """, s AS (SELECT sum((observed - expected) ** 2 / expected) AS x FROM x)
    SELECT CASE WHEN x > 3.841459 THEN 'dependent' ELSE 'independent' END AS decision FROM s""",
)
def _(t: Tables):
    found = H.chi_square(t.passengers, "survived", "sex", rounded_expected=True)
    return found.select(decision(F.col("p_value")).alias("decision"))
