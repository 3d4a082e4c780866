"""Prediction quality on scores that both engines can derive."""

from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.learn import evaluation as E

# predicted and actual classes from stored columns
_PRED = """SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS actual,
  CASE WHEN l_quantity > 30 THEN 1 ELSE 0 END AS predicted, round(l_extendedprice / 105000, 3) AS score,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label3, CAST(l_linenumber % 3 AS INT) AS predicted3 FROM """


def predictions(t: Tables):
    return t.spark.sql(_PRED + "{lineitem}", lineitem=t.lineitem)


W = f"WITH s AS ({_PRED} lineitem) "


@query(
    "e1_regression_metrics",
    """WITH s AS (SELECT l_extendedprice AS o, l_quantity * 2100 AS p, avg(l_extendedprice) OVER () AS m FROM lineitem)
    SELECT round(avg(abs(o - p)), 4) AS mae, round(sqrt(avg((o - p) ** 2)), 4) AS rmse, round(sum(abs(o - p)) / sum(abs(o - m)), 4) AS rae,
    round(sum((o - p) ** 2) / sum((o - m) ** 2), 4) AS rse, round(1 - sum((o - p) ** 2) / sum((o - m) ** 2), 4) AS r2 FROM s""",
)
def _(t: Tables):
    rows = t.lineitem.withColumn("p", F.col("l_quantity") * 2100)
    return rounded(E.regression_metrics(rows, "l_extendedprice", "p"), 4)


@query("e2_confusion", W + "SELECT label3 AS actual, predicted3 AS predicted, count(*) AS n FROM s GROUP BY ALL")
def _(t: Tables):
    return E.confusion(predictions(t), "label3", "predicted3")


_BIN = W + """, c AS (SELECT count(*) FILTER (actual = 1 AND predicted = 1) AS tp, count(*) FILTER (actual = 1 AND predicted = 0) AS fn,
  count(*) FILTER (actual = 0 AND predicted = 1) AS fp, count(*) FILTER (actual = 0 AND predicted = 0) AS tn FROM s),
  m AS (SELECT *, {r}((tp + tn) / (tp + fn + fp + tn), {d}) AS accuracy, {r}(tp / (tp + fp), {d}) AS precision, {r}(tp / (tp + fn), {d}) AS recall FROM c)"""


@query(
    "e3_binary_metrics",
    _BIN.format(r="round", d=12)
    + " SELECT tp, fn, fp, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(2 * precision * recall / (precision + recall), 6) AS f_score FROM m",
)
def _(t: Tables):
    return rounded(E.binary_metrics(predictions(t), "actual", "predicted"))


@query(
    "e3_binary_metrics_two_decimals",
    _BIN.format(r="round", d=2) + " SELECT *, round(2 * precision * recall / (precision + recall), 2) AS f_score FROM m",
)
def _(t: Tables):
    return rounded(E.binary_metrics(predictions(t), "actual", "predicted", two_decimals=True), 2)


_CLASSES = W + """, k AS (SELECT c.c AS class, CAST(count(*) FILTER (label3 = c AND predicted3 = c) AS DOUBLE) AS diag,
    CAST(count(*) FILTER (label3 = c) AS DOUBLE) AS r, CAST(count(*) FILTER (predicted3 = c) AS DOUBLE) AS q, CAST(count(*) AS DOUBLE) AS n
  FROM s, (VALUES (0), (1), (2)) c(c) GROUP BY 1) """


@query(
    "e4_class_metrics",
    _CLASSES
    + """, f AS (SELECT *, diag / q AS precision, diag / r AS recall, 2 * (diag / q) * (diag / r) / (diag / q + diag / r) AS f1, r / n AS p FROM k),
    o AS (SELECT sum(diag) / max(n) AS acc, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
      sum(n - r - q + 2 * diag) / (3 * max(n)) AS aa, sum(diag) / sum(r) AS mi, max(p) AS ma, arg_max(class, r) AS mc, sum(p * q / n) AS e FROM f)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(acc, 6) AS accuracy,
      round(mp, 6) AS macro_precision, round(mr, 6) AS macro_recall, round(mf, 6) AS macro_f1, round(aa, 6) AS avg_accuracy, round(mi, 6) AS micro_f1,
      round((acc - e) / (1 - e), 6) + 0.0 AS kappa, round(ma, 6) AS majority_accuracy, round(CASE WHEN class = mc THEN p ELSE 0 END, 6) AS majority_precision,
      CASE WHEN class = mc THEN 1.0::DOUBLE ELSE 0 END AS majority_recall, round(CASE WHEN class = mc THEN 2 * p / (p + 1) ELSE 0 END, 6) AS majority_f1,
      round(1 / 3::DOUBLE, 6) AS guess_accuracy, round(p, 6) AS guess_precision, round(1 / 3::DOUBLE, 6) AS guess_recall, round(2 * p / (3 * p + 1), 6) AS guess_f1
    FROM f, o""",
)
def _(t: Tables):
    return rounded(E.class_metrics(predictions(t), "label3", "predicted3"))


@query(
    "e5_negative_class_metrics",
    _CLASSES
    + """, f AS (SELECT diag AS tn, q - diag AS fn, r - diag AS fp, n - r - q + diag AS tp, n FROM k),
    g AS (SELECT *, (tp + tn) / n AS a, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM f)
    SELECT round(sum(tp) / max(n), 6) AS overall_accuracy, round(avg(a), 6) AS average_accuracy, round(sum(tp) / (sum(tp) + sum(fp)), 6) AS micro_precision,
      round(avg(p), 6) AS macro_precision, round(sum(tp) / (sum(tp) + sum(fn)), 6) AS micro_recall, round(avg(r), 6) AS macro_recall,
      round(avg(2 * p * r / (p + r)), 6) AS macro_f1 FROM g""",
)
def _(t: Tables):
    return rounded(E.negative_class_metrics(predictions(t), "label3", "predicted3"))


_ROC = W + """, c AS (SELECT score AS threshold, count(*) FILTER (actual = 1) AS pos, count(*) FILTER (actual = 0) AS neg FROM s GROUP BY 1),
  r AS (SELECT *, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp FROM c)"""


@query(
    "e6_roc_points",
    _ROC + " SELECT *, round(tp / (SELECT sum(pos) FROM c), 6) AS tpr, round(fp / (SELECT sum(neg) FROM c), 6) AS fpr FROM r",
)
def _(t: Tables):
    return rounded(E.roc_points(predictions(t), "actual", "score"))


@query("e7_auc", _ROC + " SELECT round(sum(neg * (tp - pos / 2)) / (max(tp) * CAST(max(fp) AS DOUBLE)), 6) AS auc FROM r")
def _(t: Tables):
    return rounded(E.auc(predictions(t), "actual", "score"))


@query(
    "e9_metrics_ranking",
    W
    + """, m AS (SELECT 'quantity' AS name, avg(CASE WHEN actual = predicted THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM s
      UNION ALL SELECT 'score', avg(CASE WHEN actual = CASE WHEN score > 0.25 THEN 1 ELSE 0 END THEN 1.0::DOUBLE ELSE 0 END) FROM s
      UNION ALL SELECT 'never', avg(CASE WHEN actual = 0 THEN 1.0::DOUBLE ELSE 0 END) FROM s)
    SELECT name, round(accuracy, 6) AS accuracy, row_number() OVER (ORDER BY accuracy DESC, name) AS rn FROM m""",
)
def _(t: Tables):
    from statloom.learn.selection import rank_metrics

    rows = predictions(t)
    scored = {
        "quantity": rows,
        "score": rows.withColumn("predicted", F.when(F.col("score") > 0.25, 1).otherwise(0)),
        "never": rows.withColumn("predicted", F.lit(0)),
    }
    metrics = {n: E.binary_metrics(d, "actual", "predicted").select("accuracy") for n, d in scored.items()}
    return rounded(rank_metrics(metrics, "accuracy").select("name", "accuracy", "rn"))


_LOANS = cte("loans") + """, b AS (SELECT id, CASE WHEN int_rate + bc_util / 20 > 15 THEN 1 ELSE 0 END AS predicted FROM loans),
  w AS (SELECT id, CASE WHEN int_rate + 9 + bc_util / 20 > 15 THEN 1 ELSE 0 END AS predicted FROM loans) """


def _scenarios(t: Tables):
    from statloom.plans.loans import compare_scenarios

    def score(loans):
        risk = F.col("int_rate") + F.col("bc_util") / 20
        return loans.select("id", F.when(risk > 15, 1).otherwise(0).alias("predicted"))

    return compare_scenarios(t.loans, score, {"int_rate": 9.0})


@query("e13_what_if_flips", _LOANS + 'SELECT id, b.predicted AS before, w.predicted AS "after" FROM b JOIN w USING (id) WHERE b.predicted <> w.predicted')
def _(t: Tables):
    return _scenarios(t)["flips"]


@query(
    "e13_a17_what_if_summary",
    _LOANS
    + """SELECT 'what_if' AS scenario, round(avg(predicted), 6) AS average, round(stddev_samp(predicted), 6) AS st_deviation FROM w
    UNION ALL SELECT 'base', round(avg(predicted), 6), round(stddev_samp(predicted), 6) FROM b""",
)
def _(t: Tables):
    return rounded(_scenarios(t)["summary"])


_PORTFOLIO = """SELECT loan_status, addr_state, CASE WHEN predicted = 1 THEN 'High' ELSE 'Low' END AS charge_off_probability,
  count(*) AS loans, round(sum(funded_amnt), 2) AS amount FROM loans JOIN {p} USING (id) GROUP BY ALL"""


@query("e13_a16_portfolio", _LOANS + _PORTFOLIO.format(p="b"))
def _(t: Tables):
    return rounded(_scenarios(t)["base"], 2)


@query("e13_a16_portfolio_what_if", _LOANS + _PORTFOLIO.format(p="w"))
def _(t: Tables):
    return rounded(_scenarios(t)["what_if"], 2)
