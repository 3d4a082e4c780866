"""Quality of predictions, computed from counts and sums in one or two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from statloom.operators.ordered import ROWS_PER_SPLIT, running, with_row


def regression_metrics(df: DataFrame, observed: str, predicted: str) -> DataFrame:
    """MAE, RMSE, relative absolute and squared error, R2."""
    rows = df.select(F.col(observed).cast("double").alias("o"), F.col(predicted).cast("double").alias("p")).dropna()
    mean = rows.agg(F.avg("o").alias("m")).scalar()
    rows = rows.withColumn("m", mean)
    error, spread = F.col("o") - F.col("p"), F.col("o") - F.col("m")
    sums = rows.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.try_divide(F.sum(F.abs(error)), F.sum(F.abs(spread))).alias("rae"),
        F.try_divide(F.sum(error * error), F.sum(spread * spread)).alias("rse"),
    )
    return sums.withColumn("r2", F.lit(1.0) - F.col("rse"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts per (actual, predicted), pairs with NULL left out."""
    rows = df.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).dropna()
    return rows.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, actual: str, predicted: str, two_decimals: bool = False) -> DataFrame:
    """Counts, accuracy, precision, recall and F for classes 0 and 1.

    ``two_decimals`` rounds every figure, and F is then built from rounded parts.
    """
    a, p = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    )

    def shown(c: Column) -> Column:
        return F.round(c, 2) if two_decimals else c

    tp, fn, fp, tn = (F.col(c).cast("double") for c in ("tp", "fn", "fp", "tn"))
    parts = counts.withColumns(
        {
            "accuracy": shown(F.try_divide(tp + tn, tp + fn + fp + tn)),
            "precision": shown(F.try_divide(tp, tp + fp)),
            "recall": shown(F.try_divide(tp, tp + fn)),
        }
    )
    pr, rc = F.col("precision"), F.col("recall")
    return parts.withColumn("f_score", shown(F.try_divide(2 * pr * rc, pr + rc)))


def _per_class(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows (class, diag, row_n, col_n) for classes seen on either side."""
    cells = confusion(df, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("row_n"), F.lit(0).cast("long").alias("col_n"), hit.alias("diag")),
        F.struct(
            F.col("predicted").alias("class"), F.lit(0).cast("long").alias("row_n"), F.col("n").alias("col_n"), F.lit(0).cast("long").alias("diag")
        ),
    )
    long = cells.select(F.explode(sides).alias("s")).select("s.*")
    return long.groupBy("class").agg(*[F.sum(c).cast("double").alias(c) for c in ("diag", "row_n", "col_n")])


def _mean_or_null(c: str) -> Column:
    """Undefined as soon as one class is undefined."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row per class with its precision, recall and F1 beside the overall figures.

    Includes macro, micro and average accuracy, kappa, and what always naming the
    majority class or guessing at random would reach.
    """
    classes = _per_class(df, actual, predicted)
    totals = classes.agg(F.sum("row_n").alias("n"), F.count(F.lit(1)).cast("double").alias("nc"))
    rows = with_row(classes, totals, "_t").select("*", "_t.n", "_t.nc").drop("_t")
    rows = rows.withColumns(
        {
            "precision": F.try_divide(F.col("diag"), F.col("col_n")),
            "recall": F.try_divide(F.col("diag"), F.col("row_n")),
            "p": F.col("row_n") / F.col("n"),
            "q": F.col("col_n") / F.col("n"),
        }
    )
    rows = rows.withColumn(
        "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    overall = rows.agg(
        F.struct(
            (F.sum("diag") / F.max("n")).alias("accuracy"),
            _mean_or_null("precision").alias("macro_precision"),
            _mean_or_null("recall").alias("macro_recall"),
            _mean_or_null("f1").alias("macro_f1"),
            (F.sum(F.col("n") - F.col("row_n") - F.col("col_n") + 2 * F.col("diag")) / (F.max("n") * F.max("nc"))).alias(
                "avg_accuracy"
            ),
            (F.sum("diag") / F.sum("row_n")).alias("micro_f1"),
            F.max("p").alias("majority_accuracy"),
            # the first of the largest classes
            F.min_by("class", F.struct(-F.col("row_n"), F.col("class"))).alias("majority"),
            F.sum(F.col("p") * F.col("q")).alias("expected"),
        ).alias("o")
    ).scalar()
    rows = rows.withColumn("_o", overall)
    o = F.col("_o")
    major = F.col("class") == o["majority"]
    p, nc = F.col("p"), F.col("nc")
    return rows.select(
        "class",
        "precision",
        "recall",
        "f1",
        *[o[c].alias(c) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "avg_accuracy", "micro_f1")],
        F.try_divide(o["accuracy"] - o["expected"], 1 - o["expected"]).alias("kappa"),
        o["majority_accuracy"].alias("majority_accuracy"),
        F.when(major, p).otherwise(F.lit(0.0)).alias("majority_precision"),
        F.when(major, F.lit(1.0)).otherwise(F.lit(0.0)).alias("majority_recall"),
        F.when(major, 2 * p / (p + 1)).otherwise(F.lit(0.0)).alias("majority_f1"),
        (F.lit(1.0) / nc).alias("guess_accuracy"),
        p.alias("guess_precision"),
        (F.lit(1.0) / nc).alias("guess_recall"),
        (2 * p / (nc * p + 1)).alias("guess_f1"),
    )


def overall_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The figures of ``class_metrics`` that hold for all classes together, as one row."""
    names = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "avg_accuracy", "micro_f1", "kappa"]
    return class_metrics(df, actual, predicted).agg(*[F.first(c).alias(c) for c in names])


def negative_class_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Averages with every class in turn as the negative one.

    Kept for comparison with older result tables: with more than two classes
    ``overall_accuracy`` can pass 1.  Use ``class_metrics`` otherwise.
    """
    classes = _per_class(df, actual, predicted)
    n = classes.agg(F.sum("row_n").alias("n")).scalar()
    rows = classes.withColumn("n", n).withColumns(
        {
            "tn": F.col("diag"),
            "fn": F.col("col_n") - F.col("diag"),
            "fp": F.col("row_n") - F.col("diag"),
            "tp": F.col("n") - F.col("row_n") - F.col("col_n") + F.col("diag"),
        }
    )
    rows = rows.withColumns(
        {
            "accuracy": (F.col("tp") + F.col("tn")) / F.col("n"),
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    )
    rows = rows.withColumn(
        "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    return rows.agg(
        (F.sum("tp") / F.max("n")).alias("overall_accuracy"),
        F.avg("accuracy").alias("average_accuracy"),
        F.try_divide(F.sum("tp"), F.sum("tp") + F.sum("fp")).alias("micro_precision"),
        _mean_or_null("precision").alias("macro_precision"),
        F.try_divide(F.sum("tp"), F.sum("tp") + F.sum("fn")).alias("micro_recall"),
        _mean_or_null("recall").alias("macro_recall"),
        _mean_or_null("f1").alias("macro_f1"),
    )


def roc_points(df: DataFrame, actual: str, score: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """(threshold, fpr, tpr) for each distinct score, highest first; rows at or above it count as positive."""
    rows = df.where(F.col(actual).isNotNull() & F.col(score).isNotNull())
    counts = rows.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )
    wanted = {"tp": ("sum", "pos"), "fp": ("sum", "neg"), "_p": ("total", "pos"), "_n": ("total", "neg")}
    summed = running(counts, [], ["-threshold"], wanted, rows_per_split, reuse=True)
    return summed.withColumns(
        {
            "tpr": F.try_divide(F.col("tp").cast("double"), F.col("_p")),
            "fpr": F.try_divide(F.col("fp").cast("double"), F.col("_n")),
        }
    ).drop("_p", "_n")


def auc(df: DataFrame, actual: str, score: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Area under the curve by trapezoids, so tied scores count half."""
    points = roc_points(df, actual, score, rows_per_split)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return points.agg(F.try_divide(area, F.max("tp").cast("double") * F.max("fp")).alias("auc"))
