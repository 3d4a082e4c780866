"""Passenger survival: prepared view and model input."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from statloom.functions import scalars as S
from statloom.learn import neighbours
from statloom.learn.evaluation import binary_metrics
from statloom.learn.selection import cross_validate, fold_summary
from statloom.learn.training import count_cells, equal_rows, fit_cells, model_pipeline, rbf_svm
from statloom.operators import bins, clean
from statloom.operators.relational import union_all
from statloom.operators.sampling import train_test_split
from statloom.session import materialise

# fixed values: title groups of the two preparations and the codes
TITLE_GROUPS_SHORT = {
    "Mr": ["Mme", "Mr"],
    "Miss": ["Mlle", "Ms", "Miss"],
    "Mrs": ["Mrs"],
    "Master": ["Master"],
}
TITLE_GROUPS = {
    "Other": ["Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona"],
    "Miss": ["Mlle", "Ms"],
    "Mrs": ["Mme"],
}
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5}
OTHER_CODE = 5
PORT_CODES = {"S": 0, "C": 1}
FARE_CUTS = [7.91, 14.454, 31]

FEATURES = ["title", "embarked", "fare", "pclass", "sex", "age", "is_alone"]


def prepared_view(passengers: DataFrame) -> DataFrame:
    """Labelled passengers with short titles, port codes and ages filled by sex."""
    rows = passengers.where(F.col("survived").isNotNull())
    rows = clean.fill_group_median(rows, "age", ["sex"], discrete=True)
    return rows.select(
        "passenger_id",
        S.generalise(S.title_between(F.col("name")), TITLE_GROUPS_SHORT, "Rare").alias("title"),
        S.encode(F.col("embarked"), PORT_CODES, 2).alias("embarked"),
        "fare",
        "pclass",
        "sex",
        "age",
        S.family_size(F.col("sibsp"), F.col("parch")).alias("family_size"),
        S.is_alone(F.col("sibsp"), F.col("parch")).alias("is_alone"),
        "survived",
    )


def title_code(word: Column, compat: bool = True) -> Column:
    """Code of the word's title group; one table, so that the word is extracted once a row."""
    codes = TITLE_CODES if compat else TITLE_CODES | {"Other": OTHER_CODE}
    members = {w: g for g, words in reversed(TITLE_GROUPS.items()) for w in words}
    words = {w: codes[g] for w, g in ({c: c for c in codes} | members).items() if g in codes}
    table = F.create_map(*[F.lit(v) for pair in words.items() for v in pair])
    return F.coalesce(F.try_element_at(table, word), F.lit(0))


def model_input(passengers: DataFrame, compat: bool = True) -> DataFrame:
    """All-number features; missing ports, ages and fares are filled.

    With ``compat`` the group of rare titles keeps code 0, as if there were no title: the
    groups call it Other, the codes Rare.  Without, it has the code meant for it.
    """
    rows = clean.fill_mode(passengers, "embarked")
    rows = rows.withColumn("sex", S.encode(F.col("sex"), {"female": 1, "male": 0}))
    rows = clean.fill_group_median(rows, "age", ["sex", "pclass"], discrete=False, round_half=True)
    rows = clean.fill_median(rows, "fare")
    return rows.select(
        "passenger_id",
        title_code(S.title_word(F.col("name")), compat).alias("title"),
        S.encode(F.col("embarked"), PORT_CODES, 2).alias("embarked"),
        bins.custom_bins(F.col("fare"), FARE_CUTS).alias("fare"),
        "pclass",
        "sex",
        F.col("age").cast("int").alias("age"),
        S.is_alone(F.col("sibsp"), F.col("parch")).alias("is_alone"),
        "survived",
    )


def learner_scores(known: DataFrame, seed: int = 123) -> DataFrame:
    """Accuracy of each learner on its training rows and on the held-out 30 percent, in percent.

    Five learners (logistic, kernel machine, three nearest, tree, forest), the tree without the
    port, and the smaller tree: (learner, part, rows, accuracy, majority).
    """
    # dealt out over the cores: every step of a learner passes over the rows
    train, test = (materialise(d, ["passenger_id"]) for d in train_test_split(known, "passenger_id", 70, seed))
    small = [f for f in FEATURES if f != "embarked"]
    models = {
        "logistic": model_pipeline("logistic", FEATURES, "survived"),
        "kernel_svm": rbf_svm(train, FEATURES, "survived"),
        "tree": model_pipeline("tree_classifier", FEATURES, "survived", depth=20),
        "forest": model_pipeline("forest_classifier", FEATURES, "survived", trees=100, depth=12),
        "tree_without_port": model_pipeline("tree_classifier", small, "survived", depth=20),
        "smaller_tree": model_pipeline("tree_classifier", FEATURES, "survived", depth=8, min_leaf=2),
    }
    vector = neighbours.feature_array(FEATURES)
    held = train.withColumn("_v", vector)
    parts = {"train": train, "test": test}
    # one part a core but one: the many short steps of the other learners need not wait for the long ones of the forest
    whole = train.coalesce(max(1, train.sparkSession.sparkContext.defaultParallelism - 1))

    def fit(name: str) -> PipelineModel:
        cells = equal_rows(models[name], train, FEATURES)
        return models[name].fit(whole) if cells is None else fit_cells(models[name], train, cells)

    def classify(part: str) -> DataFrame:
        near = neighbours.classify(held, parts[part].withColumn("_v", vector), "_v", "survived", "passenger_id", k=3)
        known_class = parts[part].select("passenger_id", "survived").join(near, "passenger_id")
        return materialise(known_class.groupBy("survived", F.col("predicted").alias("prediction")).agg(F.count(F.lit(1)).cast("double").alias("_n")))

    with ThreadPoolExecutor(len(models) + len(parts)) as pool:  # independent of each other
        near = {part: pool.submit(classify, part) for part in parts}
        fitted = dict(zip(models, pool.map(fit, models)))
    found = []
    for part, rows in parts.items():
        # equal rows get one prediction, weighed with their number
        cells = count_cells(rows, [*FEATURES, "survived"], {"_n": F.lit(1)})
        scored = rows.withColumn("_n", F.lit(1.0)) if cells is None else cells
        found += [(name, part, model.transform(scored).select("survived", "prediction", "_n")) for name, model in fitted.items()]
        found.append(("three_nearest", part, near[part].result()))
    share = lambda condition: F.sum(F.when(condition, F.col("_n")).otherwise(0.0)) / F.sum("_n")
    right = share(F.col("survived") == F.col("prediction"))
    majority = F.greatest(share(F.col("survived") == 1), share(F.col("survived") != 1))
    rows = [
        d.agg(F.sum("_n").cast("long").alias("rows"), (100 * right).alias("accuracy"), (100 * majority).alias("majority")).select(
            F.lit(name).alias("learner"), F.lit(part).alias("part"), "*"
        )
        for name, part, d in found
    ]
    return union_all(rows)


def survival_job(passengers: DataFrame, folds: int = 10) -> DataFrame:
    """Predictions for passengers without an outcome by the smaller tree, which cross validation rates.

    Returns (passenger_id, predicted, folds, cv_accuracy, cv_deviation).
    """
    rows = materialise(model_input(passengers))
    known = rows.where(F.col("survived").isNotNull())
    tree = model_pipeline("tree_classifier", FEATURES, "survived", depth=8, min_leaf=2)
    scores = cross_validate(known, "passenger_id", folds, tree.fit, lambda d: binary_metrics(d, "survived", "prediction"), seed=12)
    rating = fold_summary(scores, "accuracy").first()
    found = tree.fit(known).transform(rows.where(F.col("survived").isNull()))
    return found.select(
        "passenger_id",
        F.col("prediction").cast("int").alias("predicted"),
        F.lit(rating["folds"]).alias("folds"),
        F.lit(rating["mean"]).alias("cv_accuracy"),
        F.lit(rating["st_deviation"]).alias("cv_deviation"),
    )
