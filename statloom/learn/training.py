"""Learners as MLlib pipelines over named columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    PCA,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, functions as F

from statloom.session import materialise

#: A learner gets equal rows as one with a weight where there are at least this many times as many rows.
ROWS_A_CELL = 4
#: More distinct rows than this are dealt out over the cores; fewer are one short task a pass.
CELLS_A_TASK = 50_000


def feature_stages(features: Sequence[str], categorical: Sequence[str] = (), scale: bool = False) -> list:
    """Index text columns, assemble, and standardise on request."""
    stages = [StringIndexer(inputCol=c, outputCol=c + "_ix", handleInvalid="keep") for c in categorical]
    inputs = [c + "_ix" if c in categorical else c for c in features]
    out = "_raw_features" if scale else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="skip"))
    if scale:
        stages.append(StandardScaler(inputCol=out, outputCol="features", withMean=True, withStd=True))
    return stages


def learner(kind: str, label: str, seed: int = 1, classes: int = 2, width: int = 0, **options):
    """The estimator for a kind of model.

    Tree options: trees, depth, min_leaf, per_split (columns tried), share (rows per tree).
    Linear options: l1, l2.  Network options: hidden (layer sizes), iterations.
    """
    common = {"featuresCol": "features", "labelCol": label}
    l1, l2 = options.get("l1", 0.0), options.get("l2", 0.0)
    weight = l1 + l2
    penalty = {"regParam": weight, "elasticNetParam": l1 / weight if weight else 0.0}
    tree = {"maxDepth": options.get("depth", 5), "minInstancesPerNode": options.get("min_leaf", 1), "seed": seed}
    forest = tree | {
        "numTrees": options.get("trees", 20),
        "featureSubsetStrategy": str(options.get("per_split", "auto")),
        "subsamplingRate": options.get("share", 1.0),
        # a row's place in each deep tree is kept between the passes, not looked up from the root in every one
        "cacheNodeIds": tree["maxDepth"] > 10,
    }
    boost = tree | {"maxIter": options.get("trees", 20), "stepSize": options.get("rate", 0.1)}
    if kind == "linear":
        return LinearRegression(**common, **penalty, solver="normal" if not l1 else "auto")
    if kind == "glm":
        return GeneralizedLinearRegression(**common, family="gaussian", regParam=l2)
    if kind == "logistic":
        family = "binomial" if classes == 2 else "multinomial"
        return LogisticRegression(**common, **penalty, family=family, maxIter=options.get("iterations", 100))
    if kind == "tree_classifier":
        return DecisionTreeClassifier(**common, **tree, impurity="gini")
    if kind == "tree_regressor":
        return DecisionTreeRegressor(**common, **tree)
    if kind == "forest_classifier":
        return RandomForestClassifier(**common, **forest)
    if kind == "forest_regressor":
        return RandomForestRegressor(**common, **forest)
    if kind == "boosted_regressor":
        return GBTRegressor(**common, **boost)
    if kind == "boosted_classifier":
        one = GBTClassifier(**common, **boost)
        return one if classes == 2 else OneVsRest(classifier=one, parallelism=classes, **common)
    if kind == "network":
        layers = [width, *options.get("hidden", [20]), classes]
        return MultilayerPerceptronClassifier(**common, layers=layers, maxIter=options.get("iterations", 100), seed=seed)
    if kind == "svm":
        standardise = options.get("standardise", True)
        return LinearSVC(**common, regParam=l2, maxIter=options.get("iterations", 50), standardization=standardise)
    raise ValueError(f"unknown learner {kind}")


def model_pipeline(
    kind: str,
    features: Sequence[str],
    label: str,
    categorical: Sequence[str] = (),
    scale: bool = False,
    **options,
) -> Pipeline:
    stages = feature_stages(features, categorical, scale)
    if scale and kind == "svm":  # the columns have deviation 1 already; over weighted rows it would come out smaller
        options = {"standardise": False} | options
    return Pipeline(stages=[*stages, learner(kind, label, width=len(features), **options)])


def rbf_svm(
    df: DataFrame, features: Sequence[str], label: str, waves: int = 100, gamma: float = 0.1, seed: int = 1, l2: float = 0.01
) -> Pipeline:
    """Kernel machine: random cosine features of the Gaussian kernel, then a linear machine.

    ``df`` gives the means and deviations the columns are standardised with.
    """
    fit = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, math.sqrt(2 * gamma), size=(waves, len(features)))
    shifts = rng.uniform(0, 2 * math.pi, size=waves)
    waved = []
    for w in range(waves):
        angle, terms = float(shifts[w]), []
        for i, c in enumerate(features):
            rate = float(weights[w, i]) / (fit[f"s{i}"] or 1.0)
            angle -= rate * fit[f"m{i}"]
            terms.append(f"{rate!r}D * `{c}`")
        waved.append(f"cos({angle!r}D + " + " + ".join(terms) + ")")
    # deviations of the waves, from the distinct rows and how many there are of each
    distinct = df.select(*features).dropna().groupBy(*features).agg(F.count(F.lit(1)).alias("_n"))
    wave = distinct.select("_n", *[F.expr(c).alias(f"_w{w}") for w, c in enumerate(waved)])
    sums = [F.sum(F.col("_n") * F.col(f"_w{w}") ** p).alias(f"s{p}_{w}") for w in range(waves) for p in (1, 2)]
    moments = wave.agg(F.sum("_n").alias("n"), *sums).first()
    n, columns = moments["n"] or 0, []
    for w, c in enumerate(waved):
        square = (moments[f"s2_{w}"] - moments[f"s1_{w}"] ** 2 / n) / (n - 1) if n > 1 else 0.0
        columns.append(f"{c} / {math.sqrt(square) if square > 0 else 1.0!r}D AS _w{w}")
    cosine = SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")
    final = VectorAssembler(inputCols=[f"_w{w}" for w in range(waves)], outputCol="features", handleInvalid="skip")
    machine = learner("svm", label, l2=l2, standardise=False)
    return Pipeline(stages=[cosine, final, machine])


def weighs_rows(estimator) -> bool:
    """True where a row with weight n is for the learner what n equal rows are."""
    if isinstance(estimator, (LogisticRegression, LinearSVC)):
        # deviations of weighted rows differ a little, so a penalty must not depend on them
        return not estimator.getRegParam() or not estimator.getStandardization()
    trees = (DecisionTreeClassifier, DecisionTreeRegressor, GBTClassifier, GBTRegressor)
    return isinstance(estimator, trees) and estimator.getMinInstancesPerNode() == 1


def cell_columns(pipeline: Pipeline, columns: Sequence[str] | None = None) -> list[str] | None:
    """The columns a learner that takes weights reads, label last; None where it takes none or they are not known.

    ``columns`` names the features of a pipeline that starts in SQL.
    """
    *prepare, last = pipeline.getStages()
    if not weighs_rows(last):
        return None
    if columns is None:
        if any(isinstance(s, SQLTransformer) for s in prepare):
            return None
        made = {s.getOutputCol() for s in prepare}
        assembled = [c for s in prepare if isinstance(s, VectorAssembler) for c in s.getInputCols()]
        indexed = [s.getInputCol() for s in prepare if isinstance(s, StringIndexer)]
        columns = [c for c in assembled + indexed if c not in made]
    return list(dict.fromkeys([*columns, last.getLabelCol()]))


def count_cells(df: DataFrame, names: Sequence[str], weights: dict[str, Column]) -> DataFrame | None:
    """Distinct rows of ``names`` with the sums of ``weights``, all from one pass.

    None where the rows are not ``ROWS_A_CELL`` times as many as the distinct ones.
    """
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*names)).alias("cells")).first()
    if size["rows"] < ROWS_A_CELL * size["cells"]:
        return None
    cells = df.groupBy(*names).agg(*[F.sum(w).cast("double").alias(n) for n, w in weights.items()])
    return materialise(cells, names if size["cells"] > CELLS_A_TASK else ())


def equal_rows(pipeline: Pipeline, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame | None:
    """Distinct rows of what the pipeline reads, ``_weight`` with how many there are of each.

    None where the learner takes no weights or too few rows are equal.  ``columns`` as in ``cell_columns``.
    """
    names = cell_columns(pipeline, columns)
    return names and count_cells(df, names, {"_weight": F.lit(1)})


def fit_cells(pipeline: Pipeline, df: DataFrame, cells: DataFrame) -> PipelineModel:
    """``pipeline.fit(df)`` from its ``equal_rows``; scales and levels still come from all rows."""
    *prepare, last = pipeline.getStages()
    ready = Pipeline(stages=prepare).fit(df)
    learned = last.copy({last.weightCol: "_weight"}).fit(ready.transform(cells))
    return PipelineModel(stages=[*ready.stages, learned])


def fit_equal(pipeline: Pipeline, df: DataFrame, columns: Sequence[str] | None = None) -> PipelineModel:
    """``pipeline.fit(df)``, with equal rows taken as one where that is the same and much less."""
    cells = equal_rows(pipeline, df, columns)
    return pipeline.fit(df) if cells is None else fit_cells(pipeline, df, cells)


def coefficient_table(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Estimate, standard error, t and p per term of a linear or generalised linear model."""
    fitted = model.stages[-1]
    summary = fitted.summary
    names = [*features, "(intercept)"]
    estimates = [*[float(c) for c in fitted.coefficients], float(fitted.intercept)]
    rows = zip(names, estimates, map(float, summary.coefficientStandardErrors), map(float, summary.tValues), map(float, summary.pValues))
    spark = summary.predictions.sparkSession
    return spark.createDataFrame(list(rows), "term string, estimate double, std_error double, t double, p_value double")


def importance_table(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Share of impurity removed per feature of a tree model, or weight of a linear one."""
    fitted = model.stages[-1]
    values = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    rows = [(name, float(v)) for name, v in zip(features, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def deviance_summary(model: PipelineModel) -> DataFrame:
    """Deviance, degrees of freedom and exponentiated coefficients of a generalised linear model."""
    fitted = model.stages[-1]
    s = fitted.summary
    spark = s.predictions.sparkSession
    with np.errstate(over="ignore"):
        ratios = [float(c) for c in np.exp(fitted.coefficients.toArray())]
    return spark.createDataFrame(
        [(float(s.deviance), int(s.residualDegreeOfFreedom), float(s.nullDeviance), ratios)],
        "deviance double, df long, null_deviance double, exp_coefficients array<double>",
    )


def principal_components(df: DataFrame, columns: Sequence[str], k: int, scale: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rotation rows, explained share rows, input with the array column ``scores``); data is centred first.

    Components come from complete rows; a row with a missing value stays, with NULL scores.
    """
    assemble = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="skip")
    centre = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=scale)
    fitted = Pipeline(stages=[assemble, centre, PCA(k=k, inputCol="_c", outputCol="_s")]).fit(df)
    pca = fitted.stages[-1]
    spark = df.sparkSession
    matrix = pca.pc.toArray()
    rotation = spark.createDataFrame(
        [(c, j + 1, float(matrix[i, j])) for i, c in enumerate(columns) for j in range(k)],
        "variable string, component int, loading double",
    )
    shares = [float(v) for v in pca.explainedVariance.toArray()]
    explained = spark.createDataFrame([(j + 1, v) for j, v in enumerate(shares)], "component int, share double")
    whole = reduce(and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns])
    scores = fitted.transform(df.where(whole)).withColumn("scores", vector_to_array("_s")).drop("_v", "_c", "_s")
    scores = scores.unionByName(df.where(~whole), allowMissingColumns=True)
    return rotation, explained, scores

