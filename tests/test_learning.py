"""Properties of the learners."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statloom.learn import ensembles, evaluation, explain, groups, imputation, neighbours, neural, scoring, selection, training


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 1200
    x = rng.normal(size=(n, 3))
    y = 2 * x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=n)
    group = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b"], n))
    label = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + 0.5 * x[:, 2])))).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2], "y": y, "g": group, "label": label})
    return spark.createDataFrame(pdf).cache(), pdf


X = ["x0", "x1", "x2"]


def test_group_linear(data):
    df, pdf = data
    for r in groups.group_linear(df, "g", X, "y").collect():
        part = pdf[pdf.g == r["g"]]
        a = np.column_stack([np.ones(len(part)), part[X]])
        assert r["coefficients"] == pytest.approx(np.linalg.lstsq(a, part.y, rcond=None)[0].tolist(), rel=1e-6, abs=1e-9)


def test_group_logistic_agrees_with_single_fits(data):
    df, _ = data
    found = {r["g"]: r["coefficients"] for r in groups.group_logistic(df, "g", X, "label").collect()}
    assert set(found) == {"hot", "a", "b"}
    for g, c in found.items():
        single = training.model_pipeline("logistic", X, "label").fit(df.where(F.col("g") == g)).stages[-1]
        assert c[0] == pytest.approx(single.intercept, abs=2e-3)
        assert c[1:] == pytest.approx(list(single.coefficients), abs=2e-3)


def test_group_scores(data):
    df, _ = data
    model = groups.group_linear(df, "g", X, "y")
    scored = groups.score_groups(df, model, "g", X, "p")
    assert evaluation.regression_metrics(scored, "y", "p").first()["r2"] > 0.98


def test_network_learns(data):
    df, _ = data
    model = neural.fit_network(df, X, "y", hidden=(6,), iterations=40)
    assert model.losses[-1] < model.losses[0] / 5
    assert evaluation.regression_metrics(model.transform(df), "y", "prediction").first()["r2"] > 0.8
    again = neural.fit_network(df, X, "y", hidden=(6,), iterations=3)
    assert again.losses == pytest.approx(model.losses[:3])


def test_network_rows_are_packed_once_and_whole(data, spark):
    """A pass reads blocks of rows, and the numbers come out as they went in."""
    df, pdf = data
    rows = df.select(*X, "y")
    blocks = [r["block"] for r in neural.packed(rows).collect()]
    found = np.concatenate([np.frombuffer(b).reshape(-1, 4) for b in blocks])
    assert sorted(map(tuple, found)) == sorted(map(tuple, pdf[[*X, "y"]].to_numpy()))
    assert len(blocks) < len(pdf) / 20 and max(map(len, blocks)) <= 8 * neural.BLOCK_NUMBERS
    assert neural.packed(rows.where("false")).count() == 0


def test_predictions_are_computed_once_for_all_figures(data, spark):
    df, _ = data
    scored = spark.sparkContext.accumulator(0)

    class Costly:
        def transform(self, rows):
            @F.udf("double")
            def predict(v):
                scored.add(1)
                return v

            return rows.withColumn("prediction", predict("x0"))

    def report(model):
        return selection.generalisation(model, df, df, lambda d: evaluation.regression_metrics(d, "y", "prediction")).collect()

    found, once = report(scoring.WrittenOnce(Costly(), ["y"])), scored.value
    assert once == 2 * df.count()
    for a, b in zip(found, report(Costly())):
        assert a["part"] == b["part"] and a["unscored"] == b["unscored"] and a["rmse"] == pytest.approx(b["rmse"], rel=1e-9)


def test_network_gradient():
    rng = np.random.default_rng(0)
    sizes = [2, 3, 2, 1]
    size = sum((a + 1) * b for a, b in zip(sizes, sizes[1:]))
    w, x, y = rng.normal(size=size), rng.normal(size=(5, 2)), rng.normal(size=5)
    g, _ = neural._gradient(x, y, w, sizes)
    for i in range(size):
        step = np.zeros(size)
        step[i] = 1e-6
        up, down = (neural._gradient(x, y, w + s, sizes)[1] for s in (step, -step))
        assert g[i] == pytest.approx((up - down) / 4e-6, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("shard_rows,pivots", [(1000, 5), (40, 12), (7, 1)])
def test_nearest_neighbours_against_brute_force(spark, shard_rows, pivots):
    rng = np.random.default_rng(2)
    # whole-number points give copies and equal distances; a third of the rows are one point
    train = rng.integers(0, 6, size=(300, 3)).astype(float)
    train[:100] = [1, 2, 3]
    labels = rng.integers(0, 3, 300)
    test = rng.integers(0, 6, size=(80, 3)) + 0.25
    tr = spark.createDataFrame([(v.tolist(), int(l)) for v, l in zip(train, labels)], "v array<double>, label int")
    te = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(test)], "id int, v array<double>")
    got = neighbours.nearest(tr, te, "v", "label", "id", 3, pivots, shard_rows)
    sums = {r["id"]: (r["n"], r["d"]) for r in got.groupBy("id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("dist")).alias("d")).collect()}
    votes = {r["id"]: r["predicted"] for r in neighbours.classify(tr, te, "v", "label", "id", 3, pivots=pivots, shard_rows=shard_rows).collect()}
    for i, q in enumerate(test):
        d = np.sqrt(((train - q) ** 2).sum(axis=1))
        best = np.lexsort((labels, d))[:3]
        assert sums[i][0] == 3
        assert sums[i][1] == pytest.approx(d[best].sum())
        counts = np.bincount(labels[best], minlength=3)
        assert votes[i] == counts.argmax()


@pytest.mark.parametrize("rows_per_split", [10_000, 100])
def test_pmm_uses_observed_values(data, rows_per_split):
    df, pdf = data
    holes = df.withColumn("y", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("y")))
    filled = imputation.impute_pmm(holes.select("id", "x0", "x1", "y"), ["y"], ["x0", "x1"], 1, rows_per_split).toPandas()
    assert filled.y.notna().all() and len(filled) == len(pdf)
    merged = filled.merge(pdf, on="id", suffixes=("", "_true"))
    kept = merged.id % 5 != 0
    assert (merged.y[kept] == merged.y_true[kept]).all()
    assert set(merged.y[~kept]) <= set(merged.y_true[kept])
    assert np.corrcoef(merged.y[~kept], merged.y_true[~kept])[0, 1] > 0.95


def test_shapley_of_a_linear_model(data):
    df, pdf = data

    def predict(d):
        return d.withColumn("prediction", 3 * F.col("x0") - 2 * F.col("x1") + 1)

    few = df.where("id < 5")
    got = {(r["id"], r["feature"]): r["contribution"] for r in explain.shapley(predict, few, df, X, "id", samples=30).collect()}
    total = {i: sum(got[i, f] for f in X) for i in range(5)}
    assert got[0, "x2"] == pytest.approx(0, abs=1e-12)
    # same background for every row, so contributions differ by coefficient times difference
    assert got[1, "x0"] - got[0, "x0"] == pytest.approx(3 * (pdf.x0[1] - pdf.x0[0]))
    f = 3 * pdf.x0 - 2 * pdf.x1 + 1
    assert total[1] - total[0] == pytest.approx(f[1] - f[0])


def test_probabilities_sum_to_one(data):
    df, _ = data
    model = training.model_pipeline("forest_classifier", X, "label", trees=5).fit(df)
    scored = scoring.score(model, df, ["id"], classes=2)
    assert scored.where(F.abs(F.col("prob_0") + F.col("prob_1") - 1) > 1e-9).count() == 0
    assert scored.count() == df.count()


def test_cross_validation_beats_guessing(data):
    df, pdf = data
    fit = training.model_pipeline("logistic", X, "label").fit
    folds = selection.cross_validate(df, "id", 4, fit, lambda d: evaluation.binary_metrics(d, "label", "prediction"))
    summary = selection.fold_summary(folds, "accuracy").first()
    assert summary["folds"] == 4 and summary["mean"] > max(pdf.label.mean(), 1 - pdf.label.mean())
    assert folds.agg(F.sum(F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))).first()[0] == len(pdf)


def test_bootstrap_is_stable_and_full_size(data):
    df, pdf = data
    a, b = (ensembles.bootstrap(df, "id", 4).groupBy("id").count() for _ in range(2))
    assert a.exceptAll(b).count() == 0
    assert abs(ensembles.bootstrap(df, "id", 4).count() - len(pdf)) < 4 * np.sqrt(len(pdf))


def test_registry(spark):
    registry = scoring.empty_registry(spark)
    for f in (0.5, 0.7):
        registry = scoring.register(registry, {"name": "m", "path": "/x", "trees": 3, "train_f": f})
    registry = scoring.set_test_score(registry, "m", 0.6)
    row = registry.collect()
    assert len(row) == 1 and (row[0]["train_f"], row[0]["test_f"]) == (0.7, 0.6)


def test_rows_with_a_missing_feature_are_counted(data):
    """They get no prediction and are reported, in folds, on both parts, by the factory and by ensembles."""
    df, _ = data
    holes = df.withColumn("x0", F.when(F.col("id") % 10 != 0, F.col("x0")))
    n, missing = holes.count(), holes.where("x0 IS NULL").count()
    evaluate = lambda d: evaluation.regression_metrics(d, "y", "prediction")
    tree = training.model_pipeline("tree_regressor", X, "y")
    folds = selection.cross_validate(holes, "id", 2, tree.fit, evaluate).collect()
    assert sum(r["unscored"] for r in folds) == missing > 0
    parts = selection.generalisation(tree.fit(holes), holes, df, evaluate).collect()
    assert {r["part"]: r["unscored"] for r in parts} == {"train": missing, "test": 0}
    found = ensembles.fit_ensemble(holes, [tree, tree], "id").transform(holes)
    assert found.count() == n and found.where("prediction IS NULL").count() == missing


def test_equal_rows_are_asked_once(spark, monkeypatch):
    """Every row has the class of its vector, though the search sees a vector once."""
    df = spark.range(300).select("id", F.array((F.col("id") % 6).cast("double"), (F.col("id") % 5).cast("double")).alias("v"), (F.col("id") % 3).alias("label"))
    asked, search = [], neighbours.nearest
    monkeypatch.setattr(neighbours, "nearest", lambda train, test, *a, **o: asked.append(test.count()) or search(train, test, *a, **o))
    got = {r["id"]: r["predicted"] for r in neighbours.classify(df, df, "v", "label", "id", k=3).collect()}
    # all copies of a vector have the label its first number gives, and there are ten of them
    assert got == {i: i % 3 for i in range(300)} and asked == [30]


@pytest.fixture(scope="module")
def repeated(spark):
    """Twenty-four kinds of rows, most of them many times."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, n, 3000) for n in (4, 3, 2)]).astype(float)
    label = (rng.random(3000) < 1 / (1 + np.exp(2 - x[:, 0] - x[:, 2]))).astype(int)
    pdf = pd.DataFrame({"id": np.arange(3000), "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2], "label": label})
    return spark.createDataFrame(pdf).cache()


def _learner(kind, df):
    if kind == "kernel":
        return training.rbf_svm(df, X, "label", waves=12)
    scale = kind == "svm"
    return training.model_pipeline(kind, X, "label", scale=scale, trees=4, **({"l2": 0.01} if scale else {}))


@pytest.mark.parametrize("kind", ["logistic", "svm", "kernel", "tree_classifier", "boosted_classifier"])
def test_equal_rows_as_one_give_the_same_model(repeated, kind):
    pipeline = _learner(kind, repeated)
    cells = training.equal_rows(pipeline, repeated, X)
    assert cells.count() <= 48 and cells.agg(F.sum("_weight")).first()[0] == 3000
    found, want = training.fit_equal(pipeline, repeated, X), pipeline.fit(repeated)
    if kind in ("svm", "kernel"):  # the hinge has no single best line to stop at, so the loss that is made small is compared

        def loss(model):
            margin = (2 * F.col("label") - 1) * vector_to_array("rawPrediction")[1]
            hinge = model.transform(repeated).agg(F.avg(F.greatest(F.lit(0.0), 1 - margin))).first()[0]
            return hinge + 0.005 * float(np.square(model.stages[-1].coefficients.toArray()).sum())

        assert loss(found) == pytest.approx(loss(want), rel=0.02)
    else:
        a, b = ([r["prediction"] for r in m.transform(repeated).orderBy("id").select("prediction").collect()] for m in (found, want))
        assert a == b


def test_equal_rows_only_where_few_and_weighted(repeated, data):
    assert training.equal_rows(training.model_pipeline("logistic", X, "label"), data[0]) is None  # all rows differ
    assert training.equal_rows(training.model_pipeline("forest_classifier", X, "label"), repeated) is None  # draws rows
    assert training.equal_rows(training.model_pipeline("tree_classifier", X, "label", min_leaf=2), repeated) is None
    assert training.equal_rows(training.model_pipeline("logistic", X, "label", l2=0.1), repeated) is None


def test_passes_of_a_learner_read_evenly_dealt_rows(spark, folder):
    from statloom.catalog import Tables, models

    for parts in (models.survival(Tables(spark, folder)), models.engine(Tables(spark, folder))):
        assert all(len(rows.inputFiles()) >= spark.sparkContext.defaultParallelism for rows in parts)


def test_title_code_is_the_code_of_the_group(spark):
    from statloom.functions import scalars
    from statloom.plans import passengers as P

    words = [w for group in P.TITLE_GROUPS.values() for w in group] + [*P.TITLE_GROUPS, *P.TITLE_CODES, "Xy", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for compat in (True, False):
        codes = P.TITLE_CODES if compat else P.TITLE_CODES | {"Other": P.OTHER_CODE}
        want = scalars.encode(scalars.generalise(F.col("w"), P.TITLE_GROUPS, keep=True), codes, 0)
        assert df.where(~P.title_code(F.col("w"), compat).eqNullSafe(want)).count() == 0


def test_costly_model_scores_equal_rows_once(repeated):
    holes = repeated.withColumn("x0", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("x0")))
    model = _learner("kernel", repeated).fit(repeated)
    want = {r["id"]: r["prediction"] for r in scoring.transform_all(model, holes).select("id", "prediction").collect()}
    found = {r["id"]: r["prediction"] for r in scoring.OncePerRow(model, X).transform(holes).collect()}
    assert len(found) == 3000 and all(found[i] == (None if i % 50 == 0 else want[i]) for i in found)


def test_members_do_not_multiply_the_reads(repeated, spark, tmp_path):
    repeated.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    tree = training.model_pipeline("tree_classifier", X, "label", depth=2)
    model = ensembles.fit_ensemble(rows, [tree, tree, tree], "id", "vote")
    plan = model.transform(rows).agg(F.count("prediction"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2


def test_classes_are_fitted_side_by_side(spark):
    assert training.model_pipeline("boosted_classifier", X, "label", classes=3).getStages()[-1].getParallelism() == 3


def test_members_share_the_pass_over_the_rows(repeated, spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    trees = [training.model_pipeline("tree_classifier", X, "label", depth=d) for d in (1, 2, 3)]
    ensembles.fit_ensemble(repeated.withColumn("x0", seen("x0")), trees, "id", "probability")
    assert read.value <= 2 * repeated.count()  # one pass tells whether rows are equal, one counts them
    for i, cells in ensembles.sample_cells(repeated, trees, "id", 1).items():
        want = ensembles.bootstrap(repeated, "id", 1 + i).groupBy(*X, "label").count().collect()
        assert {tuple(r[:4]): r["_weight"] for r in cells.collect()} == {tuple(r[:4]): r["count"] for r in want}


def test_ensemble_scores_equal_rows_once(repeated, spark):
    tree = training.model_pipeline("tree_classifier", X, "label", depth=2)
    model = ensembles.fit_ensemble(repeated, [tree, tree], "id", "probability")
    holes = repeated.withColumn("x1", F.when(F.col("id") % 50 != 0, F.col("x1")))
    want = {r["id"]: r["prediction"] for r in model.transform(holes).collect()}
    assert {r["id"]: r["prediction"] for r in scoring.OncePerRow(model, X).transform(holes).collect()} == want


def test_learner_scores_take_equal_rows_once(spark, monkeypatch):
    """The figures are those of a model scored row by row; learners with weights are fitted on distinct rows."""
    from statloom.plans import passengers

    rng = np.random.default_rng(11)
    columns = {f: rng.integers(0, n, 1200) for f, n in zip(passengers.FEATURES, (2, 2, 1, 2, 2, 2, 1))}
    y = ((columns["sex"] + columns["pclass"] + rng.integers(0, 2, 1200)) > 1).astype(int)
    known = spark.createDataFrame(pd.DataFrame({"passenger_id": np.arange(1200), **columns, "survived": y}))
    fits, fit = [], passengers.fit_cells
    monkeypatch.setattr(passengers, "fit_cells", lambda p, d, cells: fits.append((d.count(), cells.count())) or fit(p, d, cells))
    rows = {(r["learner"], r["part"]): r for r in passengers.learner_scores(known).collect()}
    assert len(rows) == 14 and len(fits) == 4 and all(cells < n / 2 for n, cells in fits)
    train, test = passengers.train_test_split(known, "passenger_id", 70, 123)
    tree = training.model_pipeline("tree_classifier", passengers.FEATURES, "survived", depth=20).fit(train)
    for part, d in {"train": train, "test": test}.items():
        want = tree.transform(d).agg(F.count("*").alias("n"), F.avg((F.col("survived") == F.col("prediction")).cast("double")).alias("a"), F.avg("survived").alias("m")).first()
        got = rows["tree", part]
        assert got["rows"] == want["n"] and got["accuracy"] == pytest.approx(100 * want["a"])
        assert all(rows[k, part]["majority"] == pytest.approx(100 * max(want["m"], 1 - want["m"])) and rows[k, part]["rows"] == want["n"] for k, p in rows if p == part)
