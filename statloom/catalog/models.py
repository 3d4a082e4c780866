"""Model training, scoring, tuning and explanation."""

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from statloom.catalog import Tables, query, rounded
from statloom.catalog.inputs import cte
from statloom.catalog.jobs import return_lines
from statloom.catalog.sampling import unit
from statloom.catalog.series import CYCLES, cycles
from statloom.learn import (
    clusters as K,
    ensembles as N,
    evaluation as E,
    explain,
    forests,
    groups as G,
    imputation,
    lines as L,
    neighbours,
    neural,
    scoring as S,
    selection as X,
    training as M,
)
from statloom.operators import relational as R, sampling
from statloom.plans import customers, maintenance, passengers
from statloom.session import materialise
from statloom.sources.writers import insert_rows, scratch_folder, write_table

FEATURES = passengers.FEATURES
SENSORS = ["cycle", "s1", "s2", "a1", "a2", "sd1", "sd2"]


def _parts(df, key: list[str], seed: int = 0):
    """Train and test rows, written once with their part and dealt out evenly for the passes of a learner."""
    rows = materialise(df.withColumn("_train", sampling.hash_unit(key, seed) < 0.7), key)
    return rows.where("_train").drop("_train"), rows.where("NOT _train").drop("_train")


def survival(t: Tables):
    """Train and test passengers."""
    return _parts(passengers.model_input(t.passengers).dropna(), ["passenger_id"], seed=123)


def engine(t: Tables):
    """Train and test cycles with rolling features and labels."""
    return _parts(maintenance.train_features(cycles(t).drop("event_id"), ["s1", "s2"]), ["id", "cycle"])


def _binary(df):
    return E.binary_metrics(df, "survived", "prediction")


def _regression(df):
    return E.regression_metrics(df, "rul", "prediction")


def _multiclass(df):
    return E.class_metrics(df, "label2", "prediction")


def _fit_report(t: Tables, kind: str, **options):
    train, test = survival(t)
    model = M.fit_equal(M.model_pipeline(kind, FEATURES, "survived", **options), train)
    return X.generalisation(model, train, test, _binary)


LINE = "regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept"


@query(
    "l1_line_fit",
    f"WITH f AS (SELECT {LINE}, count(*) AS n FROM lineitem) SELECT round(intercept, 4) AS intercept, round(slope, 6) AS slope, n FROM f",
)
def _(t: Tables):
    line = L.fit_line(t.lineitem, "l_quantity", "l_extendedprice").drop("rmse")
    return rounded(rounded(line, 4, "intercept"), 6, "slope")


@query(
    "l1_coefficient_table",
    """WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_tax, l_extendedprice) AS ty, covar_pop(l_quantity, l_tax) AS ab,
      var_pop(l_quantity) AS aa, var_pop(l_tax) AS bb, avg(l_quantity) AS ma, avg(l_tax) AS mb, avg(l_extendedprice) AS my FROM lineitem),
    c AS (SELECT *, (ay * bb - ty * ab) / (aa * bb - ab * ab) AS p, (ty * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM s)
    SELECT 'l_quantity' AS term, round(p, 4) AS estimate FROM c UNION ALL SELECT 'l_tax', round(q, 4) FROM c
    UNION ALL SELECT '(intercept)', round(my - p * ma - q * mb, 4) FROM c""",
)
def _(t: Tables):
    model = M.model_pipeline("linear", ["l_quantity", "l_tax"], "l_extendedprice").fit(t.lineitem)
    return rounded(M.coefficient_table(model, ["l_quantity", "l_tax"]).select("term", "estimate"), 4)


@query(
    "l2_predictions_residuals",
    f"""WITH f AS (SELECT {LINE} FROM lineitem) SELECT l_orderkey, l_linenumber, round(intercept + slope * l_quantity, 4) AS pred,
    round(l_extendedprice - (intercept + slope * l_quantity), 4) AS resid FROM lineitem, f""",
)
def _(t: Tables):
    line = L.fit_line(t.lineitem, "l_quantity", "l_extendedprice")
    rows = L.add_predictions(t.lineitem, line, "l_quantity")
    rows = L.add_residuals(rows, line, "l_quantity", "l_extendedprice")
    return rounded(rows.select("l_orderkey", "l_linenumber", "pred", "resid"), 4)


@query(
    "l2_prediction_grid",
    f"""WITH f AS (SELECT {LINE} FROM lineitem) SELECT DISTINCT l_quantity, round(intercept + slope * l_quantity, 4) AS pred FROM lineitem, f""",
)
def _(t: Tables):
    line = L.fit_line(t.lineitem, "l_quantity", "l_extendedprice")
    return rounded(L.add_predictions(t.lineitem.select("l_quantity").distinct(), line, "l_quantity"), 4)


GRID = {"intercepts": (-40000.0, 80000 / 29, 30), "slopes": (-1000.0, 6000 / 29, 30)}


@query(
    "l3_j5_grid_search",
    f"""WITH g AS (SELECT CAST(-40000 + a * {80000 / 29!r} AS DOUBLE) AS a1, CAST(-1000 + b * {6000 / 29!r} AS DOUBLE) AS a2 FROM range(30) x(a), range(30) y(b)),
    s AS (SELECT l_quantity AS x, sum(l_extendedprice) AS y, sum(l_extendedprice ** 2) AS yy, count(*) AS n FROM lineitem GROUP BY 1),
    e AS (SELECT a1, a2, sqrt(sum(yy - 2 * (a1 + a2 * x) * y + n * (a1 + a2 * x) ** 2) / sum(n)) AS dist FROM g, s GROUP BY ALL)
    SELECT round(a1, 4) AS a1, round(a2, 4) AS a2, round(dist, 3) AS dist, CAST(rank() OVER (ORDER BY dist) AS DOUBLE) AS rank FROM e QUALIFY rank < 20""",
)
def _(t: Tables):
    best = L.best_lines(L.grid_search(t.lineitem, "l_quantity", "l_extendedprice", **GRID))
    return rounded(rounded(best, 4, "a1", "a2"), 3, "dist").select("a1", "a2", "dist", "rank")


@query(
    "l3_random_search",
    f"""WITH i AS (SELECT unnest(range(1, 5001)) AS i), g AS (SELECT -40000 + {unit('i', 1)} * 120000 AS a1, -1000 + {unit('i', 2)} * 3000 AS a2 FROM i),
    s AS (SELECT l_quantity AS x, sum(l_extendedprice) AS y, sum(l_extendedprice ** 2) AS yy, count(*) AS n FROM lineitem GROUP BY 1),
    e AS (SELECT a1, a2, sqrt(sum(yy - 2 * (a1 + a2 * x) * y + n * (a1 + a2 * x) ** 2) / sum(n)) AS dist FROM g, s GROUP BY ALL)
    SELECT round(a1, 3) AS a1, round(a2, 3) AS a2, round(dist, 3) AS dist, CAST(rank() OVER (ORDER BY dist) AS DOUBLE) AS rank FROM e QUALIFY rank < 20""",
)
def _(t: Tables):
    tried = L.random_search(t.lineitem, "l_quantity", "l_extendedprice", 5000, (-40000.0, 80000.0), (-1000.0, 2000.0), seed=1)
    return rounded(L.best_lines(tried), 3).select("a1", "a2", "dist", "rank")


@query(
    "l4_least_error",
    f"""WITH f AS (SELECT {LINE} FROM lineitem) SELECT round(sqrt(avg((l_extendedprice - intercept - slope * l_quantity) ** 2)), 4) AS rmse FROM lineitem, f""",
)
def _(t: Tables):
    return rounded(L.fit_line(t.lineitem, "l_quantity", "l_extendedprice").select("rmse"), 4)


@query("l5_regularised_linear")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("linear", SENSORS, "rul", scale=True, l1=0.1, l2=0.1).fit(train)
    return X.generalisation(model, train, test, _regression)


@query(
    "l6_glm_deviance",
    """WITH f AS (SELECT count(*) - 2 AS df, regr_sxx(l_extendedprice, l_discount) AS sxx, regr_syy(l_extendedprice, l_discount) AS syy,
      regr_sxy(l_extendedprice, l_discount) AS sxy FROM lineitem)
    SELECT round((syy - sxy * sxy / sxx) / 1e9, 4) AS deviance_bn, df, round(syy / 1e9, 4) AS null_deviance_bn FROM f""",
)
def _(t: Tables):
    model = M.model_pipeline("glm", ["l_discount"], "l_extendedprice").fit(t.lineitem)
    s = M.deviance_summary(model)
    return rounded(
        s.select((F.col("deviance") / 1e9).alias("deviance_bn"), "df", (F.col("null_deviance") / 1e9).alias("null_deviance_bn")), 4
    )


@query("l7_logistic_binary")
def _(t: Tables):
    return _fit_report(t, "logistic", l1=0.001, l2=0.001)


@query(
    "l7_logistic_calibration",
    cte("passengers")
    + """ SELECT count(*) AS rows, round(avg(survived), 3) AS share, round(avg(survived), 3) AS expected FROM passengers WHERE survived IS NOT NULL""",
)
def _(t: Tables):
    """Without a penalty the mean probability equals the share of the class."""
    rows = materialise(passengers.model_input(t.passengers).dropna())
    scored = S.score(M.model_pipeline("logistic", FEATURES, "survived").fit(rows), rows, ["survived"], classes=2)
    return rounded(
        scored.agg(F.count("*").alias("rows"), F.avg("survived").alias("share"), F.avg("prob_1").alias("expected")), 3
    )


@query("l8_logistic_multinomial")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("logistic", SENSORS, "label2", classes=3, iterations=30).fit(train)
    return _multiclass(model.transform(test))


@query("l9_decision_tree")
def _(t: Tables):
    return _fit_report(t, "tree_classifier", depth=8, min_leaf=2)


@query("l9_e12_importance")
def _(t: Tables):
    train, _ = survival(t)
    model = M.model_pipeline("tree_classifier", FEATURES, "survived", depth=8).fit(train)
    return M.importance_table(model, FEATURES, t.spark)


@query("l10_regression_tree")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("tree_regressor", SENSORS, "rul").fit(train)
    return X.generalisation(model, train, test, _regression)


@query("l11_forest_classifier")
def _(t: Tables):
    return _fit_report(t, "forest_classifier", trees=20, depth=5, per_split=3, share=0.7)


@query("l11_forest_regressor")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("forest_regressor", SENSORS, "rul", trees=20, share=0.7).fit(train)
    return X.generalisation(model, train, test, _regression)


@query("l12_boosted_regressor")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("boosted_regressor", SENSORS, "rul", trees=20).fit(train)
    return X.generalisation(model, train, test, _regression)


@query("l12_boosted_classifier")
def _(t: Tables):
    return _fit_report(t, "boosted_classifier", trees=15)


@query("l12_boosted_multiclass")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("boosted_classifier", SENSORS, "label2", classes=3, trees=25).fit(train)
    return _multiclass(model.transform(test))


@query("l13_network_classifier")
def _(t: Tables):
    return _fit_report(t, "network", scale=True, hidden=[8], iterations=100)


@query("l13_network_multiclass")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("network", SENSORS, "label2", classes=3, scale=True, hidden=[8], iterations=100).fit(train)
    return _multiclass(model.transform(test))


@query("l14_network_regressor")
def _(t: Tables):
    train, test = engine(t)
    model = neural.fit_network(train, SENSORS, "rul", hidden=(8,), iterations=100)
    return X.generalisation(S.WrittenOnce(model, ["rul"]), train, test, _regression)


@query("l15_linear_svm")
def _(t: Tables):
    return _fit_report(t, "svm", scale=True, l2=0.01, iterations=20)


@query("l15_kernel_svm")
def _(t: Tables):
    train, test = survival(t)
    model = M.fit_equal(M.rbf_svm(train, FEATURES, "survived", waves=50), train, FEATURES)
    return X.generalisation(S.OncePerRow(model, FEATURES), train, test, _binary)


_KNN = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v, CAST(concat('0x', substr(md5(concat_ws(':', '0', CAST(vec_id AS VARCHAR))), 1, 7)) AS BIGINT)
    / 268435456.0 < 0.7 AS tr FROM embeddings),
  p AS (SELECT b.vec_id, a.label, sqrt(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) ** 2))) AS dist FROM e a, e b WHERE a.tr AND NOT b.tr),
  k AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, label) <= 3),
  w AS (SELECT vec_id, label, count(*) AS n FROM k GROUP BY ALL)
  SELECT vec_id, label AS predicted FROM w QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1"""


@query("l16_nearest_neighbours", _KNN)
def _(t: Tables):
    rows = t.embeddings.withColumn("v", F.col("embedding").cast("array<double>"))
    train, test = sampling.train_test_split(rows, "vec_id", 70)
    return neighbours.classify(train, test, "v", "label", "vec_id", k=3)


@query("l17_ensemble_average")
def _(t: Tables):
    train, test = engine(t)
    members = [
        M.model_pipeline("forest_regressor", SENSORS, "rul", trees=20, share=0.7),
        M.model_pipeline("boosted_regressor", SENSORS, "rul", trees=20),
        M.model_pipeline("linear", SENSORS, "rul"),
    ]
    model = N.fit_ensemble(train, members, ["id", "cycle"], "average")
    return X.generalisation(model, train, test, _regression)


@query("l17_ensemble_vote")
def _(t: Tables):
    train, test = survival(t)
    members = [
        M.model_pipeline("forest_classifier", FEATURES, "survived", trees=10),
        M.model_pipeline("tree_classifier", FEATURES, "survived"),
        M.model_pipeline("logistic", FEATURES, "survived"),
    ]
    model = N.fit_ensemble(train, members, "passenger_id", "vote")
    return X.generalisation(S.OncePerRow(model, FEATURES), train, test, _binary)


@query("l17_ensemble_probability")
def _(t: Tables):
    train, test = survival(t)
    members = [M.model_pipeline("tree_classifier", FEATURES, "survived", depth=d) for d in (3, 5)]
    model = N.fit_ensemble(train, members, "passenger_id", "probability")
    return X.generalisation(S.OncePerRow(model, FEATURES), train, test, _binary)


@query("l18_kmeans")
def _(t: Tables):
    rows = materialise(K.with_vector(t.embeddings, "embedding"))
    model = KMeans(k=10, seed=0, predictionCol="cluster").fit(rows)
    return model.transform(rows).select("vec_id", "label", "cluster")


@query("l18_kmeans_nearest", "SELECT vec_id, true AS nearest FROM embeddings")
def _(t: Tables):
    """Every vector belongs to the centre closest to it."""
    rows = materialise(K.with_vector(t.embeddings, "embedding"))
    model = KMeans(k=10, seed=0, predictionCol="cluster").fit(rows)
    found = model.transform(rows).withColumn("near", K.nearest_centre(model, vector_to_array("features")))
    return found.select("vec_id", (F.col("near") == F.col("cluster")).alias("nearest"))


@query("l18_kmeans_centres")
def _(t: Tables):
    rows = materialise(K.with_vector(t.embeddings, "embedding"))
    return K.centres(KMeans(k=10, seed=0).fit(rows), t.spark)


@query("l19_elbow")
def _(t: Tables):
    return K.elbow(customers.return_profile(*return_lines(t)), customers.RATIOS, range(1, 20))


@query(
    "l20_customer_segments",
    """WITH s AS (SELECT count(DISTINCT o_custkey) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT CAST(4 AS BIGINT) AS clusters, n AS customers, n AS nearest, n AS listed FROM s""",
)
def _(t: Tables):
    """Segments written as a table, read back and joined to the customers: everyone is in the nearest segment, once."""
    profile = materialise(customers.return_profile(*return_lines(t)))
    model = K.kmeans(customers.RATIOS, 4, seed=111).fit(profile)
    path = scratch_folder(t.spark, "segments")
    write_table(model.transform(profile).drop("features"), path)
    found = t.spark.read.parquet(path)
    near = found.select("cluster", *customers.RATIOS, K.nearest_centre(model, F.array(*customers.RATIOS)).alias("near"))
    facts = near.agg(F.countDistinct("cluster").alias("clusters"), F.count("*").alias("customers"), F.count_if(F.col("near") == F.col("cluster")).alias("nearest"))
    lists = [customers.campaign_list(t.customer, found, c) for c in range(4)]
    return facts.withColumn("listed", R.union_all(lists).agg(F.count("*").alias("n")).scalar())


@query("l20_segment_profiles")
def _(t: Tables):
    profile = materialise(customers.return_profile(*return_lines(t)))
    found = K.kmeans(customers.RATIOS, 4, seed=111).fit(profile).transform(profile).drop("features")
    return found.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in customers.RATIOS])


@query(
    "l21_pca_explained",
    """WITH r AS (SELECT abs(corr(p_size, p_retailprice)) AS r FROM part)
    SELECT 1 AS component, round((1 + r) / 2, 6) AS share FROM r UNION ALL SELECT 2, round((1 - r) / 2, 6) FROM r""",
)
def _(t: Tables):
    return rounded(M.principal_components(t.part, ["p_size", "p_retailprice"], 2)[1])


@query("l21_pca_scores")
def _(t: Tables):
    rows = materialise(passengers.model_input(t.passengers).dropna())
    return M.principal_components(rows, FEATURES, 5, scale=True)[2].select("passenger_id", "scores")


@query("l21_pca_rotation")
def _(t: Tables):
    rows = materialise(passengers.model_input(t.passengers).dropna())
    return M.principal_components(rows, FEATURES, 2, scale=False)[0]


_GROUP = cte("trips") + """, f AS (SELECT payment_type, count(*) AS n, regr_slope(total_amount, fare_amount) AS b, regr_intercept(total_amount, fare_amount) AS a
  FROM trips GROUP BY 1)"""


@query(
    "l22_group_linear",
    _GROUP + " SELECT payment_type, n, round(a, 4) AS intercept, round(b, 4) AS slope FROM f",
)
def _(t: Tables):
    model = G.group_linear(t.trips, "payment_type", ["fare_amount"], "total_amount")
    c = F.col("coefficients")
    return rounded(model.select("payment_type", "n", c[0].alias("intercept"), c[1].alias("slope")), 4)


@query(
    "l22_group_linear_scores",
    _GROUP
    + """ SELECT payment_type, count(*) AS n, round(sum(a + b * fare_amount), 2) AS predicted FROM trips JOIN f USING (payment_type) GROUP BY 1""",
)
def _(t: Tables):
    model = G.group_linear(t.trips, "payment_type", ["fare_amount"], "total_amount")
    scored = G.score_groups(t.trips, model, "payment_type", ["fare_amount"], "predicted")
    return rounded(scored.groupBy("payment_type").agg(F.count("*").alias("n"), F.sum("predicted").alias("predicted")), 2)


@query(
    "l22_group_logistic",
    cte("trips")
    + """, f AS (SELECT payment_type, avg(CASE WHEN tip_amount > total_amount / 50 THEN 1.0::DOUBLE ELSE 0 END) AS share FROM trips GROUP BY 1)
    , m AS (SELECT payment_type, round(avg(CASE WHEN tip_amount > total_amount / 50 THEN trip_distance ELSE 0 END), 4) AS distance,
      round(avg(CASE WHEN tip_amount > total_amount / 50 THEN total_amount ELSE 0 END), 4) AS amount FROM trips GROUP BY 1)
    SELECT payment_type, round(share, 6) AS share, round(share, 6) AS expected, distance, distance AS expected_distance,
      amount, amount AS expected_amount FROM f JOIN m USING (payment_type)""",
)
def _(t: Tables):
    # at the least-deviance fit the probabilities of a group agree with its outcomes in the mean and weighted by each feature
    trips = t.trips.withColumn("tipped", F.when(F.col("tip_amount") > F.col("total_amount") / 50, 1).otherwise(0))
    features = ["trip_distance", "total_amount"]
    model = G.group_logistic(trips, "payment_type", features, "tipped")
    scored = G.score_groups(trips, model, "payment_type", features, "probability", logistic=True)
    out = scored.groupBy("payment_type").agg(
        F.avg("tipped").alias("share"),
        F.avg("probability").alias("expected"),
        F.avg(F.col("tipped") * F.col("trip_distance")).alias("distance"),
        F.avg(F.col("probability") * F.col("trip_distance")).alias("expected_distance"),
        F.avg(F.col("tipped") * F.col("total_amount")).alias("amount"),
        F.avg(F.col("probability") * F.col("total_amount")).alias("expected_amount"),
    )
    return rounded(rounded(out, 4, "distance", "expected_distance", "amount", "expected_amount"), 6, "share", "expected")


@query(
    "l23_batch_scores",
    cte("passengers")
    + f""" SELECT passenger_id, passenger_id % 5 <> 0 AS scored, CASE WHEN passenger_id % 5 <> 0 THEN CAST(1 AS DOUBLE) END AS whole
    FROM passengers WHERE survived IS NOT NULL AND {unit('passenger_id', 123)} >= 0.7""",
)
def _(t: Tables):
    """Every row comes back; one without an age has no prediction.  The chances of the classes add up to one."""
    train, test = survival(t)
    model = M.model_pipeline("forest_classifier", FEATURES, "survived", trees=20).fit(train)
    gaps = test.withColumn("age", F.when(F.col("passenger_id") % 5 != 0, F.col("age")))
    scored = S.score(model, gaps, ["passenger_id"], classes=2)
    return rounded(scored.select("passenger_id", F.col("prediction").isNotNull().alias("scored"), (F.col("prob_0") + F.col("prob_1")).alias("whole")))


@query("l24_filtered_scores")
def _(t: Tables):
    train, test = survival(t)
    model = M.model_pipeline("logistic", FEATURES, "survived").fit(train)
    return S.score_where(model, test, "pclass = 1", ["passenger_id", "survived"], classes=2)


@query("l24_single_score")
def _(t: Tables):
    train, _ = survival(t)
    model = M.model_pipeline("logistic", FEATURES, "survived").fit(train)
    row = {"title": 1, "embarked": 0, "fare": 2, "pclass": 1, "sex": 1, "age": 30, "is_alone": 1}
    return S.score_one(model, t.spark, row, classes=2)


@query(
    "l25_l28_model_registry",
    cte("passengers")
    + f""" SELECT 'forest' AS name, 38 AS trees, 3 AS per_split, 12 AS depth, true AS has_train_f, true AS has_test_f, true AS saved, count(*) AS scored
    FROM passengers WHERE survived IS NOT NULL AND {unit('passenger_id', 123)} >= 0.7""",
)
def _(t: Tables):
    """The forest with 38 trees of depth 12, 3 columns per split and at least 100 rows to split."""
    train, test = survival(t)
    options = {"trees": 38, "per_split": 3, "depth": 12, "min_leaf": 50}
    model = M.model_pipeline("forest_classifier", FEATURES, "survived", **options).fit(train)
    path = S.save_model(model, scratch_folder(t.spark, "model"))
    entry = {"name": "forest", "path": path, **options, "train_f": _binary(model.transform(train)).first()["f_score"]}
    table = scratch_folder(t.spark, "registry")
    write_table(S.register(S.empty_registry(t.spark), entry), f"{table}/trained")
    registry = t.spark.read.parquet(f"{table}/trained")
    loaded = S.load_model(registry.where("name = 'forest'").first()["path"])
    scored = materialise(loaded.transform(test).select("survived", "prediction"))
    write_table(S.set_test_score(registry, "forest", _binary(scored).first()["f_score"]), f"{table}/tested")
    sizes = S.model_sizes(t.spark.read.parquet(f"{table}/tested"))
    good = lambda c: F.col(c).between(0, 1)
    facts = sizes.select("name", "trees", "per_split", "depth", good("train_f").alias("has_train_f"), good("test_f").alias("has_test_f"), (F.col("model_mb") > 0).alias("saved"))
    return facts.withColumn("scored", scored.agg(F.count("*").alias("n")).scalar())


@query("l26_model_factory_regression")
def _(t: Tables):
    train, test = engine(t)
    learners = {
        "linear": lambda f: M.model_pipeline("linear", f, "rul", scale=True, l2=0.01),
        "glm": lambda f: M.model_pipeline("glm", f, "rul"),
        "forest": lambda f: M.model_pipeline("forest_regressor", f, "rul", trees=20),
        "boosted": lambda f: M.model_pipeline("boosted_regressor", f, "rul", trees=20),
        "network": lambda f: neural.NetworkLearner(f, "rul", {"hidden": (6,), "iterations": 100}),
        "ensemble": lambda f: N.EnsembleLearner(
            [M.model_pipeline("linear", f, "rul"), M.model_pipeline("tree_regressor", f, "rul")], ["id", "cycle"]
        ),
    }
    metrics = X.model_factory(train, test, "rul", 5, learners, _regression, exclude=["id", "label1", "label2"])
    return metrics.orderBy("mae")


@query("l26_model_factory_normalised")
def _(t: Tables):
    train, test = engine(t)
    train, test, _ = maintenance.normalised(train, test, SENSORS)
    learners = {
        "logistic": lambda f: M.model_pipeline("logistic", f, "label1"),
        "forest": lambda f: M.model_pipeline("forest_classifier", f, "label1", trees=20),
    }
    evaluate = lambda d: E.binary_metrics(d, "label1", "prediction")
    return X.model_factory(train, test, "label1", 5, learners, evaluate, exclude=["id", "rul", "label2"])


@query("l26_metrics_table")
def _(t: Tables):
    """Three-class metrics on raw and on scaled features, appended to one table and ranked."""
    train, test = engine(t)
    path = scratch_folder(t.spark, "metrics")
    learners = {
        "logistic": lambda f: M.model_pipeline("logistic", f, "label2", classes=3, iterations=20),
        "forest": lambda f: M.model_pipeline("forest_classifier", f, "label2", trees=20),
        "tree": lambda f: M.model_pipeline("tree_classifier", f, "label2"),
    }
    evaluate = lambda d: E.overall_metrics(d, "label2", "prediction")
    scaled_train, scaled_test, _ = maintenance.normalised(train, test, SENSORS)
    for data, parts in {"raw": (train, test), "scaled": (scaled_train, scaled_test)}.items():
        rows = X.model_factory(*parts, "label2", 4, learners, evaluate, exclude=["id", "rul", "label1"])
        insert_rows(rows.withColumn("data", F.lit(data)), path)
    table = t.spark.read.parquet(path)
    return R.ranked_ends(table, ["-accuracy", "name", "data"], 2, 5)


_KNOWN = """ SELECT count(*) FILTER ({u} < 0.7) AS train_rows, count(*) FILTER ({u} >= 0.7) AS test_rows FROM passengers WHERE survived IS NOT NULL"""
#: Axes of the tuned grid, 40,000 combinations.
TUNED = {"trees": (30, 2, 20), "min_split": (100, 20, 20), "depth": (2, 2, 10), "per_split": (1, 1, 10)}


def _tuned(t: Tables):
    """The five percent of the grid at their own depths, trees, split sizes and columns tried."""
    train, test = survival(t)
    tried = R.random_percent(R.parameter_grid(t.spark, TUNED), list(TUNED), 5, seed=3)
    return forests.tune_forests(train, test, tried, FEATURES, "survived", "passenger_id")


@query(
    "l27_tuning_leaderboard",
    cte("passengers")
    + f""", n AS ({_KNOWN.format(u=unit('passenger_id', 123))}),
    g AS (SELECT CAST(30 + 2 * a AS INT) AS trees, CAST(100 + 20 * b AS INT) AS min_split, CAST(2 + 2 * c AS INT) AS depth, CAST(1 + d AS INT) AS per_split
          FROM range(20) x(a), range(20) y(b), range(10) z(c), range(10) w(d)),
    r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '3', CAST(trees AS VARCHAR), CAST(min_split AS VARCHAR),
          CAST(depth AS VARCHAR), CAST(per_split AS VARCHAR)))) AS ix FROM g)
    SELECT trees, depth, per_split, min_split, train_rows, test_rows, true AS rated FROM r, n WHERE ix <= 2000""",
)
def _(t: Tables):
    """2,000 forests; every row is voted on by each of them, and the scores are shares."""
    rated = F.coalesce(F.col("train_f_score").between(0, 1) & F.col("test_f_score").between(0, 1), F.lit(True))
    return _tuned(t).select("trees", "depth", "per_split", "min_split", "train_rows", "test_rows", rated.alias("rated"))


@query("l27_models_reaching_score")
def _(t: Tables):
    """How many of the 2,000 forests reach an F-score of 0.7 on training rows."""
    return X.count_reaching(_tuned(t), "train_f_score", 0.7)


_STUMP = ["pclass", "sex", "is_alone"]


@query(
    "l27_stump_leaderboard",
    cte("passengers")
    + f""", p AS (SELECT *, {unit('passenger_id', 123)} < 0.7 AS train, CASE WHEN sex = 'female' THEN 1 ELSE 0 END AS code,
          CASE WHEN sibsp + parch = 0 THEN 1 ELSE 0 END AS alone FROM passengers WHERE survived IS NOT NULL),
    f AS (SELECT train, survived, unnest([1, 2, 3]) AS f, unnest([pclass, code, alone]) AS v FROM p),
    c AS (SELECT DISTINCT f, v FROM f WHERE train),
    h AS (SELECT c.f, c.v, count(*) AS n, sum(survived) AS y, count(*) FILTER (f.v <= c.v) AS ln, coalesce(sum(survived) FILTER (f.v <= c.v), 0) AS ly
          FROM c JOIN f ON f.f = c.f AND f.train GROUP BY c.f, c.v),
    b AS (SELECT *, round(2.0 * y * (n - y) / n - 2.0 * ly * (ln - ly) / ln - 2.0 * (y - ly) * (n - ln - y + ly) / (n - ln), 9) AS gain
          FROM h WHERE ln > 0 AND ln < n ORDER BY gain DESC, f, v LIMIT 1),
    s AS (SELECT f.train, f.survived = 1 AS y, CASE WHEN gain <= 0 THEN 2 * b.y > n WHEN f.v <= b.v THEN 2 * ly > ln ELSE 2 * (b.y - ly) > n - ln END AS yes
          FROM f JOIN b USING (f)),
    m AS (SELECT train, count(*) AS n, 2.0 * count(*) FILTER (yes AND y) AS hit, count(*) FILTER (yes <> y) AS miss FROM s GROUP BY train)
    SELECT trees, 1 AS depth, 3 AS per_split, 100 AS min_split,
           round((SELECT hit / nullif(hit + miss, 0) FROM m WHERE train), 6) AS train_f_score, round((SELECT hit / nullif(hit + miss, 0) FROM m WHERE NOT train), 6) AS test_f_score,
           (SELECT n FROM m WHERE train) AS train_rows, (SELECT n FROM m WHERE NOT train) AS test_rows
    FROM (SELECT CAST(unnest([1, 3]) AS INT) AS trees)""",
)
def _(t: Tables):
    """Trees of one level on all rows: the same best split as in SQL, however many trees vote."""
    train, test = survival(t)
    tried = R.parameter_grid(t.spark, {"trees": (1, 2, 2), "depth": (1, 1, 1), "per_split": (3, 1, 1), "min_split": (100, 1, 1)})
    return rounded(forests.tune_forests(train, test, tried, _STUMP, "survived", "passenger_id", sample=False))


@query("l29_formula_model")
def _(t: Tables):
    """Features kept by the chi-square screening become the model's inputs."""
    from statloom.operators.association import screen_features

    train, test = survival(t)
    kept = screen_features(train, FEATURES, "survived").where("relevant AND p_value < 0.05")
    features = [r["feature"] for r in kept.select("feature").orderBy("feature").collect()]
    model = M.model_pipeline("tree_classifier", features, "survived").fit(train)
    return X.generalisation(model, train, test, _binary).withColumn("formula", F.lit("survived ~ " + " + ".join(features)))


@query("e8_cross_validation")
def _(t: Tables):
    train, _ = survival(t)
    fit = M.model_pipeline("tree_classifier", FEATURES, "survived", depth=8, min_leaf=2).fit
    folds = X.cross_validate(train, "passenger_id", 4, fit, _binary, seed=12)
    return X.fold_summary(folds, "accuracy")


@query("e10_train_and_test")
def _(t: Tables):
    train, test = engine(t)
    model = M.model_pipeline("linear", SENSORS, "rul").fit(train)
    return X.generalisation(model, train, test, _regression)


@query("e11_shapley")
def _(t: Tables):
    features = ["c_nationkey", "c_acctbal"]
    model = M.model_pipeline("tree_regressor", features, "c_custkey", depth=4).fit(t.customer)
    return explain.shapley(model.transform, t.customer, t.customer, features, "c_custkey", samples=100)


@query(
    "e11_shapley_linear",
    """WITH b AS (SELECT c_nationkey, c_acctbal FROM customer
      ORDER BY md5(concat_ws(':', '1', CAST(c_custkey AS VARCHAR))) LIMIT 100),
    m AS (SELECT avg(c_nationkey) AS a, avg(c_acctbal) AS b FROM b)
    SELECT c_custkey, 'c_nationkey' AS feature, round(2 * (c_nationkey - a), 4) AS contribution FROM customer, m
    UNION ALL SELECT c_custkey, 'c_acctbal', round((c_acctbal - b) / 10, 4) FROM customer, m""",
)
def _(t: Tables):
    """Contributions in a linear score are the weighted distances from the background mean."""

    def predict(df):
        return df.withColumn("prediction", 2 * F.col("c_nationkey") + F.col("c_acctbal") / 10)

    found = explain.shapley(predict, t.customer, t.customer, ["c_nationkey", "c_acctbal"], "c_custkey", samples=100)
    return rounded(found, 4)


@query(
    "c6_impute_pmm_one_column",
    """WITH r AS (SELECT o_orderkey, o_totalprice AS x, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS y FROM orders),
    d AS (SELECT x, max(y) AS y FROM r WHERE y IS NOT NULL GROUP BY 1), h AS (SELECT o_orderkey, x FROM r WHERE y IS NULL),
    lo AS (SELECT h.o_orderkey, h.x, d.x AS dx, d.y FROM h ASOF LEFT JOIN d ON h.x >= d.x), hi AS (SELECT h.o_orderkey, d.x AS dx, d.y FROM h ASOF LEFT JOIN d ON h.x <= d.x),
    f AS (SELECT o_orderkey, CASE WHEN hi.dx IS NULL OR lo.x - lo.dx <= hi.dx - lo.x THEN lo.y ELSE hi.y END AS y FROM lo JOIN hi USING (o_orderkey))
    SELECT o_orderkey, coalesce(r.y, f.y) AS y FROM r LEFT JOIN f USING (o_orderkey)""",
)
def _(t: Tables):
    """One column on one predictor: the donor is the row with the closest predictor."""
    y = F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_custkey").cast("double"))
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("x"), y.alias("y"))
    return imputation.impute_pmm(rows, ["y"], ["x"], iterations=1, donors=1, seed=None).select("o_orderkey", "y")


@query("c6_impute_pmm", cte("passengers") + " SELECT passenger_id, true AS age_kept, true AS fare_kept, true AS from_donors FROM passengers")
def _(t: Tables):
    """Fifty rounds over two columns: observed values stay, and a filled one is a value observed elsewhere."""
    rows = materialise(t.passengers.select("passenger_id", "age", "fare", "pclass", "sibsp"))
    found = imputation.impute_pmm(rows, ["age", "fare"], ["pclass", "sibsp"], iterations=50)
    both = found.select("passenger_id", F.col("age").alias("new_age"), F.col("fare").alias("new_fare")).join(rows, "passenger_id")
    for c in ("age", "fare"):
        seen = rows.where(F.col(c).isNotNull()).select(F.col(c).cast("double").alias(f"new_{c}"), F.lit(True).alias(f"seen_{c}")).distinct()
        both = both.join(seen, f"new_{c}", "left")
    return both.select(
        "passenger_id",
        *[(F.col(c).isNull() | (F.col(c).cast("double") == F.col(f"new_{c}"))).alias(f"{c}_kept") for c in ("age", "fare")],
        (F.coalesce("seen_age", F.lit(False)) & F.coalesce("seen_fare", F.lit(False))).alias("from_donors"),
    )


@query(
    "f7_passenger_survival",
    cte("passengers") + " SELECT passenger_id, true AS valid, CAST(10 AS BIGINT) AS folds, true AS rated FROM passengers WHERE survived IS NULL",
)
def _(t: Tables):
    """Cross validation of the chosen tree and a prediction for everyone without an outcome."""
    found = passengers.survival_job(t.passengers)
    return found.select("passenger_id", F.col("predicted").isin(0, 1).alias("valid"), "folds", F.col("cv_accuracy").between(0, 1).alias("rated"))


_LEARNERS = ["logistic", "kernel_svm", "three_nearest", "tree", "forest", "tree_without_port", "smaller_tree"]


@query(
    "f7_learner_scores",
    cte("passengers")
    + f""", s AS (SELECT CASE WHEN {unit('passenger_id', 123)} < 0.7 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM passengers WHERE survived IS NOT NULL GROUP BY 1)
    SELECT learner, part, n AS "rows", true AS useful FROM s, (SELECT unnest({_LEARNERS!r}) AS learner)""",
)
def _(t: Tables):
    """Five learners and two variants on training and held-out rows; none falls far behind the majority class."""
    rows = materialise(passengers.model_input(t.passengers).dropna())
    scores = passengers.learner_scores(rows)
    return scores.select("learner", "part", "rows", (F.col("accuracy") >= F.col("majority") - 15).alias("useful"))


_PARTS = cte("passengers") + f", s AS (SELECT count(*) AS n FROM passengers WHERE survived IS NOT NULL AND {unit('passenger_id', 123)} >= 0.7)"


@query(
    "l7_l17_classifier_facts",
    _PARTS
    + """ SELECT learner, n AS scored, n AS valid, n AS repeated, true AS useful
    FROM s, (SELECT unnest(['logistic', 'tree', 'forest', 'boosted', 'network', 'svm', 'vote']) AS learner)""",
)
def _(t: Tables):
    """Per learner: rows scored, rows with a class, rows that a second fit scores alike, and no loss against the majority class."""
    train, test = survival(t)
    single = {
        "logistic": M.model_pipeline("logistic", FEATURES, "survived"),
        "tree": M.model_pipeline("tree_classifier", FEATURES, "survived"),
        "forest": M.model_pipeline("forest_classifier", FEATURES, "survived", trees=20),
        "boosted": M.model_pipeline("boosted_classifier", FEATURES, "survived", trees=15),
        "network": M.model_pipeline("network", FEATURES, "survived", scale=True, hidden=[8]),
        "svm": M.model_pipeline("svm", FEATURES, "survived", scale=True, l2=0.01),
    }
    fits = {name: partial(M.fit_equal, pipeline) for name, pipeline in single.items()}
    members = [single["forest"], single["tree"], single["logistic"]]
    fits["vote"] = lambda d: N.fit_ensemble(d, members, "passenger_id", "vote")
    with ThreadPoolExecutor(4) as pool:  # the passes are short, their fits independent
        twice = list(pool.map(lambda fit: fit(train), [fit for fit in fits.values() for _ in range(2)]))
    parts = []
    for name, first, second in zip(fits, twice[::2], twice[1::2]):
        once = first.transform(test).select(*FEATURES, "survived", F.col("prediction").alias("once"))
        both = second.transform(once).select("survived", F.col("once").alias("prediction"), F.col("prediction").alias("again"))
        right = F.avg((F.col("survived") == F.col("prediction")).cast("double"))
        majority = F.greatest(F.avg("survived"), 1 - F.avg("survived"))
        parts.append(
            both.agg(
                F.count("*").alias("scored"),
                F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("valid"),
                F.count_if(F.col("prediction") == F.col("again")).alias("repeated"),
                (right >= majority - 0.1).alias("useful"),
            ).select(F.lit(name).alias("learner"), "*")
        )
    return R.union_all(parts)


@query(
    "l5_l17_regressor_facts",
    CYCLES
    + f""", s AS (SELECT count(*) AS n FROM sensors WHERE {unit("concat_ws(':', id, cycle)")} >= 0.7)
    SELECT learner, n AS scored, n AS valid, true AS useful FROM s, (SELECT unnest(['elastic', 'tree', 'forest', 'boosted', 'average']) AS learner)""",
)
def _(t: Tables):
    """Per learner: rows scored, finite predictions, and an error below the deviation of the target."""
    train, test = engine(t)
    members = {
        "elastic": M.model_pipeline("linear", SENSORS, "rul", scale=True, l1=0.1, l2=0.1),
        "tree": M.model_pipeline("tree_regressor", SENSORS, "rul"),
        "forest": M.model_pipeline("forest_regressor", SENSORS, "rul", trees=20, share=0.7),
        "boosted": M.model_pipeline("boosted_regressor", SENSORS, "rul", trees=20),
    }
    fits = {name: p.fit for name, p in members.items()}
    fits["average"] = lambda d: N.fit_ensemble(d, list(members.values()), ["id", "cycle"], "average")
    with ThreadPoolExecutor(len(fits)) as pool:  # independent fits
        models = list(pool.map(lambda fit: fit(train), fits.values()))
    parts = []
    for name, model in zip(fits, models):
        found = model.transform(test)
        error = F.sqrt(F.avg(F.pow(F.col("rul") - F.col("prediction"), 2)))
        parts.append(
            found.agg(
                F.count("*").alias("scored"),
                F.count_if(~F.isnan("prediction") & (F.abs("prediction") < 1e9)).alias("valid"),
                (error < F.stddev_pop("rul")).alias("useful"),
            ).select(F.lit(name).alias("learner"), "*")
        )
    return R.union_all(parts)


@query("u3_script_over_query", "SELECT c_mktsegment, c_custkey, round(c_acctbal * 2, 6) AS doubled FROM customer WHERE c_acctbal > 0")
def _(t: Tables):
    def script(batches):
        for pdf in batches:
            yield pdf.assign(doubled=pdf["c_acctbal"] * 2)[["c_mktsegment", "c_custkey", "doubled"]]

    rows = t.customer.where("c_acctbal > 0").select("c_mktsegment", "c_custkey", "c_acctbal")
    return rounded(rows.mapInPandas(script, "c_mktsegment string, c_custkey long, doubled double"))


@query(
    "u5_mapped_over_parameters",
    """SELECT p AS quantile, count(*) FILTER (l_quantity <= p) AS lines FROM lineitem, (VALUES (10), (20), (30)) v(p) GROUP BY 1""",
)
def _(t: Tables):
    counts = t.lineitem.groupBy("l_quantity").agg(F.count("*").alias("n"))
    each = counts.withColumn("quantile", F.explode(F.array(*[F.lit(p) for p in (10, 20, 30)])))
    below = F.when(F.col("l_quantity") <= F.col("quantile"), F.col("n")).otherwise(0)
    return each.groupBy("quantile").agg(F.sum(below).alias("lines"))
