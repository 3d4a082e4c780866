"""k-means, its elbow and customer segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from statloom.session import materialise


def kmeans(features: Sequence[str], k: int, seed: int = 1, iterations: int = 20) -> Pipeline:
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assemble, KMeans(k=k, seed=seed, maxIter=iterations, predictionCol="cluster")])


def with_vector(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array).cast("array<double>")))


def centres(model: PipelineModel, spark) -> DataFrame:
    """Rows (cluster, centre)."""
    found = model.stages[-1].clusterCenters() if isinstance(model, PipelineModel) else model.clusterCenters()
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(found)], "cluster int, centre array<double>")


def _distance(vector: str | Column, centre: Sequence[float]) -> Column:
    point = F.array(*[F.lit(float(x)) for x in centre])
    squares = F.zip_with(vector, point, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def nearest_centre(model, point: Column) -> Column:
    """Number of the centre closest to the array ``point``."""
    found = model.stages[-1].clusterCenters() if isinstance(model, PipelineModel) else model.clusterCenters()
    away = F.array(*[F.struct(_distance(point, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(found)])
    return F.array_min(away)["i"]


def elbow(df: DataFrame, features: Sequence[str], ks: Sequence[int], seed: int = 1) -> DataFrame:
    """Rows (k, mean distance to the nearest centre), over the rows without a missing feature."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    rows = materialise(assemble.transform(df.select(*features)).select("features", vector_to_array("features").alias("_a")))
    result = []
    for k in ks:
        if k == 1:
            means = rows.agg(*[F.avg(F.col("_a")[i]).alias(f"m{i}") for i in range(len(features))]).first()
            points = [list(means)]
        else:
            points = KMeans(k=k, seed=seed, maxIter=20).fit(rows).clusterCenters()
        nearest = F.array_min(F.array(*[_distance("_a", p) for p in points]))
        result.append((k, rows.agg(F.avg(nearest).alias("d")).first()["d"]))
    return df.sparkSession.createDataFrame(result, "k int, mean_distance double")
