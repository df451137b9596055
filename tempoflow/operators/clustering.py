"""KMeans over the raw features and a profile of each cluster."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempoflow import schema as S


def fit(
    df: DataFrame,
    k: int = S.CLUSTERS,
    seed: int = 1,
    scale: bool = False,
    features: tuple[str, ...] = S.FEATURES,
    iterations: int = 20,
) -> PipelineModel:
    """Rows with a missing feature are left out. Without scaling the widest feature (tempo) dominates."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="skip")]
    column = "raw_features"
    if scale:
        stages.append(StandardScaler(inputCol=column, outputCol="scaled_features", withMean=True))
        column = "scaled_features"
    stages.append(KMeans(k=k, seed=seed, maxIter=iterations, featuresCol=column, predictionCol="prediction"))
    return Pipeline(stages=stages).fit(df.select(*features))


def assign(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``cluster``; clusters are numbered in the order of their centres, so refits stay comparable."""
    centres = [tuple(c) for c in model.stages[-1].clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    numbers = F.array(*[F.lit(order.index(i)) for i in range(len(centres))])
    columns = df.columns
    return model.transform(df).select(*columns, F.get(numbers, F.col("prediction")).alias("cluster"))


def kmeans_clusters(df: DataFrame, **options) -> DataFrame:
    return assign(df, fit(df, **options))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and rounded averages per cluster; the songs of each cluster are listed by :func:`cluster_members`."""
    profile = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("songs_in_cluster"),
        *[F.round(F.avg(m), 2).alias(f"avg_{m}") for m in S.METRICS],
    )
    return profile.orderBy("cluster")


def cluster_members(clustered: DataFrame) -> DataFrame:
    """All songs of every cluster as rows, with how often each occurs in it."""
    return clustered.groupBy("cluster", "name").agg(F.count(F.lit(1)).alias("songs"))


def distance_check(clustered: DataFrame, model: PipelineModel, features: tuple[str, ...] = S.FEATURES) -> DataFrame:
    """What must hold of an unscaled clustering: rows, rows that another centre is nearer to, and centres out of order."""
    centres = sorted(tuple(float(x) for x in c) for c in model.stages[-1].clusterCenters())
    away = [sum(((F.col(f) - x) ** 2 for f, x in zip(features, centre)), F.lit(0.0)) for centre in centres]
    own = F.get(F.array(*away), F.col("cluster"))
    wrong = own > F.least(*away) + 1e-9 * (1 + own)
    return clustered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("misplaced"), F.count_distinct("cluster").alias("clusters")
    )
