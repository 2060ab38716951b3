"""Clusters of comments by how they were scored."""

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.storage import cut_lineage

FEATURES = ("confidence", "positive_prob", "negative_prob", "neutral_prob")


def available_features(df: DataFrame, features=FEATURES) -> list:
    found = [name for name in features if name in df.columns]
    if len(found) < 2:
        raise ValueError("clustering needs at least two score columns")
    return found


def feature_profile(df: DataFrame, features, label: str = "sentiment") -> DataFrame:
    """Distinct feature vectors, by label if there is one, with their rows; stored.

    The only pass over the rows. A lexicon scorer has a handful of vectors for any
    number of comments; percentages of a model are whole numbers, so at most 101 for
    each of its labels. A scorer with continuous results gets no shorter by this.
    """
    known = df.dropna(subset=list(features))
    keys = [*features, *([label] if label in df.columns else [])]
    return cut_lineage(known.groupBy(*keys).agg(F.count("*").alias("rows")))


def feature_deviations(df: DataFrame, features) -> DataFrame:
    """One row with the sample standard deviation of every feature."""
    return profile_deviations(feature_profile(df, features), features)


def profile_deviations(profile: DataFrame, features) -> DataFrame:
    """As feature_deviations, from a stored profile: distances from the means, by weight."""
    weight = F.col("rows")
    # One row.
    means = profile.agg(
        *[(F.sum(weight * F.col(name)) / F.sum("rows")).alias(f"_{name}") for name in features]
    )
    spread = {name: F.sum(weight * F.pow(F.col(name) - F.col(f"_{name}"), 2)) for name in features}
    free = F.nullif(F.greatest(F.sum("rows") - 1, F.lit(0)), F.lit(0))
    return profile.crossJoin(F.broadcast(means)).agg(
        *[F.coalesce(F.sqrt(spread[name] / free), F.lit(0.0)).alias(name) for name in features]
    )


def scale_features(df: DataFrame, features, deviations: dict) -> DataFrame:
    """Divide by the deviation, without centring; a constant feature becomes 0."""
    return df.dropna(subset=list(features)).withColumns(
        {
            f"scaled_{name}": F.col(name) / deviations[name] if deviations[name] else F.lit(0.0)
            for name in features
        }
    )


@dataclass(frozen=True)
class Clustering:
    """A fitted model, and what it says about the profile it was fitted on."""

    model: KMeansModel
    features: list
    deviations: dict
    profile: DataFrame

    def _assemble(self, df: DataFrame) -> DataFrame:
        names = [f"scaled_{name}" for name in self.features]
        scaled = scale_features(df, self.features, self.deviations)
        return VectorAssembler(inputCols=names, outputCol="features").transform(scaled)

    def assign(self, df: DataFrame) -> DataFrame:
        """Rows that know all features, with their cluster."""
        names = [f"scaled_{name}" for name in self.features]
        return self.model.transform(self._assemble(df)).drop("features", *names)

    def centers(self) -> DataFrame:
        spark = self.profile.sparkSession
        return cluster_centers(spark, self.model, self.features, self.deviations)

    def counts(self, label: str = "sentiment") -> DataFrame:
        """Rows by cluster and label, from the profile."""
        return (
            self.assign(self.profile)
            .groupBy("cluster", label)
            .agg(F.sum("rows").alias("count"))
            .orderBy("cluster", label)
        )


def fit_clusters(
    df: DataFrame, k: int = 3, seed: int = 42, max_iter: int = 20, features=FEATURES
) -> Clustering:
    """K-means over the distinct feature vectors, weighted by how often each occurs: the
    same optimum as over the rows, which are read once. Fewer vectors than k give as
    many clusters as there are vectors."""
    used = available_features(df, features)
    return fit_profile(feature_profile(df, used), used, k, seed, max_iter)


def fit_profile(
    profile: DataFrame, used, k: int = 3, seed: int = 42, max_iter: int = 20
) -> Clustering:
    """fit_clusters from a stored feature_profile."""
    if profile.isEmpty():
        raise ValueError("no row knows all score columns")
    # Four numbers come to the driver, as they must for the model itself.
    deviations = profile_deviations(profile, used).first().asDict()
    names = [f"scaled_{name}" for name in used]
    points = (
        scale_features(profile, used, deviations)
        .groupBy(*names)
        .agg(F.sum("rows").cast("double").alias("weight"))
        .orderBy(*names)
    )
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(points)
    kmeans = KMeans(
        k=k, seed=seed, maxIter=max_iter, featuresCol="features",
        predictionCol="cluster", weightCol="weight",
    )
    return Clustering(kmeans.fit(assembled), used, deviations, profile)


def cluster_sentiment_features(
    df: DataFrame, k: int = 3, seed: int = 42, max_iter: int = 20, features=FEATURES
) -> tuple[DataFrame, DataFrame]:
    """(rows with their cluster, centres); see fit_clusters."""
    fitted = fit_clusters(df, k, seed, max_iter, features)
    return fitted.assign(df), fitted.centers()


def cluster_centers(spark, model: KMeansModel, features, deviations: dict) -> DataFrame:
    """(cluster, feature, value in scaled units, value in the feature's own units)."""
    rows = [
        (cluster, name, float(centre[i]), float(centre[i]) * float(deviations[name]))
        for cluster, centre in enumerate(model.clusterCenters())
        for i, name in enumerate(features)
    ]
    return spark.createDataFrame(
        rows, "cluster int, feature string, value double, unscaled double"
    )


def cluster_sentiment(clustered: DataFrame) -> DataFrame:
    return (
        clustered.groupBy("cluster", "sentiment")
        .agg(F.count("*").alias("count"))
        .orderBy("cluster", "sentiment")
    )
