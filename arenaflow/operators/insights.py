"""What wins matches, play styles and robot archetypes."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from . import features as features_

#: The columns of match_features and of robot_match_features that are numbers about behaviour.
WIN_FEATURES = [*features_.MEANS, features_.PARKED]
STYLE_FEATURES = features_.BEHAVIOUR


def standardized(df: DataFrame, features: list[str]) -> DataFrame:
    """The features less their mean, over their population deviation; a constant feature becomes 0. Mean and deviation come from one aggregation."""
    w = df.agg(*[F.avg(f).alias(f"{f}_m") for f in features], *[F.stddev_pop(f).alias(f"{f}_s") for f in features]).first()
    return df.withColumns({f: (F.col(f) - w[f"{f}_m"]) / w[f"{f}_s"] if w[f"{f}_s"] else F.lit(0.0) for f in features})


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="vector").transform(df)


def win_conditions(alliances: DataFrame, features: list[str] = WIN_FEATURES, least: int = 30) -> DataFrame:
    """(feature, coef, abs_coef, accuracy), the strongest first: logistic regression of won with a ridge of 1 over all decided rows. Raises below `least` rows."""
    rows = alliances.where("won IS NOT NULL").select(*features, F.col("won").cast("double").alias("label")).na.drop()
    rows = materialize(rows, "decided")  # read several times below
    n = rows.count()
    if n < least:
        raise ValueError(f"{n} decided rows; at least {least} are needed")
    data = _assembled(standardized(rows, features), features)
    fitted = LogisticRegression(featuresCol="vector", regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-9).fit(data)
    hits = fitted.transform(data).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    out = [(f, float(c), abs(float(c)), float(hits)) for f, c in zip(features, fitted.coefficients)]
    return alliances.sparkSession.createDataFrame(out, "feature string, coef double, abs_coef double, accuracy double").orderBy(F.desc("abs_coef"))


def playstyle_clusters(robots: DataFrame, k: int = 5, tries: int = 10, seed: int = 7, features: list[str] = STYLE_FEATURES) -> DataFrame:
    """robots with cluster: k-means over standardized features, the cheapest of `tries` starts. Rows with a null feature are left out."""
    rows = materialize(robots.na.drop(subset=features), "styles")  # read once a pass below
    kept = rows.withColumns({f"raw_{f}": F.col(f) for f in features})
    data = _assembled(standardized(kept, features), features)
    best = min((KMeans(k=k, seed=seed + i, featuresCol="vector", predictionCol="cluster").fit(data) for i in range(tries)), key=lambda m: m.summary.trainingCost)
    return best.transform(data).withColumns({f: F.col(f"raw_{f}") for f in features}).drop("vector", *[f"raw_{f}" for f in features])


def cluster_summary(labelled: DataFrame, features: list[str] = STYLE_FEATURES) -> DataFrame:
    """Per cluster, over decided rows: count, win rate, means to two places."""
    return labelled.where("won IS NOT NULL").groupBy("cluster").agg(F.count("*").alias("n"), F.avg(F.col("won").cast("double")).alias("win_rate"), *[F.round(F.avg(f), 2).alias(f) for f in features])


def normalized(v: Column) -> Column:
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return F.when(size > 0, F.transform(v, lambda x: x / size)).otherwise(v.cast("array<double>"))


def profile_vector(visual: Column, behaviour: Column) -> Column:
    """A unit visual vector followed by the behaviour scaled to 3 at most."""
    top = F.array_max(F.transform(behaviour, lambda x: F.abs(x))) + 1e-6
    return F.concat(normalized(visual), F.transform(behaviour, lambda x: x / top * 3))


def archetypes(teams: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """keys, archetype and archetype_conf of every team: multinomial regression on labelled seeds. teams: keys, vector (array); seeds: keys, archetype. Seeds without an archetype do not count. Raises for fewer than two labels or more than 1,000."""
    names = [r[0] for r in seeds.select("archetype").where("archetype IS NOT NULL").distinct().orderBy("archetype").limit(1001).collect()]
    if len(names) < 2:
        raise ValueError("labels of at least two archetypes are needed")
    if len(names) > 1000:
        raise ValueError("more than 1,000 archetypes")
    from pyspark.ml.functions import array_to_vector

    data = teams.select(*keys, array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    label = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("archetype")).cast("double") - 1
    known = data.join(seeds.where("archetype IS NOT NULL"), keys).withColumn("label", label)
    fitted = LogisticRegression(family="multinomial", regParam=1.0 / max(known.count(), 1), standardization=False, maxIter=2000).fit(known)
    p = vector_to_array(F.col("probability"))
    return fitted.transform(data).select(
        *keys, F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(p, F.array_max(p)).cast("int")).alias("archetype"), F.array_max(p).alias("archetype_conf")
    )


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rn = 1").drop("rn")
