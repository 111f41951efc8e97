"""Camera clusters: greedy leaders over fingerprints, medians and means of vectors, nearest centres."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import mean_l1


def leader_clusters(clips: DataFrame, threshold: float = 16.0) -> DataFrame:
    """(source_id, clip_id, cluster): in order of clip_id a clip joins the nearest centre of its source closer than `threshold` in mean absolute difference, else it leads a new cluster; centres are running means.

    The rule depends on the order, so a source is one group: the clips of one
    stream. Null fingerprints do not count.
    """

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("clip_id", kind="stable")
        centres, sizes, got = np.empty((0, 0)), [], []
        for v in rows["fp"]:
            v = np.asarray(v, float)
            off = np.abs(centres - v).mean(axis=1) if len(sizes) else np.array([np.inf])
            k = int(off.argmin())
            if off[k] < threshold:
                sizes[k] += 1
                centres[k] += (v - centres[k]) / sizes[k]
            else:
                k = len(sizes)
                centres = np.vstack([centres, v]) if k else v[None].copy()
                sizes.append(1)
            got.append(k)
        return pd.DataFrame({"source_id": key[0], "clip_id": rows["clip_id"].to_numpy(), "cluster": got})

    kind = f"source_id {dict(clips.dtypes)['source_id']}, clip_id {dict(clips.dtypes)['clip_id']}, cluster int"
    return clips.where("fp IS NOT NULL").groupBy("source_id").applyInPandas(run, kind)


def representatives(clusters: DataFrame) -> DataFrame:
    """Clusters of a source by size, the largest first, each with its middle member by clip_id."""
    w = Window.partitionBy("source_id", "cluster")
    m = clusters.withColumns({"n": F.count("*").over(w), "rn": F.row_number().over(w.orderBy("clip_id"))}).where(F.col("rn") == F.floor(F.col("n") / 2) + 1)
    return m.select("source_id", "cluster", "n", F.col("clip_id").alias("rep"), F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("n"), "cluster")).alias("size_rank"))


def by_element(df: DataFrame, keys: list[str], vector: str, how) -> DataFrame:
    """keys and the element-wise aggregate `how` of a vector column, in order of position."""
    e = df.select(*keys, F.posexplode(vector).alias("i", "v")).groupBy(*keys, "i").agg(how(F.col("v").cast("double")).alias("v"))
    return e.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias(vector))


def nearest_centre(points: DataFrame, centres: DataFrame, keys: list[str], within: float) -> DataFrame:
    """points with the centre of the same keys that is nearest in mean absolute difference, if closer than `within`; ties go to the lower centre id. Centres are few per key."""
    c = centres.select(*keys, "centre_id", F.col("fp").alias("centre_fp"))
    d = points.join(c, keys).withColumn("distance", mean_l1(F.col("fp"), F.col("centre_fp")))
    best = F.min(F.struct("distance", "centre_id")).alias("b")
    return d.where(F.col("distance") < within).groupBy(*keys, "clip_id").agg(best).select(*keys, "clip_id", "b.centre_id", "b.distance")


def calibration_plan(clips: DataFrame, fitted: DataFrame | None = None, least: int = 3, within: float = 32.0) -> DataFrame:
    """(source_id, clip_id, cluster, calibrated_as): which cluster's calibration each clip takes.

    clips: source_id, clip_id, cluster, fp. Clusters of at least `least` clips are
    calibrated on their own, if `fitted` (source_id, cluster) is given only those
    in it. A clip of a smaller one takes that of the nearest centre of its source
    closer than `within`; a centre is the mean of the cluster's first three
    fingerprints by clip_id. calibrated_as is null where there is none.
    """
    cluster = Window.partitionBy("source_id", "cluster")
    sized = clips.withColumns({"n": F.count("*").over(cluster), "rn": F.row_number().over(cluster.orderBy("clip_id"))})
    major = sized.where(F.col("n") >= least)
    if fitted is not None:
        major = major.join(fitted.select("source_id", "cluster").distinct(), ["source_id", "cluster"], "left_semi")
    centres = by_element(major.where("rn <= 3 AND fp IS NOT NULL"), ["source_id", "cluster"], "fp", F.avg).withColumnRenamed("cluster", "centre_id")
    minor = sized.where((F.col("n") < least) & F.col("fp").isNotNull())
    taken = nearest_centre(minor, centres, ["source_id"], within).select("source_id", "clip_id", F.col("centre_id").alias("taken"))
    own = major.select("source_id", "clip_id", F.col("cluster").alias("own"))
    out = clips.select("source_id", "clip_id", "cluster").join(own, ["source_id", "clip_id"], "left").join(taken, ["source_id", "clip_id"], "left")
    return out.select("source_id", "clip_id", "cluster", F.coalesce("own", "taken").alias("calibrated_as"))
