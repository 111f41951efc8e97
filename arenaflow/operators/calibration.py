"""Which calibration holds at a time, and what else is near in time or place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calibration_asof(requests: DataFrame, calibrations: DataFrame, videos: DataFrame) -> DataFrame:
    """requests (video_id, ts and others) with homography, from_ts and origin of the calibration that holds.

    origin own: the video's latest with from_ts <= ts; else origin source: the
    earliest of the clip's source or of any clip of that source, ties by
    video_id; else nulls. A video's few calibrations go to its requests as one
    array, so that no request is multiplied or needs a key, and the two lookups
    are equi-joins with one row per video. Null from_ts hold at no time.
    """
    cal = calibrations.select("video_id", "from_ts", "homography").where("from_ts IS NOT NULL")
    own = cal.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("from_ts", "homography"))).alias("own"))
    source = videos.select(F.col("id").alias("video_id"), "source_id").where("source_id IS NOT NULL AND source_id <> ''")
    of_source = cal.select(F.col("video_id").alias("source_id"), "from_ts", "homography", F.col("video_id").alias("via"))
    of_clips = cal.join(source, "video_id").select("source_id", "from_ts", "homography", F.col("video_id").alias("via"))
    best = of_source.unionByName(of_clips).groupBy("source_id").agg(F.min(F.struct("from_ts", "via", "homography")).alias("alt"))
    alt = source.join(best, "source_id").groupBy("video_id").agg(F.min("alt").alias("alt"))
    both = requests.join(own, "video_id", "left").join(alt, "video_id", "left")
    both = both.withColumn("mine", F.try_element_at(F.filter("own", lambda c: c["from_ts"] <= F.col("ts")), F.lit(-1)))
    return both.select(
        *requests.columns, F.coalesce("mine.homography", "alt.homography").alias("homography"), F.coalesce("mine.from_ts", "alt.from_ts").alias("from_ts"),
        F.when(F.col("mine").isNotNull(), "own").when(F.col("alt").isNotNull(), "source").alias("origin"),
    )


def containing_match(images: DataFrame, matches: DataFrame) -> DataFrame:
    """images (image, match_ref, video_id, ts) with match_id: the match of that id, else the first of the video whose span holds ts."""
    by_id = images.join(matches.select(F.col("id").alias("match_ref"), F.col("id").alias("direct")), "match_ref", "left")
    spans = matches.select("video_id", F.col("id").alias("held"), "video_start_ts", F.coalesce("video_end_ts", F.lit(0.0)).alias("end"))
    held = by_id.where("direct IS NULL").join(spans, "video_id").where(F.col("ts").between(F.col("video_start_ts"), F.col("end"))).groupBy("image").agg(F.min("held").alias("held"))
    return by_id.join(held, "image", "left").select("image", F.coalesce("direct", "held").alias("match_id"))


def nearest_detection(tracked: DataFrame, detections: DataFrame, keys: list[str], within: float = 12.0) -> DataFrame:
    """keys, slot, pos and distance of the detection nearest to each tracked position of the same keys, closer than `within`; ties go to the first. A detection may serve two slots."""
    d = tracked.select(*keys, "slot", F.col("x_in").alias("tx"), F.col("y_in").alias("ty")).join(detections.select(*keys, "pos", "x", "y"), keys)
    d = d.withColumn("distance", F.hypot(F.col("x") - F.col("tx"), F.col("y") - F.col("ty"))).where(F.col("distance") < within)
    return d.groupBy(*keys, "slot").agg(F.min(F.struct("distance", "pos")).alias("b")).select(*keys, "slot", "b.pos", "b.distance")


def state_at(times: DataFrame, series: DataFrame, keys: list[str], value: str, forward: bool = False) -> DataFrame:
    """times (keys, q) with the value of the series (keys, t, value) at q: the last at or before q, else the first; forward: the first at or after q, else the last."""
    j = times.join(series.select(*keys, "t", value), keys)
    near = F.when(F.col("t") >= F.col("q") if forward else F.col("t") <= F.col("q"), F.col("t"))
    a = F.min_by(value, near) if forward else F.max_by(value, near)
    b = F.max_by(value, "t") if forward else F.min_by(value, "t")
    # Ranges per key are short: a match's readings and asked times.
    hit = F.count(near) > 0
    return j.groupBy(*keys, "q").agg(F.when(hit, a).otherwise(b).alias(value))
