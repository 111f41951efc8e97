"""From videos to work: which frames to look at, what is kept between passes, what is still to do, and failures kept apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store


def duration(n_frames: Column, fps: Column) -> Column:
    """Seconds of a video; null where the frame rate is 0 or unknown."""
    return F.when(fps != 0, n_frames / fps)


def stride_times(spans: DataFrame, keys: list[str], hz: float = 5.0) -> DataFrame:
    """(keys, frame, ts): of spans (keys, start_ts, end_ts, fps) every max(1, fps / hz)-th frame from start_ts until before end_ts, the stride rounded half to even.

    Only the kept frames are made. Spans with a null bound or rate, a rate of 0
    or less, or an end not after the start give none; ts is start_ts plus whole
    frames.
    """
    fps, length = F.col("fps"), F.col("end_ts") - F.col("start_ts")
    step = F.greatest(F.lit(1), F.bround(fps / hz, 0).cast("int"))
    last = F.ceil(length * fps - 1e-9).cast("int") - 1
    ok = spans.where((fps > 0) & (length > 0)).withColumns({"step": step, "last": last}).where("last >= 0")
    f = ok.withColumn("frame", F.explode(F.sequence(F.lit(0), "last", "step")))
    return f.select(*keys, "frame", (F.col("start_ts") + F.col("frame") / fps).alias("ts"))


def period_times(videos: DataFrame, keys: list[str], period: float = 1.0) -> DataFrame:
    """(keys, k, ts): the times 0, period, 2 * period, ... before the end of videos (keys, duration_s). A null or non-positive duration gives none."""
    n = F.ceil(F.col("duration_s") / period - 1e-9).cast("int")
    k = videos.where("duration_s > 0").withColumn("k", F.explode(F.sequence(F.lit(0), n - 1)))
    return k.select(*keys, "k", (F.col("k") * period).alias("ts"))


def full_passes(samples: DataFrame, every: float = 5.0) -> DataFrame:
    """(video_id, video_ts): the samples (video_id, video_ts, timer) at which the whole frame is read again: the first, and those without a timer at least `every` seconds after the last one read whole.

    Each depends on the one before it, so the times of a video are folded as one
    array: some hours at one a second. Null times do not count.
    """
    item = F.struct("video_ts", F.col("timer").isNull().alias("lost"))
    due = lambda acc, x: F.size(acc).cast("boolean") & ~(x["lost"] & (x["video_ts"] - F.try_element_at(acc, F.lit(-1)) >= every))
    kept = F.aggregate(F.array_sort(F.collect_list(item)), F.array().cast("array<double>"), lambda acc, x: F.when(due(acc, x), acc).otherwise(F.array_append(acc, x["video_ts"])))
    return samples.where("video_ts IS NOT NULL").groupBy("video_id").agg(kept.alias("at")).select("video_id", F.explode("at").alias("video_ts"))


def carry_regions(located: DataFrame) -> DataFrame:
    """located (video_id, video_ts, timer, label, panel: boxes as structs, as overlay.locate gives them) with the label and panel last seen in the video where a pass finds none."""
    so_far = Window.partitionBy("video_id").orderBy("video_ts").rowsBetween(Window.unboundedPreceding, 0)
    return located.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in ("label", "panel")})


def first_cards(cards: DataFrame) -> DataFrame:
    """Of the result cards of a video with one name the first, as overlay.result_cards gives them."""
    columns = [c for c in cards.columns if c not in ("video_id", "match_name")]
    # The time is unique within a video, so the first one is one row.
    one = cards.groupBy("video_id", "match_name").agg(*[F.min_by(c, "video_ts").alias(c) for c in columns])
    return one.select(cards.columns)


def missing_work(wanted: DataFrame, done: DataFrame, keys: list[str], redo: bool = False) -> DataFrame:
    """The wanted items that done has no rows for; with redo all."""
    return wanted if redo else wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def process_missing(wanted: DataFrame, path: str, keys: list[str], work: Callable[[DataFrame], DataFrame], redo: bool = False) -> DataFrame:
    """The table at path, partitioned by keys, after work has run on the wanted items (keys) it lacks, or on all with redo; only partitions with new rows are written. The table may be empty but must exist."""
    spark = wanted.sparkSession
    done = spark.read.parquet(path)
    todo = missing_work(wanted, done, keys, redo)
    store.overwrite_partitions(work(todo).select(done.columns), path, keys)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(done.schema).parquet(path)


def isolated(items: DataFrame, keys: list[str], work: Callable[[dict], str]) -> DataFrame:
    """(keys, ok, result, error): work on every item (a row as a dict) on its own; an item that fails leaves its error's text and no other item without its result."""
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.select(*keys).schema) + ", ok boolean, result string, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for row in f.astype(object).where(f.notna(), None).to_dict("records"):
                try:
                    rows.append((*[row[k] for k in keys], True, work(row), None))
                except Exception as e:  # noqa: BLE001 - whatever the work raises
                    rows.append((*[row[k] for k in keys], False, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[*keys, "ok", "result", "error"], dtype=object)

    return items.mapInPandas(run, kind)
