"""Hooks for code that looks at pixels: a detector or reader per frame, run over batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Detector = Callable[[bytes], list[tuple[str, int | None, float, tuple[float, float, float, float]]]]
Reader = Callable[[bytes], list[tuple[str, float, tuple[float, float, float, float]]]]


def detect(frames: DataFrame, make: Callable[[], Detector]) -> DataFrame:
    """Detections of frames (match_id, t, image): match_id, t, pos, cls, track_id, conf, x0..y1. make builds the detector once a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = make()
        for b in batches:
            rows = [(m, t, k, c, tid, conf, *box) for m, t, img in b[["match_id", "t", "image"]].itertuples(index=False) for k, (c, tid, conf, box) in enumerate(f(img))]
            yield pd.DataFrame(rows, columns=["match_id", "t", "pos", "cls", "track_id", "conf", "x0", "y0", "x1", "y1"]).astype({"track_id": "Int64"})

    return frames.mapInPandas(run, "match_id long, t double, pos int, cls string, track_id long, conf double, x0 double, y0 double, x1 double, y1 double")


def read_text(frames: DataFrame, make: Callable[[], Reader], fallback: Callable[[], Reader] | None = None) -> DataFrame:
    """Text boxes of frames (video_id, video_ts, region, image); where make fails to build, fallback is used."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            f = make()
        except Exception:
            if fallback is None:
                raise
            f = fallback()
        for b in batches:
            rows = [(v, t, r, k, text, conf, *box) for v, t, r, img in b[["video_id", "video_ts", "region", "image"]].itertuples(index=False) for k, (text, conf, box) in enumerate(f(img))]
            yield pd.DataFrame(rows, columns=["video_id", "video_ts", "region", "pos", "text", "conf", "x0", "y0", "x1", "y1"])

    return frames.mapInPandas(run, "video_id string, video_ts double, region string, pos int, text string, conf double, x0 double, y0 double, x1 double, y1 double")
