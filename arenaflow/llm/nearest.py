"""Problem 4: pair records of two tables with the nearest in time, per entity.

Both tables go by (entity, time bucket) to the same partitions; right records
near a bucket's edge are copied to the neighbouring bucket, so that an entity
with a large part of all rows spreads over many tasks. Buckets that hold very
many rows are cut into narrow ones. Within a partition rows are sorted by
entity, bucket and time and one merge iterator walks them, batch by batch,
holding the nearest right records on either side and the left rows that still
wait for a right record to come, which are never more than the tolerance
reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slack for binary fractions: times are decimal seconds.
EPS = 1e-9
#: At most so many buckets can be dense: each holds more than 1 / DENSE_BUCKETS of all rows, and DENSE_ROWS at least.
DENSE_BUCKETS, DENSE_ROWS = 5_000, 200_000


def nearest_by_time(
    left: DataFrame, right: DataFrame, entity: str, t: str, left_id: str, right_id: str,
    tolerance: float = 0.4, bucket_s: float = 10.0, dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """(left_id, right_id, dt): of every left row the right row nearest in t, if within tolerance.

    Of right rows equally near the earlier wins, then the lower id. Rows with a
    null entity or null or NaN t match nothing; repeated left or right ids count
    once; an empty table on either side gives an empty result; dt is right t
    minus left t; other columns are ignored, whatever their names.
    """
    width, narrow = max(bucket_s, 4 * tolerance), 4 * tolerance

    def side(df: DataFrame, rid: str, is_right: int) -> DataFrame:
        return df.select(
            F.col(entity).alias("e"), F.col(t).cast("double").alias("t"), F.col(rid).cast("long").alias("id"), F.lit(is_right).cast("byte").alias("side")
        ).where("e IS NOT NULL AND t IS NOT NULL AND NOT isnan(t)")

    def bucket(c: Column, w: float) -> Column:
        return F.floor(c / F.lit(w)).cast("long")

    reach = tolerance + 2 * EPS
    lefts, rights = side(left, left_id, 0), side(right, right_id, 1)
    counts = lefts.unionByName(rights).groupBy("e", bucket(F.col("t"), width).alias("b")).count()
    n_rows, most = counts.agg(F.sum("count"), F.max("count")).first()
    limit = max(dense_rows, (n_rows or 0) // DENSE_BUCKETS)
    low, high = F.col("t") - reach, F.col("t") + reach
    wide = rights.withColumn("b", F.explode(F.sequence(bucket(low, width), bucket(high, width))))
    rows = lefts.withColumn("b", bucket(F.col("t"), width)).unionByName(wide).withColumn("n", F.lit(0).cast("long"))
    if most and most > limit:
        # Bounded by the definition of dense: at most DENSE_BUCKETS rows.
        dense = F.broadcast(counts.where(F.col("count") > limit).select("e", "b", F.lit(True).alias("dense")))
        known = rows.join(dense, ["e", "b"], "left")
        inside = lambda c: F.least(F.greatest(c, F.col("b") * width), (F.col("b") + 1) * width - EPS)
        # Of a right row's reach the part in this bucket; a left row goes to one narrow bucket.
        first, last = (bucket(inside(F.when(F.col("side") == 1, c).otherwise(F.col("t"))), narrow) for c in (low, high))
        rows = known.withColumn("n", F.explode(F.when(F.col("dense"), F.sequence(first, last)).otherwise(F.array(F.lit(0).cast("long"))))).drop("dense")
    rows = rows.select("e", "b", "n", "t", "id", "side").repartition("e", "b", "n").sortWithinPartitions("e", "b", "n", "t", "id")
    out = pa.schema([("l", pa.int64()), ("r", pa.int64()), ("dt", pa.float64())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows carried over: waiting left rows and the last right rows, in order
        for b in batches:
            now = pa.Table.from_batches([b])
            if held is not None:
                now = pa.concat_tables([held, now])
            if not now.num_rows:
                continue
            pairs, keep = _settle(*_columns(now), tolerance, last=False)
            held = now.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], schema=out)
        if held is not None and held.num_rows:
            pairs, _ = _settle(*_columns(held), tolerance, last=True)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs], schema=out)

    return rows.mapInArrow(merge, "l long, r long, dt double").select(F.col("l").alias(left_id if left_id != right_id else f"left_{left_id}"), F.col("r").alias(right_id if left_id != right_id else f"right_{right_id}"), "dt")


def _columns(tab: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the group (entity and bucket, both compared as they are), t, id and side of the rows."""
    new = np.zeros(tab.num_rows, bool)
    for c in ("e", "b", "n"):
        a = tab.column(c).combine_chunks()
        new[1:] |= np.asarray(pc.not_equal(a[1:], a[:-1]))
    return np.cumsum(new), *[tab.column(c).to_numpy() for c in ("t", "id", "side")]


def _settle(g: np.ndarray, t: np.ndarray, rid: np.ndarray, side: np.ndarray, tol: float, last: bool):
    """Pairs of the left rows whose both neighbours are known; which rows to hold for the next batch. Equal runs of g are one group, sorted by t."""
    n = len(g)
    at = np.arange(n)
    is_right = side == 1
    left = np.flatnonzero(~is_right)
    # A redelivered left row repeats (g, t, id); among the left rows the copies are neighbours.
    once = np.ones(len(left), bool)
    once[1:] = (g[left[1:]] != g[left[:-1]]) | (t[left[1:]] != t[left[:-1]]) | (rid[left[1:]] != rid[left[:-1]])
    left = left[once]
    start = np.ones(n, bool)
    start[1:] = g[1:] != g[:-1]
    group = np.cumsum(start)
    rights = np.flatnonzero(is_right)
    before = np.searchsorted(rights, left, side="left") - 1
    after = before + 1
    ok_b = before >= 0
    ok_a = after < len(rights)
    pb = rights[np.where(ok_b, before, 0)] if len(rights) else np.zeros(len(left), int)
    pa_ = rights[np.where(ok_a, after, 0)] if len(rights) else np.zeros(len(left), int)
    ok_b &= group[pb] == group[left] if len(left) else ok_b
    ok_a &= group[pa_] == group[left] if len(left) else ok_a
    if len(rights):
        # Of right rows with one t the first, with the lowest id, stands before the others.
        rk = np.ones(len(rights), bool)
        rk[1:] = (t[rights[1:]] != t[rights[:-1]]) | (group[rights[1:]] != group[rights[:-1]])
        first = rights[np.maximum.accumulate(np.where(rk, np.arange(len(rights)), 0))]
        pb = np.where(ok_b, first[np.clip(before, 0, None)], pb)
    db = np.where(ok_b, t[left] - t[pb], np.inf) if len(left) else np.zeros(0)
    da = np.where(ok_a, t[pa_] - t[left], np.inf) if len(left) else np.zeros(0)
    take_b = db <= da + EPS
    best, pick = np.where(take_b, db, da), np.where(take_b, pb, pa_)
    # Rows of an earlier group than the last are settled; of the last group those with a right row after them.
    open_ = (group[left] == group[-1]) & ~ok_a & (t[left] >= t[-1] - tol - EPS) if not last else np.zeros(len(left), bool)
    # With ties in t across the border of a batch, rows at the last t wait too.
    if not last and len(left):
        open_ |= (group[left] == group[-1]) & (t[left] == t[-1])
    good = ~open_ & (best <= tol + EPS)
    pairs = (rid[left[good]], rid[pick[good]], (t[pick] - t[left])[good])
    if last:
        return pairs, None
    keep = np.zeros(n, bool)
    keep[left[open_]] = True
    tail = (group == group[-1]) & is_right
    r = at[tail]
    if len(r):  # the right rows from the one before the first waiting row on
        first_t = t[r[-1]] if not open_.any() else min(t[r[-1]], t[left[open_]].min())
        lo = np.searchsorted(t[r], first_t, side="left")
        lo = np.searchsorted(t[r], t[r[max(lo - 1, 0)]], side="left")
        keep[r[lo:]] = True
    return pairs, keep
