"""Problem 1: collapse runs of same or nearly same consecutive events.

Rows are sorted by range into chunks, so that one hot group spreads over many
chunks. Every chunk is encoded on its own in one pass. What a chunk does not
know is the run that reaches into it from the left; a run's fate depends only
on its first reading (the anchor), and the anchors that survive the first k
rows form a box (running max - tolerance, running min + tolerance). The chunk
therefore lists the rows where that box shrinks, each with the runs that follow
if the incoming run ends there. These summaries are functions from incoming to
outgoing run; they compose associatively and a parallel prefix merge over the
chunks finds each chunk's incoming run.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import materialize, partitions

#: Chunk summaries that one task merges; beyond it the merge gets another level.
FAN_IN = 256


class _Run:
    """An open run: the anchor's row id, time and values, the last time, the readings so far."""

    __slots__ = ("rid", "t0", "v", "t1", "n")

    def __init__(self, rid, t0, v, t1, n):
        self.rid, self.t0, self.v, self.t1, self.n = rid, t0, v, t1, n

    def state(self, key):
        return (key, self.rid, self.t0, self.v, self.t1)


class _Encoder:
    """Encodes one chunk; rows are fed in order, exact repeats already folded."""

    def __init__(self, chunk: int, gap: float, tol: float, nv: int):
        self.chunk, self.gap, self.tol, self.nv = chunk, gap, tol, nv
        self.key = self.run = None
        self.head = True  # still inside the stretch that the incoming run may reach
        self.out: list[tuple] = []
        self.entries: list[tuple] = []  # (lo, hi, alternative) in order of exit
        self.alts: list[list] = []  # [open run, alternatives that share it]
        self.n_alts = 0
        self.lo = self.hi = None
        self.passing = True
        self.carried = 0
        self.carry_t = None
        self.first = None
        self.through = True

    def _emit(self, alt: int, run: _Run, touch: bool) -> None:
        self.out.append((alt, self.key, run.rid, run.t0, run.t1, run.n, run.v, touch))

    def _carry(self, alt: int) -> None:
        """The part of the incoming run that lies in this chunk, under the alternative."""
        if self.carried:
            self.out.append((alt, self.key, None, None, self.carry_t, self.carried, None, True))

    def _close_head(self, touch: bool) -> None:
        for run, members in self.alts:
            for alt in members:
                self._emit(alt, run, touch)
        if self.passing:
            self._carry(-2)
        self.head = False

    def feed(self, new_key, key, rid, t0, t1, n, v) -> None:
        if self.first is None:
            self.first, self.key = (key, t0), key
            new_key = False
        elif new_key or t0 - self.last > self.gap:
            if self.head:
                self._close_head(False)
                self.through = False
            elif self.run is not None:
                self._emit(-1, self.run, False)
            self.key, self.run = key, None
        self.last = t1
        if not self.head:
            if self.run is not None and all(abs(a - b) <= self.tol for a, b in zip(v, self.run.v)):
                self.run.t1, self.run.n = t1, self.run.n + n
            else:
                if self.run is not None:
                    self._emit(-1, self.run, False)
                self.run = _Run(rid, t0, v, t1, n)
            return
        fresh: list[int] = []  # alternatives whose run starts at this row
        kept = []
        for run, members in self.alts:
            if all(abs(a - b) <= self.tol for a, b in zip(v, run.v)):
                run.t1, run.n = t1, run.n + n
                kept.append([run, members])
            else:
                for alt in members:
                    self._emit(alt, run, False)
                fresh += members
        if self.passing:
            lo = tuple(a - self.tol for a in v) if self.lo is None else tuple(max(a - self.tol, b) for a, b in zip(v, self.lo))
            hi = tuple(a + self.tol for a in v) if self.hi is None else tuple(min(a + self.tol, b) for a, b in zip(v, self.hi))
            if (lo, hi) != (self.lo, self.hi):
                self.lo, self.hi = lo, hi
                self.entries.append((lo, hi, self.n_alts))
                self._carry(self.n_alts)
                fresh.append(self.n_alts)
                self.n_alts += 1
            if any(a > b for a, b in zip(lo, hi)):
                self.passing = False
            else:
                self.carried, self.carry_t = self.carried + n, t1
        self.alts = kept + ([[_Run(rid, t0, v, t1, n), fresh]] if fresh else [])
        if not self.passing and len(self.alts) == 1 and fresh:
            self.run, self.alts, self.head, self.through = self.alts[0][0], [], False, False

    def finish(self) -> dict | None:
        """The summary of the chunk; emits what is still open."""
        if self.first is None:
            return None
        outs, definite = {}, None
        if self.head:
            outs = {alt: run.state(self.key) for run, members in self.alts for alt in members}
            self._close_head(True)
        elif self.run is not None:
            definite = self.run.state(self.key)
            self._emit(-1, self.run, True)
        key, t0 = self.first
        passes = self.passing
        return {
            "key": key, "t0": t0, "gap": self.gap,
            "entries": [(lo, hi, alt, outs.get(alt, definite)) for lo, hi, alt in self.entries],
            "pass": (self.last if self.through else None) if passes else False,
            "after": definite,
        }


def _apply(fn: dict, state):
    """(alternative, outgoing state) of a chunk or composed chunks for an incoming state."""
    if state is None or state[0] != fn["key"] or fn["t0"] - state[4] > fn["gap"]:
        return fn["entries"][0][2], fn["entries"][0][3]
    for lo, hi, alt, out in fn["entries"]:
        if not all(a <= x <= b for a, x, b in zip(lo, state[3], hi)):
            return alt, out
    if fn["pass"] is None:  # the incoming run ended inside, at a gap or with its group
        return -2, fn["after"]
    return -2, (*state[:4], fn["pass"])


def _compose(f: dict, g: dict) -> dict:
    entries = [(lo, hi, alt, _apply(g, out)[1]) for lo, hi, alt, out in f["entries"]]
    if f["pass"] is False:
        return {**f, "entries": entries, "after": None}
    if f["pass"] is None:
        return {**f, "entries": entries, "after": _apply(g, f["after"])[1]}
    if g["key"] != f["key"] or g["t0"] - f["pass"] > g["gap"]:
        return {**f, "entries": entries, "pass": None, "after": g["entries"][0][3]}
    return {**f, "entries": entries + g["entries"], "pass": g["pass"], "after": g["after"]}


def _merge_states(fns: DataFrame, n: int) -> DataFrame:
    """Incoming state and alternative of every chunk: fns(idx, fn) -> (idx, alt, state)."""

    def walk(rows: pd.DataFrame, state) -> pd.DataFrame:
        got = []
        for idx, fn in rows.sort_values("idx")[["idx", "fn"]].itertuples(index=False):
            alt, after = _apply(pickle.loads(fn), state)
            got.append((idx, alt, pickle.dumps(state)))
            state = after
        return pd.DataFrame(got, columns=["idx", "alt", "state"])

    kind = "idx long, alt int, state binary"
    if n <= FAN_IN:
        return fns.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda rows: walk(rows, None), kind)

    def fold(key, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [pickle.loads(x) for x in rows.sort_values("idx")["fn"]]
        whole = parts[0]
        for part in parts[1:]:
            whole = _compose(whole, part)
        return pd.DataFrame({"idx": [key[0]], "fn": [pickle.dumps(whole)]})

    block = F.floor(F.col("idx") / FAN_IN).cast("long")
    blocks = fns.groupBy(block.alias("b")).applyInPandas(fold, "idx long, fn binary")
    above = _merge_states(blocks, -(-n // FAN_IN)).select(F.col("idx").alias("b"), F.col("state").alias("before"))
    return (
        fns.withColumn("b", block).join(above, "b").groupBy("b")
        .applyInPandas(lambda rows: walk(rows, pickle.loads(rows["before"].iloc[0])), kind)
    )


def collapse_runs(
    df: DataFrame, keys: list[str], t: str, row_id: str, values: list[str],
    max_gap_s: float = 5.0, tolerance: float = 1.0, n_chunks: int | None = None,
) -> DataFrame:
    """One row per run: keys, first_row_id, t_start, t_end, duration, n_readings, first_<value>...

    In order of (t, row_id) within the keys, a row joins the current run if it
    comes at most max_gap_s after the previous row and each value differs by at
    most `tolerance` from that of the run's first row.

    Rows whose t or any value is null or NaN are left out; null keys form a
    group of their own; rows with the same keys, t and row_id count once; ties
    in t go by row_id; an empty table gives an empty result; other columns are
    ignored, whatever their names.

    A chunk lists one way on per shrink of its box. For whole numbers every
    shrink takes at least 1 off one side, so there are at most
    2 * tolerance * len(values) + 2, whatever the rows; for real values that
    drift slowly there may be one per row until the box is empty.
    """
    spark = df.sparkSession
    n = n_chunks or partitions(spark)
    nv, nk = len(values), len(keys)
    rows = df.select(
        *[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
        F.col(t).cast("double").alias("t"), F.col(row_id).cast("long").alias("rid"),
        *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)],
    ).where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in ["t", *[f"v{i}" for i in range(nv)]]))
    order = [*[f"k{i}" for i in range(nk)], "t", "rid"]
    sorted_ = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("chunk", F.spark_partition_id().cast("long"))
    kind = T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("alt", T.IntegerType())]
        + [T.StructField(f"k{i}", T.StringType()) for i in range(nk)]
        + [T.StructField("rid", T.LongType()), T.StructField("t0", T.DoubleType()), T.StructField("t1", T.DoubleType()), T.StructField("n", T.LongType())]
        + [T.StructField(f"v{i}", T.DoubleType()) for i in range(nv)]
        + [T.StructField("touch", T.BooleanType()), T.StructField("fn", T.BinaryType())]
    )
    arrow = pa.schema(
        [("chunk", pa.int64()), ("alt", pa.int32())] + [(f"k{i}", pa.string()) for i in range(nk)]
        + [("rid", pa.int64()), ("t0", pa.float64()), ("t1", pa.float64()), ("n", pa.int64())]
        + [(f"v{i}", pa.float64()) for i in range(nv)] + [("touch", pa.bool_()), ("fn", pa.binary())]
    )

    def batch_of(chunk: int, out: list[tuple], summary: bytes | None) -> pa.RecordBatch:
        rows = [(chunk, a, *k, rid, t0, t1, n, *(v or (None,) * nv), touch, None) for a, k, rid, t0, t1, n, v, touch in out]
        if summary is not None:
            rows.append((chunk, -3, *(None,) * (nk + 4 + nv + 1), summary))
        cols = list(zip(*rows)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, before, chunk = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            chunk = b.column("chunk")[0].as_py()
            enc = enc or _Encoder(chunk, max_gap_s, tolerance, nv)
            codes, names = [], []
            for i in range(nk):
                d = b.column(f"k{i}").dictionary_encode()
                names.append([*d.dictionary.to_pylist(), None])
                codes.append(np.where(np.asarray(d.indices.is_null()), len(names[-1]) - 1, np.asarray(d.indices.fill_null(0))))
            tt, rid = b.column("t").to_numpy(), b.column("rid").to_numpy(zero_copy_only=False)
            vv = np.stack([b.column(f"v{i}").to_numpy() for i in range(nv)])
            now = tuple(names[i][codes[i][0]] for i in range(nk))
            change = np.ones(len(tt), bool)
            for c in codes:
                change[1:] &= c[1:] == c[:-1]
            change = ~change
            change[0] = before is None or before[0] != now
            same = ~change
            dup = np.zeros(len(tt), bool)
            dup[1:] = (tt[1:] == tt[:-1]) & (rid[1:] == rid[:-1]) & same[1:]
            dup[0] = before is not None and same[0] and before[1] == tt[0] and before[2] == rid[0]
            last = tuple(names[i][codes[i][-1]] for i in range(nk))
            before = (last, tt[-1], rid[-1])
            # Fold exact repeats within the gap; their first row stands for them.
            keep = np.flatnonzero(~dup)
            if not len(keep):
                continue
            change_at = np.maximum.accumulate(np.where(change, np.arange(len(tt)), -1))[keep]
            tk, vk = tt[keep], vv[:, keep]
            start = np.ones(len(keep), bool)
            start[1:] = (change_at[1:] != change_at[:-1]) | (tk[1:] - tk[:-1] > max_gap_s) | (vk[:, 1:] != vk[:, :-1]).any(axis=0)
            at = np.flatnonzero(start)
            ends = np.append(at[1:], len(keep))
            fresh = np.ones(len(at), bool)
            fresh[1:] = change_at[at[1:]] != change_at[at[:-1]]
            fresh[0] = change_at[0] >= 0 if before is not None else True
            ks = list(zip(*[[nm[c] for c in cd[keep][at]] for nm, cd in zip(names, codes)])) if nk else [()] * len(at)
            for args in zip(fresh.tolist(), ks, rid[keep][at].tolist(), tk[at].tolist(), tk[ends - 1].tolist(), (ends - at).tolist(), zip(*vk[:, at].tolist())):
                enc.feed(*args)
            if len(enc.out) > 5000:
                out, enc.out = enc.out, []
                yield batch_of(chunk, out, None)
        if enc is not None:
            fn = enc.finish()
            yield batch_of(chunk, enc.out, pickle.dumps(fn))

    pieces = materialize(sorted_.mapInArrow(encode, kind), "runs")
    # Cheap: the summaries are one row a chunk.
    fns = pieces.where("alt = -3").select(F.col("chunk").alias("idx"), "fn")
    chosen = _merge_states(fns, n).select(F.col("idx").alias("chunk"), F.col("alt").alias("chosen"), "state")

    inner = pieces.where("alt = -1 AND NOT touch").select(*[f"k{i}" for i in range(nk)], "rid", "t0", "t1", "n", *[f"v{i}" for i in range(nv)])
    edge = pieces.where("alt <> -3 AND (touch OR alt <> -1)").drop("fn").join(chosen, "chunk").where("alt = -1 OR alt = chosen")

    def name_carried(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f.reset_index(drop=True)
            rid = [pickle.loads(s)[1] if pd.isna(r) else int(r) for r, s in zip(f["rid"], f["state"])]
            f["rid"] = pd.array(rid, dtype="Int64")
            yield f.drop(columns=["chosen", "state", "chunk", "alt", "touch"])

    edge_kind = T.StructType([f for f in kind if f.name not in ("chunk", "alt", "touch", "fn")])
    # Only pieces at chunk borders are grouped: at most a few a chunk and alternative.
    edge = edge.mapInPandas(name_carried, edge_kind).groupBy(*[f"k{i}" for i in range(nk)], "rid").agg(
        F.min("t0").alias("t0"), F.max("t1").alias("t1"), F.sum("n").alias("n"), *[F.max(f"v{i}").alias(f"v{i}") for i in range(nv)]
    )
    types = dict(df.dtypes)
    return inner.unionByName(edge).select(
        *[F.col(f"k{i}").cast(types[k]).alias(k) for i, k in enumerate(keys)],
        F.col("rid").alias("first_row_id"), F.col("t0").alias("t_start"), F.col("t1").alias("t_end"),
        (F.col("t1") - F.col("t0")).alias("duration"), F.col("n").alias("n_readings"),
        *[F.col(f"v{i}").cast(types[v]).alias(f"first_{v}") for i, v in enumerate(values)],
    )


def clean_zone(c: str = "zone"):
    """Trimmed, lower case, spaces and hyphens as underscores."""
    return F.lower(F.regexp_replace(F.trim(F.regexp_replace(F.col(c), r"\s", " ")), r"[ -]", "_"))
