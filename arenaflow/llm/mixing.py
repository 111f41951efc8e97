"""Problem 8: mix sources to target shares of all tokens.

Every source gets a rate, its target tokens over its available tokens, at most
its max_repeat. A document is used floor(rate) times, and once more with the
rest as inclusion probability. Those draws are balanced by the cube method:
probabilities move along the null space of the constraints (documents and
tokens of the source) until they are 0 or 1. Buckets of bounded size do so on
their own and leave at most two documents undecided each; these meet again in
buckets of the next level, until one landing problem per source remains.
"""

from __future__ import annotations

import base64
import math
import random
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import fits_broadcast, materialize, union_all

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the vocabulary's texts are split before merging.
SPLIT_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents that one flight phase holds.
BUCKET = 5_000

_encoders: dict[str, object] = {}


def _encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_counts(df: DataFrame, text: str, keep: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """The columns `keep` and tokens, the tokens of the text; null counts 0."""
    kind = df.select(*keep, F.lit(0).cast("long").alias("tokens")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(tokenizer)
        for b in batches:
            n = [0 if t is None else len(enc.encode_ordinary(t)) for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(n, pa.int64())], names=[*keep, "tokens"])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(count, kind)


def flight(prob: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Moves the probabilities until at most two lie strictly between 0 and 1, keeping their sum and their sum weighted by size, each probability unchanged in expectation."""
    p = list(prob)
    todo = [k for k in range(len(p)) if 1e-9 < p[k] < 1 - 1e-9]
    todo.reverse()
    live: list[int] = []
    while True:
        while len(live) < 3 and todo:
            live.append(todo.pop())
        if len(live) < 2:
            break
        a, b = live[0], live[1]
        if len(live) == 3:
            c = live[2]
            u = [size[b] - size[c], size[c] - size[a], size[a] - size[b]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        elif size[a] == size[b]:
            u = [1.0, -1.0]
        else:
            break
        up = down = math.inf
        for k, d in zip(live, u):
            if d > 0:
                up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
            elif d < 0:
                up, down = min(up, -p[k] / d), min(down, (p[k] - 1) / d)
        step = up if rng.random() * (up + down) < down else -down
        still = []
        for k, d in zip(live, u):
            q = p[k] + step * d
            p[k] = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
            if 0.0 < p[k] < 1.0:
                still.append(k)
        live = still
    return p


def landing(prob: list[float], size: list[float]) -> list[float]:
    """Rounds what the last flight left, at most a few documents, to the choice with the least deviation in tokens."""
    open_ = [k for k, x in enumerate(prob) if 0.0 < x < 1.0]
    want = sum(prob[k] * size[k] for k in open_)
    best = min(range(1 << len(open_)), key=lambda m: (abs(sum(size[k] for i, k in enumerate(open_) if m >> i & 1) - want), m))
    out = list(prob)
    for i, k in enumerate(open_):
        out[k] = float(best >> i & 1)
    return out


def _bucket_flight(level: int, seed: int, bucket: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        rng = random.Random(f"{seed}/{level}/{key}")
        order = list(range(len(rows)))
        rng.shuffle(order)
        rows = rows.iloc[order].reset_index(drop=True)
        size = rows["tokens"].astype(float).tolist()
        p = flight(rows["p"].tolist(), size, rng)
        # The source's last bucket decides.
        return rows.assign(p=landing(p, size) if rows["n"].iloc[0] <= bucket else p)[["doc_id", "source", "tokens", "n", "p"]]

    return run


def _cube(units: DataFrame, most: int, seed: int) -> DataFrame:
    """units (doc_id, source, tokens, n, p) with p moved to 0 or 1. n: documents of the source at most; most: the greatest n."""
    kind = "doc_id long, source string, tokens long, n long, p double"
    decided, now = [], units
    level = 0
    while True:
        bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed + level)), F.ceil(F.col("n") / BUCKET))
        moved = now.withColumn("bucket", bucket).groupBy("source", "bucket").applyInPandas(_bucket_flight(level, seed, BUCKET), kind)
        moved = materialize(moved, "cube")
        if most <= BUCKET:
            return union_all([*decided, moved])
        decided.append(moved.where("p = 0 OR p = 1"))
        # Every bucket leaves two documents at most.
        now = moved.where("p > 0 AND p < 1").withColumn("n", 2 * F.ceil(F.col("n") / BUCKET))
        most = 2 * -(-most // BUCKET)
        level += 1


def source_label(c: str):
    """Source labels compare trimmed and in lower case; blank counts as null."""
    t = F.lower(F.trim(F.col(c)))
    return F.when(t != "", t)


def mixture(
    documents: DataFrame, targets: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
    total_tokens: int | None = None, tokenizer: str = TOKENIZER, seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(documents used, report per source).

    documents used: doc_id, source, tokens, copies (1..max_repeat), one row per
    document. report: source, target_share, max_repeat, available documents and
    tokens, target_tokens, mixed_tokens, mixed_docs, actual_share,
    shortfall_tokens and limits_total, one row per source of targets.
    total_tokens is the size of the mixture; by default the largest at which no
    source present in documents falls short, so that the scarcest one, marked by
    limits_total, bounds it. Sources of targets without documents fall short by their whole
    target; documents of other or null sources, with null ids, or without
    tokens, are left out. Repeated doc_ids count once. Target rows with null
    source, share or repeat, or a share of 0 or less, count as none; equal
    labels are added up. Empty tables give an empty mixture. Other columns are
    ignored, whatever their names.
    """
    rows = targets.select(source_label("source").alias("source"), F.col("target_share").cast("double").alias("share"), F.col("max_repeat").cast("int").alias("most"))
    want = rows.where("source IS NOT NULL AND share > 0 AND most > 0").groupBy("source").agg(F.sum("share").alias("share"), F.max("most").alias("most"))

    def small(df: DataFrame) -> DataFrame:
        """A table of at most one row per target, for broadcast if they are few enough."""
        return F.broadcast(df) if few else df

    few = fits_broadcast(want)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), source_label(source).alias("source"), F.col(text).alias("text"))
    docs = docs.where("doc_id IS NOT NULL").join(small(want.select("source")), "source", "left_semi")
    counted = token_counts(docs, "text", ["doc_id", "source"], tokenizer)
    counted = materialize(counted.groupBy("doc_id").agg(F.max_by("source", F.struct("tokens", "source")).alias("source"), F.max("tokens").alias("tokens")).where("tokens > 0"), "tokens")
    have = counted.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("available"))
    supply = materialize(want.join(have, "source", "left").withColumn("bound", F.col("available") * F.col("most") / F.col("share")), "supply")
    least = supply.agg(F.min("bound")).first()[0]
    if total_tokens is None:
        total_tokens = math.floor(least or 0)
    rate = F.least(F.col("most").cast("double"), F.col("share") * F.lit(float(total_tokens)) / F.col("available"))
    # Rates that rounding errors put next to a whole number are whole.
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    plan = supply.where("n > 0").select("source", "n", F.floor(rate).cast("int").alias("base"), (rate - F.floor(rate)).alias("p"))
    planned = counted.join(small(plan), "source")
    most = plan.where("p > 0").agg(F.max("n")).first()[0]
    whole = planned.select("doc_id", "source", "tokens", F.col("base").alias("copies")).where("copies > 0")
    if most:
        once = _cube(planned.where("p > 0").select("doc_id", "source", "tokens", "n", "p"), most, seed)
        extra = once.where("p = 1").select("doc_id", "source", "tokens", F.lit(1).alias("copies"))
        whole = whole.unionByName(extra).groupBy("doc_id", "source", "tokens").agg(F.sum("copies").alias("copies"))
    used = whole.select("doc_id", "source", "tokens", F.col("copies").cast("int").alias("copies"))
    goal = supply.select(
        "source", F.col("share").alias("target_share"), F.col("most").alias("max_repeat"), F.coalesce("n", F.lit(0)).alias("available_docs"), F.coalesce("available", F.lit(0)).alias("available_tokens"),
        (F.col("share") * F.lit(float(total_tokens))).alias("target_tokens"), F.coalesce(F.col("bound") == F.lit(least), F.lit(False)).alias("limits_total"),
    )
    got = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.count("*").alias("mixed_docs"))
    report = goal.join(small(got), "source", "left").fillna(0, ["mixed_tokens", "mixed_docs"])
    report = report.withColumn("all_tokens", F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0))))  # as many rows as targets
    return used, report.select(
        "source", "target_share", "max_repeat", "available_docs", "available_tokens", "target_tokens", "mixed_tokens", "mixed_docs",
        F.when(F.col("all_tokens") > 0, F.col("mixed_tokens") / F.col("all_tokens")).otherwise(0.0).alias("actual_share"),
        F.greatest(F.col("target_tokens") - F.col("mixed_tokens"), F.lit(0.0)).alias("shortfall_tokens"), "limits_total",
    )
