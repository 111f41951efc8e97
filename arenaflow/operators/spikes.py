"""Problem 2: implausible readings, judged per source against its own normal behaviour.

A source is one series of one value (a robot's coordinate, a side's score). Its
profile matrix has one row per window of consecutive readings. Robust principal
components give what is normal for the source: every window is centred at its
median and scaled to unit length before the products are summed, so that no
spike weighs more than any other window, and the leading directions of the sum
are the source's profiles. Each window is then split into a low-rank part, a
level plus profiles within the reach of the source's usual greatest step, and a
sparse rest, by cutting off what deviates by more than a falling threshold and
fitting again. A reading is in the sparse part if it deviates in every window
that holds it near its middle; a short stretch of such readings between two
readings that lie on the course is a spike. A move that stays away has windows
of its own and is none. Constant stretches and impossible values are tested on
their own.

What is known of a source, the histogram of its steps and the sum of products,
adds up over any parts of it. Sources too large for one task are cut into
blocks of rows in order, with a few rows of overlap; the sums are made over all
blocks first and constant stretches are joined across blocks, so that the cut
changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import fits_broadcast, materialize


@dataclass(frozen=True)
class SpikeRules:
    low: float  # lowest and highest possible value
    high: float
    stuck_s: float  # a constant stretch of at least this long is stuck
    times: float  # a spike's deviation from the course, in usual greatest steps
    longest: int = 4  # rows of a spike
    window: int = 12  # readings in a profile
    rank: int = 2
    rounds: int = 6
    agree: int = 2  # windows that must hold a reading in their low-rank part


TRACKS = SpikeRules(-6.0, 146.4, 3.0, 3.5)
SCORES = SpikeRules(0.0, 400.0, 25.0, 2.0)

IMPOSSIBLE, STUCK, SPIKE = 1, 2, 4

#: Steps are counted in bins of one per cent from LEAST_STEP on.
LEAST_STEP, STEP_RATIO, STEP_BINS = 1e-4, 1.01, 1852
#: Rows that a block of a large source shares with each neighbour.
OVERLAP = 40


def step_counts(x: np.ndarray, s: np.ndarray, n_src: int, mine: np.ndarray | None = None) -> np.ndarray:
    """Per source how many of its steps that are not 0 fall into each bin; mine: the rows whose step from the row before counts."""
    step = np.abs(np.diff(x))
    real = (s[1:] == s[:-1]) & (step > 0)
    if mine is not None:
        real &= mine[1:]
    at = np.clip(np.log(step[real] / LEAST_STEP) / np.log(STEP_RATIO), 0, STEP_BINS - 1).astype(np.int64)
    return np.bincount(s[1:][real] * STEP_BINS + at, minlength=n_src * STEP_BINS).reshape(n_src, STEP_BINS)


def usual_step(counts: np.ndarray) -> np.ndarray:
    """Per source the usual greatest step: the 90 % quantile of its steps that are not 0, at most 3.5 medians of them, so that many spikes do not raise it; infinite without steps."""
    total = counts.sum(axis=1)
    up = np.cumsum(counts, axis=1)

    def quantile(q: float) -> np.ndarray:
        at = (up <= (q * (total - 1))[:, None]).sum(axis=1)
        return LEAST_STEP * STEP_RATIO ** (np.minimum(at, STEP_BINS - 1) + 0.5)

    return np.where(total > 0, np.minimum(quantile(0.9), 3.5 * quantile(0.5)), np.inf)


def _windows(x: np.ndarray, start: np.ndarray, count: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, their sources, per source its first window): one window per row and one more, the row after its middle; ends are repeated."""
    half = w // 2
    size = count + 2 * half
    begin = np.cumsum(size) - size
    src = np.repeat(np.arange(len(start)), size)
    padded = x[np.clip(np.arange(size.sum()) - begin[src] - half, 0, count[src] - 1) + start[src]]
    views = np.lib.stride_tricks.sliding_window_view(padded, w)
    of = np.repeat(np.arange(len(start)), count + 1)
    first = np.cumsum(count + 1) - (count + 1)
    return views[np.arange(len(of)) - first[of] + begin[of]], of, first


def profile_products(windows: np.ndarray, of: np.ndarray, n_src: int, mine: np.ndarray | None = None) -> np.ndarray:
    """Per source the products of its windows' readings, summed over the windows, each centred at its median and of unit length. Constant windows say nothing."""
    z = windows - np.median(windows, axis=1)[:, None]
    norm = np.sqrt((z * z).sum(axis=1))
    use = norm > 1e-9 if mine is None else (norm > 1e-9) & mine
    z, of = z[use] / norm[use, None], of[use]
    out = np.zeros((n_src, windows.shape[1], windows.shape[1]))
    if len(z):
        at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        for a, b in zip(at.tolist(), np.r_[at[1:], len(of)].tolist()):
            out[of[a]] = z[a:b].T @ z[a:b]
    return out


def profiles(products: np.ndarray, unit: np.ndarray, rules: SpikeRules) -> tuple[np.ndarray, np.ndarray]:
    """Per source an orthonormal basis, the level first and then the leading profiles, and the ridge that keeps each profile within the reach of the usual step."""
    n, w, _ = products.shape
    flat = np.eye(w) - 1.0 / w
    value, vector = np.linalg.eigh(flat @ products @ flat)
    value, vector = value[:, ::-1][:, : rules.rank], vector[:, :, ::-1][:, :, : rules.rank]
    top = value[:, :1].clip(1e-12)
    # A steady move at the usual greatest step has this length; the rest of a reading is half a step.
    reach = unit * np.sqrt(w * (w * w - 1) / 12)
    basis = np.concatenate([np.full((n, w, 1), 1 / np.sqrt(w)), vector], axis=2)
    ridge = np.concatenate([np.zeros((n, 1)), (unit[:, None] / 2) ** 2 / (reach[:, None] ** 2 * (value / top).clip(1e-4))], axis=1)
    return basis, ridge


def _sparse_rest(windows: np.ndarray, of: np.ndarray, basis: np.ndarray, ridge: np.ndarray, least: np.ndarray, rounds: int) -> np.ndarray:
    """Every window less its low-rank part. least: per source the deviation of a spike."""
    centre = np.median(windows, axis=1)
    whole = windows - centre[:, None]
    rest = np.empty_like(whole)
    # One fit on all readings; what it leaves is small unless the window holds something sparse.
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    for a, b in zip(at.tolist(), np.r_[at[1:], len(of)].tolist()):
        k = of[a]
        rest[a:b] = whole[a:b] - ((whole[a:b] @ basis[k]) / (1 + ridge[k])) @ basis[k].T
    rough = np.flatnonzero(np.abs(rest).max(axis=1) > 0.2 * least[of])
    eye = np.eye(basis.shape[2])
    for part in np.array_split(rough, max(1, -(-len(rough) // 20_000))):
        y, k = whole[part], of[part]
        b, r, off = basis[k], ridge[k][:, :, None] * eye, y
        worst = np.abs(y).max(axis=1)
        for i in range(rounds):
            kept = (np.abs(off) <= np.maximum(0.4 * least[k], worst * 0.6 ** (i + 1))[:, None]).astype(float)
            bk = b * kept[:, :, None]
            inner = bk.transpose(0, 2, 1) @ b + r + 1e-9 * eye
            coef = np.linalg.solve(inner, bk.transpose(0, 2, 1) @ y[:, :, None])
            off = y - (b @ coef)[:, :, 0]
        rest[part] = off
    return rest


def low_rank(v: np.ndarray, start: np.ndarray, count: np.ndarray, unit: np.ndarray, rules: SpikeRules, products: np.ndarray | None = None) -> np.ndarray:
    """The low-rank course at every reading: of the windows that hold it near the middle the part that it deviates from least. products: of the whole sources where these rows are a part of them."""
    w = rules.window
    windows, of, first = _windows(v, start, count, w)
    if products is None:
        own = np.ones(len(of), bool)
        own[first + count] = False  # a window per row
        products = profile_products(windows, of, len(start), own)
    basis, ridge = profiles(products, unit, rules)
    rest = _sparse_rest(windows, of, basis, ridge, rules.times * unit, rules.rounds)
    src = np.repeat(np.arange(len(start)), count)
    row = np.arange(len(v)) - start[src]
    off = np.full((w - 2 * (w // 4), len(v)), np.inf)
    for i in range(len(off)):
        at = row + w // 2 - w // 4 - i
        ok = (at >= 0) & (at <= count[src])
        off[i] = np.where(ok, rest[first[src] + np.clip(at, 0, count[src]), w // 4 + i], np.inf)
    near = np.argsort(np.abs(off), axis=0)[rules.agree - 1]
    best = np.take_along_axis(off, near[None], axis=0)[0]
    return v - best


def flag_series(src: np.ndarray, t: np.ndarray, v: np.ndarray, rules: SpikeRules, known: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Bits IMPOSSIBLE, STUCK and SPIKE per row; src numbers the sources, rows of one source lie together in order of t. known: step counts and products per source number where these rows are a part of the sources."""
    n = len(v)
    flags = np.zeros(n, np.int32)
    if not n:
        return flags
    possible = (v >= rules.low) & (v <= rules.high)
    flags[~possible] |= IMPOSSIBLE
    begin, end = constant_stretches(src, v)
    long = (t[end] - t[begin] >= rules.stuck_s - 1e-9) & (end > begin)
    flags[np.repeat(long, end - begin + 1)] |= STUCK
    # Spikes, on the possible values.
    rows = np.flatnonzero(possible)
    if len(rows) < 3:
        return flags
    x = v[rows].astype(np.float64)
    names, s = np.unique(src[rows], return_inverse=True)
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    count = np.diff(np.r_[start, len(s)])
    counts, products = (step_counts(x, s, len(start)), None) if known is None else (known[0][names], known[1][names])
    unit = usual_step(counts)
    moving = np.isfinite(unit)
    off = np.abs(x - low_rank(x, start, count, np.where(moving, unit, 1.0), rules, products))
    sparse = (off >= (rules.times * np.where(moving, unit, np.inf))[s])
    flags[rows[_short_stretches(x, s, off, sparse, rules.longest)]] |= SPIKE
    return flags


def constant_stretches(src: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last rows of the stretches of one source with exactly the same value."""
    at = np.flatnonzero(np.r_[True, (src[1:] != src[:-1]) | (v[1:] != v[:-1])])
    return at, np.r_[at[1:], len(v)] - 1


def _short_stretches(x: np.ndarray, s: np.ndarray, off: np.ndarray, sparse: np.ndarray, longest: int) -> np.ndarray:
    """Rows of stretches of at most `longest` sparse rows between two rows of their source on the course, which is the same before and after."""
    n = len(x)
    hit = np.zeros(n, bool)
    change = np.r_[True, (sparse[1:] != sparse[:-1]) | (s[1:] != s[:-1])]
    first = np.flatnonzero(change)
    last = np.r_[first[1:], n] - 1
    k = np.flatnonzero(sparse[first] & (last - first < longest) & (first > 0) & (last < n - 1))
    first, last = first[k], last[k]
    inside = (s[first - 1] == s[first]) & (s[last + 1] == s[last])
    first, last = first[inside], last[inside]
    if not len(first):
        return hit
    dev = np.minimum.reduceat(np.append(off, np.inf), np.stack([first, last + 1], axis=1).ravel())[::2]
    ok = np.abs(x[last + 1] - x[first - 1]) <= 0.5 * dev
    for a, b in zip(first[ok].tolist(), last[ok].tolist()):
        hit[a : b + 1] = True
    return hit


def _new_group(tab: pa.Table, columns: list[str]) -> np.ndarray:
    """Per row whether it differs from the row before in a column."""
    new = np.zeros(tab.num_rows, bool)
    new[:1] = True
    for c in columns:
        a = tab.column(c).combine_chunks()
        new[1:] |= np.asarray(pc.fill_null(pc.not_equal(a[1:], a[:-1]), True))
    return new


def by_source(work: Callable[[pa.Table], pa.RecordBatch], columns: list[str], rows: int = 120_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work over batches sorted by the columns, each call with whole groups of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < rows:
                continue
            tab = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.flatnonzero(_new_group(tab, columns))[-1])  # the last group may go on
            if cut:
                yield work(tab.slice(0, cut))
            held, n = tab.slice(cut).to_batches(), tab.num_rows - cut
        if n:
            yield work(pa.Table.from_batches(held).combine_chunks())

    return run


def _floats(tab: pa.Table, column: str) -> np.ndarray:
    return np.asarray(tab.column(column).to_numpy(), float)


def in_blocks(rows: DataFrame, keys: list[str], n_blocks: int) -> DataFrame:
    """rows in order of keys, t and rid, in blocks of about equal size numbered in that order, each with OVERLAP rows of either neighbour as copies (core false)."""
    order = [*keys, "t", "rid"]
    ranged = rows.dropDuplicates(order).repartitionByRange(n_blocks, *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "blocks")
    # One row per block: those with too few rows to fill an overlap join the block before.
    whole = ranged.groupBy("part").count().withColumn("block", F.sum((F.col("count") >= OVERLAP).cast("int")).over(Window.orderBy("part")))
    numbered = ranged.join(whole.select("part", "block"), "part").drop("part")
    up, down = Window.partitionBy("block").orderBy(*order), Window.partitionBy("block").orderBy(*[F.desc(c) for c in order])
    placed = numbered.withColumns({"up": F.row_number().over(up), "down": F.row_number().over(down)})
    to = F.array_compact(F.array(F.lit(0), F.when(F.col("up") <= OVERLAP, F.lit(-1)), F.when(F.col("down") <= OVERLAP, F.lit(1))))
    copies = placed.withColumn("to", F.explode(to)).drop("up", "down")
    return copies.select(*[c for c in rows.columns], (F.col("block") + F.col("to")).alias("block"), (F.col("to") == 0).alias("core"))


def source_sums(blocks: DataFrame, keys: list[str], rules: list[SpikeRules]) -> DataFrame:
    """(keys, model): step counts and profile products of each source, summed over its blocks, as entries k -> value of one flat array over all values."""
    flat = [STEP_BINS + r.window**2 for r in rules]
    offset = np.cumsum([0, *flat])
    kinds = {f.name: f.dataType for f in blocks.schema}
    out_kind = ", ".join(f"{k} {kinds[k].simpleString()}" for k in keys) + ", k int, value double"

    def work(tab: pa.Table) -> pa.RecordBatch:
        s = np.cumsum(_new_group(tab, ["block", *keys])) - 1
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        core = tab.column("core").to_numpy()
        who, at, value = [], [], []
        for i, r in enumerate(rules):
            v = _floats(tab, f"v{i}")
            ok = (v >= r.low) & (v <= r.high)
            names, own = np.unique(s[ok], return_inverse=True)
            if not len(names):
                continue
            x, mine = v[ok], core[ok]
            start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            count = np.diff(np.r_[start, len(own)])
            windows, of, begin = _windows(x, start, count, r.window)
            counted = np.zeros(len(of), bool)
            counted[np.arange(len(x)) + of_row(count)] = mine
            sums = np.concatenate([step_counts(x, own, len(names), mine), profile_products(windows, of, len(names), counted).reshape(len(names), -1)], axis=1)
            a, b = np.nonzero(sums)
            who.append(first[names[a]])
            at.append(offset[i] + b)
            value.append(sums[a, b])
        who, at, value = [np.concatenate(x) if x else np.zeros(0) for x in (who, at, value)]
        head = tab.select(keys).take(pa.array(who.astype(np.int64)))
        return pa.RecordBatch.from_arrays([*[c.combine_chunks() for c in head.columns], pa.array(at.astype(np.int32)), pa.array(value.astype(float))], names=[*keys, "k", "value"])

    parts = blocks.repartition("block").sortWithinPartitions("block", *keys, "t", "rid").mapInArrow(by_source(work, ["block", *keys]), out_kind)
    sums = parts.groupBy(*keys, "k").agg(F.sum("value").alias("value"))
    # At most as many entries as the flat array has.
    return sums.groupBy(*keys).agg(F.collect_list(F.struct("k", "value")).alias("model"))


def of_row(count: np.ndarray) -> np.ndarray:
    """Per row the number of its source: each source has one window more than rows."""
    return np.repeat(np.arange(len(count)), count)


def _flag_blocks(blocks: DataFrame, models: DataFrame, keys: list[str], rules: list[SpikeRules]) -> DataFrame:
    """(keys, block, rid, t, field, flags, value, t0, t1, piece): flagged rows (piece null), and per block, source and value its first and last constant stretch (piece 0 and 1) where the source goes on beyond the block."""
    flat = [STEP_BINS + r.window**2 for r in rules]
    offset = np.cumsum([0, *flat])
    kinds = {f.name: f.dataType for f in blocks.schema}
    heads = blocks.select("block", *keys).distinct().join(models, keys)
    nothing = {c: F.lit(None).cast(kinds[c]) for c in blocks.columns if c not in ("block", *keys)}
    rows = blocks.withColumns({"model": F.lit(None).cast(models.schema["model"].dataType), "o": F.lit(1)}).unionByName(heads.withColumns({**nothing, "o": F.lit(0)}))
    out_kind = ", ".join(f"{k} {kinds[k].simpleString()}" for k in keys) + ", block long, rid long, t double, field int, flags int, value double, t0 double, t1 double, piece int"

    def work(tab: pa.Table) -> pa.RecordBatch:
        s = np.cumsum(_new_group(tab, ["block", *keys])) - 1
        n_src = int(s[-1]) + 1
        head = np.asarray(tab.column("o").to_numpy()) == 0
        known = np.zeros((n_src, offset[-1]))
        for at in np.flatnonzero(head).tolist():
            for e in tab.column("model")[at].as_py():
                known[s[at], e["k"]] = e["value"]
        body = tab.filter(pa.array(~head))
        where, s = np.flatnonzero(~head), s[~head]
        t, rid, core = _floats(body, "t"), body.column("rid").to_numpy(), body.column("core").to_numpy().astype(bool)
        got: list[tuple] = []
        for i, r in enumerate(rules):
            v = _floats(body, f"v{i}")
            real = np.flatnonzero(~np.isnan(v))
            if not len(real):
                continue
            sums = known[:, offset[i] : offset[i + 1]]
            w = r.window
            flags = flag_series(s[real], t[real], v[real], r, (sums[:, :STEP_BINS].astype(np.int64), sums[:, STEP_BINS:].reshape(-1, w, w)))
            hit = (flags > 0) & core[real]
            at = real[hit]
            got.append((where[at], rid[at], t[at], np.full(len(at), i), flags[hit], v[at], np.full(len(at), np.nan), np.full(len(at), np.nan), np.full(len(at), -1)))
            # Constant stretches of the block's own rows at its ends, where the source has rows beyond.
            mine = real[core[real]]
            if not len(mine):
                continue
            begin, end = constant_stretches(s[mine], v[mine])
            firsts = np.flatnonzero(np.r_[True, s[mine][begin][1:] != s[mine][begin][:-1]])
            lasts = np.r_[firsts[1:], len(begin)] - 1
            for piece, k in ((0, firsts), (1, lasts[lasts != firsts])):
                a, b = mine[begin[k]], mine[end[k]]
                got.append((where[a], rid[a], t[a], np.full(len(a), i), np.zeros(len(a), int), v[a], t[a], t[b], np.full(len(a), piece)))
        cols = [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0)] * 9
        own = tab.select([*keys, "block"]).take(pa.array(cols[0].astype(np.int64)))
        kinds_ = [pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [*[c.combine_chunks() for c in own.columns[:-1]], own.columns[-1].combine_chunks().cast(pa.int64()), *[pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(cols[1:], kinds_)]],
            names=[*keys, "block", "rid", "t", "field", "flags", "value", "t0", "t1", "piece"],
        )

    return rows.repartition("block").sortWithinPartitions("block", *keys, "o", "t", "rid").mapInArrow(by_source(work, ["block", *keys]), out_kind)


def _large_sources(hot: DataFrame, keys: list[str], rules: list[SpikeRules], n_blocks: int) -> DataFrame:
    """(rid, field, flags) of sources that are cut into blocks."""
    blocks = materialize(in_blocks(hot, keys, n_blocks), "blocks")
    got = materialize(_flag_blocks(blocks, source_sums(blocks, keys, rules), keys, rules), "flags")
    flagged = got.where("piece = -1").select(*keys, "t", "rid", "field", "flags")
    # Stretches that go on from block to block: pieces in order, a new stretch at every change of value and at a block's last piece.
    order = Window.partitionBy(*keys, "field").orderBy("block", "piece")
    pieces = got.where("piece >= 0")
    goes_on = (F.col("piece") == 0) & (F.lag("value").over(order) == F.col("value"))
    joined = pieces.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("stretch", F.sum("new").over(order))
    least = F.element_at(F.array(*[F.lit(float(r.stuck_s)) for r in rules]), F.col("field") + 1)
    long = joined.groupBy(*keys, "field", "stretch").agg(F.min("t0").alias("a"), F.max("t1").alias("z"), F.count("*").alias("n")).where((F.col("z") - F.col("a") >= least - 1e-9) & (F.col("n") > 1))
    parts = joined.join(long.select(*keys, "field", "stretch"), [*keys, "field", "stretch"]).select(*keys, "block", "field", "value", "t0", "t1")
    value = F.element_at(F.array(*[F.col(f"v{i}") for i in range(len(rules))]), F.col("field") + 1)
    stuck = blocks.where("core").join(parts, [*keys, "block"]).where(F.col("t").between(F.col("t0"), F.col("t1")) & (value == F.col("value")))
    stuck = stuck.select(*keys, "t", "rid", "field", F.lit(STUCK).alias("flags"))
    return flagged.unionByName(stuck).groupBy(*keys, "t", "rid", "field").agg(F.bit_or("flags").alias("flags")).select("rid", "field", "flags")


def flag_readings(df: DataFrame, source: list[str], t: str, row_id: str, values: dict[str, SpikeRules], max_rows: int = 100_000) -> DataFrame:
    """(row_id, field, impossible, stuck, spike): one row per flagged reading and value column.

    Rows with null source, t or row_id, or NaN t, do not count; of a value
    column its null or NaN rows do not count. Ties in t go by row_id; rows
    repeated with the same row_id count once; an empty table gives an empty
    result; other columns are ignored, whatever their names. A source of more
    than max_rows rows is cut into blocks of about that many rows, which changes
    no result: all blocks are judged by the sums over the whole source.
    """
    fields, rules = list(values), list(values.values())
    keys, vs = [f"s{i}" for i in range(len(source))], [f"v{i}" for i in range(len(values))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(source, keys)], F.col(t).cast("double").alias("t"), F.col(row_id).cast("long").alias("rid"),
        *[F.col(f).cast("double").alias(v) for f, v in zip(fields, vs)],
    ).where(" AND ".join([f"{k} IS NOT NULL" for k in keys] + ["t IS NOT NULL", "NOT isnan(t)", "rid IS NOT NULL"]))
    out = pa.schema([("rid", pa.int64()), ("field", pa.int32()), ("flags", pa.int32())])

    def work(tab: pa.Table) -> pa.RecordBatch:
        new = _new_group(tab, keys)
        t_, rid = _floats(tab, "t"), tab.column("rid").to_numpy()
        once = new | np.r_[True, (t_[1:] != t_[:-1]) | (rid[1:] != rid[:-1])]
        src, t_, rid = np.cumsum(new)[once], t_[once], rid[once]
        got: list[tuple] = []
        for i, r in enumerate(rules):
            v = _floats(tab, vs[i])[once]
            real = ~np.isnan(v)
            flags = flag_series(src[real], t_[real], v[real], r)
            hit = flags > 0
            got.append((rid[real][hit], np.full(hit.sum(), i, np.int32), flags[hit]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*got)], schema=out)

    # Sources too large for one task: usually none.
    counted = rows.groupBy(*keys).count().where(F.col("count") > max_rows)
    n_hot = counted.agg(F.sum("count")).first()[0]
    if n_hot:
        names = F.broadcast(counted.select(*keys)) if fits_broadcast(counted) else counted.select(*keys)
        large = _large_sources(rows.join(names, keys), keys, rules, -(-n_hot // max_rows))
        rows = rows.join(names, keys, "left_anti")
    flagged = rows.repartition(*keys).sortWithinPartitions(*keys, "t", "rid").mapInArrow(by_source(work, keys), "rid long, field int, flags int")
    if n_hot:
        flagged = flagged.unionByName(large)
    names = F.array(*[F.lit(f) for f in fields])
    return flagged.select(
        F.col("rid").alias(row_id), F.element_at(names, F.col("field") + 1).alias("field"),
        (F.col("flags").bitwiseAND(IMPOSSIBLE) > 0).alias("impossible"), (F.col("flags").bitwiseAND(STUCK) > 0).alias("stuck"), (F.col("flags").bitwiseAND(SPIKE) > 0).alias("spike"),
    )
