"""Problem 6: irregular readings onto a regular grid.

The smoother is a Kalman filter with a backward pass over a local trend in
continuous time (an integrated Wiener process): exact for any spacing. Every
reading is a step of its own; only readings within `resolution_s` of each other
are one step, of their mean and with the weight of their number, which bounds
the steps of a source by the length of the grid. Many sources, values and noise
ratios go through each step of the recursion at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Candidate ratios of trend noise (per second cubed) to reading noise; each series takes the likeliest.
NOISE_RATIOS = tuple(10.0 ** (k / 2) for k in range(-8, 1))
#: Scores are whole numbers: their rounding alone has a variance of 1/12.
LEAST_VARIANCE = 1 / 12


def _predict(m0, m1, a, b, c, dt, q):
    """State and covariance [[a, b], [b, c]] after dt seconds."""
    return m0 + dt * m1, m1, a + dt * (2 * b + dt * (c + q * dt / 3)), b + dt * (c + q * dt / 2), c + q * dt


def _filter(times, obs, weight, ratio, keep: bool = True):
    """Forward pass over (series, step) arrays; obs NaN where a step has no reading. Returns per step the filtered and the predicted states (m0, m1, a, b, c), if kept, and per series the log likelihood with the reading noise concentrated out, and that noise."""
    n, k = times.shape
    seen = ~np.isnan(obs)
    first = np.argmax(seen, axis=1)
    state = (np.nan_to_num(obs[np.arange(n), first]), np.zeros(n), np.full(n, 1e6), np.zeros(n), np.full(n, 1e2))
    after, before = (np.empty((k, 5, n)), np.empty((k, 5, n))) if keep else (None, None)
    sum_sq, sum_log, count = np.zeros(n), np.zeros(n), np.zeros(n)
    for j in range(k):
        dt = times[:, j] - times[:, j - 1] if j else np.zeros(n)
        m0, m1, a, b, c = _predict(*state, dt, ratio)
        if keep:
            before[j] = m0, m1, a, b, c
        s = a + 1.0 / weight[:, j]
        e = np.where(seen[:, j], obs[:, j] - m0, 0.0)
        g = np.where(seen[:, j], 1.0 / s, 0.0)
        state = (m0 + a * g * e, m1 + b * g * e, a - a * a * g, b - a * b * g, c - b * b * g)
        if keep:
            after[j] = state
        scored = seen[:, j] & (count >= 2)  # the first two fix the unknown start
        sum_sq += np.where(scored, e * e * g, 0)
        sum_log += np.where(scored, np.log(s), 0)
        count += seen[:, j]
    dof = np.maximum(count - 2, 1)
    var = np.maximum(sum_sq / dof, LEAST_VARIANCE)
    return after, before, -0.5 * (dof * np.log(var) + sum_log + sum_sq / var), var


def smooth(times: np.ndarray, obs: np.ndarray, weight: np.ndarray, ratios: tuple[float, ...] = NOISE_RATIOS) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed level and its standard deviation at every step; times ascend along axis 1; series without a reading give NaN."""
    n, k = times.shape
    m = len(ratios)
    many = [np.repeat(x, m, axis=0) for x in (times, obs, weight)]
    ll = _filter(*many, np.tile(ratios, n), keep=False)[2].reshape(n, m)
    ratio = np.array(ratios)[ll.argmax(axis=1)]
    after, before, _, var = _filter(times, obs, weight, ratio)
    level, spread = np.empty((n, k)), np.empty((n, k))
    m0, m1, a, b, c = after[-1]
    level[:, -1], spread[:, -1] = m0, a
    for j in range(k - 2, -1, -1):
        dt = times[:, j + 1] - times[:, j]
        f0, f1, fa, fb, fc = after[j]
        p0, p1, pa_, pb, pc = before[j + 1]
        det = pa_ * pc - pb * pb
        still = (dt <= 0) | (det <= 0)  # two steps at one time share their state
        det = np.where(still, 1.0, det)
        # Gain: filtered covariance times the transition's transpose times the inverse of the predicted covariance.
        x0, x1, y0, y1 = fa + dt * fb, fb, fb + dt * fc, fc
        g00, g01 = (x0 * pc - x1 * pb) / det, (x1 * pa_ - x0 * pb) / det
        g10, g11 = (y0 * pc - y1 * pb) / det, (y1 * pa_ - y0 * pb) / det
        d0, d1, da, db, dc = m0 - p0, m1 - p1, a - pa_, b - pb, c - pc
        new = (
            f0 + g00 * d0 + g01 * d1, f1 + g10 * d0 + g11 * d1, fa + g00 * (g00 * da + g01 * db) + g01 * (g00 * db + g01 * dc),
            fb + g10 * (g00 * da + g01 * db) + g11 * (g00 * db + g01 * dc), fc + g10 * (g10 * da + g11 * db) + g11 * (g10 * db + g11 * dc),
        )
        m0, m1, a, b, c = (np.where(still, old, x) for old, x in zip((m0, m1, a, b, c), new))
        level[:, j], spread[:, j] = m0, a
    none = np.isnan(obs).all(axis=1)
    level[none], spread[none] = np.nan, np.nan
    return level, np.sqrt(np.maximum(spread, 0) * var[:, None])


def without_outliers(obs: np.ndarray, least: float = 15.0) -> np.ndarray:
    """obs with NaN where a reading is far from the median of its five neighbours in time, by `least` and by six times the series' usual such distance. Series of fewer than five readings stay as they are."""
    seen = ~np.isnan(obs)
    n = seen.sum(axis=1)
    width = max(int(n.max(initial=0)), 1)
    # The readings of each series close together, its last one repeated.
    order = np.argsort(~seen, axis=1, kind="stable")[:, :width]
    v = np.take_along_axis(obs, order, axis=1)
    place = np.arange(-2, width + 2)[None, :].clip(0, np.maximum(n - 1, 0)[:, None])
    near = np.lib.stride_tricks.sliding_window_view(np.take_along_axis(v, place, axis=1), 5, axis=1)
    real = np.arange(width) < n[:, None]
    off = np.where(real, np.abs(v - np.median(near, axis=2)), 0.0)
    far = real & (off > np.maximum(least, 6 * off.sum(axis=1) / np.maximum(n, 1))[:, None]) & (n >= 5)[:, None]
    out = obs.copy()
    r, c = np.nonzero(far)
    out[r, order[r, c]] = np.nan
    return out


def regular_grid(
    df: DataFrame, source: str, t: str, row_id: str, values: list[str], grid_end: int, resolution_s: float = 0.001, at: float = 0.5, outlier: float = 15.0,
) -> DataFrame:
    """One row per source and second 0..grid_end-1: source, grid_s, n_readings, missing, and per value <v> and <v>_sd.

    A reading counts if 0 <= t < grid_end and at least one value is not null
    (NaN counts as null); sources without one give no rows. missing marks the
    seconds s without a reading in s <= t < s + 1; n_readings counts row ids.
    <v> is the smoothed level at s + `at` and <v>_sd its standard deviation;
    both are null if the source never has the value. Readings far off their
    neighbours (by `outlier` at least) count as readings but do not pull the
    level. Readings within one step of resolution_s are averaged, so that a
    source has at most grid_end / resolution_s steps, however many its readings.
    Rows with null source, t or row_id do not count, rows repeated with the same
    row_id count once, an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    src_type = dict(df.dtypes)[source]
    plain = {"tinyint", "smallint", "int", "bigint"}
    rows = df.select(
        F.col(source).cast("long" if src_type in plain else "string").alias("src"), F.col(t).cast("double").alias("t"), F.col(row_id).alias("rid"),
        *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)],
    )
    rows = rows.select("src", "t", "rid", *[F.when(~F.isnan(f"v{i}"), F.col(f"v{i}")).alias(f"v{i}") for i in range(len(values))])
    some = F.coalesce(*[F.col(f"v{i}") for i in range(len(values))]).isNotNull()
    rows = rows.where(F.col("src").isNotNull() & F.col("rid").isNotNull() & (F.col("t") >= 0) & (F.col("t") < grid_end) & some)
    # The second is part of the step, so that none spans two; steps of a second are numbered by the resolution.
    second = F.floor("t").cast("int")
    steps = (
        rows.withColumns({"second": second, "step": F.floor((F.col("t") - second) / resolution_s + 1e-6).cast("int")})
        # Redelivered copies first; both aggregations combine before they shuffle, so a hot source is bounded by its steps.
        .groupBy("src", "second", "step", "rid").agg(F.min("t").alias("t"), *[F.max(f"v{i}").alias(f"v{i}") for i in range(len(values))])
        .groupBy("src", "second", "step").agg(
            F.count("*").alias("n"), F.avg("t").alias("t"), *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(values))], *[F.avg(f"v{i}").alias(f"v{i}") for i in range(len(values))]
        )
        .repartition("src").sortWithinPartitions("src", "second", "step")
    )
    nv = len(values)
    kind = f"src {'long' if src_type in plain else 'string'}, grid_s long, n long, " + ", ".join(f"v{i} double, sd{i} double" for i in range(nv))
    schema = pa.schema([("src", pa.int64() if src_type in plain else pa.string()), ("grid_s", pa.int64()), ("n", pa.int64())] + [x for i in range(nv) for x in ((f"v{i}", pa.float64()), (f"sd{i}", pa.float64()))])

    def fill(tab: pa.Table) -> Iterator[pa.RecordBatch]:
        names = tab.column("src").combine_chunks().dictionary_encode()
        code = names.indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(code)
        # Series of about equal length together, so that one long source does not widen all others.
        size = np.ceil(np.log2(np.maximum(counts, 64))).astype(int)
        for k in np.unique(size):
            chosen = np.flatnonzero(size == k)
            most = max(1, 400_000 // (1 << int(k)))
            for part in np.array_split(chosen, -(-len(chosen) // most)):
                mine = np.isin(code, part)
                yield one_size(names.dictionary.take(pa.array(part)), np.searchsorted(part, code[mine]), tab.filter(pa.array(mine)))

    def one_size(names: pa.Array, code: np.ndarray, tab: pa.Table) -> pa.RecordBatch:
        n_src = len(names)
        start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        pos = np.arange(len(code)) - np.repeat(start, np.diff(np.r_[start, len(code)]))
        width = int(pos.max()) + 1
        times = np.full((n_src, width + grid_end), np.inf)
        times[code, pos] = tab.column("t").to_numpy()
        times[:, width:] = np.arange(grid_end) + at
        order = np.argsort(times, axis=1, kind="stable")
        times = np.take_along_axis(times, order, axis=1)
        # Padding comes last and repeats the last time, with no reading.
        times = np.minimum(times, np.where(np.isinf(times), -np.inf, times).max(axis=1)[:, None])
        back = np.argsort(order, axis=1)[:, width:]
        obs, weight = np.full((nv, n_src, width + grid_end), np.nan), np.ones((nv, n_src, width + grid_end))
        for i in range(nv):
            obs[i][code, pos] = np.asarray(tab.column(f"v{i}").to_pandas(), float)
            weight[i][code, pos] = np.maximum(tab.column(f"n{i}").to_numpy(), 1)
            obs[i], weight[i] = without_outliers(np.take_along_axis(obs[i], order, axis=1), outlier), np.take_along_axis(weight[i], order, axis=1)
        # All values through the recursion at once.
        level, sd = (x.reshape(nv, n_src, -1) for x in smooth(np.tile(times, (nv, 1)), obs.reshape(nv * n_src, -1), weight.reshape(nv * n_src, -1)))
        out = [np.take_along_axis(x[i], back, axis=1).ravel() for i in range(nv) for x in (level, sd)]
        n = np.bincount(code * grid_end + tab.column("second").to_numpy(), weights=tab.column("n").to_numpy(), minlength=n_src * grid_end)
        cols = [names.take(pa.array(np.repeat(np.arange(n_src), grid_end))), np.tile(np.arange(grid_end), n_src), n.astype(np.int64), *out]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, from_pandas=True) for c in cols], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n < 30_000:
                continue
            tab = pa.Table.from_batches(held).combine_chunks()
            src = tab.column("src").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cut = int(np.argmax(src == src[-1]))
            if cut:
                yield from fill(tab.slice(0, cut))
            held = tab.slice(cut).combine_chunks().to_batches()
            n = tab.num_rows - cut
        if n:
            yield from fill(pa.Table.from_batches(held).combine_chunks())

    return steps.mapInArrow(work, kind).select(
        F.col("src").cast(src_type).alias(source), "grid_s", F.col("n").alias("n_readings"), (F.col("n") == 0).alias("missing"),
        *[c for i, v in enumerate(values) for c in (F.col(f"v{i}").alias(v), F.col(f"sd{i}").alias(f"{v}_sd"))],
    )
