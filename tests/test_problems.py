"""Spikes, orphan references and the regular grid, against brute force and on odd input."""

import datetime as dt
import random

import numpy as np
import pytest

from arenaflow.operators import orphans, regrid, spikes

TRACK = "row_id long, match_id long, slot string, t double, x_in double, y_in double, v0 int, src string, rid string"


def walk(match, n, seed, t0=0.0):
    rng = random.Random(seed)
    x, y, rows = 70.0, 70.0, []
    for k in range(n):
        x, y = min(140, max(0, x + rng.uniform(-2, 2))), min(140, max(0, y + rng.uniform(-2, 2)))
        rows.append([match * 10_000 + k, match, "red1", t0 + k * 0.2, x, y, 1, "s", "r"])
    return rows


@pytest.mark.parametrize("max_rows", [100_000, 90])
def test_planted_readings(spark, max_rows):
    rows = walk(1, 300, 1) + walk(2, 300, 2)
    want = set()
    for at, length, field in ((50, 1, 4), (120, 2, 5), (200, 3, 4)):
        for k in range(at, at + length):
            rows[k][field] += 60 if rows[k][field] < 70 else -60
            want.add((rows[k][0], "x_in" if field == 4 else "y_in", "spike"))
    rows[10][4] = 999.0
    want.add((rows[10][0], "x_in", "impossible"))
    for k in range(400, 420):
        rows[k][5] = rows[400][5]
        want.add((rows[k][0], "y_in", "stuck"))
    for k in range(500, 600):  # moves away and stays
        rows[k][4] = (rows[k][4] + 40) % 140
    rows += [rows[50], rows[120]]  # redelivered
    rows += [[1, None, "red1", 1.0, 1.0, 1.0, 1, "", ""], [2, 1, None, 1.0, 1.0, 1.0, 1, "", ""], [3, 1, "red1", None, 1.0, 1.0, 1, "", ""], [4, 1, "red1", float("nan"), 1.0, 1.0, 1, "", ""], [5, 1, "red1", 2.01, None, None, 1, "", ""]]
    df = spark.createDataFrame(rows, TRACK)
    got = spikes.flag_readings(df, ["match_id", "slot"], "t", "row_id", {"x_in": spikes.TRACKS, "y_in": spikes.TRACKS}, max_rows=max_rows).collect()
    assert {(r["row_id"], r["field"], k) for r in got for k in ("impossible", "stuck", "spike") if r[k]} == want


@pytest.mark.parametrize("max_rows", [100_000, 1_000])
def test_parked_block_is_judged_by_the_whole_source(spark, max_rows):
    """In the second third the robot is parked, and its only steps are those of the spikes."""
    rows = walk(1, 3000, 5)
    want = set()
    for k in range(1000, 2000):
        rows[k][4] = rows[1000][4] if k > 1000 else 70.0
        if k % 9 == 0 and 1050 < k < 1950:
            rows[k][4] += 60.0
            want.add(rows[k][0])
    got = spikes.flag_readings(spark.createDataFrame(rows, TRACK), ["match_id", "slot"], "t", "row_id", {"x_in": spikes.TRACKS}, max_rows=max_rows).where("spike").collect()
    assert {r["row_id"] for r in got if 1050 < r["row_id"] - 10_000 < 1950} == want


def test_cut_into_blocks_changes_nothing(spark):
    """Sources of very different sizes, one of them frozen over several blocks, one with all rows at one time."""
    rows = walk(1, 900, 11) + walk(2, 150, 12) + walk(3, 40, 13)
    rng = random.Random(14)
    for r in rows[::37]:
        r[4] += rng.choice((-70, 70, 300))
    for r in rows[300:560]:
        r[5] = 12.5
    rows += [[90_000 + k, 4, "red1", 7.0, float(k % 7), 50.0, 1, "", ""] for k in range(200)] + rows[40:60]
    df = spark.createDataFrame(rows, TRACK)
    args = df, ["match_id", "slot"], "t", "row_id", {"x_in": spikes.TRACKS, "y_in": spikes.TRACKS}
    whole = sorted(tuple(r) for r in spikes.flag_readings(*args).collect())
    assert len(whole) > 260
    for most in (50, 130, 400):
        assert sorted(tuple(r) for r in spikes.flag_readings(*args, max_rows=most).collect()) == whole


def test_blocks_are_of_equal_size_and_numbered_without_gaps(spark):
    rows = spark.createDataFrame([(s, k * 0.2, k) for s, n in ((1, 101), (2, 3000)) for k in range(n)], "s0 long, t double, rid long")
    n = {r["block"]: r["count"] for r in spikes.in_blocks(rows, ["s0"], 31).where("core").groupBy("block").count().collect()}
    assert sum(n.values()) == 3101 and max(n.values()) <= 250 and sorted(n) == list(range(min(n), min(n) + len(n)))


def test_sparse_part_decides(spark, monkeypatch):
    """Spikes are the rows that the low-rank course does not hold: without that course none of this comes out."""
    rows = walk(1, 400, 21)
    want = set()
    for k in range(30, 380, 50):
        rows[k][4] += 60 if rows[k][4] < 70 else -60
        want.add(rows[k][0])
    df = spark.createDataFrame(rows, TRACK)

    def found():
        got = spikes.flag_readings(df, ["match_id", "slot"], "t", "row_id", {"x_in": spikes.TRACKS}).where("spike").collect()
        return {r["row_id"] for r in got}

    assert found() == want
    x, one, n = np.array([r[4] for r in rows]), np.array([0]), np.array([400])
    unit = spikes.usual_step(spikes.step_counts(x, np.zeros(400, int), 1))
    flags = lambda: (spikes.flag_series(np.zeros(400, int), np.arange(400) * 0.2, x, spikes.TRACKS) & spikes.SPIKE).nonzero()[0]
    assert np.abs(np.delete(x - spikes.low_rank(x, one, n, unit, spikes.TRACKS), np.arange(30, 380, 50))).max() < 3.5 * unit[0]
    assert {rows[k][0] for k in flags()} == want
    monkeypatch.setattr(spikes, "low_rank", lambda v, *a: np.full(len(v), v.mean()))
    assert {rows[k][0] for k in flags()} != want


def test_no_readings(spark):
    df = spark.createDataFrame([], TRACK)
    assert spikes.flag_readings(df, ["match_id"], "t", "row_id", {"x_in": spikes.TRACKS}).count() == 0
    one = spark.createDataFrame([[1, 1, "red1", 0.0, 5.0, 5.0, 1, "", ""]], TRACK)
    assert spikes.flag_readings(one, ["match_id"], "t", "row_id", {"x_in": spikes.TRACKS}).count() == 0


def test_low_rank_part_ignores_spikes():
    x = np.sin(np.arange(200) / 15) * 30 + 70
    y = x.copy()
    y[[50, 51, 120]] += 80
    course = spikes.low_rank(y, np.array([0]), np.array([200]), np.array([2.0]), spikes.TRACKS)
    assert np.abs(course - x)[10:190].max() < 6


DAY = dt.datetime(2026, 1, 5)
LATER = dt.datetime(2026, 3, 5)


def test_orphans(spark):
    videos = [("a", None, DAY, None), ("a", " b ", LATER, None), ("late", None, LATER, None), ("gone", None, DAY, None), ("gone", "\tzz", LATER, LATER), ("", "", DAY, None)]
    matches = [(1, "a", 7), (2, " gone\t", 8), (3, "late", 9), (4, "nope", None), (5, "  ", 7), (6, None, 7), (6, None, 7)]
    v = spark.createDataFrame(videos, "id string, source_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz")
    m = spark.createDataFrame([(*x, DAY) for x in matches], "id long, video_id string, event_id long, loaded_at timestamp_ntz")
    t = spark.createDataFrame([(7, DAY, None), (8, DAY, LATER)], "id long, loaded_at timestamp_ntz, deleted_at timestamp_ntz")
    got = {tuple(r) for r in orphans.league_orphans(m, v, t).select("ref_field", "row_key", "state", "period").collect()}
    assert got == {
        ("matches.video_id", "2", "deleted", "2026-01"), ("matches.video_id", "3", "late", "2026-01"), ("matches.video_id", "4", "missing", "2026-01"),
        ("videos.source_id", "a", "missing", "2026-03"), ("videos.source_id", "gone", "missing", "2026-03"),
        ("matches.event_id", "2", "deleted", "2026-01"), ("matches.event_id", "3", "missing", "2026-01"),
    }
    assert orphans.league_orphans(m.limit(0), v.limit(0), t).count() == 0
    assert orphans.league_orphans(m.limit(4), v.limit(0), t.limit(0)).where("state <> 'missing'").count() == 0


def test_heavy_key_goes_by_broadcast(spark):
    n = 12_000
    m = spark.range(n).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id)) AS video_id", "timestamp_ntz'2026-01-05 00:00:00' AS loaded_at")
    refs = orphans.references(m, "f", "id", "video_id").unionByName(orphans.references(m.selectExpr("id + 100000 AS id", "'hot2' AS video_id", "loaded_at"), "f", "id", "video_id"))
    known = orphans.targets(spark.createDataFrame([("hot", DAY, None), ("k1", LATER, None)], "id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"), ["f"])
    got = orphans.orphans(refs, known)
    assert got.count() == n * 2 - n // 3 and got.where("state = 'late'").count() == 1


@pytest.mark.parametrize("heavy", [5_000, 1])
def test_orphan_report_counts_what_orphans_lists(spark, monkeypatch, heavy):
    """Hot keys checked by broadcast or not, targets that arrive in the middle of a period, null times and nulls in any column."""
    monkeypatch.setattr(orphans, "HEAVY_KEYS", heavy)
    rng = random.Random(heavy)
    at = lambda: rng.choice((DAY, DAY + dt.timedelta(days=9), LATER, None))
    rows = [(k, "hot" if k % 3 == 0 else rng.choice((None, " ", f"k{rng.randrange(30)}")), at()) for k in range(33_000 if heavy > 1 else 600)]
    refs = orphans.references(spark.createDataFrame(rows, "id long, video_id string, loaded_at timestamp_ntz"), "f", "id", "video_id")
    ids = [(f"k{k}", rng.choice((DAY, DAY + dt.timedelta(days=5), LATER, None)), rng.choice((None, None, DAY))) for k in range(0, 30, 2)] + [("hot", DAY + dt.timedelta(days=5), None), (None, DAY, None)]
    known = orphans.targets(spark.createDataFrame(ids, "id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"), ["f"])
    found = orphans.orphans(refs, known).toPandas()
    found["period"] = found["loaded_at"].dt.strftime("%Y-%m")
    want = {k if k[0] == k[0] else (None, k[1]): n for k, n in found.groupby(["period", "state"], dropna=False).size().items()}
    got = {(r["period"], r["state"]): r["n_refs"] for r in orphans.orphan_report(refs, known).collect()}
    assert got == {(None if p != p else p, s): n for (p, s), n in want.items()} and len(got) >= 5
    assert orphans.orphan_report(refs.limit(0), known).count() == 0


SCORE = "row_id long, match_id long, t double, red_score int, blue_score int, src string, bin int"


def test_grid_marks_and_fills(spark):
    rows = [(k, 1, float(k) + 0.3, 2 * k, None, "", 0) for k in range(0, 120) if not 40 <= k < 50]
    rows += [rows[3], (500, 1, 130.0, 9, 9, "", 0), (501, 1, None, 9, 9, "", 0), (502, None, 1.0, 9, 9, "", 0), (503, 2, 5.0, None, None, "", 0), (504, 3, 5.0, 7, None, "", 0), (505, 1, 60.1, 900, None, "", 0)]
    g = regrid.regular_grid(spark.createDataFrame(rows, SCORE), "match_id", "t", "row_id", ["red_score", "blue_score"], 120).toPandas()
    assert sorted(g.match_id.unique()) == [1, 3] and len(g) == 240
    one = g[g.match_id == 1].set_index("grid_s")
    assert one[one.missing].index.tolist() == list(range(40, 50)) and one.n_readings[3] == 1 and one.n_readings[60] == 2
    truth = 2 * (np.arange(120) + 0.2)
    assert np.abs(one.red_score - truth).max() < 1.5 and one.blue_score.isna().all()
    assert one.red_score_sd[45] > one.red_score_sd[20]
    assert regrid.regular_grid(spark.createDataFrame([], SCORE), "match_id", "t", "row_id", ["red_score"], 120).count() == 0


def dense(t, y, q, weight):
    """Mean and variance of the level at t under the model, by its covariances, for reading noise 1."""
    seen = np.flatnonzero(~np.isnan(y))
    s, d = np.minimum.outer(t - t[0], t - t[0]), np.abs(np.subtract.outer(t, t))
    cov = 1e6 + 1e2 * np.multiply.outer(t - t[0], t - t[0]) + q * (s**3 / 3 + d * s**2 / 2)
    gain = cov[:, seen] @ np.linalg.inv(cov[np.ix_(seen, seen)] + np.diag(1 / weight[seen]))
    return y[seen[0]] + gain @ (y[seen] - y[seen[0]]), np.diag(cov - gain @ cov[seen])


@pytest.mark.parametrize("q", [1e-3, 0.1, 1.0])
def test_smoother_equals_dense_solution(q):
    """Level and deviation at every step are those of the Gaussian that the model defines."""
    rng = np.random.default_rng(1)
    t = np.sort(rng.uniform(0, 20, (6, 15)), axis=1)
    y, w = np.full((6, 15), np.nan), rng.integers(1, 4, (6, 15)).astype(float)
    for k in range(6):
        seen = rng.permutation(15)[: 5 + k]
        y[k, seen] = rng.normal(size=5 + k) * 10
    level, sd = regrid.smooth(t, y, w, (q,))
    var = regrid._filter(t, y, w, np.full(6, q))[3]
    for k in range(6):
        mean, spread = dense(t[k], y[k], q, w[k])
        # The dense form takes the variance as a difference of numbers near 1e6.
        assert np.abs(level[k] - mean).max() < 1e-3 and np.allclose(sd[k], np.sqrt(spread * var[k]), rtol=0.02)


def test_deviation_covers_the_truth():
    """Of series drawn from the model about 95 of 100 true levels lie within two deviations."""
    rng = np.random.default_rng(2)
    t = np.sort(rng.uniform(0, 60, (200, 60)), axis=1)
    y, truth = np.full(t.shape, np.nan), np.zeros(t.shape)
    for k in range(200):
        level, slope = 50.0, rng.normal()
        for j in range(60):
            h = t[k, j] - t[k, j - 1] if j else 0.0
            a, b = np.linalg.cholesky(0.1 * np.array([[h**3 / 3, h**2 / 2], [h**2 / 2, h]]) + 1e-12 * np.eye(2)) @ rng.normal(size=2)
            level, slope = level + h * slope + a, slope + b
            truth[k, j] = level
        seen = rng.permutation(60)[:40]
        y[k, seen] = truth[k, seen] + rng.normal(size=40)
    level, sd = regrid.smooth(t, y, np.ones(t.shape))
    assert 0.9 < (np.abs(level - truth) <= 2 * sd).mean() < 0.98


def test_far_readings_are_left_out():
    y = np.full((3, 30), np.nan)
    y[0, ::2] = np.arange(15)
    y[0, 10] = 300
    y[1, :4] = (1, 2, 500, 3)
    out = regrid.without_outliers(y)
    assert np.isnan(out[0, 10]) and np.nansum(out[0]) == 105 - 5 and np.nansum(out[1]) == 506 and np.isnan(out[2]).all()


def test_every_reading_is_a_step(spark):
    """Two readings of one quarter of a second, at its ends, are not averaged; a long source beside short ones changes nothing."""
    rows = [(k, 1, 10.01 + 0.24 * (k % 2) + k // 2, 10 * k, 0, "", 0) for k in range(20)]
    long = [(1000 + k, 2, (k * 0.013) % 119.9, k % 50, 0, "", 0) for k in range(6000)]
    grid = lambda r: regrid.regular_grid(spark.createDataFrame(r, SCORE), "match_id", "t", "row_id", ["red_score"], 120).where("match_id = 1").orderBy("grid_s").toPandas()
    one, both = grid(rows), grid(rows + long)
    assert np.allclose(one.red_score, both.red_score) and one.n_readings.sum() == 20
    t = np.sort(np.r_[[r[2] for r in rows], np.arange(120) + 0.5])
    y = np.array([dict((r[2], r[3]) for r in rows).get(x, np.nan) for x in t])
    level = regrid.smooth(t[None], y[None], np.ones((1, len(t))))[0][0]
    assert np.allclose(level[np.isin(t, np.arange(120) + 0.5)], one.red_score, atol=1e-6)
