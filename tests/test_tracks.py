import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.functions import geometry as geo
from arenaflow.game import PUSHBACK, load
from arenaflow.operators import calibration, clusters, features, insights, store, tracking


def reference_resample(samples, t_end, hz=5, gap=3.0):
    ts = np.array([s[0] for s in samples])
    out = []
    for t in np.arange(math.ceil(t_end * hz)) / hz:
        i = int((ts < t).sum())
        if i == 0 or i == len(ts):
            s = samples[0 if i == 0 else -1]
            out.append((s[1], s[2], 0.0))
            continue
        a, b = samples[i - 1], samples[i]
        if b[0] - a[0] > gap:
            out.append((a[1], a[2], 0.0))
        else:
            f = (t - a[0]) / max(b[0] - a[0], 1e-6)
            out.append((a[1] + f * (b[1] - a[1]), a[2] + f * (b[2] - a[2]), min(a[3], b[3])))
    xs, ys = (np.convolve([o[k] for o in out], np.ones(3) / 3, mode="same") for k in (0, 1))
    return xs, ys, [o[2] for o in out]


@pytest.mark.parametrize("t_end", [4.0, 0.4, 0.2])
def test_resample(spark, t_end):
    rng = random.Random(1)
    samples = sorted((round(rng.uniform(0, 9), 3), rng.uniform(0, 140), rng.uniform(0, 140), rng.random()) for _ in range(9))
    df = spark.createDataFrame([(1, *s) for s in samples], "m long, t double, x double, y double, conf double")
    got = tracking.resample(df, ["m"], t_end).orderBy("i").toPandas()
    xs, ys, conf = reference_resample(samples, t_end)
    n = math.ceil(t_end * 5)
    assert len(got) == n
    np.testing.assert_allclose(got["x"], xs[:n], atol=1e-9)
    np.testing.assert_allclose(got["y"], ys[:n], atol=1e-9)
    np.testing.assert_allclose(got["conf"], conf[:n])


def test_throttle(spark):
    ts = [0.0, 0.4, 0.9999, 1.0, 1.5, 2.1, 2.9, 3.3]
    got = tracking.throttle(spark.createDataFrame([(1, t) for t in ts] + [(2, None)], "m long, t double"), ["m"])
    assert sorted(r["t"] for r in got.collect()) == [0.0, 1.0, 2.1, 3.3]


def test_slots_hand_off(spark):
    rows = []
    for k in range(20):
        tid = 7 if k < 16 else 9
        rows.append((1, k * 0.2, 0, "robot_red", tid, 10.0 + k, 88.0, 0.9))
        rows.append((1, k * 0.2, 1, "robot_blue", 8, 130.0, 88.0, 0.9))
        rows.append((1, k * 0.2, 2, "robot_red", None, 20.0, 20.0, 0.9))
    got = tracking.slot_tracks(spark.createDataFrame(rows, "match_id long, t double, pos int, cls string, track_id long, x double, y double, conf double")).toPandas()
    assert got[got.slot == "red1"].shape[0] == 20 and got[got.slot == "blue1"].shape[0] == 20 and set(got.switches) == {1}
    assert set(got.slot) == {"red1", "blue1"}


def crosses(poly, x, y):
    hit = False
    for (x0, y0), (x1, y1) in zip(poly, poly[1:] + poly[:1]):
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            hit = not hit
    return hit


def test_points_in_zones(spark):
    rng = random.Random(2)
    pts = [(rng.uniform(-6, 146), rng.uniform(-6, 146)) for _ in range(2000)] + [(4.0, 0.0), (30.0, 5.0), (70.2, 70.2), (0.0, 60.77)]
    df = spark.createDataFrame(pts, "x double, y double")
    got = df.select(geo.zone_at(PUSHBACK, F.col("x"), F.col("y"))).collect()
    want = [next((z.name for z in PUSHBACK.zones if crosses(list(z.polygon), x, y)), None) for x, y in pts]
    assert [r[0] for r in got] == want
    assert df.select(geo.zone_at(load("override"), F.col("x"), F.col("y"))).distinct().collect()[0][0] is None


def test_homography_fit_and_inverse(spark):
    px = np.array([[100, 600], [1180, 600], [900, 150], [380, 150]], float)
    fld = np.array([[0, 0], [140.4, 0], [140.4, 140.4], [0, 140.4]])
    h = geo.fit(px, fld)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in px], "x double, y double").withColumn("h", F.array(*[F.lit(float(v)) for v in h]))
    gx, gy = geo.project(F.col("h"), F.col("x"), F.col("y"))
    df = df.withColumns({"gx": gx, "gy": gy})
    bx, by = geo.project(geo.inverse(F.col("h")), F.col("gx"), F.col("gy"))
    got = df.select("gx", "gy", bx.alias("bx"), by.alias("by")).toPandas().to_numpy()
    np.testing.assert_allclose(got[:, :2], fld, atol=1e-6)
    np.testing.assert_allclose(got[:, 2:], px, atol=1e-4)
    with pytest.raises(ValueError):
        geo.fit(px[:3], fld[:3])


def test_robot_features_without_rows(spark):
    t = spark.createDataFrame([], "row_id long, match_id long, t double, slot string, team string, x_in double, y_in double, conf double")
    m = spark.createDataFrame([], "id long, event_id long, red_score int, blue_score int, ocr_red_score int, ocr_blue_score int")
    assert features.robot_match_features(t, m).count() == 0


def test_leader_clusters(spark):
    rows = [("s", f"c{k}", [float(v)] * 4) for k, v in enumerate((0, 1, 40, 2, 41, 3))] + [("s", "c9", None)]
    got = clusters.leader_clusters(spark.createDataFrame(rows, "source_id string, clip_id string, fp array<double>")).orderBy("clip_id").toPandas()
    assert got["cluster"].tolist() == [0, 0, 1, 0, 1, 0]


def test_win_conditions_match_newton(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2)) * [3, 0.5] + [1, 2]
    y = (x[:, 0] + rng.normal(size=200) > 1).astype(float)
    df = spark.createDataFrame([(float(a), float(b), bool(c)) for (a, b), c in zip(x, y)], "a double, b double, won boolean")
    got = {r["feature"]: r["coef"] for r in insights.win_conditions(df, ["a", "b"]).collect()}
    z = np.c_[(x - x.mean(0)) / x.std(0), np.ones(200)]
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        ridge = np.diag([1.0, 1.0, 0.0])
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
    assert abs(got["a"] - w[0]) < 1e-4 and abs(got["b"] - w[1]) < 1e-4
    with pytest.raises(ValueError):
        insights.win_conditions(df.limit(10), ["a", "b"])


def test_calibration_chain(spark):
    videos = spark.createDataFrame([("m1", "vod"), ("m2", "vod"), ("m3", None), ("vod", None)], "id string, source_id string")
    cal = spark.createDataFrame([("m2", 5.0, "x"), ("vod", 9.0, "y"), ("m3", 50.0, "z")], "video_id string, from_ts double, homography string")
    req = spark.createDataFrame([(1, "m1", 0.0), (2, "m2", 7.0), (3, "m3", 10.0), (4, "vod", 20.0)], "k int, video_id string, ts double")
    got = {r["k"]: (r["homography"], r["origin"]) for r in calibration.calibration_asof(req, cal, videos).collect()}
    assert got == {1: ("x", "source"), 2: ("x", "own"), 3: (None, None), 4: ("y", "own")}


def test_upsert_and_reload(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "n"), (2, "b", "n")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, seq int")
    got = store.upsert(old, new, ["k"], F.col("seq")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, "a", "n"), (2, "d", None), (3, "e", None)]
    assert store.replace_by_key(old, old.where("k = 2"), ["k"]).count() == 2
    p = str(tmp_path / "t")
    store.overwrite_partitions(old, p, ["k"])
    store.overwrite_partitions(old.where("k = 2").withColumn("v", F.lit("z")), p, ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "z")]
