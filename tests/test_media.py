"""Frame sampling, carried regions, incremental work, isolation, exact quantiles, pages and label files on small and odd input."""

import http.server
import json
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.functions import geometry as geo
from arenaflow.game import PUSHBACK
from arenaflow.operators import calibration, clusters, ingest, quantiles, store
from arenaflow.operators.tracking import mutual_pairs
from arenaflow.sources import detectors, rest, tables


def test_stride_and_period(spark):
    spans = spark.createDataFrame([(1, 10.0, 11.0, 30.0), (2, 0.0, 1.0, 12.5), (3, 5.0, 5.0, 30.0), (4, None, 5.0, 30.0), (5, 0.0, 9.0, 0.0), (6, 0.0, 0.05, 30.0)], "id long, start_ts double, end_ts double, fps double")
    got = {}
    for r in ingest.stride_times(spans, ["id"]).orderBy("id", "frame").collect():
        got.setdefault(r["id"], []).append(r["frame"])
    # 12.5 / 5 rounds half to even: 2.
    assert got == {1: list(range(0, 30, 6)), 2: list(range(0, 13, 2)), 6: [0]}
    v = spark.createDataFrame([(1, 3.0), (2, 2.5), (3, 0.0), (4, None)], "id long, duration_s double")
    assert sorted((r["id"], r["ts"]) for r in ingest.period_times(v, ["id"]).collect()) == [(1, 0.0), (1, 1.0), (1, 2.0), (2, 0.0), (2, 1.0), (2, 2.0)]
    assert ingest.stride_times(spans.limit(0), ["id"]).count() == 0 and ingest.period_times(v.limit(0), ["id"]).count() == 0


def test_full_passes_and_carried_regions(spark):
    s = spark.createDataFrame([("v", float(t), None if 3 <= t < 20 else 5) for t in range(30)] + [("v", None, 3)], "video_id string, video_ts double, timer int")
    assert sorted(r["video_ts"] for r in ingest.full_passes(s).collect()) == [0.0, 5.0, 10.0, 15.0]
    box = "struct<x0: int>"
    located = spark.createDataFrame([("v", 0.0, (1,), (2,), None), ("v", 1.0, (1,), None, (7,)), ("v", 2.0, (1,), None, None), ("w", 0.0, (1,), None, None)], f"video_id string, video_ts double, timer {box}, label {box}, panel {box}")
    got = [(r["video_id"], r["label"] and r["label"][0], r["panel"] and r["panel"][0]) for r in ingest.carry_regions(located).orderBy("video_id", "video_ts").collect()]
    assert got == [("v", 2, None), ("v", 2, 7), ("v", 2, 7), ("w", None, None)]


def test_incremental_and_redo(spark, tmp_path):
    path = str(tmp_path / "t")
    wanted = spark.range(4).withColumnRenamed("id", "k")
    store.append(spark.createDataFrame([(7, 0), (8, 1)], "v long, k long"), path, ["k"])
    make = lambda v: lambda todo: todo.select(F.lit(v).cast("long").alias("v"), "k")
    assert {(r["k"], r["v"]) for r in ingest.process_missing(wanted, path, ["k"], make(9)).collect()} == {(0, 7), (1, 8), (2, 9), (3, 9)}
    assert {(r["k"], r["v"]) for r in ingest.process_missing(wanted.where("k < 2"), path, ["k"], make(1), redo=True).collect()} == {(0, 1), (1, 1), (2, 9), (3, 9)}


def test_one_failure_leaves_the_others(spark):
    items = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, None)], "id long, x double")
    got = {r["id"]: (r["ok"], r["result"], r["error"]) for r in ingest.isolated(items, ["id"], lambda row: str(4 / row["x"])).collect()}
    assert got[1] == (True, "2.0", None) and not got[2][0] and got[2][2].startswith("ZeroDivisionError") and got[3][2].startswith("TypeError")
    assert ingest.isolated(items.limit(0), ["id"], str).count() == 0


@pytest.mark.parametrize("p", [0.0, 0.3, 0.5, 0.9, 1.0])
def test_exact_percentile(spark, p):
    rng = random.Random(1)
    groups = {"big": [rng.gauss(0, 9) for _ in range(6000)], "ties": [rng.randrange(5) for _ in range(4000)], "one": [3.0], "two": [1.0, 2.0], None: [rng.random() for _ in range(900)]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("none", None), ("big", float("nan")), ("one", None)]
    got = {r["k"]: r["q"] for r in quantiles.exact_percentile(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", p, "q").collect()}
    assert got.keys() == groups.keys()
    assert all(abs(got[k] - np.quantile(vs, p)) < 1e-9 for k, vs in groups.items())


def test_numbered(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice((None, 1, 2, 3))) for k in range(500)]
    got = store.numbered(spark.createDataFrame(rows, "id long, g int"), [F.col("g").asc_nulls_first(), F.col("id")]).collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["place"])] == [r[0] for r in want] and sorted(r["place"] for r in got) == list(range(1, 501))


def test_calibration_needs_no_key(spark):
    """The same request twice, a video without calibrations of its own, one without any, null times."""
    req = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("a", 0.5), ("c", 1.0), ("x", 1.0), ("a", None)], "video_id string, ts double")
    cal = spark.createDataFrame([("a", 1.0, "h1"), ("a", 4.0, "h2"), ("s", 9.0, "h3"), ("a", None, "h4")], "video_id string, from_ts double, homography string")
    vid = spark.createDataFrame([("a", ""), ("c", "s"), ("x", None)], "id string, source_id string")
    got = sorted((str(r["video_id"]), str(r["ts"]), str(r["homography"]), str(r["origin"])) for r in calibration.calibration_asof(req, cal, vid).collect())
    assert got == sorted([("a", "5.0", "h2", "own")] * 2 + [("a", "0.5", "None", "None"), ("c", "1.0", "h3", "source"), ("x", "1.0", "None", "None"), ("a", "None", "None", "None")])


def test_calibration_plan_with_failed_fits(spark):
    rows = [(1, k, 0, [0.0, 0.0]) for k in range(3)] + [(1, 10 + k, 1, [10.0, 10.0]) for k in range(3)] + [(1, 20, 2, [9.0, 9.0]), (1, 21, 3, [90.0, 90.0]), (1, 22, 4, None)]
    clips = spark.createDataFrame(rows, "source_id long, clip_id long, cluster int, fp array<double>")
    plan = lambda fitted=None: {r["clip_id"]: r["calibrated_as"] for r in clusters.calibration_plan(clips, fitted).collect()}
    assert plan() == {0: 0, 1: 0, 2: 0, 10: 1, 11: 1, 12: 1, 20: 1, 21: None, 22: None}
    fitted = spark.createDataFrame([(1, 0)], "source_id long, cluster int")
    assert plan(fitted) == {0: 0, 1: 0, 2: 0, 10: None, 11: None, 12: None, 20: 0, 21: None, 22: None}


def test_pairs_go_to_the_nearest_first():
    rng = np.random.default_rng(0)
    for _ in range(200):
        d = np.round(rng.uniform(0, 5, (rng.integers(0, 5), rng.integers(0, 5))), 1)
        left, right, want = set(range(d.shape[0])), set(range(d.shape[1])), set()
        for v, i, j in sorted((d[i, j], i, j) for i in range(d.shape[0]) for j in range(d.shape[1])):
            if v <= 3 and i in left and j in right:
                want.add((i, j))
                left.discard(i)
                right.discard(j)
        assert set(mutual_pairs(d, 3.0)) == want


def test_homography_text(spark):
    texts = ["[1,0,0,0,1,0,0,0,1]", "[1,2]", "[1,0,0,0,1,0,0,0,null]", "no list", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert [r[0] is not None for r in df.orderBy("k").select(geo.homography_of(F.col("t"))).collect()] == [True, False, False, False, False]


def test_pages_of_endpoints(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"id": 1, "divisions": [{"id": 4, "name": "North", "order": 1}]}))
    (tmp_path / "t.json").write_text(json.dumps({"data": [{"id": 9, "number": "1A", "team_name": "x"}]}))
    assert [(r["id"], r["name"]) for r in tables.read_pages(spark, str(tmp_path / "d.json"), "divisions").collect()] == [(4, "North")]
    r = tables.read_pages(spark, str(tmp_path / "t.json"), "teams").collect()[0]
    assert (r["number"], r["organization"]) == ("1A", None)


def test_label_files(spark, tmp_path):
    assert tables.label_config(("robot_red", "new")).splitlines()[3:5] == ['    <Label value="robot_red" background="#e53935"/>', '    <Label value="new" background="#aaaaaa"/>']
    assert tables.dataset_yaml("/d", PUSHBACK.classes).endswith("names:\n  0: robot_red\n  1: robot_blue\n  2: block_red\n  3: block_blue\n")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jpg").write_bytes(b"12345")
    (tmp_path / "a" / "x.txt").write_bytes(b"1")
    got = tables.list_files(spark, str(tmp_path), "*.jpg").collect()
    assert len(got) == 1 and got[0]["path"].endswith("a/x.jpg") and got[0]["size"] == 5


def test_packed_documents(spark, tmp_path):
    docs = spark.range(40).selectExpr("id AS match_id", "concat('{', id, '}') AS body")
    tables.pack_documents(docs, str(tmp_path / "p"), 3)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 40 and len(back.inputFiles()) <= 3 and back.where("match_id = 7").collect()[0]["body"] == "{7}"


def test_text_reader_hook_falls_back(spark):
    def broken():
        raise RuntimeError("no engine")

    def other():
        return lambda image: [(image.decode(), 0.5, (0.0, 0.0, 1.0, 1.0))]

    frames = spark.createDataFrame([("v", 1.0, "full", b"1:45"), ("v", 2.0, "full", b"x")], "video_id string, video_ts double, region string, image binary")
    got = detectors.read_text(frames, broken, other).orderBy("video_ts").collect()
    assert [(r["text"], r["pos"]) for r in got] == [("1:45", 0), ("x", 0)]


class _Pages(http.server.BaseHTTPRequestHandler):
    seen: list[str] = []

    def do_GET(self):
        self.seen.append(self.path + " " + self.headers["Authorization"])
        page = 1 + ("page=2&" in self.path)
        body = json.dumps({"data": [{"id": page}], "meta": {"current_page": page, "last_page": 2}}).encode()
        self.send_response(200 if "fail" not in self.path else 500)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


def test_rest_source_reads_all_pages():
    server = http.server.HTTPServer(("127.0.0.1", 0), _Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/events?x=1"
        got = [json.loads(v) for (v,) in rest.RestReader({"url": url, "token": "k", "gap_s": "0"}).read(None)]
        assert got == [{"id": 1}, {"id": 2}] and all(s.endswith("Bearer k") and "per_page=250" in s for s in _Pages.seen)
        with pytest.raises(OSError):
            list(rest.RestReader({"url": url + "&fail=1", "gap_s": "0"}).read(None))
    finally:
        server.shutdown()
