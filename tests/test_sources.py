import json


from arenaflow.operators import overlay
from arenaflow.sources import detectors, tables


def test_store_round_trip(spark, tmp_path):
    m = spark.createDataFrame([(1, "Q1")], "id long, name string")
    m.write.parquet(str(tmp_path / "matches.parquet"))
    store = tables.open_store(spark, str(tmp_path))
    assert store["matches"].columns == tables.conform(m, "matches").columns and store["videos"].count() == 0
    assert tables.export_tables(store, str(tmp_path / "out")) == ["matches"]


def test_documents_and_sidecars(spark, tmp_path):
    tables.write_documents(spark.createDataFrame([(5, '{"a": 1}')], "match_id long, body string"), str(tmp_path / "docs"))
    assert spark.read.text(str(tmp_path / "docs")).collect()[0]["match_id"] == 5
    (tmp_path / "v1.info.json").write_text(json.dumps({"title": "T", "channel": "", "uploader": "U"}))
    assert [tuple(r) for r in tables.read_sidecars(spark, str(tmp_path / "*.info.json")).collect()] == [("v1", "T", "U")]


def test_official_pages(spark, tmp_path):
    page = {"data": [{"id": 3, "round": 2, "matchnum": 7, "alliances": [{"color": "red", "score": 5, "teams": [{"team": {"name": "1A"}}]}]}]}
    (tmp_path / "p.json").write_text(json.dumps(page, indent=1))
    r = tables.read_official(spark, str(tmp_path / "p.json")).collect()[0]
    assert (r["id"], r["instance"], r["alliances"][0]["teams"][0]["team"]["name"]) == (3, None, "1A")


def test_labels(spark):
    b = spark.createDataFrame([("i", 0, 1, 0.5, 0.5, 0.25, 0.125), ("i", 1, 0, 0.1, 0.2, 0.3, 0.4)], "image string, pos int, cls int, cx double, cy double, bw double, bh double")
    text = tables.label_lines(b).collect()[0]["label"]
    assert text.splitlines()[0] == "1 0.500000 0.500000 0.250000 0.125000"
    assert tables.parse_labels(spark.createDataFrame([("i", text + "\nbad line\n")], "image string, label string")).count() == 2
    task = json.loads(tables.label_tasks(b, ("a", "b")).collect()[0]["task"])
    assert task["predictions"][0]["result"][0] == {"x": 37.5, "y": 43.75, "width": 25.0, "height": 12.5, "rectanglelabels": ["b"]}
    assert tables.pending_images(b, b).count() == 0


def test_detector_hook(spark):
    frames = spark.createDataFrame([(1, 0.0, b"x"), (1, 0.2, b"")], "match_id long, t double, image binary")
    got = detectors.detect(frames, lambda: lambda img: [("robot_red", None, 0.5, (0.0, 0.0, 1.0, 1.0))] * len(img)).collect()
    assert len(got) == 1 and got[0]["track_id"] is None


DETS = "video_id string, video_ts double, region string, pos int, text string, conf double, x0 double, y0 double, x1 double, y1 double, w int, h int"


def dets(spark, rows, region="panel"):
    return spark.createDataFrame([("v", 0.0, region, k, t, 0.9, *map(float, box), 1280, 720) for k, (t, box) in enumerate(rows)], DETS)


def test_samples_need_both_headers(spark):
    rows = [("RED ALLIANCE", (0, 100, 50, 110)), ("12A", (0, 120, 50, 130)), ("9", (0, 122, 9, 131)), ("33", (0, 200, 50, 240)), ("BLUE ALLIANCE", (0, 300, 50, 310)), ("44", (0, 400, 50, 440))]
    s = overlay.samples(dets(spark, rows)).collect()[0]
    assert (s["red_teams"], s["blue_teams"], s["red_score"], s["blue_score"]) == (["12A"], [], 33, None)
    s = overlay.samples(dets(spark, rows[:4])).collect()[0]
    assert (s["red_teams"], s["red_score"]) == ([], None)
    assert overlay.samples(dets(spark, [("x", (0, 0, 1, 1))]).limit(0)).count() == 0


def test_result_card(spark):
    rows = [
        ("QUAL 12", (600, 20, 700, 40)), ("Blocks Scored", (560, 300, 720, 320)), ("11", (400, 300, 430, 320)), ("9", (800, 300, 830, 320)), ("Parked Robots", (560, 350, 720, 370)), ("1", (400, 350, 430, 370)),
        ("88", (100, 200, 200, 290)), ("77", (1000, 200, 1100, 290)), ("12A rank", (100, 600, 200, 620)), ("34B", (1000, 600, 1100, 620)),
    ]
    c = overlay.result_cards(dets(spark, rows, "full")).collect()[0]
    assert (c["match_name"], c["red_score"], c["blue_score"], c["red_teams"], c["blue_teams"]) == ("Q12", 88, 77, ["12A"], ["34B"])
    got = {k: (v["red"], v["blue"]) for k, v in c["breakdown"].items()}
    assert got == {"blocks": (11, 9), "parked": (1, None)}
    assert overlay.result_cards(dets(spark, rows[:1], "full")).count() == 0


def test_locate(spark):
    rows = [("1:45", (600, 10, 680, 30)), ("RED ALLIANCE", (900, 100, 1000, 120)), ("BLUE ALLIANCE", (900, 300, 1000, 320))]
    r = overlay.locate(dets(spark, rows, "full")).collect()[0]
    assert tuple(r["timer"]) == (576, 0, 704, 42) and r["label"] is None and tuple(r["panel"]) == (874, 85, 1280, 720)
    assert overlay.locate(dets(spark, rows[1:], "full")).count() == 0


def test_sampled_times_repeat(spark):
    m = spark.createDataFrame([(1, 10.0, 130.0), (2, 5.0, None)], "id long, video_start_ts double, video_end_ts double")
    a, b = (tables.sampled_times(m, 50).orderBy("k").collect() for _ in range(2))
    assert a == b and len(a) == 50 and all(10 <= r["ts"] <= 130 for r in a)
