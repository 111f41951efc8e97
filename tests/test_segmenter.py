"""The scenarios of a countdown overlay, one sample a second."""

import pandas as pd
from pyspark.sql import functions as F

from arenaflow.functions import parsing as ps
from arenaflow.operators.segment import SAMPLE, Countdown, segment, tail_median, top_votes


def feed(machine, samples, t0=0.0):
    for k, s in enumerate(samples):
        s = {"timer": None, "name": None, "red": [], "blue": [], "rs": None, "bs": None} | s
        machine.feed(t0 + k, s["timer"], s["name"], s["red"], s["blue"], s["rs"], s["bs"])
    return t0 + len(samples)


def timers(values, **more):
    return [{"timer": v} | more for v in values]


def test_timer_texts(spark):
    texts = ["1:45", "0:15", "o:00", "O;O5", "12:45", "row 1"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(ps.timer(F.col("t"))).collect()] == [105, 15, 0, 5, None, None]


def test_labels(spark):
    texts = ["QUAL 118", "Qualification 12", "SF 1-2", "FINAL 1", "UP NEXT: QUAL 119", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(ps.match_label(F.col("t"))).collect()] == ["Q118", "Q12", "SF1-2", "F1", None, None]


def full_match():
    red, blue = {"red": ["1234A"], "blue": ["5678B"]}, {"red": ["1Z34A"], "blue": ["5678B"]}
    seq = timers([15] * 5) + timers(range(14, -1, -1), name="Q3", **red) + timers(range(105, -1, -1), name="Q3", rs=21, bs=10, **red)
    seq[30] |= blue
    return seq + [{}] * 5


def test_full_match():
    m = Countdown()
    feed(m, full_match())
    (s,) = m.ready
    assert s.name == "Q3" and abs(s.auton_end - s.start - 15) <= 2 and abs(s.end - s.start - 120) <= 2
    assert s.scores[-1][1:] == (21, 10) and max(set(s.red), key=s.red.count) == "1234A"


def test_stream_cut_in_driver():
    m = Countdown()
    t = feed(m, timers(range(100, 40, -1), name="Q5"))
    feed(m, timers(range(14, 5, -1), name="Q6"), t)
    (s,) = m.ready
    assert s.name == "Q5" and s.notes == "auton-missed" and m.open.name == "Q6" and not m.driving


def test_static_timer_and_final_ticks_start_nothing():
    for seq in (timers([15] * 30), timers([3, 2, 1, 0]) + [{}] * 10):
        m = Countdown()
        feed(m, seq)
        assert m.open is None and not m.ready


def test_start_moves_on_driver_jump():
    m = Countdown()
    feed(m, timers([14, 12] + [12] * 20 + list(range(105, 90, -1))))
    assert m.driving and abs(m.open.start - 7) <= 1


def test_stuck_auton_is_dropped():
    m = Countdown()
    feed(m, timers([14, 13]) + [{}] * 40)
    assert m.open is None and not m.ready


def test_end_of_stream_keeps_driver_only():
    m = Countdown()
    feed(m, timers(range(100, 90, -1)))
    m.finish()
    assert m.ready[0].end is None


def rows_of(video, seq):
    return [(video, float(k), s.get("timer"), None, s.get("name"), s.get("red", []), s.get("blue", []), s.get("rs"), s.get("bs")) for k, s in enumerate(seq)]


def test_batch_and_stream_agree(spark, tmp_path):
    rows = rows_of("a", full_match()) + rows_of("b", full_match() + full_match())
    df = spark.createDataFrame(rows, SAMPLE)
    batch = segment(df).select("video_id", "name", "start_ts", "end_ts").toPandas().sort_values(["video_id", "start_ts"], ignore_index=True)
    assert batch["video_id"].tolist() == ["a", "b", "b"]
    from arenaflow.streaming.segmenter import segment_stream

    for k, (lo, hi) in enumerate(((0, 60), (60, 1000))):
        df.where((F.col("video_ts") >= lo) & (F.col("video_ts") < hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = segment_stream(stream).writeStream.format("memory").queryName("spans").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("spans").select("video_id", "name", "start_ts", "end_ts").toPandas().sort_values(["video_id", "start_ts"], ignore_index=True)
    pd.testing.assert_frame_equal(got, batch)


def test_segment_empty_and_nulls(spark):
    assert segment(spark.createDataFrame([], SAMPLE)).count() == 0
    assert segment(spark.createDataFrame([("v", None, 5, None, None, None, None, None, None)], SAMPLE)).count() == 0


def test_votes_and_tail(spark):
    v = spark.createDataFrame([(1, 0, "a", 1), (1, 1, "b", 1), (1, 2, "c", 5), (1, 3, None, 9)], "k int, pos int, value string, weight int")
    assert [(r["value"], r["rank"]) for r in top_votes(v, ["k"]).orderBy("rank").collect()] == [("c", 1), ("a", 2)]
    d = spark.createDataFrame([([9, 1, None, 3, 2, 8],), ([None],), ([],)], "a array<int>")
    assert [r[0] for r in d.select(tail_median(F.col("a"))).collect()] == [3, None, None]
