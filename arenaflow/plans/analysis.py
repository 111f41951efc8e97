"""Queries of the scalar functions, windows, features, stateful operators, models and exports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import parsing as ps
from ..game import PUSHBACK
from ..operators import clusters, export, features, insights, overlay, segment, tracking
from ..runtime import table
from ..sources import tables
from .base import MA, SC, TR, VI, ZONE_SQL, any_zone, matches, query, r6, rounded, scores, tracks, videos, zones

# Motion between readings, as the SQL side sees it.
_MO = f"""WITH {TR}, {MA}, seen AS (SELECT * FROM tr WHERE conf > 0), mo AS (
  SELECT *, sqrt((x_in - lag(x_in) OVER w) ** 2 + (y_in - lag(y_in) OVER w) ** 2) AS dist, t - lag(t) OVER w AS dt, max(t) OVER (PARTITION BY match_id, slot) AS t_last
  FROM seen WINDOW w AS (PARTITION BY match_id, slot ORDER BY t, row_id)
), sp AS (SELECT *, CASE WHEN dt > 0 AND dt < 2 THEN dist / dt END AS speed, CASE WHEN slot LIKE 'red%' THEN 'red' ELSE 'blue' END AS alliance FROM mo)"""

_PARKS = {a: c for a, c in (("red", "(x_in >= 0 AND x_in < 16.88::DOUBLE AND y_in >= 60.77::DOUBLE AND y_in < 79.64::DOUBLE)"), ("blue", "(x_in >= 123.52::DOUBLE AND x_in < 140.4::DOUBLE AND y_in >= 60.77::DOUBLE AND y_in < 79.64::DOUBLE)"))}

_RM = (
    _MO
    + f""", rm AS (
  SELECT match_id, slot, alliance, first(team ORDER BY t, row_id) AS team, coalesce(avg(speed), 0) AS speed_mean, coalesce(quantile_cont(speed, 0.9), 0) AS speed_p90, stddev_pop(x_in) AS range_x, stddev_pop(y_in) AS range_y,
    avg(CASE WHEN alliance = 'red' THEN x_in > 70.2::DOUBLE ELSE x_in < 70.2::DOUBLE END::INT) AS frac_offensive_half, avg({any_zone("loader")}::INT) AS frac_near_loader, avg({any_zone("goal")}::INT) AS frac_near_goal,
    avg(CASE WHEN alliance = 'red' THEN {_PARKS["red"]} ELSE {_PARKS["blue"]} END::INT) FILTER (WHERE t >= t_last - 15) AS endgame_in_own_park, coalesce(sum(dist) FILTER (WHERE t <= 15), 0) AS auton_dist, count(*) AS n_samples
  FROM sp GROUP BY match_id, slot, alliance
), sco AS (SELECT id, event_id, coalesce(red_score, ocr_red_score) AS r, coalesce(blue_score, ocr_blue_score) AS b FROM ma),
full_rm AS (SELECT rm.*, sco.event_id, CASE WHEN r > b THEN alliance = 'red' WHEN r < b THEN alliance = 'blue' END AS won FROM rm JOIN sco ON sco.id = rm.match_id)"""
)
_STYLE = ["speed_mean", "speed_p90", "range_x", "range_y", "frac_offensive_half", "frac_near_loader", "frac_near_goal", "endgame_in_own_park", "auton_dist"]


def _robots(spark, d):
    return features.robot_match_features(tracks(spark, d), matches(spark, d))


@query(_RM + f" SELECT match_id, slot, alliance, team, event_id, won, {r6(*_STYLE)}, n_samples FROM full_rm")
def robot_match_features(spark, d):
    return rounded(_robots(spark, d))


@query(
    _RM + " SELECT match_id, alliance, event_id, any_value(won) AS won, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in features.MEANS) + ", round(sum(endgame_in_own_park), 6) AS robots_parked_endgame FROM full_rm GROUP BY match_id, alliance, event_id"
)
def match_features(spark, d):
    return rounded(features.match_features(_robots(spark, d)))


@query(_RM + ", lab AS (SELECT *, match_id % 3 AS cluster FROM full_rm WHERE won IS NOT NULL) SELECT cluster, count(*) AS n, round(avg(won::INT), 6) AS win_rate, " + ", ".join(f"round(avg({c}), 2) AS {c}" for c in _STYLE) + " FROM lab GROUP BY cluster")
def cluster_summary(spark, d):
    return rounded(insights.cluster_summary(_robots(spark, d).withColumn("cluster", F.col("match_id") % 3)))


_TENDS = ["speed_mean", "frac_offensive_half", "frac_near_loader", "frac_near_goal", "endgame_in_own_park"]


@query(_RM + " SELECT team, count(*) AS matches, count(won) AS decided, round(avg(won::INT), 6) AS win_rate, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _TENDS) + ", CASE WHEN count(*) FILTER (WHERE alliance = 'red') >= count(*) FILTER (WHERE alliance <> 'red') THEN 'red' ELSE 'blue' END AS main_alliance FROM full_rm WHERE team IS NOT NULL GROUP BY team")
def tendencies(spark, d):
    return rounded(features.team_tendencies(_robots(spark, d)))


@query(
    f"""WITH {TR}, c AS (SELECT team, CAST(least(floor(x_in * 36 / 140.4::DOUBLE), 35) AS INTEGER) AS bin_x, CAST(least(floor(y_in * 36 / 140.4::DOUBLE), 35) AS INTEGER) AS bin_y, count(*) AS n
    FROM tr WHERE conf > 0 AND team IS NOT NULL AND x_in BETWEEN 0 AND 140.4::DOUBLE AND y_in BETWEEN 0 AND 140.4::DOUBLE GROUP BY 1, 2, 3)
    SELECT team, bin_x, bin_y, n, round(n / max(n) OVER (PARTITION BY team), 6) AS density FROM c"""
)
def heatmap(spark, d):
    return rounded(features.heatmap(tracks(spark, d).where("conf > 0 AND team IS NOT NULL"), ["team"]))


def _kinds(kind: str) -> str:
    return " + ".join(f"avg({c}::INT)" for k, c in ZONE_SQL.values() if k == kind)


@query(
    f"""WITH {TR}, {MA}, j AS (SELECT tr.*, ma.event_id FROM tr JOIN ma ON ma.id = tr.match_id WHERE conf > 0 AND team IS NOT NULL AND event_id IS NOT NULL),
    mo AS (SELECT *, sqrt((x_in - lag(x_in) OVER w) ** 2 + (y_in - lag(y_in) OVER w) ** 2) AS dist, t - lag(t) OVER w AS dt FROM j WINDOW w AS (PARTITION BY event_id, team, match_id ORDER BY t, row_id)),
    b AS (SELECT event_id, team, coalesce(avg(dist / dt) FILTER (WHERE dt > 0 AND dt < 2), 0) AS speed_mean, coalesce(quantile_cont(CASE WHEN dt > 0 AND dt < 2 THEN dist / dt END, 0.9), 0) AS speed_p90, stddev_pop(x_in) AS std_x, stddev_pop(y_in) AS std_y,
    avg((x_in < 70.2::DOUBLE)::INT) AS on_red_side, {_kinds("loader")} AS loader, {_kinds("goal")} AS goal, {_kinds("park")} AS park FROM mo GROUP BY event_id, team)
    SELECT event_id, team, {r6("speed_mean", "speed_p90", "std_x", "std_y", "on_red_side", "loader", "goal", "park")} FROM b"""
)
def behavioral_features(spark, d):
    return rounded(features.behavioral_features(tracks(spark, d), matches(spark, d)))


# Blocks: readings stand for detections, by row_id odd or even red or blue.
_BLOCKS = f"WITH {TR}, fr AS (SELECT DISTINCT match_id, floor(t) AS t FROM tr)"


@query(
    _BLOCKS
    + ", bl AS (SELECT match_id, floor(t) AS t, row_id % 2 AS odd, "
    + "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, (_, c) in ZONE_SQL.items()) + " END AS zone FROM tr), "
    + "names AS (SELECT unnest([" + ", ".join(f"'{z.name}'" for z in PUSHBACK.zones) + "]) AS zone) "
    + "SELECT fr.match_id, fr.t, names.zone, count(bl.t) FILTER (WHERE odd = 1) AS red_blocks, count(bl.t) FILTER (WHERE odd = 0) AS blue_blocks FROM fr CROSS JOIN names LEFT JOIN bl ON bl.match_id = fr.match_id AND bl.t = fr.t AND bl.zone = names.zone GROUP BY fr.match_id, fr.t, names.zone"
)
def zone_counts(spark, d):
    t = tracks(spark, d).withColumn("t", F.floor("t").cast("double"))
    cls = F.when(F.col("row_id") % 2 == 1, "block_red").otherwise("block_blue")
    return features.zone_counts(t.select("match_id", "t", cls.alias("cls"), F.col("x_in").alias("x"), F.col("y_in").alias("y")), t)


@query(_MO + " SELECT match_id, slot, round(coalesce(avg(speed), 0), 6) AS speed_mean, round(coalesce(quantile_cont(speed, 0.9), 0), 6) AS speed_p90, count(speed) AS n_steps FROM sp GROUP BY match_id, slot")
def speed_guarded(spark, d):
    m = features.with_motion(tracks(spark, d).where("conf > 0"), ["match_id", "slot"], ["t", "row_id"])
    return rounded(m.groupBy("match_id", "slot").agg(F.coalesce(F.avg("speed"), F.lit(0.0)).alias("speed_mean"), F.coalesce(F.percentile("speed", 0.9), F.lit(0.0)).alias("speed_p90"), F.count("speed").alias("n_steps")))


@query(_MO + " SELECT match_id, slot, round(coalesce(sum(dist), 0), 6) AS path, count(*) AS n FROM sp WHERE t <= 15 GROUP BY match_id, slot")
def auton_path(spark, d):
    m = features.with_motion(tracks(spark, d).where("conf > 0 AND t <= 15"), ["match_id", "slot"], ["t", "row_id"])
    return rounded(m.groupBy("match_id", "slot").agg(F.coalesce(F.sum("dist"), F.lit(0.0)).alias("path"), F.count("*").alias("n")))


@query(_MO + " SELECT match_id, slot, count(*) AS n_late FROM sp WHERE t >= t_last - 15 GROUP BY match_id, slot")
def endgame(spark, d):
    t = tracks(spark, d).where("conf > 0").withColumn("last", F.max("t").over(Window.partitionBy("match_id", "slot")))
    return t.where("t >= last - 15").groupBy("match_id", "slot").agg(F.count("*").alias("n_late"))


_S1 = "s1 AS (SELECT match_id, slot, t, avg(x_in) AS x, avg(y_in) AS y, min(conf) AS conf FROM tr WHERE conf > 0 GROUP BY match_id, slot, t)"


@query(
    f"""WITH {TR}, {_S1}, g AS (SELECT match_id, slot, i, i * 0.2::DOUBLE AS t FROM (SELECT DISTINCT match_id, slot FROM s1), range(0, 600) AS r(i)),
    j AS (SELECT g.*, p.t AS pt, p.x AS px, p.y AS py, p.conf AS pc FROM g ASOF LEFT JOIN s1 p ON p.match_id = g.match_id AND p.slot = g.slot AND p.t < g.t),
    k AS (SELECT j.*, q.t AS qt, q.x AS qx, q.y AS qy, q.conf AS qc FROM j ASOF LEFT JOIN s1 q ON q.match_id = j.match_id AND q.slot = j.slot AND q.t >= j.t),
    v AS (SELECT match_id, slot, i, t,
      CASE WHEN pt IS NULL THEN qx WHEN qt IS NULL OR qt - pt > 3 THEN px ELSE px + (t - pt) / greatest(qt - pt, 1e-6::DOUBLE) * (qx - px) END AS x,
      CASE WHEN pt IS NULL THEN qy WHEN qt IS NULL OR qt - pt > 3 THEN py ELSE py + (t - pt) / greatest(qt - pt, 1e-6::DOUBLE) * (qy - py) END AS y,
      CASE WHEN pt IS NULL OR qt IS NULL OR qt - pt > 3 THEN 0 ELSE least(pc, qc) END AS conf FROM k)
    SELECT match_id, slot, CAST(i AS INTEGER) AS i, round(t, 6) AS t, round((coalesce(lag(x) OVER w, 0) + x + coalesce(lead(x) OVER w, 0)) / 3 + 1e-8, 6) AS x, round((coalesce(lag(y) OVER w, 0) + y + coalesce(lead(y) OVER w, 0)) / 3 + 1e-8, 6) AS y, round(conf, 6) AS conf
    FROM v WINDOW w AS (PARTITION BY match_id, slot ORDER BY i)"""
)
def resample(spark, d):
    s = tracks(spark, d).where("conf > 0").groupBy("match_id", "slot", "t").agg(F.avg("x_in").alias("x"), F.avg("y_in").alias("y"), F.min("conf").alias("conf"))
    # The small addend keeps decimal ties from being rounded apart by two engines.
    r = tracking.resample(s, ["match_id", "slot"], sum(PUSHBACK.seconds.values()))
    return rounded(r.withColumns({"x": F.col("x") + 1e-8, "y": F.col("y") + 1e-8}))


@query(f"WITH {TR} SELECT row_id, count(*) OVER w AS trail_n, round(min(t) OVER w, 6) AS trail_from FROM tr WINDOW w AS (PARTITION BY match_id, slot ORDER BY t RANGE BETWEEN 10 PRECEDING AND CURRENT ROW)")
def trail(spark, d):
    return rounded(features.trail(tracks(spark, d)).select("row_id", "trail_n", "trail_from"))


# Countdown texts, some with letters for digits, some invalid.
_TXT = "tx AS (SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN 'row ' || event_id % 150 ELSE (event_id % 150) // 60 || CASE WHEN event_id % 2 = 0 THEN ':' ELSE ';' END || CASE WHEN event_id % 3 = 0 THEN replace(lpad(CAST(event_id % 150 % 60 AS VARCHAR), 2, '0'), '0', 'O') ELSE lpad(CAST(event_id % 150 % 60 AS VARCHAR), 2, '0') END END AS text FROM events)"


@query(f"WITH {_TXT}, d AS (SELECT id, replace(text, 'O', '0') AS x FROM tx) SELECT id, CASE WHEN regexp_full_match(x, '[0-2][:;.][0-5][0-9]') AND CAST(left(x, 1) AS INTEGER) * 60 + CAST(right(x, 2) AS INTEGER) <= 120 THEN CAST(left(x, 1) AS INTEGER) * 60 + CAST(right(x, 2) AS INTEGER) END AS timer FROM d")
def parse_timer(spark, d):
    i = F.col("event_id")
    s = F.lpad((i % 150 % 60).cast("string"), 2, "0")
    text = F.when(i % 7 == 0, F.concat(F.lit("row "), (i % 150).cast("string"))).otherwise(
        F.concat(F.floor(i % 150 / 60).cast("string"), F.when(i % 2 == 0, ":").otherwise(";"), F.when(i % 3 == 0, F.replace(s, F.lit("0"), F.lit("O"))).otherwise(s))
    )
    return table(spark, d, "events").select(i.alias("id"), ps.timer(text).alias("timer"))


@query("""WITH x AS (SELECT event_id AS id, event_id % 6 AS k, event_id % 40 AS n FROM events)
    SELECT id, CASE k WHEN 0 THEN 'Q' || n WHEN 1 THEN 'Q' || n WHEN 2 THEN 'SF' || n || '-2' WHEN 3 THEN 'F' || n WHEN 5 THEN 'R16' || n END AS name FROM x""")
def parse_match_name(spark, d):
    k, n = F.col("event_id") % 6, (F.col("event_id") % 40).cast("string")
    text = F.when(k == 0, F.concat(F.lit("QUAL "), n)).when(k == 1, F.concat(F.lit("Qualification #"), n)).when(k == 2, F.concat(F.lit("sf "), n, F.lit(" - 2")))
    text = text.when(k == 3, F.concat(F.lit("FINAL "), n)).when(k == 4, F.concat(F.lit("UP NEXT: QUAL "), n)).otherwise(F.concat(F.lit("Round of 16 #"), n))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), ps.match_label(text).alias("name"))


@query(f"WITH {MA} SELECT id, upper(regexp_replace(coalesce(name, ''), '\\s+', '', 'g')) AS key FROM ma")
def canon(spark, d):
    return matches(spark, d).select("id", ps.canon(F.col("name")).alias("key"))


@query(
    f"""WITH {MA}, {VI}, j AS (SELECT ma.id, ma.video_id, video_start_ts, notes, vi.source_id, regexp_extract(coalesce(notes, ''), 'src=(\\S+)@(\\d+)', 1) AS nv, regexp_extract(coalesce(notes, ''), 'src=(\\S+)@(\\d+)', 2) AS nt FROM ma LEFT JOIN vi ON vi.id = ma.video_id),
    k AS (SELECT id, CASE WHEN source_id <> '' AND nv <> '' THEN nv WHEN source_id <> '' THEN source_id ELSE coalesce(video_id, '') END AS v, CASE WHEN source_id <> '' AND nv <> '' THEN CAST(nt AS DOUBLE) ELSE video_start_ts END AS start_ts FROM j)
    SELECT id, split_part(split_part(v, '_', 1), '.', 1) AS ref, start_ts FROM k"""
)
def youtube_ref(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), "source_id")
    ref, ts = ps.source_ref(F.col("video_id"), F.col("video_start_ts"), F.col("source_id"), F.col("notes"))
    return matches(spark, d).join(v, "video_id", "left").select("id", ref.alias("ref"), ts.alias("start_ts"))


_H = [1.2, 0.1, 5.0, -0.05, 0.9, 3.0, 0.0002, 0.0001, 1.0]
_HX = "(1.2::DOUBLE * x_in + 0.1::DOUBLE * y_in + 5)"
_HY = "(-0.05::DOUBLE * x_in + 0.9::DOUBLE * y_in + 3)"
_HW = "(0.0002::DOUBLE * x_in + 0.0001::DOUBLE * y_in + 1)"


def _h():
    return F.array(*[F.lit(v) for v in _H])


@query(f"WITH {TR} SELECT row_id, round({_HX} / {_HW}, 6) AS gx, round({_HY} / {_HW}, 6) AS gy FROM tr")
def homography(spark, d):
    gx, gy = geo.project(_h(), F.col("x_in"), F.col("y_in"))
    return rounded(tracks(spark, d).select("row_id", gx.alias("gx"), gy.alias("gy")))


@query(f"WITH {TR} SELECT row_id, round(x_in, 6) AS x, round(y_in, 6) AS y FROM tr")
def homography_inverse(spark, d):
    """There and back gives the point again."""
    gx, gy = geo.project(_h(), F.col("x_in"), F.col("y_in"))
    t = tracks(spark, d).withColumns({"gx": gx, "gy": gy})
    x, y = geo.project(geo.inverse(_h()), F.col("gx"), F.col("gy"))
    return rounded(t.select("row_id", F.round(x, 7).alias("x"), F.round(y, 7).alias("y")))


@query(f"WITH {TR} SELECT match_id, round(sqrt(avg(({_HX} / {_HW} - x_in) ** 2 + ({_HY} / {_HW} - y_in) ** 2)), 6) AS rms FROM tr GROUP BY match_id")
def reproj_rms(spark, d):
    gx, gy = geo.project(_h(), F.col("x_in"), F.col("y_in"))
    return rounded(tracks(spark, d).groupBy("match_id").agg(F.sqrt(F.avg((gx - F.col("x_in")) ** 2 + (gy - F.col("y_in")) ** 2)).alias("rms")))


@query("SELECT a.vec_id, round(list_sum(list_transform(range(1, 65), lambda i: abs(a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE))) / 64, 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def l1_distance(spark, d):
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rounded(e.join(b, "vec_id").select("vec_id", geo.mean_l1(F.col("embedding"), F.col("other")).alias("distance")))


@query(f"WITH {TR} SELECT row_id, round((floor(x_in) * 2 + 9) / 2 / 1024, 6) AS cx, round((floor(y_in) * 2 + 12) / 2 / 512, 6) AS cy, round(9 / 1024::DOUBLE, 6) AS bw, round(12 / 512::DOUBLE, 6) AS bh FROM tr")
def yolo_box(spark, d):
    x, y = F.floor("x_in"), F.floor("y_in")
    b = geo.yolo_box(x, y, x + 9, y + 12, F.lit(1024.0), F.lit(512.0))
    return tracks(spark, d).select("row_id", *[c.alias(n) for c, n in zip(b, ("cx", "cy", "bw", "bh"))])


@query(f"WITH {TR} SELECT row_id, match_id, t FROM tr")
def filename_parts(spark, d):
    """A file name made of match and time gives them back."""
    name = F.concat(F.lit("m"), F.col("match_id").cast("string"), F.lit("_t"), F.col("t").cast("string"), F.lit(".jpg"))
    m, t = ps.image_parts(name)
    return tracks(spark, d).select("row_id", m.alias("match_id"), t.alias("t"))


@query(f"WITH {SC} SELECT row_id, CAST(CAST(floor(t) AS BIGINT) // 60 AS VARCHAR) || ':' || lpad(CAST(CAST(floor(t) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock, CASE WHEN t <= 15 THEN 'AUTON' ELSE 'DRIVER' END AS period FROM sc WHERE t >= 0")
def clock(spark, d):
    return scores(spark, d).where("t >= 0").select("row_id", ps.clock(F.col("t")).alias("clock"), ps.period(F.col("t")).alias("period"))


def _ocr(spark, d):
    """Overlay boxes of one frame per score reading: headers, two teams and a score a side, a timer and a label."""
    s = scores(spark, d).where("match_id IS NOT NULL AND red_score BETWEEN 0 AND 400 AND blue_score BETWEEN 0 AND 400 AND t BETWEEN 0 AND 120")
    s = s.groupBy("match_id", "t").agg(F.max("red_score").alias("red_score"), F.max("blue_score").alias("blue_score"))
    left = (F.lit(120) - F.floor("t")).cast("int")
    secs = F.when(F.col("t") <= 15, F.lit(15) - F.floor("t").cast("int")).otherwise(F.least(left, F.lit(105)))
    text = F.concat(F.floor(secs / 60).cast("string"), F.lit(":"), F.lpad((secs % 60).cast("string"), 2, "0"))
    box = lambda region, value, y, height: F.struct(F.lit(region).alias("region"), value.alias("text"), F.lit(float(y)).alias("y0"), F.lit(float(y + height)).alias("y1"))
    num = F.col("match_id").cast("string")
    boxes = F.array(
        box("timer", text, 10, 20), box("label", F.concat(F.lit("QUAL "), num), 40, 12),
        box("panel", F.lit("RED ALLIANCE"), 100, 10), box("panel", F.concat(num, F.lit("A")), 120, 10), box("panel", F.lit("7"), 121, 9), box("panel", F.col("red_score").cast("string"), 200, 30),
        box("panel", F.lit("BLUE ALLIANCE"), 300, 10), box("panel", F.concat(num, F.lit("B")), 320, 10), box("panel", F.col("blue_score").cast("string"), 400, 30),
    )
    e = s.select(F.concat(F.lit("v"), num).alias("video_id"), F.col("t").alias("video_ts"), F.posexplode(boxes).alias("pos", "b"))
    return e.select("video_id", "video_ts", "b.region", "pos", "b.text", F.lit(0.9).alias("conf"), F.lit(10.0).alias("x0"), "b.y0", F.lit(60.0).alias("x1"), "b.y1", F.lit(1280).alias("w"), F.lit(720).alias("h"))


@query(
    f"""WITH {SC}, s AS (SELECT * FROM sc WHERE match_id IS NOT NULL AND red_score BETWEEN 0 AND 400 AND blue_score BETWEEN 0 AND 400 AND t BETWEEN 0 AND 120),
    one AS (SELECT match_id, t, max(red_score) AS red_score, max(blue_score) AS blue_score FROM s GROUP BY match_id, t)
    SELECT 'v' || match_id AS video_id, t AS video_ts, CASE WHEN t <= 15 THEN 15 - CAST(floor(t) AS INTEGER) ELSE least(120 - CAST(floor(t) AS INTEGER), 105) END AS timer, 'Q' || match_id AS match_name, match_id || 'A' AS red_team, match_id || 'B' AS blue_team, red_score, blue_score FROM one"""
)
def parse_samples(spark, d):
    """Every frame; of readings at one time the greater scores show."""
    s = overlay.samples(_ocr(spark, d))
    return s.select("video_id", "video_ts", "timer", "match_name", F.try_element_at("red_teams", F.lit(1)).alias("red_team"), F.try_element_at("blue_teams", F.lit(1)).alias("blue_team"), "red_score", "blue_score")


@query(
    f"""WITH {SC} SELECT 'v' || match_id AS video_id, t AS video_ts, 0 AS timer_x0, 0 AS timer_y0, 75 AS timer_x1, 42 AS timer_y1, 0 AS label_x0, 36 AS label_y0, 80 AS label_x1, 55 AS label_y1, 0 AS panel_x0, 85 AS panel_y0, 1280 AS panel_x1, 720 AS panel_y1
    FROM sc WHERE match_id IS NOT NULL AND red_score BETWEEN 0 AND 400 AND blue_score BETWEEN 0 AND 400 AND t BETWEEN 0 AND 120 GROUP BY match_id, t"""
)
def locate_regions(spark, d):
    r = overlay.locate(_ocr(spark, d).withColumn("region", F.lit("full")))
    return r.select("video_id", "video_ts", *[F.col(f"{g}.{c}").alias(f"{g}_{c}") for g in ("timer", "label", "panel") for c in ("x0", "y0", "x1", "y1")])


# Streams of several matches, 200 s apart; the timer is lost in every fifth stretch of seven seconds, the name shows twice in three.
_STREAM = """sm AS (
  SELECT match_id % 20 AS video, match_id // 20 * 200 + t AS ts, CASE WHEN t <= 120 AND CAST(floor(t / 7) AS BIGINT) % 5 <> 3 THEN CASE WHEN t <= 15 THEN 15 - CAST(floor(t) AS INTEGER) ELSE least(120 - CAST(floor(t) AS INTEGER), 105) END END AS timer,
    CASE WHEN CAST(floor(t) AS BIGINT) % 3 <> 0 THEN 'Q' || match_id END AS name, max(red_score) AS red
  FROM sc WHERE match_id IS NOT NULL AND t BETWEEN 0 AND 140 GROUP BY match_id, t
), o AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY ts, timer) AS i FROM sm)"""

# One step per sample of each stream. wait: no match is open; auto, drive: its period. open_i: the sample that opened it.
_STEPS = """w AS (
  SELECT video, 1::BIGINT AS i, 'wait' AS phase, NULL::BIGINT AS open_i, NULL::VARCHAR AS name, NULL::DOUBLE AS start, NULL::DOUBLE AS auton, FALSE AS missed, ts AS b_ts, timer AS b_timer,
    NULL::BIGINT AS into_i, NULL::BIGINT AS done_i, NULL::VARCHAR AS done_name, NULL::DOUBLE AS done_start, NULL::DOUBLE AS done_auton, NULL::DOUBLE AS done_end, FALSE AS done_missed FROM o WHERE i = 1
  UNION ALL
  SELECT video, i, phase2, open2, CASE WHEN open2 IS NULL THEN NULL WHEN open2 = i THEN now_name WHEN into2 IS NOT NULL THEN coalesce(name, now_name) ELSE name END, start2, auton2, missed2, ts, timer,
    into2, CASE WHEN renamed OR lost_end OR jumped OR zero THEN open_i END, CASE WHEN zero THEN coalesce(name, now_name) ELSE name END, start, auton,
    CASE WHEN renamed THEN least(coalesce(zero_at, ts), ts) WHEN zero THEN ts ELSE zero_at END, missed
  FROM (
    SELECT *, CASE WHEN begins THEN CASE WHEN timer > 15 THEN 'drive' ELSE 'auto' END WHEN ended OR dropped THEN 'wait' WHEN turns THEN 'drive' ELSE ph END AS phase2,
      CASE WHEN begins THEN i WHEN ended OR dropped THEN NULL ELSE op END AS open2,
      CASE WHEN begins THEN CASE WHEN timer > 15 THEN ts - (105 - timer) - 15 ELSE ts - (15 - timer) END WHEN ended OR dropped THEN NULL WHEN turns AND abs(ts - (105 - timer) - 15 - start) > 3 THEN ts - (105 - timer) - 15 ELSE start END AS start2,
      CASE WHEN begins AND timer > 15 THEN ts - (105 - timer) WHEN begins OR ended OR dropped THEN NULL WHEN turns THEN ts - (105 - timer) ELSE auton END AS auton2,
      CASE WHEN begins THEN timer > 15 WHEN ended OR dropped THEN FALSE ELSE missed END AS missed2,
      CASE WHEN begins THEN i WHEN timer IS NOT NULL AND ph <> 'wait' AND NOT dropped AND NOT jumped THEN op END AS into2
    FROM (
      SELECT *, (ph = 'wait' AND timer IS NOT NULL AND b_timer IS NOT NULL AND timer < b_timer AND timer >= 5) AS begins, ph = 'auto' AND timer IS NOT NULL AND timer > 15 AS turns,
        ph = 'auto' AND ((timer IS NULL AND ts - start > 30) OR (timer IS NOT NULL AND timer <= 15 AND (ts - start > 30 OR coalesce(timer > b_timer, FALSE)))) AS dropped,
        lost_end OR jumped OR zero AS ended
      FROM (
        SELECT *, ph = 'drive' AND timer IS NULL AND coalesce(ts > zero_at + 10, FALSE) AS lost_end, ph = 'drive' AND coalesce(timer > 0 AND timer > b_timer + 2, FALSE) AS jumped, ph = 'drive' AND coalesce(timer = 0, FALSE) AS zero
        FROM (
          SELECT *, CASE WHEN renamed THEN 'wait' ELSE phase END AS ph, CASE WHEN renamed THEN NULL ELSE open_i END AS op
          FROM (
            SELECT w.video, w.phase, w.open_i, w.name, w.start, w.auton, w.missed, w.b_ts, w.b_timer, o.i, o.ts, o.timer, o.name AS now_name, w.b_ts + w.b_timer AS zero_at,
              o.timer IS NOT NULL AND w.open_i IS NOT NULL AND coalesce(o.name <> w.name, FALSE) AS renamed
            FROM w JOIN o ON o.video = w.video AND o.i = w.i + 1))))))"""


def _spans_sql(stream: str) -> str:
    """The spans of the samples sm (video, ts, timer, name, red), in order in o, as the steps close them."""
    return f"""WITH RECURSIVE {SC}, {stream}, {_STEPS}, lasts AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY video ORDER BY i DESC) = 1),
    spans AS (
      SELECT video, done_i AS open_i, done_name AS name, done_start AS start, done_auton AS auton, done_end AS fin, done_missed AS missed FROM w WHERE done_i IS NOT NULL
      UNION ALL SELECT video, open_i, name, start, auton, NULL, missed FROM lasts WHERE phase = 'drive'),
    tail AS (SELECT s.video, s.open_i, count(*) AS n_scores, list_sort((list(o.red ORDER BY o.i DESC))[1:5]) AS r FROM spans s JOIN w ON w.video = s.video AND w.into_i = s.open_i JOIN o ON o.video = w.video AND o.i = w.i WHERE o.red IS NOT NULL AND o.ts >= s.start GROUP BY s.video, s.open_i)
    SELECT 'v' || s.video AS video_id, s.name, round(start, 6) AS start_ts, round(auton, 6) AS auton_end_ts, round(fin, 6) AS end_ts, CASE WHEN missed THEN 'auton-missed' END AS notes, coalesce(n_scores, 0) AS n_scores, r[len(r) // 2 + 1] AS final_red
    FROM spans s LEFT JOIN tail ON tail.video = s.video AND tail.open_i = s.open_i"""


@query(_spans_sql(_STREAM))
def segment_streams(spark, d):
    """The state machine over streams of several matches with lost timers and partial names."""
    f = F.floor("t")
    timer = F.when((F.col("t") <= 120) & (F.floor(F.col("t") / 7) % 5 != 3), F.when(F.col("t") <= 15, 15 - f).otherwise(F.least(120 - f, F.lit(105)))).cast("int")
    s = scores(spark, d).where("match_id IS NOT NULL AND t BETWEEN 0 AND 140").groupBy("match_id", "t").agg(F.max("red_score").alias("red_score"))
    none = F.array().cast("array<string>")
    s = s.select(
        F.concat(F.lit("v"), (F.col("match_id") % 20).cast("string")).alias("video_id"), (F.floor(F.col("match_id") / 20) * 200 + F.col("t")).alias("video_ts"), timer.alias("timer"), F.lit(None).cast("string").alias("phase_text"),
        F.when(f % 3 != 0, F.concat(F.lit("Q"), F.col("match_id").cast("string"))).alias("match_name"), none.alias("red_teams"), none.alias("blue_teams"), "red_score", F.lit(None).cast("int").alias("blue_score"),
    )
    r = segment.segment(s)
    return rounded(r.select("video_id", "name", "start_ts", "auton_end_ts", "end_ts", "notes", F.size("scores").cast("long").alias("n_scores"), segment.tail_median(F.transform("scores", lambda x: x["red"])).alias("final_red")))


# The overlay of _ocr: one stream per match, a timer, a name and both scores in every sample.
_OVERLAY = """sm AS (
  SELECT match_id AS video, t AS ts, CASE WHEN t <= 15 THEN 15 - CAST(floor(t) AS INTEGER) ELSE least(120 - CAST(floor(t) AS INTEGER), 105) END AS timer, 'Q' || match_id AS name, max(red_score) AS red
  FROM sc WHERE match_id IS NOT NULL AND red_score BETWEEN 0 AND 400 AND blue_score BETWEEN 0 AND 400 AND t BETWEEN 0 AND 120 GROUP BY match_id, t
), o AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY ts, timer) AS i FROM sm)"""


@query(_spans_sql(_OVERLAY))
def segment_matches(spark, d):
    s = segment.segment(overlay.samples(_ocr(spark, d)))
    s = s.select("video_id", "name", "start_ts", "auton_end_ts", "end_ts", F.size("scores").cast("long").alias("n_scores"), segment.tail_median(F.transform("scores", lambda x: x["red"])).alias("final_red"), "notes")
    return rounded(s)


def _detections(spark, d):
    """Tracks as detections whose ids change every 20 seconds."""
    t = tracks(spark, d).where("conf > 0")
    rank = F.array_position(F.array(*[F.lit(x) for x in ("red1", "red2", "blue1", "blue2")]), F.col("slot"))
    return t.select(
        "match_id", F.col("t"), F.col("row_id").cast("int").alias("pos"), F.when(F.col("slot").startswith("red"), "robot_red").otherwise("robot_blue").alias("cls"),
        (rank + 4 * F.floor(F.col("t") / 20)).cast("long").alias("track_id"), F.col("x_in").alias("x"), F.col("y_in").alias("y"), "conf",
    )


#: Start places of the slots, as the SQL side sees them.
_SLOTS = {"red1": (10.0, 88.0), "red2": (10.0, 52.0), "blue1": (130.4, 88.0), "blue2": (130.4, 52.0)}


def _slot_sql() -> str:
    """The slot rule as a recursion over frames: per slot the ids it owns (o), its place (p), its reading in the frame (r), and whether that was a hand-off (h)."""
    seeds = ""
    for s, (x, y) in _SLOTS.items():
        other = {"red2": "AND tid IS DISTINCT FROM o_red1", "blue2": "AND tid IS DISTINCT FROM o_blue1"}.get(s, "")
        src = "b0" if s == "red1" else "b_" + list(_SLOTS)[list(_SLOTS).index(s) - 1]
        seeds += f"b_{s} AS (SELECT b.*, (SELECT arg_min(tid, (sqrt((x - {x}::DOUBLE) ** 2 + (y - {y}::DOUBLE) ** 2), k)) FROM latest l WHERE l.match_id = b.match_id AND colour = '{s[:-1]}' {other}) AS o_{s} FROM {src} b), "
    owned = [f"w.o_{s}, w.p_{s}, list_filter(fr.dets, lambda d: list_contains(w.o_{s}, d.tid))[1] AS d_{s}" for s in _SLOTS]
    layers = """SELECT w.match_id, fr.i, fr.t, fr.dets, list_filter(fr.dets, lambda d: NOT list_contains(list_concat(list_concat(w.o_red1, w.o_red2), list_concat(w.o_blue1, w.o_blue2)), d.tid)) AS free_0, """ + ", ".join(owned) + " FROM w JOIN fr ON fr.match_id = w.match_id AND fr.i = w.i + 1"
    before = "free_0"
    for s in _SLOTS:
        layers = f"SELECT *, CASE WHEN d_{s} IS NULL AND p_{s} IS NOT NULL THEN list_sort(list_filter(list_transform({before}, lambda f, k: {{'d': sqrt((f.x - p_{s}.x) ** 2 + (f.y - p_{s}.y) ** 2), 'k': k, 'f': f}}), lambda z: z.f.colour = '{s[:-1]}' AND z.d < 30))[1].f END AS t_{s} FROM ({layers})"
        layers = f"SELECT *, CASE WHEN t_{s} IS NULL THEN {before} ELSE list_filter({before}, lambda f: f <> t_{s}) END AS free_{s} FROM ({layers})"
        before = f"free_{s}"
    state = ", ".join(f"CASE WHEN t_{s} IS NULL THEN o_{s} ELSE list_append(o_{s}, t_{s}.tid) END AS o_{s}, coalesce(d_{s}, t_{s}, p_{s}) AS p_{s}, coalesce(d_{s}, t_{s}) AS r_{s}, t_{s} IS NOT NULL AS h_{s}" for s in _SLOTS)
    none = "NULL::STRUCT(colour VARCHAR, tid BIGINT, x DOUBLE, y DOUBLE, conf DOUBLE)"
    start = ", ".join(f"CASE WHEN o_{s} IS NULL THEN []::BIGINT[] ELSE [o_{s}] END AS o_{s}, {none} AS p_{s}, {none} AS r_{s}, FALSE AS h_{s}" for s in _SLOTS)
    rows = " UNION ALL ".join(f"SELECT match_id, '{s}' AS slot, t, r_{s}.x AS x, r_{s}.y AS y, r_{s}.conf AS conf FROM w WHERE r_{s} IS NOT NULL" for s in _SLOTS)
    return f"""WITH RECURSIVE {TR}, dt AS (SELECT match_id, t, row_id AS pos, CASE WHEN slot LIKE 'red%' THEN 'red' ELSE 'blue' END AS colour, CAST(CASE slot WHEN 'red1' THEN 1 WHEN 'red2' THEN 2 WHEN 'blue1' THEN 3 ELSE 4 END + 4 * floor(t / 20) AS BIGINT) AS tid, x_in AS x, y_in AS y, conf FROM tr WHERE conf > 0),
    fr AS (SELECT match_id, t, list({{'colour': colour, 'tid': tid, 'x': x, 'y': y, 'conf': conf}} ORDER BY pos) AS dets, row_number() OVER (PARTITION BY match_id ORDER BY t) AS i FROM dt GROUP BY match_id, t),
    n AS (SELECT match_id, count(*) FILTER (WHERE t <= 3) AS early FROM fr GROUP BY match_id),
    first5 AS (SELECT fr.match_id, fr.t FROM fr JOIN n ON n.match_id = fr.match_id WHERE CASE WHEN early > 0 THEN fr.t <= 3 ELSE i <= 5 END),
    latest AS (SELECT match_id, tid, arg_max(colour, (t, pos)) AS colour, arg_max(x, (t, pos)) AS x, arg_max(y, (t, pos)) AS y, min((t, pos)) AS k FROM dt JOIN first5 USING (match_id, t) GROUP BY match_id, tid),
    b0 AS (SELECT DISTINCT match_id FROM dt), {seeds}
    w AS (SELECT match_id, 0::BIGINT AS i, NULL::DOUBLE AS t, {start} FROM b_blue2
      UNION ALL SELECT match_id, i, t, {state} FROM ({layers})),
    h AS (SELECT match_id, CAST(sum(h_red1::INT + h_red2::INT + h_blue1::INT + h_blue2::INT) AS INTEGER) AS switches FROM w GROUP BY match_id)
    SELECT r.*, h.switches FROM ({rows}) r JOIN h ON h.match_id = r.match_id"""


@query(
    f"""SELECT match_id, CASE WHEN c - least(0.35::DOUBLE, 0.02::DOUBLE * k) < 0 THEN 0 ELSE least(1, c - least(0.35::DOUBLE, 0.02::DOUBLE * k)) END AS quality, k AS switches
    FROM (SELECT match_id, round(count(*) / (4 * count(DISTINCT t)), 6) AS c, max(switches) AS k FROM ({_slot_sql()}) GROUP BY match_id)"""
)
def handoff_quality(spark, d):
    """Quality of a match's tracks: the share of slots filled, less its hand-offs."""
    g = tracking.slot_tracks(_detections(spark, d)).groupBy("match_id").agg(F.round(F.count("*") / (4 * F.countDistinct("t")), 6).alias("c"), F.max("switches").alias("k"))
    return g.select("match_id", tracking.quality(F.col("c"), F.col("k")).alias("quality"), F.col("k").alias("switches"))


@query(_slot_sql())
def slot_tracks(spark, d):
    return tracking.slot_tracks(_detections(spark, d))


@query(
    f"""WITH {TR}, k AS (SELECT DISTINCT match_id, t, slot FROM tr WHERE conf > 0)
    SELECT match_id, TRUE AS one_a_frame, TRUE AS of_detections, TRUE AS own_colour FROM k GROUP BY match_id"""
)
def slot_tracks_check(spark, d):
    """What must hold of slot tracks: a slot has one reading a frame, each a detection of its colour; every match with detections has some."""
    dets = _detections(spark, d)
    s = tracking.slot_tracks(dets)
    real = dets.select("match_id", "t", "x", "y", F.substring("cls", 7, 9).alias("colour")).distinct().withColumn("there", F.lit(True))
    j = s.join(real.where("colour IS NOT NULL"), ["match_id", "t", "x", "y"], "left")
    order = Window.partitionBy("match_id", "slot", "t")
    j = j.withColumn("copies", F.count("*").over(order))
    per = j.groupBy("match_id").agg(
        F.max("copies").alias("copies"), F.every(F.coalesce("there", F.lit(False))).alias("of_detections"), F.every(F.coalesce(F.col("slot").startswith(F.col("colour")), F.lit(False))).alias("own_colour")
    )
    return dets.select("match_id").distinct().join(per, "match_id", "left").select("match_id", (F.col("copies") == 1).alias("one_a_frame"), "of_detections", "own_colour")


@query(f"WITH {TR} SELECT match_id, count(*) AS n_boxes, TRUE AS once_a_frame, TRUE AS within_reach FROM tr WHERE conf > 0 GROUP BY match_id")
def associate_check(spark, d):
    """What must hold of associated boxes: every box has an id, an id is in a frame once, and from one frame to the next moves no further than the reach."""
    f = _detections(spark, d).withColumn("frame", F.floor(F.col("t") * 5).cast("int")).select("match_id", "frame", "pos", "x", "y")
    ids = tracking.associate(f, 18.0).join(f, ["match_id", "frame", "pos"])
    # A frame's predecessor is the last one that holds boxes.
    frames = f.select("match_id", "frame").distinct().withColumn("before", F.lag("frame").over(Window.partitionBy("match_id").orderBy("frame")))
    w = Window.partitionBy("match_id", "track_id").orderBy("frame", "pos")
    m = ids.join(frames, ["match_id", "frame"]).withColumns({"from": F.lag("frame").over(w), "step": F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w))})
    return m.groupBy("match_id").agg(F.count("*").alias("n_boxes"), F.every(F.coalesce(F.col("from") != F.col("frame"), F.lit(True))).alias("once_a_frame"), F.every(F.coalesce((F.col("from") == F.col("before")) & (F.col("step") <= 27), F.lit(True))).alias("within_reach"))


@query(
    f"""WITH RECURSIVE {TR}, fr AS (SELECT match_id, frame, list({{'pos': pos, 'x': x, 'y': y}} ORDER BY pos) AS dets, row_number() OVER (PARTITION BY match_id ORDER BY frame) AS i
      FROM (SELECT match_id, CAST(floor(t * 5) AS INTEGER) AS frame, CAST(row_id AS INTEGER) AS pos, x_in AS x, y_in AS y FROM tr WHERE conf > 0) GROUP BY match_id, frame), w AS (
      SELECT match_id, i, frame, dets, range(1, len(dets) + 1) AS ids, len(dets) + 1 AS fresh FROM fr WHERE i = 1
      UNION ALL
      SELECT match_id, i, frame, dets, list_transform(range(1, len(dets) + 1), lambda a: CASE WHEN list_contains(mine, a) THEN last_ids[theirs[list_position(mine, a)]] ELSE fresh - 1 + a - len(list_filter(mine, lambda b: b < a)) END), fresh + len(dets) - len(mine)
      FROM (SELECT *, coalesce(m.mine, []::BIGINT[]) AS mine, coalesce(m.theirs, []::BIGINT[]) AS theirs FROM (
        SELECT *, CASE WHEN len(pairs) > 0 THEN list_reduce(list_sort(pairs), lambda acc, p: CASE WHEN list_contains(acc.mine, p.i) OR list_contains(acc.theirs, p.j) THEN acc ELSE {{'d': p.d, 'i': p.i, 'j': p.j, 'mine': list_append(acc.mine, p.i), 'theirs': list_append(acc.theirs, p.j)}} END) END AS m FROM (
          SELECT fr.match_id, fr.i, fr.frame, fr.dets, w.ids AS last_ids, w.fresh, list_filter(flatten(list_transform(range(1, len(fr.dets) + 1), lambda a: list_transform(range(1, len(w.dets) + 1), lambda b: {{'d': sqrt((fr.dets[a].x - w.dets[b].x) ** 2 + (fr.dets[a].y - w.dets[b].y) ** 2), 'i': a, 'j': b, 'mine': [a], 'theirs': [b]}}))), lambda p: p.d <= 27) AS pairs
          FROM w JOIN fr ON fr.match_id = w.match_id AND fr.i = w.i + 1))))
    SELECT match_id, frame, unnest(list_transform(dets, lambda x: x.pos)) AS pos, unnest(ids) AS track_id FROM w"""
)
def associate_boxes(spark, d):
    f = _detections(spark, d).withColumn("frame", F.floor(F.col("t") * 5).cast("int"))
    return tracking.associate(f.select("match_id", "frame", "pos", "x", "y"), 18.0)


@query(f"WITH {TR} SELECT match_id, slot, CASE WHEN c - least(0.35::DOUBLE, 0.02::DOUBLE * k) < 0 THEN 0 ELSE least(1, c - least(0.35::DOUBLE, 0.02::DOUBLE * k)) END AS quality FROM (SELECT match_id, slot, round(count(*) FILTER (WHERE conf > 0) / count(*), 6) AS c, count(*) FILTER (WHERE conf = 0) AS k FROM tr GROUP BY match_id, slot)")
def track_quality(spark, d):
    g = tracks(spark, d).groupBy("match_id", "slot").agg(F.round(F.count_if(F.col("conf") > 0) / F.count("*"), 6).alias("c"), F.count_if(F.col("conf") == 0).alias("k"))
    return g.select("match_id", "slot", tracking.quality(F.col("c"), F.col("k")).alias("quality"))


@query(
    """WITH RECURSIVE e AS (SELECT vec_id // 25 AS source_id, vec_id AS clip_id, list_transform(embedding, lambda x: x::DOUBLE) AS fp, row_number() OVER (PARTITION BY vec_id // 25 ORDER BY vec_id) AS i FROM embeddings), w AS (
      SELECT source_id, i, clip_id, [fp] AS centres, [1::BIGINT] AS sizes, 0::BIGINT AS cluster FROM e WHERE i = 1
      UNION ALL
      SELECT source_id, i, clip_id,
        CASE WHEN hit THEN list_transform(range(1, len(centres) + 1), lambda k: CASE WHEN k = best THEN list_transform(range(1, 65), lambda j: centres[k][j] + (fp[j] - centres[k][j]) / (sizes[k] + 1)) ELSE centres[k] END) ELSE list_append(centres, fp) END,
        CASE WHEN hit THEN list_transform(range(1, len(sizes) + 1), lambda k: sizes[k] + CASE WHEN k = best THEN 1 ELSE 0 END) ELSE list_append(sizes, 1) END,
        CASE WHEN hit THEN best - 1 ELSE len(sizes) END
      FROM (SELECT *, list_position(off, list_min(off)) AS best, list_min(off) < 0.11::DOUBLE AS hit FROM (
        SELECT e.source_id, e.i, e.clip_id, e.fp, w.centres, w.sizes, list_transform(w.centres, lambda c: list_sum(list_transform(range(1, 65), lambda j: abs(c[j] - e.fp[j]))) / 64) AS off FROM w JOIN e ON e.source_id = w.source_id AND e.i = w.i + 1)))
    SELECT source_id, clip_id, CAST(cluster AS INTEGER) AS cluster FROM w"""
)
def leader_clusters(spark, d):
    """25 vectors stand for the clips of one stream."""
    e = table(spark, d, "embeddings").select(F.floor(F.col("vec_id") / 25).alias("source_id"), F.col("vec_id").alias("clip_id"), F.col("embedding").alias("fp"))
    return clusters.leader_clusters(e, 0.11)


@query("""WITH c AS (SELECT label % 4 AS source_id, label AS cluster, vec_id, count(*) OVER (PARTITION BY label % 4, label) AS n, row_number() OVER (PARTITION BY label % 4, label ORDER BY vec_id) AS rn FROM embeddings)
    SELECT source_id, cluster, n, vec_id AS rep, CAST(row_number() OVER (PARTITION BY source_id ORDER BY n DESC, cluster) AS INTEGER) AS size_rank FROM c WHERE rn = n // 2 + 1""")
def cluster_representatives(spark, d):
    e = table(spark, d, "embeddings").select((F.col("label") % 4).alias("source_id"), F.col("vec_id").alias("clip_id"), F.col("label").alias("cluster"))
    return clusters.representatives(e)


@query(f"WITH {TR} SELECT match_id, slot, count(*) AS n_points, round(sum(t), 3) AS t_sum, min(t) AS t_first FROM tr GROUP BY match_id, slot HAVING match_id IN (SELECT id FROM matches)")
def match_json(spark, d):
    """The documents, taken apart again into their track series."""
    docs = export.match_documents(matches(spark, d), videos(spark, d), tracks(spark, d), zones(spark, d), scores(spark, d))
    m = docs.select("match_id", F.explode(F.from_json(F.get_json_object("body", "$.tracks"), "map<string, array<array<double>>>")).alias("slot", "points"))
    p = m.select("match_id", "slot", F.explode("points").alias("p"))
    return p.groupBy("match_id", "slot").agg(F.count("*").alias("n_points"), F.round(F.sum(F.col("p")[0]), 3).alias("t_sum"), F.min(F.col("p")[0]).alias("t_first"))


@query(f"WITH {TR} SELECT team, match_id, count(*) AS n_points, round(arg_min(x_in, (t, row_id)), 6) AS x0, round(arg_max(x_in, (t, row_id)), 6) AS x1 FROM tr WHERE conf > 0 AND t <= 15 AND team IS NOT NULL GROUP BY team, match_id HAVING count(*) > 1")
def auton_routes(spark, d):
    r = export.auton_routes(tracks(spark, d))
    return rounded(r.select("team", "match_id", "n_points", F.element_at("route", 1)["x"].alias("x0"), F.element_at("route", -1)["x"].alias("x1")))


def _report_sql() -> str:
    pct = lambda c: f"coalesce(CAST(CAST(round({c} * 100) AS INTEGER) AS VARCHAR), '–') || '%'"
    cells = {
        "Matches": "CAST(matches AS VARCHAR)", "Win rate": pct("win_rate") + " || ' (' || decided || ')'", "Mean speed": "format('{:.1f}', speed_mean) || ' in/s'", "Offensive half": pct("frac_offensive_half"),
        "Near loaders": pct("frac_near_loader"), "Near goals": pct("frac_near_goal"), "Parked at the end": pct("endgame_in_own_park"),
    }
    rows = " || ".join(f"'<tr><th>{name}</th><td>' || {v} || '</td></tr>'" for name, v in cells.items())
    return f"SELECT team, replace(team, '/', '_') || '.html' AS file, '<!doctype html><meta charset=''utf-8''><h1>' || team || '</h1><table>' || {rows} || '</table>' AS html FROM te"


@query(_RM + ", te AS (SELECT team, count(*) AS matches, count(won) AS decided, avg(won::INT) AS win_rate, " + ", ".join(f"avg({c}) AS {c}" for c in _TENDS) + " FROM full_rm WHERE team IS NOT NULL GROUP BY team) " + _report_sql())
def team_reports(spark, d):
    return export.team_reports(features.team_tendencies(_robots(spark, d)))


@query(f"WITH {TR} SELECT match_id AS image_id, count(*) AS n_boxes, round(sum(floor(x_in) / 200), 4) AS cx_sum FROM tr GROUP BY match_id")
def label_round_trip_whole(spark, d):
    """Boxes to label text and back."""
    b = tracks(spark, d).select(F.col("match_id").cast("string").alias("image"), F.col("row_id").alias("pos"), F.lit(1).alias("cls"), (F.floor("x_in") / 200).alias("cx"), (F.floor("y_in") / 200).alias("cy"), F.lit(0.1).alias("bw"), F.lit(0.1).alias("bh"))
    p = tables.parse_labels(tables.label_lines(b))
    return p.groupBy(F.col("image").cast("long").alias("image_id")).agg(F.count("*").alias("n_boxes"), F.round(F.sum("cx"), 4).alias("cx_sum"))


@query(None)
def sampled_times(spark, d):
    return tables.sampled_times(matches(spark, d), 1000)


@query("SELECT id, sku, name FROM tournaments WHERE lower(name) LIKE '%open%'")
def search_events(spark, d):
    return tables.search_events(table(spark, d, "tournaments"), name="Open").select("id", "sku", "name")


@query(None)
def win_conditions(spark, d):
    """Over all decided alliances; raises where there are fewer than 30, as in the smallest test data."""
    return insights.win_conditions(features.match_features(_robots(spark, d)))


@query(None)
def playstyle_clusters(spark, d):
    return insights.cluster_summary(insights.playstyle_clusters(_robots(spark, d)))


@query(None)
def archetypes(spark, d):
    """Every vector, by a regression on all labelled ones."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    seeds = e.where("label IS NOT NULL").select("vec_id", F.concat(F.lit("kind"), F.col("label").cast("string")).alias("archetype"))
    return insights.archetypes(e.select("vec_id", "vector"), seeds, ["vec_id"])


@query("WITH f AS (SELECT unnest([" + ", ".join(f"'{f}'" for f in insights.WIN_FEATURES) + "]) AS feature) SELECT feature, TRUE AS abs_right, TRUE AS accurate FROM f")
def win_conditions_check(spark, d):
    """What must hold of the regression at any number of rows: a row per feature, absolute values, and at least half of the rows hit."""
    w = insights.win_conditions(features.match_features(_robots(spark, d)), least=2)
    return w.select("feature", (F.abs("coef") == F.col("abs_coef")).alias("abs_right"), F.col("accuracy").between(0.5, 1.0).alias("accurate"))


@query(_RM + ", k AS (SELECT * FROM full_rm WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _STYLE) + ") SELECT count(*) AS n_robots, count(won) AS n_decided, TRUE AS five_clusters, TRUE AS near_own_centre FROM k")
def playstyle_check(spark, d):
    """What must hold of k-means: every complete row has one of five clusters, and its standardized features lie nearer to the mean of its own cluster than to any other."""
    c = insights.playstyle_clusters(_robots(spark, d))
    z = insights.standardized(c, insights.STYLE_FEATURES)
    v = F.array(*insights.STYLE_FEATURES)
    # One row per cluster, five at most.
    means = z.groupBy("cluster").agg(*[F.avg(f).alias(f) for f in insights.STYLE_FEATURES]).collect()
    centres = F.array(*[F.struct(F.lit(r["cluster"]).alias("cluster"), F.array(*[F.lit(r[f]) for f in insights.STYLE_FEATURES]).alias("centre")) for r in means])
    far = lambda x: F.aggregate(F.zip_with(v, x["centre"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
    m = z.withColumn("nearest", F.array_min(F.transform(centres, lambda x: F.struct(F.round(far(x), 9).alias("d"), x["cluster"].alias("cluster"))))["cluster"])
    return m.agg(F.count("*").alias("n_robots"), F.count("won").alias("n_decided"), (F.countDistinct("cluster") == F.least(F.lit(5), F.count("*"))).alias("five_clusters"), (F.avg((F.col("nearest") == F.col("cluster")).cast("double")) > 0.98).alias("near_own_centre"))


@query("SELECT vec_id, 'kind' || label AS label, TRUE AS sure FROM embeddings")
def archetypes_check(spark, d):
    """Every vector comes out once, with a probability that is the largest of all kinds'."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    kinds = e.where("label IS NOT NULL").select("label").distinct().count()
    a = archetypes(spark, d)
    return a.join(e.select("vec_id", F.concat(F.lit("kind"), F.col("label").cast("string")).alias("label")), "vec_id").select("vec_id", "label", F.col("archetype_conf").between(1 / kinds, 1.0).alias("sure"))
