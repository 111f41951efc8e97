"""Queries of frame sampling, overlay and card parsing, calibration, labels, incremental work and small helpers, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import parsing as ps
from ..game import PUSHBACK
from ..operators import clusters, export, features, ingest, insights, overlay, quantiles, segment, store, tracking
from ..runtime import scratch, table
from ..sources import tables
from .base import MA, SC, TR, VI, matches, query, r6, rounded, scores, tracks, videos


# Frame sampling.


@query(f"WITH {VI} SELECT id, CASE WHEN fps <> 0 THEN round(width / fps, 6) END AS duration_s FROM vi")
def probe_duration(spark, d):
    """Widths stand for numbers of frames."""
    return rounded(videos(spark, d).select("id", ingest.duration(F.col("width"), F.col("fps")).alias("duration_s")))


_SPANS = "sp AS (SELECT ma.id, video_start_ts AS s, video_end_ts AS e, fps FROM ma JOIN vi ON vi.id = ma.video_id WHERE fps > 0 AND video_end_ts > video_start_ts)"


def _spans(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), "fps")
    return matches(spark, d).join(v, "video_id").select("id", F.col("video_start_ts").alias("start_ts"), F.col("video_end_ts").alias("end_ts"), "fps")


@query(
    f"""WITH {MA}, {VI}, {_SPANS}, st AS (SELECT *, greatest(1, CAST(round_even(fps / 5, 0) AS INTEGER)) AS step, CAST(ceil((e - s) * fps - 1e-9) AS INTEGER) - 1 AS n FROM sp)
    SELECT id, CAST(k AS INTEGER) AS frame, round(s + k / fps, 6) AS ts FROM st, LATERAL (SELECT unnest(range(0, n + 1, step)) AS k)"""
)
def stride_frames(spark, d):
    return rounded(ingest.stride_times(_spans(spark, d), ["id"]))


@query(f"WITH {VI} SELECT id, CAST(k AS INTEGER) AS k, k * 30.0::DOUBLE AS ts FROM vi, LATERAL (SELECT unnest(range(0, CAST(ceil(duration_s / 30 - 1e-9) AS INTEGER))) AS k) WHERE duration_s > 0")
def period_frames(spark, d):
    return ingest.period_times(videos(spark, d), ["id"], 30.0)


@query(f"WITH {MA}, done AS (SELECT * FROM ma WHERE video_end_ts IS NOT NULL AND video_start_ts IS NOT NULL) SELECT id AS match_id, greatest(1, 1000 // (SELECT count(*) FROM done)) AS n_frames, TRUE AS inside, TRUE AS known_split FROM done")
def sampled_times_check(spark, d):
    """What must hold of the drawn times, whatever the draw: as many per match, within its span, of a known split."""
    m = matches(spark, d)
    s = tables.sampled_times(m, 1000).join(m.select(F.col("id").alias("match_id"), F.least("video_start_ts", "video_end_ts").alias("a"), F.greatest("video_start_ts", "video_end_ts").alias("z")), "match_id")
    return s.groupBy("match_id").agg(F.count("*").alias("n_frames"), F.every(F.col("ts").between(F.col("a"), F.col("z"))).alias("inside"), F.every(F.col("split").isin("train", "val")).alias("known_split"))


_LOST = "ls AS (SELECT DISTINCT match_id, t, CAST(floor(t / 7) AS BIGINT) % 3 = 0 AS lost FROM sc WHERE match_id IS NOT NULL)"


@query(
    f"""WITH RECURSIVE {SC}, {_LOST}, o AS (SELECT match_id, t, lost, row_number() OVER (PARTITION BY match_id ORDER BY t) AS i FROM ls), w AS (
      SELECT match_id, i, t AS at, TRUE AS hit, t FROM o WHERE i = 1
      UNION ALL SELECT o.match_id, o.i, CASE WHEN lost AND o.t - w.at >= 5 THEN o.t ELSE w.at END, lost AND o.t - w.at >= 5, o.t FROM w JOIN o ON o.match_id = w.match_id AND o.i = w.i + 1)
    SELECT 'v' || match_id AS video_id, t AS video_ts FROM w WHERE hit"""
)
def full_passes(spark, d):
    """Score readings as samples, the timer lost in every third stretch of seven seconds."""
    s = scores(spark, d).where("match_id IS NOT NULL").select(F.concat(F.lit("v"), "match_id").alias("video_id"), F.col("t").alias("video_ts"), F.when(F.floor(F.col("t") / 7) % 3 != 0, 1).alias("timer")).distinct()
    return ingest.full_passes(s)


@query(
    f"""WITH {SC}, one AS (SELECT DISTINCT match_id, t FROM sc WHERE match_id IS NOT NULL)
    SELECT 'v' || match_id AS video_id, t AS video_ts, last_value(CASE WHEN CAST(floor(t) AS BIGINT) % 4 = 0 THEN floor(t) END IGNORE NULLS) OVER w AS label_x, last_value(CASE WHEN CAST(floor(t) AS BIGINT) % 9 = 0 THEN floor(t) END IGNORE NULLS) OVER w AS panel_x
    FROM one WINDOW w AS (PARTITION BY match_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def region_carry(spark, d):
    s = scores(spark, d).where("match_id IS NOT NULL").select("match_id", "t").distinct()
    sec = F.floor("t")
    box = lambda every: F.when(sec % every == 0, F.struct(sec.cast("double").alias("x0")))
    r = ingest.carry_regions(s.select(F.concat(F.lit("v"), "match_id").alias("video_id"), F.col("t").alias("video_ts"), F.struct(sec.alias("x0")).alias("timer"), box(4).alias("label"), box(9).alias("panel")))
    return r.select("video_id", "video_ts", F.col("label.x0").alias("label_x"), F.col("panel.x0").alias("panel_x"))


# Overlay texts.


def _boxes(rows, frame, entries, w=1280, h=720):
    """Text boxes of one frame per row. entries: (region, text column, x0, y0, x1, y1)."""
    boxes = F.array(*[F.struct(F.lit(r).alias("region"), t.alias("text"), *[F.lit(float(v)).alias(n) for v, n in zip(b, ("x0", "y0", "x1", "y1"))]) for r, t, *b in entries])
    e = rows.select(*[c.alias(n) for c, n in zip(frame, ("video_id", "video_ts"))], F.posexplode(boxes).alias("pos", "b")).where("b.text IS NOT NULL")
    return e.select("video_id", "video_ts", "b.region", "pos", "b.text", F.lit(0.9).alias("conf"), "b.x0", "b.y0", "b.x1", "b.y1", F.lit(w).alias("w"), F.lit(h).alias("h"))


#: Digits as recognition confuses them, by the place of the reading.
_FORMS = [("0", "o", "O"), ("1", "l", "I"), ("5", "S", "S"), ("8", "B", "B")]


@query(
    f"""WITH {SC} SELECT row_id, CASE WHEN t < 120 THEN 120 - CAST(ceil(t) AS INTEGER) END AS timer FROM sc WHERE t > 0"""
)
def timer_confusions(spark, d):
    """Countdown texts with every letter that stands for a digit, by row; later ones show no valid time."""
    left = (F.lit(120) - F.ceil("t")).cast("int")
    text = F.concat(F.floor(left / 60).cast("string"), F.element_at(F.array(F.lit(":"), F.lit(";"), F.lit(".")), (F.col("row_id") % 3 + 1).cast("int")), F.lpad((left % 60).cast("string"), 2, "0"))
    for k, (digit, low, high) in enumerate(_FORMS):
        form = F.when(F.col("row_id") % (k + 2) == 0, F.lit(low)).when(F.col("row_id") % (k + 3) == 0, F.lit(high)).otherwise(F.lit(digit))
        text = F.replace(text, F.lit(digit), form)
    shown = F.when(F.col("t") < 120, F.when(text.rlike(r"^[0-2oOlI]"), text)).otherwise(F.lit("3:00"))
    return scores(spark, d).where("t > 0").select("row_id", ps.timer(F.concat(F.lit(" "), shown, F.lit(" "))).alias("timer"))


_NAMES = ["QUALIFICATION 7", "qual#7", "Q 7", "ROUND OF 16 7-2", "r16 7 - 2", "Quarterfinal 7-1", "QF 7", "SEMIFINAL #7 - 3", "sf7", "FINAL 7", "Practice 7", "P 7", "UP NEXT: FINAL 7", "TIME 1:45", "FINALIST 7", ""]
_SHORT = ["Q7", "Q7", "Q7", "R167-2", "R167-2", "QF7-1", "QF7", "SF7-3", "SF7", "F7", "P7", None, None, None, None, None]


@query("WITH f AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _NAMES) + "]) AS text, unnest([" + ", ".join(f"'{x}'" if x else "NULL" for x in _SHORT) + "]) AS name, unnest(range(0, 16)) AS k) SELECT event_id AS id, replace(f.name, '7', CAST(event_id % 90 + 10 AS VARCHAR)) AS name FROM events JOIN f ON f.k = event_id % 16")
def match_label_forms(spark, d):
    """Labels of every round in several spellings, previews and texts that are none, with the number of each row."""
    text = F.element_at(F.array(*[F.lit(x) for x in _NAMES]), (F.col("event_id") % 16 + 1).cast("int"))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), ps.match_label(F.replace(text, F.lit("7"), (F.col("event_id") % 90 + 10).cast("string"))).alias("name"))


@query(f"WITH {SC}, s AS (SELECT match_id, t FROM sc WHERE match_id IS NOT NULL GROUP BY match_id, t) SELECT 'v' || match_id AS video_id, t AS video_ts, CASE WHEN CAST(floor(t) AS BIGINT) % 5 = 0 THEN NULL WHEN CAST(floor(t) AS BIGINT) % 5 = 4 THEN 'driver' WHEN t <= 15 THEN 'auton' ELSE 'driver' END AS phase_text FROM s")
def phase_of_frames(spark, d):
    """Of the phase texts of a frame the last counts; every fifth second shows none, every fifth both."""
    s = scores(spark, d).where("match_id IS NOT NULL").select("match_id", "t").distinct()
    k = F.floor("t") % 5
    first = F.when(k == 4, "Autonomous").when(k != 0, F.when(F.col("t") <= 15, "AUTONOMOUS").otherwise("Driver Control"))
    b = _boxes(s, (F.concat(F.lit("v"), F.col("match_id").cast("string")), F.col("t")), [("timer", first, 0, 0, 10, 10), ("timer", F.when(k == 4, F.lit("DRIVER CONTROL")), 0, 10, 10, 20), ("timer", F.lit("1:00"), 0, 20, 10, 30)])
    return overlay.samples(b).select("video_id", "video_ts", "phase_text")


def _ocr_full(spark, d):
    """A whole frame per second of every timeline; every third shows no label, every fifth no blue header."""
    s = scores(spark, d).where("match_id IS NOT NULL AND t >= 0").select("match_id", F.floor("t").cast("long").alias("s")).distinct()
    k = F.col("s")
    entries = [
        ("full", F.lit("SPONSOR"), 5, 5, 50, 15), ("full", F.concat(F.floor(k % 120 / 60).cast("string"), F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0")), 600, 10, 680, 30),
        ("full", F.when(k % 3 != 0, F.concat(F.lit("QUAL "), F.col("match_id").cast("string"))), 610, 40, 670, 52), ("full", F.lit("Red Alliance"), 900, 100, 1000, 120), ("full", F.when(k % 5 != 0, F.lit("BLUE ALLIANCE")), 880, 300, 1000, 320),
    ]
    return _boxes(s, (F.concat(F.lit("v"), F.col("match_id").cast("string")), k.cast("double")), entries)


@query(
    f"""WITH {SC}, s AS (SELECT DISTINCT match_id, CAST(floor(t) AS BIGINT) AS k FROM sc WHERE match_id IS NOT NULL AND t >= 0)
    SELECT 'v' || match_id AS video_id, CAST(k AS DOUBLE) AS video_ts, 576 AS timer_x0, 0 AS timer_y0, 704 AS timer_x1, 42 AS timer_y1,
    CASE WHEN k % 3 <> 0 THEN 586 END AS label_x0, CASE WHEN k % 3 <> 0 THEN 36 END AS label_y0, CASE WHEN k % 3 <> 0 THEN 694 END AS label_x1, CASE WHEN k % 3 <> 0 THEN 55 END AS label_y1,
    CASE WHEN k % 5 <> 0 THEN CAST(trunc(880 - 0.02::DOUBLE * 1280) AS INTEGER) END AS panel_x0, CASE WHEN k % 5 <> 0 THEN CAST(trunc(100 - 0.02::DOUBLE * 720) AS INTEGER) END AS panel_y0, CASE WHEN k % 5 <> 0 THEN 1280 END AS panel_x1, CASE WHEN k % 5 <> 0 THEN 720 END AS panel_y1
    FROM s"""
)
def located_regions(spark, d):
    r = overlay.locate(_ocr_full(spark, d))
    return r.select("video_id", "video_ts", *[F.col(f"{g}.{c}").alias(f"{g}_{c}") for g in ("timer", "label", "panel") for c in ("x0", "y0", "x1", "y1")])


_CARDS = "cd AS (SELECT id, abs(id) % 90 + 10 AS num, coalesce(red_score, ocr_red_score) AS r, coalesce(blue_score, ocr_blue_score) AS b FROM ma), ok AS (SELECT * FROM cd WHERE r BETWEEN 0 AND 400 AND b BETWEEN 0 AND 400)"


def _card_boxes(spark, d):
    """A result card per match with both scores, shown twice; the second showing has other scores."""
    m = matches(spark, d).select("id", F.coalesce("red_score", "ocr_red_score").alias("r"), F.coalesce("blue_score", "ocr_blue_score").alias("b")).where("r BETWEEN 0 AND 400 AND b BETWEEN 0 AND 400")
    m = m.withColumn("show", F.explode(F.array(F.lit(0), F.lit(1))))
    num, text = F.abs("id") % 90 + 10, lambda c: c.cast("string")
    entries = [
        ("full", F.concat(F.lit("Qualification "), text(num)), 600, 20, 700, 40), ("full", F.lit("Blocks Scored"), 560, 300, 720, 320), ("full", text(F.col("r") % 60), 400, 300, 430, 320), ("full", text(F.col("b") % 60), 800, 300, 830, 320),
        ("full", F.lit("Parked Robots"), 560, 350, 720, 370), ("full", text(num % 3), 400, 350, 430, 370), ("full", text(F.col("r") + F.col("show")), 100, 200, 200, 290), ("full", text(F.col("b") + F.col("show")), 1000, 200, 1100, 290),
        ("full", F.concat(text(num), F.lit("A rank 3")), 100, 600, 200, 620), ("full", F.concat(text(num), F.lit("B")), 1000, 600, 1100, 620),
    ]
    return _boxes(m, (F.concat(F.lit("c"), text(F.col("id"))), F.col("show").cast("double")), entries)


def _cards(spark, d):
    return overlay.result_cards(_card_boxes(spark, d))


@query(
    f"""WITH {MA}, {_CARDS} SELECT 'c' || id AS video_id, CAST(k AS DOUBLE) AS video_ts, 'Q' || num AS match_name, CAST(r + k AS INTEGER) AS red_score, CAST(b + k AS INTEGER) AS blue_score, CAST(r % 60 AS INTEGER) AS red_blocks, CAST(b % 60 AS INTEGER) AS blue_blocks,
    CAST(num % 3 AS INTEGER) AS red_parked, num || 'A' AS red_team, num || 'B' AS blue_team FROM ok, (SELECT unnest([0, 1]) AS k)"""
)
def result_cards(spark, d):
    c = _cards(spark, d)
    return c.select(
        "video_id", "video_ts", "match_name", "red_score", "blue_score", F.col("breakdown")["blocks"]["red"].alias("red_blocks"), F.col("breakdown")["blocks"]["blue"].alias("blue_blocks"), F.col("breakdown")["parked"]["red"].alias("red_parked"),
        F.col("red_teams")[0].alias("red_team"), F.col("blue_teams")[0].alias("blue_team"),
    )


@query(f"WITH {MA}, {_CARDS} SELECT 'c' || id AS video_id, 'Q' || num AS match_name, CAST(r AS INTEGER) AS red_score, CAST(b AS INTEGER) AS blue_score FROM ok")
def card_dedupe(spark, d):
    """Of the showings of one card in a video the first."""
    return ingest.first_cards(_cards(spark, d)).select("video_id", "match_name", "red_score", "blue_score")


@query(
    f"""WITH {MA}, {_CARDS}, one AS (SELECT 'Q' || num AS k, arg_max(r, id) AS card_red, arg_max(b, id) AS card_blue FROM ok GROUP BY 1)
    SELECT ma.id, CAST(coalesce(card_red, red_score) AS INTEGER) AS red, CAST(coalesce(card_blue, blue_score) AS INTEGER) AS blue FROM ma LEFT JOIN one ON one.k = upper(regexp_replace(coalesce(name, ''), '\\s+', '', 'g'))"""
)
def card_join(spark, d):
    """Matches with the last card of their name, whose scores count before theirs."""
    cards = ingest.first_cards(_cards(spark, d)).withColumn("pos", F.substring("video_id", 2, 99).cast("long"))
    j = segment.join_cards(matches(spark, d).select("id", "name", "red_score", "blue_score"), cards, ps.canon(F.col("match_name")))
    return j.select("id", F.coalesce("card_red", "red_score").alias("red"), F.coalesce("card_blue", "blue_score").alias("blue"))


# Calibration.


@query(f"WITH {MA} SELECT id, 1.5::DOUBLE AS h0, CAST(id % 7 AS DOUBLE) AS h2, -0.25::DOUBLE AS h3, id / 4.0::DOUBLE AS h5, CASE WHEN id % 5 = 0 THEN NULL ELSE 1.0::DOUBLE END AS h8 FROM ma WHERE id % 5 <> 0 UNION ALL SELECT id, NULL, NULL, NULL, NULL, NULL FROM ma WHERE id % 5 = 0")
def homography_json(spark, d):
    """Homographies written as JSON and read back; every fifth text lacks a number and gives none."""
    h = F.array(F.lit(1.5), F.lit(0.0), (F.col("id") % 7).cast("double"), F.lit(-0.25), F.lit(1.0), F.col("id") / 4, F.lit(0.0), F.lit(0.001), F.lit(1.0))
    text = geo.homography_text(h)
    broken = F.when(F.col("id") % 5 == 0, F.regexp_replace(text, ",[^,]*]$", "]")).otherwise(text)
    m = matches(spark, d).withColumn("h", geo.homography_of(broken))
    return m.select("id", *[F.col("h")[k].alias(f"h{k}") for k in (0, 2, 3, 5, 8)])


# Pixels to the field: x = 0.1 u + 5, y = 0.2 v + k with a perspective that depends on the match.
_BACK = "(SELECT id, CAST(id % 7 AS DOUBLE) AS k FROM ma)"


def _scaled(spark, d):
    k = (F.col("id") % 7).cast("double")
    return matches(spark, d).select("id", F.array(F.lit(0.1), F.lit(0.0), F.lit(5.0), F.lit(0.0), F.lit(0.2), k, F.lit(0.0), F.lit(0.0005), F.lit(1.0)).alias("h"))


def _pixel(x: str, y: str) -> tuple[str, str]:
    """The pixel of a field point, solved by hand: v from y (1 + p v) = 0.2 v + k, u from x (1 + p v) = 0.1 u + 5."""
    v = f"(({y}) - k) / (0.2::DOUBLE - 0.0005::DOUBLE * ({y}))"
    return f"((({x}) * (1 + 0.0005::DOUBLE * {v}) - 5) / 0.1::DOUBLE)", f"({v})"


def _gap(a: tuple[str, str], b: tuple[str, str]) -> str:
    return f"sqrt(({a[0]} - {b[0]}) ** 2 + ({a[1]} - {b[1]}) ** 2)"


@query(f"WITH {MA} SELECT id, round(({_gap(_pixel('60', '50'), _pixel('64', '50'))} + {_gap(_pixel('60', '50'), _pixel('60', '54'))}) / 2, 6) AS block_px, round({_gap(_pixel('70.2', '70.2'), _pixel('88.2', '70.2'))}, 6) AS robot_px FROM {_BACK}")
def pixel_scales(spark, d):
    return rounded(_scaled(spark, d).select("id", geo.block_scale(F.col("h"), F.lit(60.0), F.lit(50.0)).alias("block_px"), geo.robot_scale(PUSHBACK, F.col("h")).alias("robot_px")))


@query(f"WITH {TR} SELECT row_id, round((floor(x_in) * 2 + 9) / 2, 6) AS foot_x, round(floor(y_in) + 12, 6) AS foot_y FROM tr")
def ground_contact(spark, d):
    x, y = F.floor("x_in"), F.floor("y_in")
    fx, fy = geo.ground_contact(x, x + 9, y + 12)
    return rounded(tracks(spark, d).select("row_id", fx.cast("double").alias("foot_x"), fy.cast("double").alias("foot_y")))


_FOOT = "ft AS (SELECT row_id, floor(x_in * 12) - 60 + 4.5::DOUBLE AS u, floor(y_in * 6) + 12 AS v FROM tr), pr AS (SELECT row_id, (0.1::DOUBLE * u + 5) / (1 + 0.0005::DOUBLE * v) AS gx, (0.2::DOUBLE * v + 3) / (1 + 0.0005::DOUBLE * v) AS gy FROM ft)"


@query(f"WITH {TR}, {_FOOT} SELECT row_id, round(greatest(0, least(140.4::DOUBLE, gx)), 6) AS x, round(greatest(0, least(140.4::DOUBLE, gy)), 6) AS y FROM pr WHERE gx BETWEEN -6 AND 146.4::DOUBLE AND gy BETWEEN -6 AND 146.4::DOUBLE")
def field_positions(spark, d):
    """Boxes in pixels to places on the field; those far out are dropped, those just out cut to it."""
    x0, y0 = F.floor(F.col("x_in") * 12) - 60, F.floor(F.col("y_in") * 6)
    h = F.array(*[F.lit(v) for v in (0.1, 0.0, 5.0, 0.0, 0.2, 3.0, 0.0, 0.0005, 1.0)])
    t = tracks(spark, d).select("row_id", x0.cast("double").alias("x0"), (x0 + 9).cast("double").alias("x1"), (y0 + 12).cast("double").alias("y1"), h.alias("h"))
    return rounded(tracking.field_positions(t).select("row_id", "x", "y"))


_BLOB = "bl AS (SELECT row_id, CAST(row_id % 41 AS DOUBLE) + 1 AS w, CAST(row_id % 29 AS DOUBLE) + 1 AS h, CAST(row_id % 301 AS DOUBLE) AS area FROM tr)"


@query(f"WITH {TR}, {_BLOB} SELECT row_id, greatest(w, h) BETWEEN 0.4 * 12 AND 2.5 * 12 AND area >= 0.15 * 144 AND greatest(w, h) / greatest(1, least(w, h)) <= 2.5 AS block, greatest(w, h) BETWEEN 0.35 * 20 AND 1.8 * 20 AND area >= 0.15 * 400 AS robot FROM bl")
def blob_shapes(spark, d):
    b = tracks(spark, d).select("row_id", (F.col("row_id") % 41 + 1.0).alias("w"), (F.col("row_id") % 29 + 1.0).alias("h"), (F.col("row_id") % 301).cast("double").alias("area"))
    return b.select("row_id", geo.block_sized(F.col("w"), F.col("h"), F.col("area"), F.lit(12.0)).alias("block"), geo.robot_sized(F.col("w"), F.col("h"), F.col("area"), F.lit(20.0)).alias("robot"))


@query(
    """WITH q AS (SELECT event_id AS id, event_id % 2 = 0 AS red_left, unnest([0, 1, 2, 3]) AS i, unnest([event_id * 7 % 101, event_id * 11 % 103, event_id * 13 % 107, event_id * 17 % 109]) AS x, unnest([event_id * 19 % 113, event_id * 23 % 127, event_id * 29 % 131, event_id * 31 % 137]) AS y FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY y, i) AS by_y FROM q), s AS (SELECT *, by_y <= 2 AS far, row_number() OVER (PARTITION BY id, by_y <= 2 ORDER BY x, i) AS side FROM r),
    p AS (SELECT *, CASE WHEN red_left THEN CASE WHEN far THEN 5 - side ELSE side END ELSE CASE WHEN far THEN 2 + side ELSE 3 - side END END AS place FROM s)
    SELECT id, CAST(max(x) FILTER (WHERE place = 1) AS DOUBLE) AS x1, CAST(max(y) FILTER (WHERE place = 1) AS DOUBLE) AS y1, CAST(max(x) FILTER (WHERE place = 2) AS DOUBLE) AS x2, CAST(max(x) FILTER (WHERE place = 3) AS DOUBLE) AS x3, CAST(max(y) FILTER (WHERE place = 4) AS DOUBLE) AS y4 FROM p GROUP BY id"""
)
def corner_order(spark, d):
    e = F.col("event_id")
    point = lambda a, m, b, n: F.struct((e * a % m).cast("double").alias("x"), (e * b % n).cast("double").alias("y"))
    quad = F.array(point(7, 101, 19, 113), point(11, 103, 23, 127), point(13, 107, 29, 131), point(17, 109, 31, 137))
    c = table(spark, d, "events").select(e.alias("id"), geo.ordered_corners(quad, e % 2 == 0).alias("c"))
    return c.select("id", F.col("c")[0]["x"].alias("x1"), F.col("c")[0]["y"].alias("y1"), F.col("c")[1]["x"].alias("x2"), F.col("c")[2]["x"].alias("x3"), F.col("c")[3]["y"].alias("y4"))


_CLIPS = "cl AS (SELECT label % 4 AS source_id, vec_id AS clip_id, CASE WHEN vec_id % 12 = 0 THEN 1000 + vec_id // 24 ELSE label END AS cluster, embedding FROM embeddings)"


@query(
    f"""WITH {_CLIPS}, n AS (SELECT *, count(*) OVER (PARTITION BY source_id, cluster) AS n, row_number() OVER (PARTITION BY source_id, cluster ORDER BY clip_id) AS rn FROM cl),
    ce AS (SELECT source_id, cluster, i, avg(embedding[i]::DOUBLE) AS v FROM n, range(1, 65) AS r(i) WHERE n >= 3 AND rn <= 3 GROUP BY source_id, cluster, i), cv AS (SELECT source_id, cluster, list(v ORDER BY i) AS v FROM ce GROUP BY source_id, cluster),
    near AS (SELECT n.source_id, n.clip_id, cv.cluster, list_sum(list_transform(range(1, 65), lambda i: abs(embedding[i]::DOUBLE - v[i]))) / 64 AS off FROM n JOIN cv ON cv.source_id = n.source_id WHERE n < 3),
    best AS (SELECT source_id, clip_id, cluster FROM near WHERE off < 0.2 QUALIFY row_number() OVER (PARTITION BY source_id, clip_id ORDER BY off, cluster) = 1)
    SELECT n.source_id, n.clip_id, n.cluster, CASE WHEN n >= 3 THEN n.cluster ELSE best.cluster END AS calibrated_as FROM n LEFT JOIN best ON best.source_id = n.source_id AND best.clip_id = n.clip_id"""
)
def calibration_plan(spark, d):
    """Large clusters by label, and pairs and single clips that look for the nearest of them."""
    v = F.col("vec_id")
    cluster = F.when(v % 12 == 0, 1000 + F.floor(v / 24)).otherwise(F.col("label").cast("long"))
    e = table(spark, d, "embeddings").select((F.col("label") % 4).alias("source_id"), v.alias("clip_id"), cluster.alias("cluster"), F.col("embedding").alias("fp"))
    return clusters.calibration_plan(e, within=0.2)


# Labels and files.


@query(f"WITH {TR} SELECT match_id, count(*) AS n, round(sum((floor(x_in) / 200 - 0.05) * 100), 3) AS left_sum, round(sum((floor(y_in) / 200 - 0.05) * 100), 3) AS top_sum, count(*) FILTER (WHERE row_id % 4 = 2) AS block_reds FROM tr GROUP BY match_id")
def label_tasks(spark, d):
    """Boxes to labelling tasks as JSON, and read again."""
    b = tracks(spark, d).select(F.col("match_id").cast("string").alias("image"), F.col("row_id").alias("pos"), (F.col("row_id") % 4).cast("int").alias("cls"), (F.floor("x_in") / 200).alias("cx"), (F.floor("y_in") / 200).alias("cy"), F.lit(0.1).alias("bw"), F.lit(0.1).alias("bh"))
    kind = "data struct<image: string>, predictions array<struct<result: array<struct<x: double, y: double, width: double, height: double, rectanglelabels: array<string>>>>>"
    t = tables.label_tasks(b, PUSHBACK.classes).select(F.from_json("task", kind).alias("t")).select(F.col("t.data.image").cast("long").alias("match_id"), F.explode(F.col("t.predictions")[0]["result"]).alias("r"))
    return t.groupBy("match_id").agg(F.count("*").alias("n"), F.round(F.sum("r.x"), 3).alias("left_sum"), F.round(F.sum("r.y"), 3).alias("top_sum"), F.count_if(F.col("r.rectanglelabels")[0] == "block_red").alias("block_reds"))


@query(f"WITH {MA} SELECT 'm' || id || '.jpg' AS image, 'block_red' AS class, CAST(id % 90 AS DOUBLE) AS x, CAST(id % 80 AS DOUBLE) AS y, 5.0::DOUBLE AS width, 2.5::DOUBLE AS height FROM ma WHERE id % 3 <> 0")
def finished_annotations(spark, d):
    """Completions of a labelling tool, a third of them cancelled."""
    i = F.col("id")
    value = F.struct((i % 90).cast("double").alias("x"), (i % 80).cast("double").alias("y"), F.lit(5.0).alias("width"), F.lit(2.5).alias("height"), F.array(F.lit("block_red")).alias("rectanglelabels"))
    m = matches(spark, d)
    done = m.select(i.alias("task_id"), (i % 3 == 0).cast("int").alias("was_cancelled"), F.to_json(F.array(F.struct(value.alias("value")))).alias("result"))
    return tables.finished_annotations(done, m.select("id", F.to_json(F.struct(F.concat(F.lit("m"), i.cast("string"), F.lit(".jpg")).alias("image"))).alias("data")))


@query(f"WITH {MA} SELECT 'm' || id || '.jpg' AS image FROM ma WHERE id % 4 <> 0")
def unlabelled_images(spark, d):
    m = matches(spark, d).select("id", F.concat(F.lit("m"), F.col("id").cast("string"), F.lit(".jpg")).alias("image"))
    return tables.pending_images(m.select("image"), m.where("id % 4 = 0").select("image"))


@query("SELECT '" + tables.label_config(PUSHBACK.classes).replace("'", "''") + "' AS config, length('path: /data\ntrain: images/train\nval: images/val\nnames:\n  0: robot_red\n  1: robot_blue\n  2: block_red\n  3: block_blue\n') AS yaml_length")
def label_config(spark, d):
    row = (tables.label_config(PUSHBACK.classes), len(tables.dataset_yaml("/data", PUSHBACK.classes)))
    return spark.createDataFrame([row], "config string, yaml_length long")


@query(
    f"""WITH {MA}, {VI}, {TR}, {SC} SELECT 'matches' AS name, count(*) AS n, count(video_end_ts) AS filled FROM ma UNION ALL SELECT 'score_timeline', count(*), count(red_score) FROM sc UNION ALL SELECT 'robot_tracks', count(*), count(team) FROM tr
    UNION ALL SELECT 'events', 0, 0 UNION ALL SELECT 'videos', 0, 0 UNION ALL SELECT 'calibrations', 0, 0 UNION ALL SELECT 'zone_states', 0, 0 UNION ALL SELECT 'team_robots', 0, 0"""
)
def store_round_trip(spark, d):
    """Tables exported and opened again as a store: those with rows are there with their columns, the others empty."""
    path = scratch(spark, "store")
    kept = {"matches": matches(spark, d), "score_timeline": scores(spark, d), "robot_tracks": tracks(spark, d)}
    tables.export_tables({k: tables.conform(v, k) for k, v in kept.items()}, path)
    filled = {"matches": "video_end_ts", "score_timeline": "red_score", "robot_tracks": "team"}
    out = None
    for name, df in tables.open_store(spark, path).items():
        n = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.count(filled[name]).alias("filled") if name in filled else F.lit(0).cast("long").alias("filled"))
        out = n if out is None else out.union(n)
    return out


@query(f"WITH {MA} SELECT id AS match_id, name FROM ma")
def documents_round_trip(spark, d):
    """A JSON document per match in few files, and read again."""
    path = scratch(spark, "documents")
    docs = matches(spark, d).select(F.col("id").alias("match_id"), F.to_json(F.struct("name")).alias("body"))
    tables.pack_documents(docs, path, 4)
    return spark.read.parquet(path).select("match_id", F.get_json_object("body", "$.name").alias("name"))


@query("SELECT 'parquet' AS kind, TRUE AS listed, TRUE AS sized")
def file_listing(spark, d):
    """The files of a written table by pattern, without their contents."""
    path = scratch(spark, "files")
    table(spark, d, "nation").repartition(3).write.parquet(path)
    f = tables.list_files(spark, path, "*.parquet")
    return f.agg(F.lit("parquet").alias("kind"), F.count("*").between(1, 3).alias("listed"), F.every(F.col("size") > 0).alias("sized"))


# Small helpers.


@query("SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS d, event_type || '_x' AS file, '00_10_' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS section FROM events")
def url_and_names(spark, d):
    i, n = F.col("event_id"), F.col("event_id").cast("string")
    url = F.concat(F.lit("/data/local-files/?"), F.when(i % 3 == 0, F.concat(F.lit("id="), n)).otherwise(F.concat(F.lit("k=1&d="), n, F.lit("&z=2"))))
    section = F.concat(F.lit("0:0-1:0-"), F.lpad((i % 60).cast("string"), 2, "0"))
    return table(spark, d, "events").select(i.alias("id"), ps.query_param(url, "d").alias("d"), ps.file_slug(F.concat("event_type", F.lit("/x"))).alias("file"), ps.section_suffix(section).alias("section"))


@query(f"WITH {TR} SELECT row_id, round(x_in * 5, 6) AS cx, round((140.4::DOUBLE - y_in) * 5, 6) AS cy FROM tr")
def canvas_points(spark, d):
    cx, cy = geo.canvas(PUSHBACK, F.col("x_in"), F.col("y_in"), 5.0)
    return rounded(tracks(spark, d).select("row_id", cx.alias("cx"), cy.alias("cy")))


_SHARES = "sh AS (SELECT row_id, x_in / 200 + 0.1::DOUBLE AS x, y_in / 300 + 0.1::DOUBLE AS y FROM tr)"


@query(f"WITH {TR}, {_SHARES} SELECT row_id, round(x * 1280, 6) AS x0, round((1 - y - 0.05::DOUBLE) * 720, 6) AS y0, round((x + 0.1::DOUBLE) * 1280 + 7, 6) AS shifted_x1, round((1 - y) * 720 + 9, 6) AS shifted_y1, round((x - 0.05::DOUBLE) * 100, 6) AS pct_left, round((y - 0.025::DOUBLE) * 100, 6) AS pct_top FROM sh")
def box_forms(spark, d):
    """A box from shares to pixels, shifted by its crop's corner, and in percent."""
    s = tracks(spark, d).select("row_id", (F.col("x_in") / 200 + 0.1).alias("x"), (F.col("y_in") / 300 + 0.1).alias("y"))
    px = geo.ocr_box(F.col("x"), F.col("y"), F.lit(0.1), F.lit(0.05), F.lit(1280), F.lit(720))
    moved = geo.shifted_box(*px, F.lit(7), F.lit(9))
    pct = geo.percent_box(F.col("x"), F.col("y"), F.lit(0.1), F.lit(0.05))
    return rounded(s.select("row_id", px[0].alias("x0"), px[1].alias("y0"), moved[2].alias("shifted_x1"), moved[3].alias("shifted_y1"), pct[0].alias("pct_left"), pct[1].alias("pct_top")))


@query(f"WITH {TR} SELECT row_id, round(least(x_in, y_in, 50), 6) AS x0, round(least(x_in - y_in, 3), 6) AS y0, round(greatest(x_in, y_in, 50), 6) AS x1, round(greatest(x_in - y_in, 3), 6) AS y1 FROM tr")
def quad_boxes(spark, d):
    x, y = F.col("x_in"), F.col("y_in")
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    b = geo.quad_box(F.array(p(x, x - y), p(y, F.lit(3.0)), p(F.lit(50.0), F.lit(3.0)), p(x, F.lit(3.0))))
    return rounded(tracks(spark, d).select("row_id", *[c.alias(n) for c, n in zip(b, ("x0", "y0", "x1", "y1"))]))


@query(f"WITH {TR} SELECT DISTINCT team, coalesce(regexp_full_match(trim(team), '[0-9]{{1,5}}[A-Z]'), FALSE) AS is_team FROM tr")
def team_texts(spark, d):
    return tracks(spark, d).select("team").distinct().select("team", F.coalesce(ps.is_team(F.col("team")), F.lit(False)).alias("is_team"))


@query("""WITH e AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS size, [vec_id % 7 - 3, vec_id % 5, 2] AS b FROM embeddings)
    SELECT vec_id, 67 AS n, round(embedding[1]::DOUBLE / size, 6) AS first, round(b[1] / (list_max(list_transform(b, lambda x: abs(x))) + 1e-6::DOUBLE) * 3, 6) AS style FROM e""")
def profile_vectors(spark, d):
    v = F.col("vec_id")
    b = F.array((v % 7 - 3).cast("double"), (v % 5).cast("double"), F.lit(2.0))
    p = table(spark, d, "embeddings").select("vec_id", insights.profile_vector(F.col("embedding"), b).alias("p"))
    return rounded(p.select("vec_id", F.size("p").alias("n"), F.col("p")[0].alias("first"), F.col("p")[64].alias("style")))


# Order, sets, incremental work.


@query(f"WITH {MA} SELECT id, CAST(row_number() OVER (ORDER BY event_id NULLS FIRST, quality DESC NULLS LAST, id) AS INTEGER) AS place FROM ma WHERE event_id IN (SELECT event_id FROM ma GROUP BY event_id HAVING count(*) > 0) OR event_id IS NULL")
def ordered_listing(spark, d):
    """Places in an order by several keys: a range-partitioned sort, then the offset of each partition, so that no task orders all rows."""
    m = matches(spark, d).select("id", "event_id", "quality")
    order = [F.col("event_id").asc_nulls_first(), F.col("quality").desc_nulls_last(), F.col("id")]
    return store.numbered(m, order).select("id", F.col("place").cast("int").alias("place"))


@query(f"WITH {MA} SELECT id, name FROM ma ORDER BY id LIMIT 1")
def first_match(spark, d):
    """The one row of a limit without an order, made certain by the id."""
    return matches(spark, d).select("id", "name").orderBy("id").limit(1)


@query(f"WITH {MA}, {VI}, a AS (SELECT DISTINCT video_id AS v FROM ma WHERE video_id IS NOT NULL), b AS (SELECT DISTINCT id AS v FROM vi) SELECT 'both' AS kind, count(*) AS n FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'only matches', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'only videos', count(*) FROM (FROM b EXCEPT FROM a) UNION ALL SELECT 'either', count(*) FROM (FROM a UNION FROM b)")
def set_operations(spark, d):
    a = matches(spark, d).select(F.col("video_id").alias("v")).where("v IS NOT NULL")
    b = videos(spark, d).select(F.col("id").alias("v"))
    kinds = {"both": a.intersect(b), "only matches": a.subtract(b), "only videos": b.subtract(a), "either": a.union(b).distinct()}
    out = None
    for kind, rows in kinds.items():
        n = rows.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
        out = n if out is None else out.union(n)
    return out


@query(f"WITH {TR} SELECT match_id, count(*) AS n, CASE WHEN match_id % 3 = 0 THEN 'first' ELSE 'second' END AS pass FROM tr GROUP BY match_id")
def incremental_tracks(spark, d):
    """A table filled for a third of the matches, then for those it lacks: the second pass leaves the first one's rows as they are."""
    path = scratch(spark, "incremental")
    counts = tracks(spark, d).groupBy("match_id").agg(F.count("*").alias("n")).withColumn("bucket", F.pmod("match_id", F.lit(3)))
    done = counts.where("bucket = 0").withColumn("pass", F.lit("first"))
    store.append(done.select("match_id", "n", "pass", "bucket").repartition("bucket"), path, ["bucket"])
    work = lambda todo: counts.join(todo, "bucket", "left_semi").withColumn("pass", F.lit("second")).repartition("bucket")
    return ingest.process_missing(counts.select("bucket").distinct(), path, ["bucket"], work).select("match_id", "n", "pass")


@query(f"WITH {VI} SELECT id, duration_s IS NOT NULL AND coalesce(width, 0) > 0 AS ok FROM vi")
def isolated_items(spark, d):
    """Work that fails on some items; theirs is the error, the others have their result."""

    def work(row: dict) -> str:
        return f"{row['duration_s'] / row['width']:.6f}"

    v = videos(spark, d).select("id", "duration_s", F.coalesce("width", F.lit(0)).alias("width"))
    return ingest.isolated(v, ["id"], work).select("id", "ok")


@query(f"WITH {TR} SELECT team, round(quantile_cont(x_in, 0.9), 6) AS x90 FROM tr GROUP BY team")
def team_percentile(spark, d):
    """A quantile of groups of any size, without putting a whole group in order."""
    return rounded(quantiles.exact_percentile(tracks(spark, d), ["team"], "x_in", 0.9, "x90"))


# Exports.


@query(
    f"""WITH {TR}, hm AS (SELECT team, count(*) AS n_cells FROM (SELECT DISTINCT team, least(floor(x_in * 36 / 140.4::DOUBLE), 35) AS bx, least(floor(y_in * 36 / 140.4::DOUBLE), 35) AS bj FROM tr WHERE conf > 0 AND team IS NOT NULL AND x_in BETWEEN 0 AND 140.4::DOUBLE AND y_in BETWEEN 0 AND 140.4::DOUBLE) GROUP BY team),
    rt AS (SELECT team, count(*) AS n_routes FROM (SELECT team, match_id FROM tr WHERE conf > 0 AND t <= 15 AND team IS NOT NULL GROUP BY team, match_id HAVING count(*) > 1) GROUP BY team),
    te AS (SELECT DISTINCT team FROM (SELECT first(team ORDER BY t, row_id) AS team FROM tr WHERE conf > 0 AND match_id IN (SELECT id FROM matches) GROUP BY match_id, slot) WHERE team IS NOT NULL)
    SELECT team, replace(team, '/', '_') || '.html' AS file, coalesce(n_cells, 0) AS n_cells, coalesce(n_routes, 0) AS n_routes FROM te LEFT JOIN hm USING (team) LEFT JOIN rt USING (team)"""
)
def scout_pages(spark, d):
    """Report pages with heat map and routes, taken apart again: the cells and the routes drawn."""
    t = tracks(spark, d)
    tends = features.team_tendencies(features.robot_match_features(t, matches(spark, d)))
    pages = export.team_pages(tends, features.heatmap(t.where("conf > 0 AND team IS NOT NULL"), ["team"]), export.auton_routes(t))
    return pages.select("team", "file", F.regexp_count("html", F.lit("<rect")).cast("long").alias("n_cells"), F.regexp_count("html", F.lit("<polyline")).cast("long").alias("n_routes"))


@query(
    f"""WITH {MA}, {VI}, {TR}, zo AS (SELECT DISTINCT row_id, match_id FROM zone_states WHERE t IS NOT NULL), {SC}, d AS (SELECT DISTINCT ma.id, ma.name FROM ma WHERE id IN (SELECT match_id FROM tr))
    SELECT d.id AS match_id, d.name, (SELECT count(*) FROM zo WHERE zo.match_id = d.id) AS n_zone_points, (SELECT count(*) FROM sc WHERE sc.match_id = d.id) AS n_score_points, 14 AS n_game_zones, 140.4::DOUBLE AS field_size FROM d"""
)
def match_json_keys(spark, d):
    """The documents' other parts: match, zone states, score timeline and game."""
    from .base import zones

    docs = export.match_documents(matches(spark, d), videos(spark, d), tracks(spark, d), zones(spark, d), scores(spark, d))
    part = lambda path, kind: F.from_json(F.get_json_object("body", path), kind)
    return docs.select(
        "match_id", F.get_json_object("body", "$.match.name").alias("name"),
        F.coalesce(F.aggregate(F.map_values(part("$.zone_states", "map<string, array<array<double>>>")), F.lit(0), lambda a, x: a + F.size(x)), F.lit(0)).cast("long").alias("n_zone_points"),
        F.coalesce(F.size(part("$.score_timeline", "array<array<double>>")), F.lit(0)).cast("long").alias("n_score_points"), F.size(part("$.game.zones", "array<string>")).alias("n_game_zones"), F.get_json_object("body", "$.game.field_size").cast("double").alias("field_size"),
    )
