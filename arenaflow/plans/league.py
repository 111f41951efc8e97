"""Queries of the relational operators: projections, joins, aggregates, votes, writes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import parsing as ps
from ..game import PUSHBACK
from ..operators import calibration, clusters, features, quantiles, segment, store, tracking
from ..runtime import table
from .base import MA, SC, TR, VI, ZO, matches, query, rounded, scores, tracks, videos, zone_case, zones


@query(f"WITH {TR} SELECT row_id, match_id, t, slot, team, x_in, y_in, conf FROM tr")
def scan_tracks(spark, d):
    return tracks(spark, d)


@query(
    f"""WITH {MA} SELECT id, event_id, video_id, name, red1, red2, blue1, blue2, red_score, blue_score,
    round(CASE WHEN video_end_ts IS NOT NULL AND video_end_ts <> 0 THEN video_end_ts - video_start_ts ELSE 0 END, 6) AS dur, quality FROM ma"""
)
def match_listing(spark, d):
    dur = F.when(F.col("video_end_ts").isNotNull() & (F.col("video_end_ts") != 0), F.col("video_end_ts") - F.col("video_start_ts")).otherwise(0.0)
    return matches(spark, d).select("id", "event_id", "video_id", "name", "red1", "red2", "blue1", "blue2", "red_score", "blue_score", F.round(dur, 6).alias("dur"), "quality")


@query(f"WITH {TR} SELECT row_id, match_id, slot FROM tr WHERE conf > 0")
def conf_filter(spark, d):
    return tracks(spark, d).where("conf > 0").select("row_id", "match_id", "slot")


@query(f"WITH {MA} SELECT id, video_id, video_start_ts, video_end_ts FROM ma WHERE video_end_ts IS NOT NULL")
def finished_matches(spark, d):
    return matches(spark, d).where("video_end_ts IS NOT NULL").select("id", "video_id", "video_start_ts", "video_end_ts")


@query(f"WITH {MA} SELECT event_id, id, name FROM ma WHERE event_id IS NOT NULL AND re_match_id IS NULL")
def unjoined_matches(spark, d):
    return matches(spark, d).where("event_id IS NOT NULL AND re_match_id IS NULL").select("event_id", "id", "name")


@query(f"WITH {MA} SELECT id, coalesce(red_score, ocr_red_score) AS red, coalesce(blue_score, ocr_blue_score) AS blue FROM ma")
def score_coalesce(spark, d):
    return matches(spark, d).select("id", F.coalesce("red_score", "ocr_red_score").alias("red"), F.coalesce("blue_score", "ocr_blue_score").alias("blue"))


_SIDES = "(SELECT id, 'red' AS alliance, coalesce(red_score, ocr_red_score) AS r, coalesce(blue_score, ocr_blue_score) AS b FROM ma UNION ALL SELECT id, 'blue', coalesce(red_score, ocr_red_score), coalesce(blue_score, ocr_blue_score) FROM ma)"


@query(f"WITH {MA} SELECT id, alliance, CASE WHEN r > b THEN alliance = 'red' WHEN r < b THEN alliance = 'blue' END AS won FROM {_SIDES}")
def outcome(spark, d):
    m = matches(spark, d).select("id", F.coalesce("red_score", "ocr_red_score").alias("r"), F.coalesce("blue_score", "ocr_blue_score").alias("b"), F.explode(F.array(F.lit("red"), F.lit("blue"))).alias("alliance"))
    return m.select("id", "alliance", features.outcome(F.col("r"), F.col("b"), F.col("alliance")).alias("won"))


@query("""SELECT DISTINCT row_id, greatest(0, least(140.4::DOUBLE, x_in)) AS x, greatest(0, least(140.4::DOUBLE, y_in)) AS y FROM robot_tracks
    WHERE x_in >= -6 AND x_in <= 146.4::DOUBLE AND y_in >= -6 AND y_in <= 146.4::DOUBLE""")
def bounds_clamp(spark, d):
    t = table(spark, d, "robot_tracks").where(geo.in_bounds(PUSHBACK, F.col("x_in"), F.col("y_in")))
    return t.select("row_id", geo.clamp(PUSHBACK, F.col("x_in")).alias("x"), geo.clamp(PUSHBACK, F.col("y_in")).alias("y")).distinct()


@query(
    f"""WITH {MA}, s AS (SELECT *, greatest(0, video_start_ts - 8) AS s0 FROM ma WHERE video_start_ts IS NOT NULL AND video_id IS NOT NULL)
    SELECT id, round(s0, 6) AS start_ts, round(video_start_ts - s0, 6) AS pre, round(video_end_ts - s0, 6) AS end_ts,
    coalesce(notes, '') || ' | src=' || video_id || '@' || CAST(CAST(round_even(video_start_ts, 0) AS BIGINT) AS VARCHAR) AS notes FROM s"""
)
def clip_rebase(spark, d):
    s0 = F.greatest(F.lit(0.0), F.col("video_start_ts") - 8)
    m = matches(spark, d).where("video_start_ts IS NOT NULL AND video_id IS NOT NULL")
    return m.select(
        "id", F.round(s0, 6).alias("start_ts"), F.round(F.col("video_start_ts") - s0, 6).alias("pre"), F.round(F.col("video_end_ts") - s0, 6).alias("end_ts"),
        ps.clip_notes(F.col("notes"), F.col("video_id"), F.col("video_start_ts")).alias("notes"),
    )


@query(f"WITH {VI} SELECT id, source_id FROM vi WHERE id ILIKE 'm%'")
def prefix_like(spark, d):
    return videos(spark, d).where(F.col("id").ilike("m%")).select("id", "source_id")


@query(f"WITH {TR}, {MA} SELECT row_id, match_id, slot, event_id, coalesce(red_score, ocr_red_score) AS red, coalesce(blue_score, ocr_blue_score) AS blue FROM tr JOIN ma ON ma.id = tr.match_id WHERE conf > 0")
def tracks_with_matches(spark, d):
    m = matches(spark, d).select(F.col("id").alias("match_id"), "event_id", F.coalesce("red_score", "ocr_red_score").alias("red"), F.coalesce("blue_score", "ocr_blue_score").alias("blue"))
    return tracks(spark, d).where("conf > 0").join(m, "match_id").select("row_id", "match_id", "slot", "event_id", "red", "blue")


@query(f"WITH {MA}, {VI} SELECT ma.id AS match_id, vi.path, vi.fps FROM ma JOIN vi ON vi.id = ma.video_id WHERE video_end_ts IS NOT NULL")
def match_video(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), "path", "fps")
    return matches(spark, d).where("video_end_ts IS NOT NULL").join(v, "video_id").select(F.col("id").alias("match_id"), "path", "fps")


@query(f"WITH {MA}, {VI} SELECT ma.id AS match_id, coalesce(vi.source_id, ma.video_id) AS stream FROM ma LEFT JOIN vi ON vi.id = ma.video_id")
def video_left(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), "source_id")
    return matches(spark, d).join(v, "video_id", "left").select(F.col("id").alias("match_id"), F.coalesce("source_id", "video_id").alias("stream"))


@query(f"WITH {MA} SELECT id FROM ma WHERE NOT EXISTS (SELECT 1 FROM robot_tracks r WHERE r.match_id = ma.id)")
def untracked_anti(spark, d):
    return matches(spark, d).select("id").join(table(spark, d, "robot_tracks").select(F.col("match_id").alias("id")), "id", "left_anti")


@query(f"WITH {MA} SELECT id FROM ma WHERE EXISTS (SELECT 1 FROM robot_tracks r WHERE r.match_id = ma.id)")
def tracked_semi(spark, d):
    return matches(spark, d).select("id").join(table(spark, d, "robot_tracks").select(F.col("match_id").alias("id")), "id", "left_semi")


@query(f"WITH {MA}, {VI} SELECT ma.id, ma.video_id FROM ma WHERE video_id LIKE 'm1%' OR video_id IN (SELECT id FROM vi WHERE width >= 1920)")
def or_in_subquery(spark, d):
    hd = videos(spark, d).where("width >= 1920").select(F.col("id").alias("video_id"), F.lit(True).alias("hd"))
    m = matches(spark, d).select("id", "video_id").join(hd, "video_id", "left")
    return m.where(F.col("video_id").like("m1%") | F.col("hd")).select("id", "video_id")


# Calibrations: three a stream, from the stream's own length; clips have some of their own.
_CAL = """cal AS (
  SELECT id AS video_id, k * 600.0::DOUBLE + length(id) AS from_ts, [0.1::DOUBLE, 0.01::DOUBLE, 5.0::DOUBLE + k, 0.02::DOUBLE, 0.2::DOUBLE, 3.0::DOUBLE, 0.0::DOUBLE, 0.0001::DOUBLE * k, 1.0::DOUBLE] AS homography
  FROM vi, range(0, 3) AS r(k) WHERE id NOT LIKE 'm%' OR (length(id) + k) % 3 = 0)"""


def _calibrations(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    k = F.col("k")
    h = F.array(F.lit(0.1), F.lit(0.01), 5.0 + k, F.lit(0.02), F.lit(0.2), F.lit(3.0), F.lit(0.0), 0.0001 * k, F.lit(1.0))
    keep = ~F.col("video_id").like("m%") | ((F.length("video_id") + k) % 3 == 0)
    return v.where(keep).select("video_id", (k * 600.0 + F.length("video_id")).alias("from_ts"), h.alias("homography"))


_ASOF = f"""WITH {MA}, {VI}, {_CAL}, own AS (
  SELECT ma.id, max(cal.from_ts) AS f FROM ma JOIN cal ON cal.video_id = ma.video_id AND cal.from_ts <= ma.video_start_ts GROUP BY ma.id
), alts AS (
  SELECT v.id AS video_id, c.from_ts, c.video_id AS via FROM vi v JOIN cal c ON c.video_id = v.source_id WHERE v.source_id <> ''
  UNION ALL SELECT v.id, c.from_ts, c.video_id FROM vi v JOIN vi s ON s.source_id = v.source_id JOIN cal c ON c.video_id = s.id WHERE v.source_id <> ''
), alt AS (SELECT video_id, min(from_ts) AS f FROM alts GROUP BY video_id)"""


@query(_ASOF + " SELECT ma.id, own.f AS from_ts FROM ma JOIN own ON own.id = ma.id")
def calibration_asof(spark, d):
    r = matches(spark, d).select("id", "video_id", F.col("video_start_ts").alias("ts"))
    return calibration.calibration_asof(r, _calibrations(spark, d), videos(spark, d)).where("origin = 'own'").select("id", "from_ts")


@query(_ASOF + " SELECT ma.id, coalesce(own.f, alt.f) AS from_ts, CASE WHEN own.f IS NOT NULL THEN 'own' WHEN alt.f IS NOT NULL THEN 'source' END AS origin FROM ma LEFT JOIN own ON own.id = ma.id LEFT JOIN alt ON alt.video_id = ma.video_id")
def calibration_fallback(spark, d):
    r = matches(spark, d).select("id", "video_id", F.col("video_start_ts").alias("ts"))
    return calibration.calibration_asof(r, _calibrations(spark, d), videos(spark, d)).select("id", "from_ts", "origin")


_OFF = """off AS (SELECT * FROM official_matches QUALIFY row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC NULLS LAST) = 1),
ofk AS (SELECT id, sku, CASE round WHEN 1 THEN 'P' WHEN 2 THEN 'Q' WHEN 3 THEN 'QF' WHEN 4 THEN 'SF' WHEN 5 THEN 'F' WHEN 6 THEN 'R16' ELSE '?' END AS code, coalesce(instance, 1) AS inst, coalesce(matchnum, 0) AS num FROM off),
ofn AS (SELECT id, sku, CASE WHEN code IN ('P', 'Q') THEN code || num WHEN num = 0 THEN code || inst ELSE code || inst || '-' || num END AS name FROM ofk)"""


def _official_names(spark, d):
    from ..operators.orphans import latest_versions

    o = latest_versions(table(spark, d, "official_matches"), "id", ["sku", "round", "instance", "matchnum"], "fetched_at")
    return o.select("id", "sku", ps.official_label(F.col("round"), F.col("instance"), F.col("matchnum")).alias("name"))


@query(f"WITH {_OFF} SELECT id, name FROM ofn")
def normalize_name(spark, d):
    return _official_names(spark, d).select("id", "name")


@query(
    f"""WITH {MA}, {_OFF}, tn AS (SELECT id, max(sku) AS sku FROM tournaments GROUP BY id), lastk AS (SELECT sku, name, max(id) AS oid FROM ofn WHERE sku IS NOT NULL GROUP BY sku, name)
    SELECT tn.sku, count(*) AS n, count(lastk.oid) AS joined, count(*) - count(lastk.oid) AS unjoined
    FROM ma JOIN tn ON tn.id = ma.event_id LEFT JOIN lastk ON lastk.sku = tn.sku AND lastk.name = upper(regexp_replace(coalesce(ma.name, ''), '\\s+', '', 'g')) GROUP BY tn.sku"""
)
def official_results(spark, d):
    t = table(spark, d, "tournaments").groupBy(F.col("id").alias("event_id")).agg(F.max("sku").alias("sku"))
    last = _official_names(spark, d).where("sku IS NOT NULL").groupBy("sku", F.col("name").alias("key")).agg(F.max("id").alias("oid"))
    m = matches(spark, d).join(t, "event_id").withColumn("key", ps.canon(F.col("name"))).join(last, ["sku", "key"], "left")
    return m.groupBy("sku").agg(F.count("*").alias("n"), F.count("oid").alias("joined"), (F.count("*") - F.count("oid")).alias("unjoined"))


@query(f"WITH {TR} SELECT row_id, {zone_case()} AS zone FROM tr WHERE conf > 0")
def zone_of_point(spark, d):
    return tracks(spark, d).where("conf > 0").select("row_id", geo.zone_at(PUSHBACK, F.col("x_in"), F.col("y_in")).alias("zone"))


@query(f"WITH {TR} SELECT match_id, zone, count(*) AS n FROM (SELECT match_id, {zone_case()} AS zone FROM tr WHERE conf > 0) WHERE zone IS NOT NULL GROUP BY match_id, zone")
def zone_occupancy(spark, d):
    z = tracks(spark, d).where("conf > 0").select("match_id", geo.zone_at(PUSHBACK, F.col("x_in"), F.col("y_in")).alias("zone"))
    return z.where("zone IS NOT NULL").groupBy("match_id", "zone").agg(F.count("*").alias("n"))


@query(
    f"""WITH {MA}, img AS (SELECT 'm' || (id * 7 % 400) || '_t' || CAST(id AS VARCHAR) AS image, id * 7 % 400 AS ref, video_id, video_start_ts + 30 AS ts FROM ma),
    held AS (SELECT i.image, min(m.id) AS h FROM img i JOIN ma m ON m.video_id = i.video_id AND i.ts >= m.video_start_ts AND i.ts <= coalesce(m.video_end_ts, 0) GROUP BY i.image)
    SELECT img.image, coalesce(m.id, held.h) AS match_id FROM img LEFT JOIN ma m ON m.id = img.ref LEFT JOIN held ON held.image = img.image"""
)
def span_containment(spark, d):
    m = matches(spark, d)
    img = m.select(F.concat(F.lit("m"), (F.col("id") * 7 % 400).cast("string"), F.lit("_t"), F.col("id").cast("string")).alias("image"), (F.col("id") * 7 % 400).alias("match_ref"), "video_id", (F.col("video_start_ts") + 30).alias("ts"))
    return calibration.containing_match(img, m)


_NEAR = "dt AS (SELECT match_id, floor(t) AS s, row_id AS pos, x_in, y_in FROM tr WHERE conf = 0), tg AS (SELECT match_id, floor(t) AS s, slot, avg(x_in) AS tx, avg(y_in) AS ty FROM tr WHERE conf > 0 GROUP BY 1, 2, 3)"


@query(f"WITH {TR}, {_NEAR} SELECT tg.match_id, tg.s, slot, pos, round(sqrt((x_in - tx) ** 2 + (y_in - ty) ** 2), 6) AS distance FROM tg JOIN dt ON dt.match_id = tg.match_id AND dt.s = tg.s WHERE sqrt((x_in - tx) ** 2 + (y_in - ty) ** 2) < 12 QUALIFY row_number() OVER (PARTITION BY tg.match_id, tg.s, slot ORDER BY sqrt((x_in - tx) ** 2 + (y_in - ty) ** 2), pos) = 1")
def nearest_detection(spark, d):
    t = tracks(spark, d).withColumn("s", F.floor("t").cast("double"))
    det = t.where("conf = 0").select("match_id", "s", F.col("row_id").alias("pos"), F.col("x_in").alias("x"), F.col("y_in").alias("y"))
    tg = t.where("conf > 0").groupBy("match_id", "s", "slot").agg(F.avg("x_in").alias("x_in"), F.avg("y_in").alias("y_in"))
    return rounded(calibration.nearest_detection(tg, det, ["match_id", "s"]))


@query("""WITH p AS (SELECT vec_id, label % 4 AS source_id, embedding FROM embeddings), c AS (SELECT source_id, vec_id AS cid, embedding AS ce FROM p QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY vec_id) <= 5),
    j AS (SELECT p.source_id, p.vec_id AS clip_id, c.cid AS centre_id, list_sum(list_transform(range(1, 65), lambda i: abs(embedding[i]::DOUBLE - ce[i]::DOUBLE))) / 64 AS distance FROM p JOIN c ON c.source_id = p.source_id)
    SELECT source_id, clip_id, centre_id, round(distance, 6) AS distance FROM j WHERE distance < 0.5 QUALIFY row_number() OVER (PARTITION BY source_id, clip_id ORDER BY distance, centre_id) = 1""")
def nearest_centroid(spark, d):
    p = table(spark, d, "embeddings").select((F.col("label") % 4).alias("source_id"), F.col("vec_id").alias("clip_id"), F.col("embedding").alias("fp"))
    first = p.withColumn("rn", F.row_number().over(Window.partitionBy("source_id").orderBy("clip_id"))).where("rn <= 5").select("source_id", F.col("clip_id").alias("centre_id"), "fp")
    return rounded(clusters.nearest_centre(p, first, ["source_id"], 0.5))


_ASK = "asked AS (SELECT match_id, q FROM (SELECT DISTINCT match_id FROM sc), (SELECT CAST(5 * i + 0.5 AS DOUBLE) AS q FROM range(0, 24) AS r(i)))"
_ONE = "one AS (SELECT match_id, t, max(red_score) AS red_score FROM sc GROUP BY match_id, t HAVING max(red_score) IS NOT NULL)"


@query(f"WITH {SC}, {_ASK}, {_ONE} SELECT a.match_id, a.q, coalesce(arg_max(red_score, t) FILTER (WHERE t <= q), arg_min(red_score, t)) AS red_score FROM asked a JOIN one ON one.match_id = a.match_id GROUP BY a.match_id, a.q")
def replay_asof(spark, d):
    s = scores(spark, d).where("match_id IS NOT NULL")
    q = s.select("match_id").distinct().withColumn("q", F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: i * 5 + F.lit(0.5).cast("double"))))
    one = s.groupBy("match_id", "t").agg(F.max("red_score").alias("red_score")).where("red_score IS NOT NULL")
    return calibration.state_at(q, one, ["match_id"], "red_score")


@query(f"WITH {SC}, {_ASK}, {_ONE} SELECT a.match_id, a.q, coalesce(arg_min(red_score, t) FILTER (WHERE t >= q), arg_max(red_score, t)) AS red_score FROM asked a JOIN one ON one.match_id = a.match_id GROUP BY a.match_id, a.q")
def forward_asof(spark, d):
    s = scores(spark, d).where("match_id IS NOT NULL")
    q = s.select("match_id").distinct().withColumn("q", F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: i * 5 + F.lit(0.5).cast("double"))))
    one = s.groupBy("match_id", "t").agg(F.max("red_score").alias("red_score")).where("red_score IS NOT NULL")
    return calibration.state_at(q, one, ["match_id"], "red_score", forward=True)


@query(f"WITH {MA} SELECT id, slot, team FROM (SELECT id, red1, red2, blue1, blue2 FROM ma) UNPIVOT INCLUDE NULLS (team FOR slot IN (red1, red2, blue1, blue2))")
def slot_unpivot(spark, d):
    return matches(spark, d).unpivot(["id"], ["red1", "red2", "blue1", "blue2"], "slot", "team")


@query(f"WITH {MA}, {VI} SELECT coalesce(source_id, video_id) AS stream, count(*) AS n, count(video_end_ts) AS finished, count(re_match_id) AS joined FROM ma LEFT JOIN vi ON vi.id = ma.video_id GROUP BY 1")
def pipeline_summary(spark, d):
    v = videos(spark, d).select(F.col("id").alias("video_id"), "source_id")
    m = matches(spark, d).join(v, "video_id", "left")
    return m.groupBy(F.coalesce("source_id", "video_id").alias("stream")).agg(F.count("*").alias("n"), F.count("video_end_ts").alias("finished"), F.count("re_match_id").alias("joined"))


@query(f"WITH {TR} SELECT team, count(*) AS n_slots, count(DISTINCT match_id) AS n_matches FROM (SELECT DISTINCT team, match_id, slot FROM tr WHERE team IS NOT NULL) GROUP BY team")
def distinct_slots(spark, d):
    t = tracks(spark, d).where("team IS NOT NULL").select("team", "match_id", "slot").distinct()
    return t.groupBy("team").agg(F.count("*").alias("n_slots"), F.countDistinct("match_id").alias("n_matches"))


_VOTES = f"WITH {TR}, v AS (SELECT match_id, slot, team, sum(CASE WHEN conf > 0.8 THEN 5 ELSE 1 END)::BIGINT AS votes, min(row_id) AS first_pos FROM tr WHERE team IS NOT NULL GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY match_id, slot ORDER BY votes DESC, first_pos, team)::INTEGER AS rank FROM v)"


def _votes(spark, d, k):
    v = tracks(spark, d).select("match_id", "slot", F.col("row_id").alias("pos"), F.col("team").alias("value"), F.when(F.col("conf") > 0.8, 5).otherwise(1).alias("weight"))
    return segment.top_votes(v, ["match_id", "slot"], k)


@query(_VOTES + " SELECT match_id, slot, team, votes, first_pos FROM k WHERE rank = 1")
def majority_vote(spark, d):
    return _votes(spark, d, 1).select("match_id", "slot", F.col("value").alias("team"), "votes", "first_pos")


@query(_VOTES + " SELECT match_id, slot, team, rank FROM k WHERE rank <= 2")
def top2_votes(spark, d):
    return _votes(spark, d, 2).select("match_id", "slot", F.col("value").alias("team"), "rank")


@query(
    f"""WITH {SC}, l AS (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY t DESC, row_id DESC) AS rn FROM sc),
    v AS (SELECT match_id, list_sort(list(red_score) FILTER (WHERE red_score IS NOT NULL)) AS a, list_sort(list(blue_score) FILTER (WHERE blue_score IS NOT NULL)) AS b FROM l WHERE rn <= 5 GROUP BY match_id)
    SELECT match_id, a[len(a) // 2 + 1] AS final_red, b[len(b) // 2 + 1] AS final_blue FROM v"""
)
def tail_median(spark, d):
    g = scores(spark, d).groupBy("match_id").agg(F.array_sort(F.collect_list(F.struct("t", "row_id", "red_score", "blue_score"))).alias("a"))
    return g.select("match_id", *[segment.tail_median(F.transform("a", lambda x: x[f"{side}_score"])).alias(f"final_{side}") for side in ("red", "blue")])


@query("SELECT label, CAST(i - 1 AS INTEGER) AS i, round(median(embedding[i]::DOUBLE), 6) AS med, round(avg(embedding[i]::DOUBLE), 6) AS mean FROM embeddings, range(1, 65) AS r(i) GROUP BY label, i")
def vector_median(spark, d):
    e = table(spark, d, "embeddings")
    a = quantiles.exact_percentile(e.select("label", F.posexplode("embedding").alias("i", "v")), ["label", "i"], "v", 0.5, "med")
    b = clusters.by_element(e, ["label"], "embedding", F.avg).select("label", F.posexplode("embedding").alias("i", "mean"))
    return rounded(a.join(b, ["label", "i"]))


@query(f"WITH {VI} SELECT id, deleted_at IS NOT NULL AS gone, loaded_at FROM vi")
def latest_per_key(spark, d):
    return videos(spark, d).select("id", F.col("deleted_at").isNotNull().alias("gone"), "loaded_at")


@query(f"WITH {TR}, k AS (SELECT match_id, slot, row_id, row_number() OVER (PARTITION BY match_id, slot ORDER BY conf DESC, row_id) AS rn FROM tr) SELECT match_id, slot, row_id FROM k WHERE rn <= 40 AND (rn - 1) % 4 = 0")
def spaced_sample(spark, d):
    k = tracks(spark, d).withColumn("rn", F.row_number().over(Window.partitionBy("match_id", "slot").orderBy(F.desc("conf"), "row_id")))
    return k.where("rn <= 40 AND (rn - 1) % 4 = 0").select("match_id", "slot", "row_id")


@query(f"WITH {ZO}, k AS (SELECT match_id, t, zone, row_number() OVER (PARTITION BY match_id, t ORDER BY red_blocks + blue_blocks DESC, red_blocks DESC, zone) AS rn FROM zo WHERE red_blocks IS NOT NULL AND blue_blocks IS NOT NULL) SELECT match_id, t, zone FROM k WHERE rn = 1")
def fullest_zone(spark, d):
    z = zones(spark, d).where("red_blocks IS NOT NULL AND blue_blocks IS NOT NULL")
    best = F.min(F.struct((-F.col("red_blocks") - F.col("blue_blocks")).alias("n"), (-F.col("red_blocks")).alias("r"), "zone")).alias("b")
    return z.groupBy("match_id", "t").agg(best).select("match_id", "t", "b.zone")


@query("""WITH RECURSIVE o AS (
      SELECT match_id, t, row_number() OVER (PARTITION BY match_id ORDER BY t) AS i FROM (SELECT DISTINCT match_id, t FROM robot_tracks WHERE match_id IS NOT NULL AND t >= 0)),
    w AS (
      SELECT match_id, i, t, t AS kept, TRUE AS hit FROM o WHERE i = 1
      UNION ALL SELECT o.match_id, o.i, o.t, CASE WHEN o.t >= w.kept + 1.0::DOUBLE THEN o.t ELSE w.kept END, o.t >= w.kept + 1.0::DOUBLE FROM w JOIN o ON o.match_id = w.match_id AND o.i = w.i + 1)
    SELECT match_id, t FROM w WHERE hit""")
def throttle_frames(spark, d):
    """The frames of whole matches, of all slots."""
    return tracking.throttle(table(spark, d, "robot_tracks").where("match_id IS NOT NULL"), ["match_id"])


@query(f"WITH {MA}, n AS (SELECT id, red1 AS team FROM ma WHERE id % 3 = 0 UNION ALL SELECT id + 1000000, blue1 FROM ma WHERE id % 5 = 0) SELECT id, red1 AS team FROM ma WHERE id NOT IN (SELECT id FROM n) UNION ALL SELECT id, team FROM n")
def upsert_latest(spark, d):
    m = matches(spark, d)
    old = m.select("id", F.col("red1").alias("team"))
    new = m.where("id % 3 = 0").select("id", F.col("red1").alias("team"), F.lit(2).alias("seq")).unionByName(m.where("id % 3 = 0").select("id", F.col("red2").alias("team"), F.lit(1).alias("seq")))
    new = new.unionByName(m.where("id % 5 = 0").select((F.col("id") + 1_000_000).alias("id"), F.col("blue1").alias("team"), F.lit(1).alias("seq")))
    return store.upsert(old, new, ["id"], F.col("seq")).select("id", "team")


@query(f"WITH {SC} SELECT match_id, row_id, red_score FROM sc WHERE match_id % 3 <> 0 OR match_id IS NULL UNION ALL SELECT match_id, row_id, 0 FROM sc WHERE match_id % 3 = 0 AND t < 30")
def replace_by_key(spark, d):
    s = scores(spark, d)
    new = s.where("match_id % 3 = 0 AND t < 30").select("match_id", "row_id", F.lit(0).alias("red_score"))
    kept = s.where("match_id % 3 <> 0 OR match_id IS NULL").select("match_id", "row_id", "red_score")
    return store.replace_by_key(kept.unionByName(s.where("match_id % 3 = 0").join(new.select("match_id").distinct(), "match_id", "left_semi").select("match_id", "row_id", "red_score")), new, ["match_id"])


@query(f"WITH {MA}, {_OFF}, sc2 AS (SELECT off.id, a.score FROM off, UNNEST(alliances) AS u(a) WHERE a.color = 'red') SELECT ma.id, coalesce(sc2.score, ma.ocr_red_score) AS red FROM ma LEFT JOIN sc2 ON sc2.id = ma.re_match_id")
def update_from_join(spark, d):
    from ..operators.orphans import latest_versions

    o = latest_versions(table(spark, d, "official_matches"), "id", ["alliances"], "fetched_at").select(F.col("id").alias("re_match_id"), F.inline("alliances")).where("color = 'red'").select("re_match_id", F.col("score").alias("red"))
    m = matches(spark, d).select("id", "re_match_id", F.col("ocr_red_score").alias("red"))
    return store.update_from(m, o, ["re_match_id"], ["red"]).select("id", "red")
