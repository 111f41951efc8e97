"""The pN_ queries of the general operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import orphans, regrid, spikes
from ..runtime import table


def _flags(spark: SparkSession, d: str) -> DataFrame:
    tracks = table(spark, d, "robot_tracks").where("conf > 0 AND match_id IS NOT NULL AND x_in IS NOT NULL AND y_in IS NOT NULL")
    a = spikes.flag_readings(tracks, ["match_id", "slot"], "t", "row_id", {"x_in": spikes.TRACKS, "y_in": spikes.TRACKS})
    b = spikes.flag_readings(table(spark, d, "score_timeline"), ["match_id"], "t", "row_id", {"red_score": spikes.SCORES, "blue_score": spikes.SCORES})
    return a.withColumn("tab", F.lit("robot_tracks")).unionByName(b.withColumn("tab", F.lit("score_timeline")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _flags(spark, d).select("tab", "row_id").distinct()


def p2_flags(spark: SparkSession, d: str) -> DataFrame:
    return _flags(spark, d).select("tab", "row_id", "field", "impossible", "stuck", "spike")


def p2_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The flags that no model decides: impossible values and constant stretches."""
    return _flags(spark, d).where("impossible OR stuck").select("tab", "row_id", "field", "impossible", "stuck")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphans.league_orphans(table(spark, d, "matches"), table(spark, d, "videos"), table(spark, d, "tournaments"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("ref_field", "row_key", "state", "period").distinct()


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_counts(_orphans(spark, d).select("ref_field", "row_key", "state", "period").distinct())


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(*orphans.league_references(table(spark, d, "matches"), table(spark, d, "videos"), table(spark, d, "tournaments")))


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return regrid.regular_grid(table(spark, d, "score_timeline"), "match_id", "t", "row_id", ["red_score", "blue_score"], 120)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).where("missing").select("match_id", "grid_s")


def p6_readings(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).select("match_id", "grid_s", "n_readings", "missing")


def p6_filled(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the smoothed values: a level and a deviation for every second of a match that ever has the value, near the readings of that second unless they are far off their neighbours."""
    g = _grid(spark, d)
    s = table(spark, d, "score_timeline").where("match_id IS NOT NULL AND t >= 0 AND t < 120")
    seen = s.groupBy("match_id").agg(F.count("red_score").alias("n_red"), F.count("blue_score").alias("n_blue"))
    return g.join(seen, "match_id").groupBy("match_id").agg(
        F.every((F.col("n_red") > 0) == F.col("red_score").isNotNull()).alias("red_filled"), F.every((F.col("n_blue") > 0) == F.col("blue_score").isNotNull()).alias("blue_filled"),
        F.every(F.coalesce(F.col("red_score_sd") > 0, F.lit(True)) & F.coalesce(F.col("blue_score_sd") > 0, F.lit(True))).alias("uncertain"), F.count("*").alias("n"),
    )


def p6_grid(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d)


QUERIES = {f.__name__: f for f in (p2_found, p2_flags, p2_ranges, p3_found, p3_counts, p3_report, p6_found, p6_readings, p6_filled, p6_grid)}

_ORPHANS_SQL = """
WITH latest AS (
  SELECT * FROM videos QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, source_id DESC NULLS LAST) = 1
), refs AS (
  SELECT 'matches.video_id' AS ref_field, CAST(id AS VARCHAR) AS row_key, trim(video_id, ' \t') AS key, loaded_at FROM matches
  UNION ALL SELECT 'videos.source_id', id, trim(source_id, ' \t'), loaded_at FROM latest
  UNION ALL SELECT 'matches.event_id', CAST(id AS VARCHAR), CAST(event_id AS VARCHAR), loaded_at FROM matches
), t AS (
  SELECT trim(id, ' \t') AS key, 'v' AS kind, min(loaded_at) AS first_at, arg_max(deleted_at IS NOT NULL, loaded_at) AS gone FROM videos GROUP BY 1
  UNION ALL SELECT CAST(id AS VARCHAR), 'e', min(loaded_at), arg_max(deleted_at IS NOT NULL, loaded_at) FROM tournaments GROUP BY 1
), each AS (
  SELECT ref_field, row_key, r.key,
    CASE WHEN t.key IS NULL THEN 'missing' WHEN t.gone THEN 'deleted' WHEN t.first_at > r.loaded_at THEN 'late' END AS state, strftime(r.loaded_at, '%Y-%m') AS period
  FROM refs r LEFT JOIN t ON r.key = t.key AND t.kind = CASE WHEN ref_field = 'matches.event_id' THEN 'e' ELSE 'v' END
  WHERE r.key IS NOT NULL AND r.key <> ''
), found AS (SELECT DISTINCT ref_field, row_key, state, period FROM each)""".replace("\t", "'||chr(9)||'")

SQL = {
    "p2_ranges": """
WITH tk AS (SELECT DISTINCT row_id, match_id || '/' || slot AS src, t, x_in, y_in FROM robot_tracks WHERE conf > 0 AND match_id IS NOT NULL AND slot IS NOT NULL AND t IS NOT NULL AND x_in IS NOT NULL AND y_in IS NOT NULL),
st AS (SELECT DISTINCT row_id, CAST(match_id AS VARCHAR) AS src, t, red_score, blue_score FROM score_timeline WHERE match_id IS NOT NULL AND t IS NOT NULL),
v AS (
  SELECT 'robot_tracks' AS tab, 'x_in' AS field, src, t, row_id, x_in AS v, -6.0 AS lo, 146.4 AS hi, 3.0 AS s FROM tk
  UNION ALL SELECT 'robot_tracks', 'y_in', src, t, row_id, y_in, -6.0, 146.4, 3.0 FROM tk
  UNION ALL SELECT 'score_timeline', 'red_score', src, t, row_id, red_score, 0, 400, 25 FROM st WHERE red_score IS NOT NULL
  UNION ALL SELECT 'score_timeline', 'blue_score', src, t, row_id, blue_score, 0, 400, 25 FROM st WHERE blue_score IS NOT NULL
), c AS (SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS new FROM v WINDOW w AS (PARTITION BY field, src ORDER BY t, row_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY field, src ORDER BY t, row_id) AS stretch FROM c),
e AS (SELECT *, max(t) OVER q - min(t) OVER q AS lasts, count(*) OVER q AS n FROM g WINDOW q AS (PARTITION BY field, src, stretch))
SELECT tab, row_id, field, v < lo OR v > hi AS impossible, lasts >= s - 1e-9 AND n > 1 AS stuck FROM e WHERE v < lo OR v > hi OR (lasts >= s - 1e-9 AND n > 1)""",
    "p3_found": _ORPHANS_SQL + " SELECT * FROM found WHERE state IS NOT NULL",
    "p3_counts": _ORPHANS_SQL + " SELECT ref_field, state, period, count(*) AS n_refs, count(DISTINCT row_key) AS n_rows FROM found WHERE state IS NOT NULL GROUP BY 1, 2, 3",
    "p3_report": _ORPHANS_SQL + " SELECT ref_field, period, state, count(*) AS n_refs, count(DISTINCT key) AS n_keys FROM each WHERE state IS NOT NULL GROUP BY 1, 2, 3",
    "p6_found": """
WITH s AS (SELECT DISTINCT match_id, CAST(floor(t) AS BIGINT) AS g FROM score_timeline
           WHERE match_id IS NOT NULL AND t >= 0 AND t < 120 AND (red_score IS NOT NULL OR blue_score IS NOT NULL))
SELECT match_id, grid_s FROM (SELECT DISTINCT match_id FROM s) m, range(0, 120) AS x(grid_s)
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.match_id = m.match_id AND s.g = x.grid_s)""",
    "p6_readings": """
WITH r AS (SELECT DISTINCT match_id, row_id, CAST(floor(t) AS BIGINT) AS g FROM score_timeline
           WHERE match_id IS NOT NULL AND t >= 0 AND t < 120 AND (red_score IS NOT NULL OR blue_score IS NOT NULL))
SELECT m.match_id, grid_s, count(r.row_id) AS n_readings, count(r.row_id) = 0 AS missing
FROM (SELECT DISTINCT match_id FROM r) m CROSS JOIN range(0, 120) AS x(grid_s) LEFT JOIN r ON r.match_id = m.match_id AND r.g = x.grid_s GROUP BY m.match_id, grid_s""",
    "p6_filled": "SELECT DISTINCT match_id, TRUE AS red_filled, TRUE AS blue_filled, TRUE AS uncertain, 120::BIGINT AS n FROM score_timeline WHERE match_id IS NOT NULL AND t >= 0 AND t < 120 AND (red_score IS NOT NULL OR blue_score IS NOT NULL)",
}
