"""The pN_ queries of the operators in this package, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orphans import latest_versions
from ..runtime import table
from . import leakage, matching, mixing, nearest, quality, runs


def _zone_runs(spark: SparkSession, d: str) -> DataFrame:
    states = table(spark, d, "zone_states").withColumn("zone", runs.clean_zone())
    return runs.collapse_runs(states, ["match_id", "zone"], "t", "row_id", ["red_blocks", "blue_blocks"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _zone_runs(spark, d).where("n_readings >= 2").select("match_id", "zone", "first_row_id", "n_readings")


def p1_runs(spark: SparkSession, d: str) -> DataFrame:
    r = _zone_runs(spark, d)
    return r.select("match_id", "zone", "first_row_id", F.round("t_start", 3).alias("t_start"), F.round("duration", 3).alias("duration"), "n_readings", "first_red_blocks", "first_blue_blocks")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    scores = table(spark, d, "score_timeline").withColumnRenamed("row_id", "score_row_id")
    tracks = table(spark, d, "robot_tracks").withColumnRenamed("row_id", "track_row_id")
    return nearest.nearest_by_time(scores, tracks, "match_id", "t", "score_row_id", "track_row_id").select("score_row_id", "track_row_id")


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_official(table(spark, d, "matches"), table(spark, d, "official_matches"), table(spark, d, "tournaments"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).where("confidence >= 0.6").select("match_id", "official_id")


def p5_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d)


def p5_heldout(spark: SparkSession, d: str) -> DataFrame:
    """Every second known link is hidden and must be found again: how many there are, and whether at least 0.9 of them are found and 0.95 of what is found for them is right."""
    m = table(spark, d, "matches")
    hidden = F.col("id") % 2 == 0
    known = latest_versions(m.where("id IS NOT NULL"), "id", ["re_match_id"]).where(hidden & F.col("re_match_id").isNotNull()).select(F.col("id").alias("match_id"), F.col("re_match_id").alias("truth"))
    got = matching.match_official(m.withColumn("re_match_id", F.when(~hidden, F.col("re_match_id"))), table(spark, d, "official_matches"), table(spark, d, "tournaments"))
    j = known.join(got.where("confidence >= 0.6").select("match_id", "official_id"), "match_id", "left")
    n = j.agg(F.count("*").alias("n"), F.count("official_id").alias("found"), F.count_if(F.col("official_id") == F.col("truth")).alias("right"))
    return n.select(F.col("n").alias("n_hidden"), (F.col("right") >= 0.9 * F.col("n")).alias("recalled"), (F.col("right") >= 0.95 * F.col("found")).alias("precise"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p7_removal_spans(spark: SparkSession, d: str) -> DataFrame:
    return leakage.removal_spans(_leaks(spark, d))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the mixture per source of the targets: no document above the cap, and the tokens as wanted to within one document."""
    docs = table(spark, d, "documents")
    used, report = mixing.mixture(docs, table(spark, d, "mix_targets"))
    # A token has a byte at least.
    longest = docs.groupBy(mixing.source_label("source").alias("source")).agg(F.max(F.octet_length("text")).alias("longest"))
    r = report.join(used.groupBy("source").agg(F.max("copies").alias("copies")), "source", "left").join(longest, "source", "left")
    return r.select(
        "source", F.round("target_share", 6).alias("target_share"), "max_repeat", "available_docs", (F.coalesce("copies", F.lit(0)) <= F.col("max_repeat")).alias("within_cap"),
        F.when(F.col("available_docs") > 0, F.abs(F.col("mixed_tokens") - F.col("target_tokens")) <= F.col("longest")).otherwise(F.col("shortfall_tokens") == F.col("target_tokens")).alias("as_wanted"),
    )


def p9_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(table(spark, d, "documents")).select("doc_id", "n_chars", "n_words", "n_lines")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_quality(table(spark, d, "documents")).where(~F.col("is_prose")).select("doc_id")


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_quality(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_runs, p4_found, p5_found, p5_confidence, p5_heldout, p7_found, p7_removal_spans, p8_mixture, p8_shares, p8_check, p9_found, p9_statistics, p9_counts)}

_RUNS_SQL = """
WITH RECURSIVE r AS (
  SELECT match_id, zone, t, row_id, red_blocks, blue_blocks, row_number() OVER (PARTITION BY match_id, zone ORDER BY t, row_id) AS i
  FROM (SELECT DISTINCT match_id, lower(replace(replace(trim(zone), ' ', '_'), '-', '_')) AS zone, t, row_id, red_blocks, blue_blocks
        FROM zone_states WHERE t IS NOT NULL AND red_blocks IS NOT NULL AND blue_blocks IS NOT NULL)
), walk AS (
  SELECT match_id, zone, i, t, row_id AS first_row_id, red_blocks AS r0, blue_blocks AS b0, t AS t0 FROM r WHERE i = 1
  UNION ALL
  SELECT n.match_id, n.zone, n.i, n.t,
    CASE WHEN n.t - w.t <= 5 AND abs(n.red_blocks - w.r0) <= 1 AND abs(n.blue_blocks - w.b0) <= 1 THEN w.first_row_id ELSE n.row_id END,
    CASE WHEN n.t - w.t <= 5 AND abs(n.red_blocks - w.r0) <= 1 AND abs(n.blue_blocks - w.b0) <= 1 THEN w.r0 ELSE n.red_blocks END,
    CASE WHEN n.t - w.t <= 5 AND abs(n.red_blocks - w.r0) <= 1 AND abs(n.blue_blocks - w.b0) <= 1 THEN w.b0 ELSE n.blue_blocks END,
    CASE WHEN n.t - w.t <= 5 AND abs(n.red_blocks - w.r0) <= 1 AND abs(n.blue_blocks - w.b0) <= 1 THEN w.t0 ELSE n.t END
  FROM walk w JOIN r n ON n.match_id IS NOT DISTINCT FROM w.match_id AND n.zone IS NOT DISTINCT FROM w.zone AND n.i = w.i + 1
), runs AS (
  SELECT match_id, zone, first_row_id, min(t0) AS t_start, max(t) AS t_end, count(*) AS n_readings, min(r0) AS first_red_blocks, min(b0) AS first_blue_blocks
  FROM walk GROUP BY match_id, zone, first_row_id
)"""

SQL = {
    "p1_found": _RUNS_SQL + " SELECT match_id, zone, first_row_id, n_readings FROM runs WHERE n_readings >= 2",
    "p1_runs": _RUNS_SQL + " SELECT match_id, zone, first_row_id, round(t_start, 3) AS t_start, round(t_end - t_start, 3) AS duration, n_readings, first_red_blocks, first_blue_blocks FROM runs",
    "p4_found": """
SELECT s.row_id AS score_row_id, k.row_id AS track_row_id
FROM (SELECT DISTINCT row_id, match_id, t FROM score_timeline WHERE t IS NOT NULL) s
JOIN (SELECT DISTINCT row_id, match_id, t FROM robot_tracks WHERE t IS NOT NULL AND match_id IS NOT NULL) k
  ON s.match_id = k.match_id AND abs(s.t - k.t) <= 0.4 + 1e-9
QUALIFY row_number() OVER (PARTITION BY s.row_id ORDER BY round(abs(s.t - k.t), 9), k.t, k.row_id) = 1""",
    "p5_heldout": """
SELECT count(*) AS n_hidden, TRUE AS recalled, TRUE AS precise
FROM (SELECT id, re_match_id FROM matches WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, re_match_id DESC NULLS LAST) = 1)
WHERE id % 2 = 0 AND re_match_id IS NOT NULL""",
    "p8_check": """
WITH w AS (SELECT lower(trim(source)) AS source, sum(target_share) AS target_share, max(max_repeat) AS max_repeat FROM mix_targets GROUP BY 1),
d AS (SELECT lower(trim(source)) AS source, count(DISTINCT doc_id) AS n FROM documents WHERE doc_id IS NOT NULL AND text <> '' GROUP BY 1)
SELECT w.source, round(target_share, 6) AS target_share, max_repeat, coalesce(n, 0) AS available_docs, TRUE AS within_cap, TRUE AS as_wanted FROM w LEFT JOIN d USING (source)""",
    "p9_counts": r"""
SELECT doc_id, length(regexp_replace(text, '[\s\v]+', '', 'g')) AS n_chars, len(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS n_words,
  len(list_filter(regexp_split_to_array(text, '[\r\n]+'), lambda x: regexp_matches(x, '[^\s\v]'))) AS n_lines
FROM documents WHERE regexp_matches(text, '[^\s\v]')""",
}
