"""Cleaned tables that the queries start from, in both dialects, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orphans import latest_versions
from ..runtime import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


MATCH_COLUMNS = [
    "event_id", "video_id", "name", "re_match_id", "red1", "red2", "blue1", "blue2", "video_start_ts", "video_auton_end_ts", "video_end_ts",
    "red_score", "blue_score", "ocr_red_score", "ocr_blue_score", "breakdown", "quality", "notes",
]


def matches(spark: SparkSession, d: str) -> DataFrame:
    return latest_versions(table(spark, d, "matches"), "id", MATCH_COLUMNS)


def videos(spark: SparkSession, d: str) -> DataFrame:
    return latest_versions(table(spark, d, "videos"), "id", ["source_id", "event_id", "division", "path", "title", "duration_s", "fps", "width", "height", "deleted_at"])


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """Readings on or near the field, one per row_id."""
    t = table(spark, d, "robot_tracks").where("match_id IS NOT NULL AND t IS NOT NULL AND x_in BETWEEN -6 AND 146.4 AND y_in BETWEEN -6 AND 146.4")
    return t.select("row_id", "match_id", "t", "slot", F.upper("team").alias("team"), "x_in", "y_in", "conf").distinct()


def scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "score_timeline").where("t IS NOT NULL").select("row_id", "match_id", "t", "red_score", "blue_score").distinct()


def zones(spark: SparkSession, d: str) -> DataFrame:
    z = F.lower(F.regexp_replace(F.trim("zone"), "[ -]", "_"))
    return table(spark, d, "zone_states").where("t IS NOT NULL").select("row_id", "match_id", "t", z.alias("zone"), "red_blocks", "blue_blocks").distinct()


MA = "ma AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST) = 1)"
VI = "vi AS (SELECT * FROM videos QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, source_id DESC NULLS LAST) = 1)"
TR = "tr AS (SELECT DISTINCT row_id, match_id, t, slot, upper(team) AS team, x_in, y_in, conf FROM robot_tracks WHERE match_id IS NOT NULL AND t IS NOT NULL AND x_in BETWEEN -6 AND 146.4 AND y_in BETWEEN -6 AND 146.4)"
SC = "sc AS (SELECT DISTINCT row_id, match_id, t, red_score, blue_score FROM score_timeline WHERE t IS NOT NULL)"
ZO = "zo AS (SELECT DISTINCT row_id, match_id, t, lower(replace(replace(trim(zone), ' ', '_'), '-', '_')) AS zone, red_blocks, blue_blocks FROM zone_states WHERE t IS NOT NULL)"


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def in_rect(x0: float, y0: float, x1: float, y1: float) -> str:
    return f"(x_in >= {x0}::DOUBLE AND x_in < {x1}::DOUBLE AND y_in >= {y0}::DOUBLE AND y_in < {y1}::DOUBLE)"


def in_bar(sign: int) -> str:
    """The diagonal goal in coordinates along and across it."""
    u = f"((x_in - 70.2::DOUBLE) + {sign} * (y_in - 70.2::DOUBLE)) / sqrt(2::DOUBLE)"
    v = f"((y_in - 70.2::DOUBLE) - {sign} * (x_in - 70.2::DOUBLE)) / sqrt(2::DOUBLE)"
    return f"(abs({u}) <= 11.3::DOUBLE AND abs({v}) <= 2.5::DOUBLE)"


_A, _B = "(70.2::DOUBLE - 13.33::DOUBLE / 2)", "(70.2::DOUBLE + 13.33::DOUBLE / 2)"
#: The zones in order, as independent SQL conditions.
ZONE_SQL = {
    "long_near_red": ("goal", f"(x_in >= 45.83::DOUBLE AND x_in < {_A} AND y_in >= 20.94::DOUBLE AND y_in < 25.94::DOUBLE)"),
    "long_near_center": ("goal", f"(x_in >= {_A} AND x_in < {_B} AND y_in >= 20.94::DOUBLE AND y_in < 25.94::DOUBLE)"),
    "long_near_blue": ("goal", f"(x_in >= {_B} AND x_in < 94.62::DOUBLE AND y_in >= 20.94::DOUBLE AND y_in < 25.94::DOUBLE)"),
    "long_far_red": ("goal", f"(x_in >= 45.83::DOUBLE AND x_in < {_A} AND y_in >= 114.47::DOUBLE AND y_in < 119.47::DOUBLE)"),
    "long_far_center": ("goal", f"(x_in >= {_A} AND x_in < {_B} AND y_in >= 114.47::DOUBLE AND y_in < 119.47::DOUBLE)"),
    "long_far_blue": ("goal", f"(x_in >= {_B} AND x_in < 94.62::DOUBLE AND y_in >= 114.47::DOUBLE AND y_in < 119.47::DOUBLE)"),
    "center_upper": ("goal", in_bar(1)),
    "center_lower": ("goal", in_bar(-1)),
    "park_red": ("park", in_rect(0, 60.77, 16.88, 79.64)),
    "park_blue": ("park", in_rect(140.4 - 16.88, 60.77, 140.4, 79.64)),
    "loader_red_near": ("loader", in_rect(4, 0, 30, 14)),
    "loader_red_far": ("loader", in_rect(4, 140.4 - 14, 30, 140.4)),
    "loader_blue_near": ("loader", in_rect(140.4 - 30, 0, 140.4 - 4, 14)),
    "loader_blue_far": ("loader", in_rect(140.4 - 30, 140.4 - 14, 140.4 - 4, 140.4)),
}


def any_zone(kind: str) -> str:
    return "(" + " OR ".join(c for k, c in ZONE_SQL.values() if k == kind) + ")"


def zone_case() -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, (_, c) in ZONE_SQL.items()) + " END"
