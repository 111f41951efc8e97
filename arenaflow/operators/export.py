"""Nested exports: one JSON document per match, and routes of teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as ps
from ..game import PUSHBACK, Game


def _series(df: DataFrame, name: str, cols: list[str], order: list[str], sub: str | None = None) -> DataFrame:
    """match_id and the rows as an array of number arrays in order, or a map of them by `sub`."""
    item = F.struct(*order, F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))
    keys = ["match_id"] + ([sub] if sub else [])
    g = df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias(name))
    return g.groupBy("match_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(sub, name)))).alias(name)) if sub else g


def game_struct(game: Game) -> Column:
    zones = [F.struct(F.lit(z.name).alias("name"), F.lit(z.kind).alias("kind"), F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in z.polygon]).alias("polygon")) for z in game.zones]
    kind = "array<struct<name: string, kind: string, polygon: array<array<double>>>>"
    return F.struct(F.lit(game.name).alias("name"), F.lit(game.size).alias("field_size"), F.lit(game.seconds["auton"]).alias("auton_seconds"), F.array(*zones).cast(kind).alias("zones"))


def match_documents(matches: DataFrame, videos: DataFrame, tracks: DataFrame, zones: DataFrame, scores: DataFrame, game: Game = PUSHBACK) -> DataFrame:
    """(match_id, body): the match, game, tracks, zone states, score timeline and stream reference as JSON, for matches that have tracks."""
    vid = videos.select(F.col("id").alias("video_id"), "source_id")
    ref, ts = ps.source_ref(F.col("video_id"), F.col("video_start_ts"), F.col("source_id"), F.col("notes"))
    info = matches.join(vid, "video_id", "left").select(F.col("id").alias("match_id"), F.struct(*matches.columns).alias("match"), F.struct(ref.alias("video_id"), ts.alias("start_ts")).alias("youtube"))
    parts = [
        _series(tracks, "tracks", ["t", "x_in", "y_in", "conf"], ["t", "row_id"], "slot"),
        _series(zones, "zone_states", ["t", "red_blocks", "blue_blocks"], ["t", "row_id"], "zone"),
        _series(scores, "score_timeline", ["t", "red_score", "blue_score"], ["t", "row_id"]),
    ]
    out = info.join(parts[0], "match_id").join(parts[1], "match_id", "left").join(parts[2], "match_id", "left")
    return out.select("match_id", F.to_json(F.struct("match", game_struct(game).alias("game"), "tracks", "zone_states", "score_timeline", "youtube"), {"ignoreNullFields": "false"}).alias("body"))


def auton_routes(tracks: DataFrame, auton_s: float = 15) -> DataFrame:
    """(team, match_id, n_points, route): positions in order of time up to auton_s, for teams with more than one."""
    early = tracks.where((F.col("conf") > 0) & (F.col("t") <= auton_s) & F.col("team").isNotNull())
    g = early.groupBy("team", "match_id").agg(F.array_sort(F.collect_list(F.struct("t", "row_id", "x_in", "y_in"))).alias("p"), F.count("*").alias("n_points"))
    return g.where("n_points > 1").select("team", "match_id", "n_points", F.transform("p", lambda x: F.struct(x["x_in"].alias("x"), x["y_in"].alias("y"))).alias("route"))


def team_reports(tendencies: DataFrame) -> DataFrame:
    """(team, file, html): a small report page per team."""
    pct = lambda c: F.concat(F.coalesce(F.round(F.col(c) * 100).cast("int").cast("string"), F.lit("–")), F.lit("%"))
    cells = [
        ("Matches", F.col("matches").cast("string")), ("Win rate", F.concat(pct("win_rate"), F.lit(" ("), F.col("decided").cast("string"), F.lit(")"))), ("Mean speed", F.concat(F.format_number("speed_mean", 1), F.lit(" in/s"))),
        ("Offensive half", pct("frac_offensive_half")), ("Near loaders", pct("frac_near_loader")), ("Near goals", pct("frac_near_goal")), ("Parked at the end", pct("endgame_in_own_park")),
    ]
    rows = F.concat(*[x for name, v in cells for x in (F.lit(f"<tr><th>{name}</th><td>"), v, F.lit("</td></tr>"))])
    return tendencies.select("team", F.concat(ps.file_slug(F.col("team")), F.lit(".html")).alias("file"), F.concat(F.lit("<!doctype html><meta charset='utf-8'><h1>"), "team", F.lit("</h1><table>"), rows, F.lit("</table>")).alias("html"))


def team_pages(tendencies: DataFrame, heat: DataFrame, routes: DataFrame, size: float = PUSHBACK.size, bins: int = 36, scale: float = 3.0) -> DataFrame:
    """team_reports with two drawings: the cells of the team's heat map (team, bin_x, bin_y, density) and its routes (team, match_id, route), y upwards. A heat map has at most bins squared cells; a team has a route per match."""
    side = size * scale
    cell = side / bins
    number = lambda c: F.format_string("%.1f", c.cast("double"))
    rect = F.concat(
        F.lit("<rect x='"), number(F.col("bin_x") * cell), F.lit("' y='"), number(side - (F.col("bin_y") + 1) * cell), F.lit(f"' width='{cell:.1f}' height='{cell:.1f}' fill-opacity='"), F.format_string("%.2f", "density"), F.lit("'/>")
    )
    cells = heat.groupBy("team").agg(F.array_join(F.array_sort(F.collect_list(rect)), "").alias("cells"))
    points = F.array_join(F.transform("route", lambda p: F.concat(number(p["x"] * scale), F.lit(","), number(side - p["y"] * scale))), " ")
    line = F.concat(F.lit("<polyline fill='none' stroke='black' points='"), points, F.lit("'/>"))
    lines = routes.groupBy("team").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("match_id", line.alias("l")))), lambda x: x["l"]), "").alias("lines"))
    both = team_reports(tendencies).join(cells, "team", "left").join(lines, "team", "left")
    drawing = lambda c: F.concat(F.lit(f"<svg width='{side:.0f}' height='{side:.0f}'>"), F.coalesce(c, F.lit("")), F.lit("</svg>"))
    return both.select("team", "file", F.concat("html", drawing(F.col("cells")), drawing(F.col("lines"))).alias("html"))
