"""Behaviour of robots, alliances and teams from tracks, as aggregations over windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..game import PUSHBACK, Game, zones_like
from ..runtime import materialize
from .quantiles import exact_percentile


def share(cond: Column) -> Column:
    return F.avg(cond.cast("double"))


def alliance(slot: Column) -> Column:
    return F.when(slot.startswith("red"), "red").otherwise("blue")


def outcome(red: Column, blue: Column, side: Column) -> Column:
    """True for a win, false for a loss, null for a tie or a missing score."""
    return F.when(red.isNotNull() & blue.isNotNull() & (red != blue), (red > blue) == (side == "red"))


def with_motion(tracks: DataFrame, keys: list[str], order: list[str], guard: Column | None = None) -> DataFrame:
    """Adds dist and dt to the row before, and speed where 0 < dt < 2 (null elsewhere)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    px, py, pt = (F.lag(c).over(w) for c in ("x_in", "y_in", "t"))
    d = tracks.withColumns({"dist": F.hypot(F.col("x_in") - px, F.col("y_in") - py), "dt": F.col("t") - pt})
    ok = (F.col("dt") > 0) & (F.col("dt") < 2)
    return d.withColumn("speed", F.when(ok if guard is None else ok & guard, F.col("dist") / F.col("dt")))


def robot_match_features(tracks: DataFrame, matches: DataFrame, game: Game = PUSHBACK) -> DataFrame:
    """One row per match and slot of the tracks that join a match: speeds, ranges, time shares, first-15-seconds path, end in the own park, outcome.

    tracks: match_id, t, slot, team, x_in, y_in, conf and row_id as tie-breaker;
    rows with conf 0 or null are left out. matches: id, event_id and the four
    scores. Without guarded steps speeds are 0, with one reading the path is 0.
    """
    seen = tracks.where("conf > 0").select("match_id", "t", "slot", "team", "x_in", "y_in", "row_id")
    info = matches.select(F.col("id").alias("match_id"), "event_id", F.coalesce("red_score", "ocr_red_score").alias("red"), F.coalesce("blue_score", "ocr_blue_score").alias("blue"))
    keys, order = ["match_id", "slot"], ["t", "row_id"]
    m = with_motion(seen, keys, order)
    group = Window.partitionBy(*keys)
    x, y, t = F.col("x_in"), F.col("y_in"), F.col("t")
    side = alliance(F.col("slot"))
    half = game.size / 2
    park = F.when(side == "red", geo.inside_any(zones_like(game, "park", "red"), x, y)).otherwise(geo.inside_any(zones_like(game, "park", "blue"), x, y))
    # The path's first step is dropped with the lag, so steps within t <= auton are those between readings of that time.
    early = t <= game.seconds["auton"]
    m = m.withColumns({"late": t >= F.max("t").over(group) - 15, "park": park})
    first = F.struct("t", "row_id")
    per = m.groupBy(*keys).agg(
        F.min_by("team", first).alias("team"), F.coalesce(F.avg("speed"), F.lit(0.0)).alias("speed_mean"), F.coalesce(F.percentile("speed", 0.9), F.lit(0.0)).alias("speed_p90"),
        F.stddev_pop("x_in").alias("range_x"), F.stddev_pop("y_in").alias("range_y"),
        share(F.when(side == "red", x > half).otherwise(x < half)).alias("frac_offensive_half"),
        share(geo.inside_any(zones_like(game, "loader"), x, y)).alias("frac_near_loader"), share(geo.inside_any(zones_like(game, "goal"), x, y)).alias("frac_near_goal"),
        F.avg(F.when(F.col("late"), F.col("park").cast("double"))).alias("endgame_in_own_park"),
        F.coalesce(F.sum(F.when(early, F.col("dist"))), F.lit(0.0)).alias("auton_dist"), F.count("*").alias("n_samples"),
    )
    # Matches are a dimension of the tracks; the planner broadcasts them if they are small.
    return per.join(info, "match_id").select(
        "match_id", "slot", side.alias("alliance"), "team", "event_id", outcome(F.col("red"), F.col("blue"), side).alias("won"), *BEHAVIOUR, "n_samples"
    )


#: What robot_match_features says of a robot's behaviour.
BEHAVIOUR = ["speed_mean", "speed_p90", "range_x", "range_y", "frac_offensive_half", "frac_near_loader", "frac_near_goal", "endgame_in_own_park", "auton_dist"]
#: What match_features averages, and its count of parked robots.
PARKED = "robots_parked_endgame"
MEANS = ["speed_mean", "frac_offensive_half", "frac_near_loader", "frac_near_goal", "auton_dist"]


def match_features(robots: DataFrame) -> DataFrame:
    """One row per match, alliance and event: means of the robots, robots parked at the end."""
    return robots.groupBy("match_id", "alliance", "event_id").agg(
        F.any_value("won").alias("won"), *[F.avg(c).alias(c) for c in MEANS], F.sum("endgame_in_own_park").alias(PARKED)
    )


def behavioral_features(tracks: DataFrame, matches: DataFrame, game: Game = PUSHBACK) -> DataFrame:
    """The eight-number profile per event and team over all its matches; a reading in two zones of one kind counts twice."""
    seen = tracks.where("conf > 0 AND team IS NOT NULL").select("match_id", "t", "team", "x_in", "y_in", "row_id")
    seen = seen.join(matches.select(F.col("id").alias("match_id"), "event_id").where("event_id IS NOT NULL"), "match_id")
    m = materialize(with_motion(seen, ["event_id", "team", "match_id"], ["t", "row_id"]).select("event_id", "team", "x_in", "y_in", "speed"), "motion")  # read three times below
    x, y = F.col("x_in"), F.col("y_in")

    def kind(k: str) -> Column:
        return sum((share(geo.inside(z, x, y)) for z in zones_like(game, k)), F.lit(0.0))

    # A team may hold a large part of all rows: its steps are never put in order as a whole.
    fast = exact_percentile(m.select("event_id", "team", "speed"), ["event_id", "team"], "speed", 0.9, "p90")
    means = m.groupBy("event_id", "team").agg(
        F.coalesce(F.avg("speed"), F.lit(0.0)).alias("speed_mean"), F.stddev_pop("x_in").alias("std_x"), F.stddev_pop("y_in").alias("std_y"),
        share(x < game.size / 2).alias("on_red_side"), kind("loader").alias("loader"), kind("goal").alias("goal"), kind("park").alias("park"),
    )
    profile = means.join(fast, ["event_id", "team"], "left").withColumn("speed_p90", F.coalesce("p90", F.lit(0.0)))
    return profile.select("event_id", "team", "speed_mean", "speed_p90", "std_x", "std_y", "on_red_side", "loader", "goal", "park")


def team_tendencies(robots: DataFrame) -> DataFrame:
    """Per team: matches, decided matches, win rate, means, and the alliance it mostly played for (red on a tie)."""
    red = F.count_if(F.col("alliance") == "red")
    return robots.where("team IS NOT NULL").groupBy("team").agg(
        F.count("*").alias("matches"), F.count("won").alias("decided"), share(F.col("won")).alias("win_rate"),
        *[F.avg(c).alias(c) for c in ("speed_mean", "frac_offensive_half", "frac_near_loader", "frac_near_goal", "endgame_in_own_park")],
        F.when(red >= F.count("*") - red, "red").otherwise("blue").alias("main_alliance"),
    )


def heatmap(tracks: DataFrame, keys: list[str], game: Game = PUSHBACK, bins: int = 36) -> DataFrame:
    """Cells of a bins x bins histogram of positions per key, with their share of the fullest cell; positions off the field are left out, the last edge is in."""
    size = game.size
    on = F.col("x_in").between(0, size) & F.col("y_in").between(0, size)

    def cell(c: str) -> Column:
        return F.least(F.floor(F.col(c) * bins / size), F.lit(bins - 1)).cast("int")

    n = tracks.where(on).groupBy(*keys, cell("x_in").alias("bin_x"), cell("y_in").alias("bin_y")).agg(F.count("*").alias("n"))
    return n.withColumn("density", F.col("n") / F.max("n").over(Window.partitionBy(*keys)))


def zone_counts(blocks: DataFrame, frames: DataFrame, game: Game = PUSHBACK) -> DataFrame:
    """Red and blue blocks per frame and zone, zeros included. blocks: match_id, t, cls, x, y; frames: match_id, t. A block counts for the first zone that holds it."""
    hits = blocks.where(F.col("cls").startswith("block")).withColumn("zone", geo.zone_at(game, F.col("x"), F.col("y"))).where("zone IS NOT NULL")
    n = hits.groupBy("match_id", "t", "zone").agg(F.count_if(F.col("cls") == "block_red").alias("red_blocks"), F.count_if(F.col("cls") != "block_red").alias("blue_blocks"))
    # Every zone of the configuration for every frame: an explode of a literal, no join.
    names = F.array(*[F.lit(z.name) for z in game.zones]) if game.zones else F.array().cast("array<string>")
    grid = frames.select("match_id", "t").distinct().withColumn("zone", F.explode(names))
    return grid.join(n, ["match_id", "t", "zone"], "left").fillna(0, ["red_blocks", "blue_blocks"])


def trail(tracks: DataFrame, seconds: float = 10) -> DataFrame:
    """Per reading the number of readings of its slot in the last `seconds` and the time of the first of them."""
    w = Window.partitionBy("match_id", "slot").orderBy("t").rangeBetween(-seconds, 0)
    return tracks.withColumns({"trail_n": F.count("*").over(w), "trail_from": F.min("t").over(w)})
