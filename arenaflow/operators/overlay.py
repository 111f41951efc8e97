"""Text boxes of a frame to records: overlay regions, samples, result cards.

Boxes come as rows (video_id, video_ts, region, pos, text, conf, x0, y0, x1,
y1, w, h); pos is their order in the frame. A frame holds a few dozen boxes, so
its boxes are folded as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import parsing as ps

# Row labels of a result card and their short names.
CARD_ROWS = {
    "blocks scored": "blocks", "long goals controlled": "long_goals", "upper goal controlled": "upper_goal", "lower goal controlled": "lower_goal",
    "parked robots": "parked", "autonomous bonus": "auton_bonus", "autonomous win point": "awp",
}

FRAME = ["video_id", "video_ts"]


def _first(cond: Column, value: Column) -> Column:
    return F.min_by(value, F.when(cond, F.col("pos")))


def _last(cond: Column, value: Column) -> Column:
    return F.max_by(value, F.when(cond, F.col("pos")))


def locate(dets: DataFrame) -> DataFrame:
    """Pixel regions per frame that shows a timer: the timer's, the label's (or null) and, if both alliance headers show, the panel's."""
    box = F.struct("x0", "y0", "x1", "y1")
    red, blue = F.col("text").rlike(r"(?i)RED\s*ALLIANCE"), F.col("text").rlike(r"(?i)BLUE\s*ALLIANCE")
    g = dets.groupBy(*FRAME).agg(
        F.max("w").alias("w"), F.max("h").alias("h"), _first(ps.timer(F.col("text")).isNotNull(), box).alias("timer"), _first(ps.match_label(F.col("text")).isNotNull(), box).alias("label"),
        _last(red, box).alias("red"), _last(blue, box).alias("blue"),
    ).where("timer IS NOT NULL")

    def grown(c: str, fx: float, fy: float) -> Column:
        parts = geo.expand_box(*(F.col(f"{c}.{k}") for k in ("x0", "y0", "x1", "y1")), F.col("w"), F.col("h"), fx, fy)
        return F.when(F.col(c).isNotNull(), F.struct(*[p.alias(n) for p, n in zip(parts, ("x0", "y0", "x1", "y1"))]))

    edge = [F.greatest(F.lit(0.0), F.least(f"red.{k}", f"blue.{k}") - 0.02 * F.col(size)).cast("int") for k, size in (("x0", "w"), ("y0", "h"))]
    panel = F.when(F.col("red").isNotNull() & F.col("blue").isNotNull(), F.struct(edge[0].alias("x0"), edge[1].alias("y0"), F.col("w").cast("int").alias("x1"), F.col("h").cast("int").alias("y1")))
    return g.select(*FRAME, grown("timer", 1.6, 2.2).alias("timer"), grown("label", 1.8, 1.6).alias("label"), panel.alias("panel"))


def samples(dets: DataFrame) -> DataFrame:
    """One sample per frame, from boxes whose region is timer, label or panel: first valid timer and label, last phase; teams and scores only when both alliance headers show."""
    text, region = F.col("text"), F.col("region")
    red, blue = (region == "panel") & text.rlike(r"(?i)RED\s*ALLIANCE"), (region == "panel") & text.rlike(r"(?i)BLUE\s*ALLIANCE")
    # Each pattern is tried only on the texts of its region.
    secs, label, phase = F.when(region == "timer", ps.timer(text)), F.when(region == "label", ps.match_label(text)), F.when(region == "timer", ps.phase(text))
    # A text that names both alliances is the red one's.
    g = dets.withColumns({"secs": secs, "label": label, "phase": phase, "red": red, "blue": blue}).groupBy(*FRAME).agg(
        _first(F.col("secs").isNotNull(), F.col("secs")).alias("timer"), _last(F.col("phase").isNotNull(), F.col("phase")).alias("phase_text"),
        _first(F.col("label").isNotNull(), F.col("label")).alias("match_name"), _last(F.col("red"), F.col("y0")).alias("ry"), _last(F.col("blue") & ~F.col("red"), F.col("y0")).alias("by"),
        F.array_sort(F.collect_list(F.when(region == "panel", F.struct("pos", F.trim(text).alias("text"), "y0", (F.col("y1") - F.col("y0")).alias("height"))))).alias("boxes"),
    )
    both = F.col("ry").isNotNull() & F.col("by").isNotNull()

    def of(side: str) -> Column:
        mine, other = (F.col("ry"), F.col("by")) if side == "red" else (F.col("by"), F.col("ry"))
        # Equal heights of the headers make the section of the first one, blue, begin and end at once.
        upper = (mine < other) if side == "red" else (mine <= other)
        section = F.filter("boxes", lambda b: both & F.when(upper, (b["y0"] >= mine) & (b["y0"] < other)).otherwise(b["y0"] >= mine))
        return section

    out = g.withColumns({"red_boxes": of("red"), "blue_boxes": of("blue")})
    # The team rows' heights are a column of their own, else every box would compute them anew.
    out = out.withColumns({f"{s}_rows": F.transform(F.filter(f"{s}_boxes", lambda b: b["text"].rlike(ps.TEAM)), lambda b: b["y0"]) for s in ("red", "blue")})

    def teams(side: str) -> Column:
        return F.transform(F.filter(f"{side}_boxes", lambda b: b["text"].rlike(ps.TEAM)), lambda b: b["text"])

    def live(side: str) -> Column:
        rows = F.col(f"{side}_rows")
        free = F.filter(f"{side}_boxes", lambda b: b["text"].rlike(ps.SCORE) & ~F.exists(rows, lambda y: F.abs(b["y0"] - y) < b["height"] * 1.2))
        best = F.array_max(F.transform(free, lambda b: F.struct(b["height"].alias("height"), b["text"].try_cast("int").alias("value"))))
        return F.when(F.size(rows) > 0, best["value"])

    return out.select(
        *FRAME, "timer", "phase_text", "match_name", teams("red").alias("red_teams"), teams("blue").alias("blue_teams"), live("red").alias("red_score"), live("blue").alias("blue_score")
    )


def result_cards(dets: DataFrame) -> DataFrame:
    """Result cards of the frames that are one: name, both scores, teams, and breakdown slug -> {red, blue}; needs a name, the row of scored blocks and a large number in each outer third."""
    low = F.lower(F.trim("text"))
    slug = F.array_compact(F.array(*[F.when(low.contains(k), F.lit(v)) for k, v in CARD_ROWS.items()]))
    label = ps.match_label(F.col("text"))
    g = dets.groupBy(*FRAME).agg(
        F.max("w").alias("w"), _first(label.isNotNull(), label).alias("name"),
        F.array_sort(F.collect_list(F.struct("pos", F.trim("text").alias("text"), "x0", "y0", "y1", slug.alias("slugs")))).alias("boxes"),
    )
    rows = F.flatten(F.transform("boxes", lambda b: F.transform(b["slugs"], lambda s: F.struct(s.alias("slug"), b["y0"].alias("y0"), b["y1"].alias("y1")))))
    nums = F.transform(
        F.filter("boxes", lambda b: b["text"].rlike(ps.SCORE)),
        lambda b: F.struct((b["y1"] - b["y0"]).alias("height"), (-b["pos"]).alias("order"), b["x0"].alias("x"), ((b["y0"] + b["y1"]) / 2).alias("yc"), b["text"].try_cast("int").alias("value")),
    )
    g = g.withColumns({"rows": rows, "nums": nums, "w": F.col("w").cast("double")}).where("name IS NOT NULL AND size(nums) > 0 AND exists(rows, r -> r.slug = 'blocks')")
    g = g.withColumn("median", F.element_at(F.array_sort(F.transform("nums", lambda n: n["height"])), F.floor(F.size("nums") / 2).cast("int") + 1))
    tall = F.filter("nums", lambda n: n["height"] >= 1.5 * F.col("median"))
    g = g.withColumns({"r": F.array_max(F.filter(tall, lambda n: n["x"] < F.col("w") / 3)), "b": F.array_max(F.filter(tall, lambda n: n["x"] > 2 * F.col("w") / 3))}).where("r IS NOT NULL AND b IS NOT NULL")
    inner = F.filter("nums", lambda n: (n["order"] != F.col("r.order")) & (n["order"] != F.col("b.order")) & (n["x"] > 0.2 * F.col("w")) & (n["x"] < 0.8 * F.col("w")))
    # The row of a number is the first, by first mention of its slug, whose last band holds it.
    slugs = F.array_distinct(F.transform("rows", lambda r: r["slug"]))

    def band(s: Column) -> Column:
        return F.try_element_at(F.filter("rows", lambda r: r["slug"] == s), F.lit(-1))

    def slug_of(n: Column) -> Column:
        return F.get(F.filter(slugs, lambda s: n["yc"].between(band(s)["y0"] - 5, band(s)["y1"] + 5)), F.lit(0))

    g = g.withColumn("inner", F.transform(inner, lambda n: F.struct(slug_of(n).alias("slug"), (n["x"] < F.col("w") / 2).alias("left"), n["value"].alias("value"))))

    def side(s: Column, left: bool) -> Column:
        return F.try_element_at(F.filter("inner", lambda n: (n["slug"] == s) & (n["left"] == left)), F.lit(-1))["value"]

    hit = F.array_distinct(F.transform(F.filter("inner", lambda n: n["slug"].isNotNull()), lambda n: n["slug"]))
    breakdown = F.map_from_entries(F.transform(hit, lambda s: F.struct(s, F.struct(side(s, True).alias("red"), side(s, False).alias("blue")))))
    token = lambda b: F.split_part(b["text"], F.lit(" "), F.lit(1))

    def team_list(left: bool) -> Column:
        half = lambda b: (b["x0"] < F.col("w") / 2) if left else (b["x0"] >= F.col("w") / 2)
        return F.transform(F.filter("boxes", lambda b: token(b).rlike(ps.TEAM) & half(b)), token)

    return g.select(*FRAME, F.col("name").alias("match_name"), F.col("r.value").alias("red_score"), F.col("b.value").alias("blue_score"), breakdown.alias("breakdown"), team_list(True).alias("red_teams"), team_list(False).alias("blue_teams"))
