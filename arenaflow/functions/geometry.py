"""Field geometry as column expressions: homographies, polygons, distances, boxes."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..game import Game, Zone


def project(h: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """The point under the homography h (array of 9, row by row); where the denominator is 0 both are 0."""
    w = h[6] * x + h[7] * y + h[8]
    ok = w != 0
    return F.when(ok, (h[0] * x + h[1] * y + h[2]) / w).otherwise(0.0), F.when(ok, (h[3] * x + h[4] * y + h[5]) / w).otherwise(0.0)


def inverse(h: Column) -> Column:
    """The inverse homography by the adjugate; null if it is singular."""
    a, b, c, d, e, f, g, i, k = (h[n] for n in range(9))
    det = a * (e * k - f * i) - b * (d * k - f * g) + c * (d * i - e * g)
    adj = [e * k - f * i, c * i - b * k, b * f - c * e, f * g - d * k, a * k - c * g, c * d - a * f, d * i - e * g, b * g - a * i, a * e - b * d]
    return F.when(det != 0, F.array(*[x / det for x in adj]))


def fit(pixel: np.ndarray, field: np.ndarray) -> np.ndarray:
    """Homography (9 values, the last 1) that takes pixel points to field points, least squares for more than 4; raises for fewer."""
    if len(pixel) < 4:
        raise ValueError("a homography needs 4 points")
    rows, rhs = [], []
    for (x, y), (u, v) in zip(pixel, field):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        rhs += [u, v]
    return np.append(np.linalg.lstsq(np.array(rows, float), np.array(rhs, float), rcond=None)[0], 1.0)


def inside(zone: Zone, x: Column, y: Column) -> Column:
    """Even-odd test against the zone's polygon; a point on a lower or left edge is in, on an upper or right edge out."""
    tests = []
    for (x0, y0), (x1, y1) in zip(zone.polygon, (*zone.polygon[1:], zone.polygon[0])):
        if y0 == y1:
            continue
        lo, hi = min(y0, y1), max(y0, y1)
        slope = (x1 - x0) / (y1 - y0)
        tests.append((y >= lo) & (y < hi) & (x < (y - y0) * slope + x0))
    crossed = reduce(lambda a, b: a + b, [t.cast("int") for t in tests], F.lit(0))
    return F.pmod(crossed, F.lit(2)) == 1


def inside_any(zones: tuple[Zone, ...], x: Column, y: Column) -> Column:
    return reduce(lambda a, b: a | b, [inside(z, x, y) for z in zones], F.lit(False))


def zone_at(game: Game, x: Column, y: Column) -> Column:
    """Name of the first zone, in the game's order, that holds the point; else null."""
    return F.coalesce(*[F.when(inside(z, x, y), F.lit(z.name)) for z in game.zones], F.lit(None).cast("string"))


def in_bounds(game: Game, x: Column, y: Column, margin: float = 6.0) -> Column:
    return x.between(-margin, game.size + margin) & y.between(-margin, game.size + margin)


def clamp(game: Game, c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(game.size), c))


def mean_l1(a: Column, b: Column) -> Column:
    """Mean absolute difference of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def block_scale(h: Column, x: Column, y: Column, step: float = 4.0) -> Column:
    """Mean pixel length of steps of `step` inches in x and in y at the field point; h takes pixels to the field."""
    back = inverse(h)
    (x0, y0), (x1, y1), (x2, y2) = (project(back, x + dx, y + dy) for dx, dy in ((0.0, 0.0), (step, 0.0), (0.0, step)))
    return (F.hypot(x1 - x0, y1 - y0) + F.hypot(x2 - x0, y2 - y0)) / 2


def robot_scale(game: Game, h: Column, inches: float = 18.0) -> Column:
    """Pixel length of a robot's width at the field's centre."""
    back, mid = inverse(h), F.lit(game.size / 2)
    (x0, y0), (x1, y1) = project(back, mid, mid), project(back, mid + inches, mid)
    return F.hypot(x1 - x0, y1 - y0)


def ground_contact(x0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    return (x0 + x1) / 2, y1


def yolo_box(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column) -> list[Column]:
    """Centre and size as shares of the image."""
    return [F.round(v, 6) for v in ((x0 + x1) / 2 / w, (y0 + y1) / 2 / h, (x1 - x0) / w, (y1 - y0) / h)]


def percent_box(cx: Column, cy: Column, bw: Column, bh: Column) -> list[Column]:
    """Left, top, width and height in percent, from centre and size."""
    return [(cx - bw / 2) * 100, (cy - bh / 2) * 100, bw * 100, bh * 100]


def expand_box(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column, fx: float = 1.5, fy: float = 1.5) -> list[Column]:
    """The box scaled about its centre, cut to the image, as whole pixels."""
    cx, cy, hw, hh = (x0 + x1) / 2, (y0 + y1) / 2, (x1 - x0) / 2 * fx, (y1 - y0) / 2 * fy
    return [F.greatest(F.lit(0.0), cx - hw).cast("int"), F.greatest(F.lit(0.0), cy - hh).cast("int"), F.least(w.cast("double"), cx + hw).cast("int"), F.least(h.cast("double"), cy + hh).cast("int")]


def ocr_box(x: Column, y: Column, bw: Column, bh: Column, w: Column, h: Column) -> list[Column]:
    """Pixels from the top left, from shares that count from the bottom left."""
    return [x * w, (1 - y - bh) * h, (x + bw) * w, (1 - y) * h]


def quad_box(quad: Column) -> list[Column]:
    """Bounding box of an array of {x, y}."""
    xs, ys = F.transform(quad, lambda p: p["x"]), F.transform(quad, lambda p: p["y"])
    return [F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)]


def canvas(game: Game, x: Column, y: Column, scale: float) -> tuple[Column, Column]:
    """Canvas pixels of a field point; y grows downwards there."""
    return x * scale, (game.size - y) * scale


def homography_text(h: Column) -> Column:
    """The nine values as a JSON list."""
    return F.to_json(h)


def homography_of(text: Column) -> Column:
    """The homography of a JSON list; null unless it holds nine numbers."""
    h = F.from_json(text, "array<double>")
    return F.when((F.size(h) == 9) & ~F.exists(h, lambda v: v.isNull()), h)


def shifted_box(x0: Column, y0: Column, x1: Column, y1: Column, left: Column, top: Column) -> list[Column]:
    """A box found in a crop, in the frame's pixels: the crop's corner added."""
    return [x0 + left, y0 + top, x1 + left, y1 + top]


def block_sized(w: Column, h: Column, area: Column, scale: Column) -> Column:
    """Whether a blob may be one block of `scale` pixels: 0.4 to 2.5 of it long, at least 0.15 of its square, at most 2.5 times as long as wide."""
    long, short = F.greatest(w, h), F.least(w, h)
    return long.between(0.4 * scale, 2.5 * scale) & (area >= 0.15 * scale * scale) & (long / F.greatest(short, F.lit(1)) <= 2.5)


def robot_sized(w: Column, h: Column, area: Column, scale: Column) -> Column:
    """Whether a blob may be a robot of `scale` pixels: 0.35 to 1.8 of it long, at least 0.15 of its square."""
    return F.greatest(w, h).between(0.35 * scale, 1.8 * scale) & (area >= 0.15 * scale * scale)


def ordered_corners(quad: Column, red_left: Column) -> Column:
    """An array of four {x, y} as near and far corners: the two lower in the frame are near; from the red side's near one around. Equal heights keep their order."""
    placed = F.transform(quad, lambda p, i: F.struct(p["y"].alias("y"), i.alias("i"), p["x"].alias("x")))
    by_y = F.array_sort(placed)

    def pair(from_: int) -> tuple[Column, Column]:
        two = F.array_sort(F.transform(F.slice(by_y, from_, 2), lambda p: F.struct(p["x"].alias("x"), p["i"].alias("i"), p["y"].alias("y"))))
        return two[0], two[1]

    (far_l, far_r), (near_l, near_r) = pair(1), pair(3)
    corners = F.when(red_left, F.array(near_l, near_r, far_r, far_l)).otherwise(F.array(near_r, near_l, far_l, far_r))
    return F.transform(corners, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
