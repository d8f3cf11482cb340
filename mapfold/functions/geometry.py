"""Geometry as column expressions.

Coordinates are bigint micro-degrees.  |lon| <= 180e6 so every cross product
below stays under 2^63 and the predicates are exact.  All functions return
``Column`` objects that stay inside whole-stage codegen (no Python UDFs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000  # micro-degrees per degree

POINT_T = "struct<kind:string,parts:array<array<array<struct<x:bigint,y:bigint>>>>>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_micro(deg) -> Column:
    """Degrees (double or text) -> bigint micro-degrees; bad text -> NULL."""
    return F.round(_c(deg).try_cast("double") * MICRO).cast("long")


def point(x, y) -> Column:
    """Point geometry struct from micro-degree columns (proj_points_from_xy)."""
    v = F.struct(_c(x).cast("long").alias("x"), _c(y).cast("long").alias("y"))
    return F.struct(F.lit("Point").alias("kind"), F.array(F.array(F.array(v))).alias("parts"))


def cell(v, size) -> Column:
    """Grid cell index of a micro-degree coordinate; the size is a number or a column."""
    return F.floor(_c(v) / (size if isinstance(size, Column) else F.lit(size))).cast("long")


def crosses_ray(px, py, x1, y1, x2, y2) -> Column:
    """Segment crosses the horizontal ray from (px, py) to +x (half-open rule).

    Counts when exactly one end lies strictly above py and the crossing lies
    strictly right of px; tested without division.
    """
    px, py, x1, y1, x2, y2 = map(_c, (px, py, x1, y1, x2, y2))
    lhs = (py - y1) * (x2 - x1)
    rhs = (px - x1) * (y2 - y1)
    right = F.when(y2 > y1, lhs > rhs).otherwise(lhs < rhs)
    return ((y1 > py) != (y2 > py)) & right


def on_segment(px, py, x1, y1, x2, y2) -> Column:
    """Point lies on the closed segment (exact)."""
    px, py, x1, y1, x2, y2 = map(_c, (px, py, x1, y1, x2, y2))
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return (
        (cross == 0)
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def orient(ax, ay, bx, by, cx, cy) -> Column:
    """Sign of the cross product (b-a) x (c-a): -1, 0, 1."""
    ax, ay, bx, by, cx, cy = map(_c, (ax, ay, bx, by, cx, cy))
    v = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return F.when(v > 0, F.lit(1)).when(v < 0, F.lit(-1)).otherwise(F.lit(0))


def segments_intersect(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Closed segments a and b share at least one point (exact)."""
    a = list(map(_c, (ax1, ay1, ax2, ay2)))
    b = list(map(_c, (bx1, by1, bx2, by2)))
    o1 = orient(a[0], a[1], a[2], a[3], b[0], b[1])
    o2 = orient(a[0], a[1], a[2], a[3], b[2], b[3])
    o3 = orient(b[0], b[1], b[2], b[3], a[0], a[1])
    o4 = orient(b[0], b[1], b[2], b[3], a[2], a[3])
    proper = (o1 * o2 < 0) & (o3 * o4 < 0)
    touch = (
        ((o1 == 0) & on_segment(b[0], b[1], *a))
        | ((o2 == 0) & on_segment(b[2], b[3], *a))
        | ((o3 == 0) & on_segment(a[0], a[1], *b))
        | ((o4 == 0) & on_segment(a[2], a[3], *b))
    )
    return proper | touch


def cut_param(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Parameter t in [0, 1] where non-parallel segment b meets segment a, else NULL.

    Collinear overlaps are handled by ``point_param`` on b's end points.
    """
    a = list(map(_c, (ax1, ay1, ax2, ay2)))
    b = list(map(_c, (bx1, by1, bx2, by2)))
    dax, day = a[2] - a[0], a[3] - a[1]
    dbx, dby = b[2] - b[0], b[3] - b[1]
    den = dax * dby - day * dbx
    tn = (b[0] - a[0]) * dby - (b[1] - a[1]) * dbx
    un = (b[0] - a[0]) * day - (b[1] - a[1]) * dax
    # t = tn/den and u = un/den must both lie in [0, 1]; compare without division
    pos = (tn >= 0) & (tn <= den) & (un >= 0) & (un <= den)
    neg = (tn <= 0) & (tn >= den) & (un <= 0) & (un >= den)
    ok = F.when(den > 0, pos).when(den < 0, neg).otherwise(F.lit(False))
    return F.when(ok, tn.cast("double") / den.cast("double"))


def point_param(ax1, ay1, ax2, ay2, px, py) -> Column:
    """Parameter of point p along segment a when p lies on a, else NULL."""
    ax1, ay1, ax2, ay2, px, py = map(_c, (ax1, ay1, ax2, ay2, px, py))
    dx, dy = ax2 - ax1, ay2 - ay1
    num = ((px - ax1) * dx + (py - ay1) * dy).cast("double")
    den = (dx * dx + dy * dy).cast("double")
    return F.when(on_segment(px, py, ax1, ay1, ax2, ay2) & (den > 0), num / den)


def seg_len_deg(x1, y1, x2, y2) -> Column:
    """Planar length in degrees."""
    x1, y1, x2, y2 = map(_c, (x1, y1, x2, y2))
    return F.sqrt(F.pow((x2 - x1).cast("double"), 2) + F.pow((y2 - y1).cast("double"), 2)) / MICRO


#: half the width of the web Mercator plane, in metres
MERCATOR = 20037508.342789244


def aligned(crs, x, y, target: str) -> tuple[Column, Column]:
    """Coordinates in the ``target`` system (EPSG:4326 or EPSG:3857): those that are in it
    already stay, those of the other one are projected, of any other are null."""
    pi = F.lit(3.141592653589793)
    crs, x, y = _c(crs), _c(x), _c(y)
    if target == "EPSG:4326":
        other, px, py = "EPSG:3857", x * 180 / MERCATOR, F.atan(F.exp(y * pi / MERCATOR)) * 360 / pi - 90
    elif target == "EPSG:3857":
        other, px, py = "EPSG:4326", x * MERCATOR / 180, F.log(F.tan((90 + y) * pi / 360)) / pi * MERCATOR
    else:
        raise ValueError(f"unknown reference system {target}")
    return F.when(crs == target, x).when(crs == other, px), F.when(crs == target, y).when(crs == other, py)
