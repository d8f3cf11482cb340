"""Spatial joins of points and lines with areas, as equi-joins on grid cells.

The areas become one cell table (:mod:`mapfold.operators.cells`): per area and
cell the edges that pass it and the winding number at its corner.  Points and
line segments join it on the cell, with all their columns, and the exact integer
predicate is a function of the joined row: no candidate is exploded against
single edges, nothing is joined back, and there is no nested loop over all
features x all areas.

The table depends on the areas only.  Adaptive execution broadcasts it when its
measured size is small and keeps a shuffled join otherwise; a cell with very many
points is split by its skew handling.  ``grid`` should be about the distance of a
few area vertices: a cell's edges are the work of one test.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.functions.geometry import MICRO, cell, cut_param, point_param, segments_intersect
from mapfold.operators.cells import EDGE, cell_table, edge_cells, on_edges, winding

DEFAULT_GRID = 2 * MICRO  # 2 degree cells for point tests
LINE_GRID = 5 * MICRO  # coarser cells for segments, which pass several


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _odd(px: Column, py: Column, grid: int) -> Column:
    return F.pmod(winding(px, py, grid), F.lit(2)) == 1


def points_in_areas(
    points: DataFrame,
    segs: DataFrame,
    pid="pid",
    key="area_id",
    mode: str = "within",
    grid: int = DEFAULT_GRID,
    x: str = "x",
    y: str = "y",
    payload: Sequence[str] = (),
) -> DataFrame:
    """Pairs (pid.., payload.., key..) where the point is within / intersects the area.

    ``segs`` holds every ring edge of the area (outer rings and holes) as
    (key.., x1, y1, x2, y2); the even-odd rule treats holes and multi-part
    areas without special cases.  ``mode`` is ``within`` (boundary excluded,
    like a strict containment test) or ``intersects`` (boundary included).
    """
    ids, k = [*_keys(pid), *payload], _keys(key)
    pts = points.select(*ids, F.col(x).alias("_px"), F.col(y).alias("_py")).withColumns({"cx": cell("_px", grid), "cy": cell("_py", grid)})
    met = pts.join(cell_table(segs, k, grid), on=["cx", "cy"])
    px, py = F.col("_px"), F.col("_py")
    odd, on = _odd(px, py, grid), on_edges(px, py)
    return met.where(odd & ~on if mode == "within" else odd | on).select(*ids, *k)


def lines_intersect_areas(
    lines: DataFrame,
    segs: DataFrame,
    lid="line_id",
    key="area_id",
    grid: int = LINE_GRID,
) -> DataFrame:
    """Distinct (lid.., key..) where a polyline meets the closed area.

    ``lines`` is one row per line segment (lid.., x1, y1, x2, y2).  A segment
    meets the area if it meets an edge in one of their common cells or starts inside.
    """
    ids, k = _keys(lid), _keys(key)
    met = edge_cells(lines.select(*ids, *EDGE), grid).join(cell_table(segs, k, grid), on=["cx", "cy"])
    own = [F.col(c) for c in EDGE]
    touches = F.exists("edges", lambda e: segments_intersect(*own, *[e[c] for c in EDGE]))
    starts = (cell("x1", grid) == F.col("cx")) & (cell("y1", grid) == F.col("cy")) & _odd(F.col("x1"), F.col("y1"), grid)
    return met.where(touches | starts).select(*ids, *k).distinct()


def clip_lines(
    lines: DataFrame,
    segs: DataFrame,
    lid="line_id",
    key="area_id",
    grid: int = LINE_GRID,
    eps: float = 1e-6,
) -> DataFrame:
    """Pieces of line segments inside the closed area (overlay intersection).

    ``lines``: (lid.., seq, x1, y1, x2, y2) per line segment.  Returns one row
    per inside interval (lid.., seq, x1, y1, x2, y2, key.., t0, t1).  A segment is
    cut by the area edges of the cells it passes; each interval between
    neighbouring cuts is kept when its midpoint lies inside, or on an edge within
    ``eps`` degrees, by its own cell.
    """
    ids, k = _keys(lid), _keys(key)
    sid = [*ids, "seq", *EDGE]
    table = cell_table(segs, k, grid)
    own = [F.col(c) for c in EDGE]

    def cuts(e: Column) -> Column:
        return F.array_compact(F.array(cut_param(*own, *[e[c] for c in EDGE]), point_param(*own, e["x1"], e["y1"]), point_param(*own, e["x2"], e["y2"])))

    met = edge_cells(lines.select(*sid), grid).join(table, on=["cx", "cy"]).select(*sid, *k, F.flatten(F.transform("edges", cuts)).alias("ts"))
    # a segment's own cuts by one area: bounded by the edges it meets
    per = met.groupBy(*sid, *k).agg(F.flatten(F.collect_list("ts")).alias("ts"))
    # -0.0 and 0.0 are one cut
    ts = F.transform("ts", lambda t: F.when(t == 0, F.lit(0.0)).otherwise(t))
    per = per.select(*sid, *k, F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), ts))).alias("ts"))
    iv = per.select(*sid, *k, "ts", F.explode(F.sequence(F.lit(0), F.size("ts") - 2)).alias("i"))
    iv = iv.select(*sid, *k, F.get("ts", F.col("i")).alias("t0"), F.get("ts", F.col("i") + 1).alias("t1"))
    tm = (F.col("t0") + F.col("t1")) / 2
    mids = iv.withColumns({"_mx": F.col("x1") + tm * (F.col("x2") - F.col("x1")), "_my": F.col("y1") + tm * (F.col("y2") - F.col("y1"))})
    mids = mids.withColumns({"cx": F.floor(F.col("_mx") / grid).cast("long"), "cy": F.floor(F.col("_my") / grid).cast("long")})
    mx, my = F.col("_mx"), F.col("_my")

    def near(e: Column) -> Column:
        x1, y1, x2, y2 = (e[c].cast("double") for c in EDGE)
        dx, dy, slack = x2 - x1, y2 - y1, eps * MICRO
        far = F.abs(dx * (my - y1) - dy * (mx - x1)) / F.greatest(F.sqrt(dx * dx + dy * dy), F.lit(1.0))
        return (far <= slack) & mx.between(F.least(x1, x2) - slack, F.greatest(x1, x2) + slack) & my.between(F.least(y1, y2) - slack, F.greatest(y1, y2) + slack)

    judged = mids.join(table, on=[*k, "cx", "cy"])
    return judged.where(_odd(mx, my, grid) | F.exists("edges", near)).select(*sid, *k, "t0", "t1")


def within_first(segs: DataFrame, feature_col: str = "feature_seq") -> DataFrame:
    """Keep only the edges of each area's first feature (reference: first feature only);
    edges that do not say which feature they belong to are an error."""
    if feature_col not in segs.columns:
        raise ValueError(f"within_first needs the column {feature_col}")
    return segs.where(F.col(feature_col) == 0)


def merge_runs(pieces: DataFrame, ids, key="area_id") -> DataFrame:
    """Merge touching inside intervals of one segment into runs.

    ``pieces`` from :func:`clip_lines`; returns (ids.., seq, x1, y1, x2, y2, key.., run,
    t0, t1) where consecutive kept intervals that share an end are one run.
    """
    sid, k = [*_keys(ids), "seq", *EDGE], _keys(key)
    w = Window.partitionBy(*sid, *k).orderBy("t0")
    start = F.when(F.lag("t1").over(w).isNull() | (F.lag("t1").over(w) != F.col("t0")), 1).otherwise(0)
    runs = pieces.withColumn("start", start).withColumn("run", F.sum("start").over(w))
    return runs.groupBy(*sid, *k, "run").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"))
