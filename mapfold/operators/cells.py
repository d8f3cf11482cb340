"""Polygons as grid cells: which cells an edge passes, the winding number at
each cell's corner, and the winding number at any point from its own cell alone.

A polygon layer is an edge table (key.., x1, y1, x2, y2) in micro-degrees whose
interior lies left of every edge (outer rings counter-clockwise, holes
clockwise); for even-odd questions the direction does not matter.

``cell_table`` keeps, per polygon and touched cell, the edges that pass the cell
and the winding number at its lower left corner, and one row per untouched cell
inside.  A point is then judged by the edges of its own cell: the walk from the
corner up the cell's left side and along the point's own height changes the
winding number by one at each edge it crosses.  All tests are signs of integer
products, ties are those of a walk moved by two infinitesimals (the left side to
the right by d, the height up by e, e far below d), so corners and vertices on
grid lines need no special case.

Corner numbers come from one pass: an edge that crosses a grid line to the left
of a corner changes it, so they are running sums along a row of cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.functions.geometry import cell

EDGE = ["x1", "y1", "x2", "y2"]


def edge_cells(edges: DataFrame, grid: int) -> DataFrame:
    """Every row of ``edges`` once per cell (cx, cy) that the edge passes.

    Column by column, so a diagonal edge gets a diagonal of cells, not its box;
    a micro-degree of slack keeps the neighbours of edges along cell borders.
    """
    cols = edges.columns
    columns = F.explode(F.sequence(cell(F.least("x1", "x2"), grid), cell(F.greatest("x1", "x2"), grid)))
    rows = edges.select("*", columns.alias("cx"))
    low, high = _rows_passed([F.col(c) for c in EDGE], F.col("cx"), grid)
    rows = rows.select(*cols, "cx", low.alias("_low"), high.alias("_high"))
    return rows.select(*cols, "cx", F.explode(F.sequence("_low", "_high")).alias("cy"))


def _rows_passed(edge: list[Column], cx: Column, grid: int) -> tuple[Column, Column]:
    """The lowest and the highest cell that an edge x1, y1, x2, y2 passes in column cx."""
    x1, y1, x2, y2 = edge
    dx, dy = x2 - x1, y2 - y1

    def height(x: Column) -> Column:
        at = F.least(F.greatest(x, F.least(x1, x2)), F.greatest(x1, x2))
        return y1 + (at - x1) * dy / dx

    left, right = height(cx * grid - 1), height((cx + 1) * grid + 1)
    low = F.when(dx == 0, F.least(y1, y2).cast("double")).otherwise(F.least(left, right))
    high = F.when(dx == 0, F.greatest(y1, y2).cast("double")).otherwise(F.greatest(left, right))
    return F.floor((low - 1) / grid).cast("long"), F.floor((high + 1) / grid).cast("long")


def corner_steps(edges: DataFrame, key: list[str], grid: int) -> DataFrame:
    """(key.., cy, pos, step): crossing row cy's lower grid line, the edges change
    the winding number by ``step`` at every corner from column ``pos`` on."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # lines with low <= line < high; an empty range must not count down
    first, last = F.ceil(low / F.lit(grid)).cast("long"), F.ceil(high / F.lit(grid)).cast("long") - 1
    rows = edges.where(first <= last).select(*key, *EDGE, F.explode(F.sequence(first, last)).alias("cy"))
    up = dy > 0
    num = (F.col("x1") * dy + (F.col("cy") * grid - F.col("y1")) * dx) * F.when(up, 1).otherwise(-1)
    den = F.abs(dy) * grid
    pos = F.call_function("div", num, den) + F.when(num % den > 0, 1).otherwise(0)
    return rows.select(*key, "cy", pos.alias("pos"), F.when(up, -1).otherwise(1).alias("step"))


def cell_table(edges: DataFrame, key, grid: int, eid: str | None = None) -> DataFrame:
    """(key.., cx, cy, w0, edges): winding number at the cell's corner and the edges
    that pass it (an empty list: the cell lies inside as a whole).  Cells outside
    are absent.  ``eid`` is carried in the edges if given."""
    k = [key] if isinstance(key, str) else list(key)
    kept = [*([eid] if eid else []), *EDGE]
    touched = edge_cells(edges.select(*k, *kept), grid).groupBy(*k, "cy", F.col("cx").alias("pos")).agg(F.collect_list(F.struct(*kept)).alias("edges"))
    steps = corner_steps(edges, k, grid).groupBy(*k, "cy", "pos").agg(F.sum("step").alias("step"))
    rows = touched.join(steps, [*k, "cy", "pos"], "full_outer")
    row = Window.partitionBy(*k, "cy").orderBy("pos")
    rows = rows.select(
        *k, "cy", "pos", "edges",
        F.sum("step").over(row.rangeBetween(Window.unboundedPreceding, 0)).alias("w0"),
        F.sum("step").over(row.rangeBetween(Window.unboundedPreceding, 1)).alias("after"),
    ).where(F.col("edges").isNotNull()).na.fill(0, ["w0", "after"])
    rows = rows.withColumn("next", F.lead("pos").over(row))
    gap = F.when((F.col("after") != 0) & (F.col("next") > F.col("pos") + 1), F.sequence(F.col("pos") + 1, F.col("next") - 1))
    empty = F.filter("edges", lambda e: F.lit(False))
    inside = F.transform(F.coalesce(gap, F.array().cast("array<bigint>")), lambda c: F.struct(c.alias("cx"), F.col("after").alias("w0"), empty.alias("edges")))
    own = F.array(F.struct(F.col("pos").alias("cx"), "w0", "edges"))
    return rows.select(*k, "cy", F.inline(F.concat(own, inside))).select(*k, "cx", "cy", "w0", "edges")


def parted(rows: DataFrame, grid: int, parts: int) -> DataFrame:
    """Rows (.., cx, cy, w0, edges) of a cell table, each cell in ``parts`` x ``parts`` smaller ones.

    A part's corner is reached by the walk from the cell's corner, so a cell needs nothing
    but its own row.
    """
    if grid % parts:
        raise ValueError(f"a cell of {grid} does not fall into {parts} parts")
    size, others = grid // parts, [c for c in rows.columns if c not in ("cx", "cy", "w0", "edges")]
    x0, y0 = (F.col("cx") * grid).alias("x0"), (F.col("cy") * grid).alias("y0")
    part = lambda c: F.explode(F.sequence(F.col(c) * parts, F.col(c) * parts + (parts - 1))).alias(c)
    rows = rows.select(*others, "w0", "edges", x0, y0, "cy", part("cx")).select(*others, "w0", "edges", "x0", "y0", "cx", part("cy"))
    ends = lambda e: [e[c] for c in EDGE]
    px, py = F.col("cx") * size, F.col("cy") * size
    w0 = F.aggregate("edges", F.col("w0").cast("long"), lambda n, e: n + walked(ends(e), F.col("x0"), F.col("y0"), px, py, corner=True))

    def passes(e: Column) -> Column:
        low, high = _rows_passed(ends(e), F.col("cx"), size)
        column = F.col("cx").between(cell(F.least(e["x1"], e["x2"]), size), cell(F.greatest(e["x1"], e["x2"]), size))
        return column & F.col("cy").between(low, high)

    # a generator, as a filter on these columns would be moved below them and work them twice
    rows = rows.select(*others, "cx", "cy", F.inline(F.array(F.struct(w0.alias("w0"), F.filter("edges", passes).alias("edges")))))
    return rows.where((F.col("w0") != 0) | (F.size("edges") > 0))


def winding(px: Column, py: Column, grid: int, scale: int = 1) -> Column:
    """Winding number at (px, py) from its cell's columns cx, cy, w0, edges.

    Coordinates may be multiplied by ``scale`` (2 for midpoints).  Without a cell
    (left join) it is 0.
    """
    x0, y0 = F.col("cx") * (grid * scale), F.col("cy") * (grid * scale)
    change = lambda total, e: total + walked([e[c] * scale for c in EDGE], x0, y0, px, py)
    return F.coalesce(F.aggregate("edges", F.col("w0").cast("long"), change), F.lit(0).cast("long"))


def walked(edge: list[Column], x0: Column, y0: Column, px: Column, py: Column, owner: Column | None = None, corner: bool = False) -> Column:
    """By how much an edge x1, y1, x2, y2 changes the winding number on the walk from its
    cell's corner (x0, y0) to (px, py).  The walk ends on the west side (north of a level
    edge) of an edge that the point lies on, an ``owner``; if to a ``corner``, d to its right."""
    x1, y1, x2, y2 = edge
    dx, dy = x2 - x1, y2 - y1

    def above(y: Column) -> Column:
        side = ((y1 - y) * dx + (x0 - x1) * dy) * F.signum(dx.cast("double")).cast("long")
        return (side > 0) | ((side == 0) & (F.signum(dx.cast("double")) * F.signum(dy.cast("double")) > 0))

    def right_of(x: Column) -> Column:
        return ((x1 - x) * dy + (py - y1) * dx) * F.signum(dy.cast("double")).cast("long")

    up = F.when(((x1 > x0) != (x2 > x0)) & above(y0) & ~above(py), F.when(dx > 0, 1).otherwise(-1)).otherwise(0)
    spans, sign = (y1 > py) != (y2 > py), F.when(dy < 0, 1).otherwise(-1)
    passed = right_of(px) <= 0 if corner else right_of(px) < 0
    along = F.when(spans & passed & (right_of(x0) > 0), sign).otherwise(0)
    if owner is not None:
        # one on the cell's left side was passed on the way
        along = F.when(spans, F.when(owner, F.when(right_of(x0) <= 0, -sign).otherwise(0)).otherwise(along)).otherwise(0)
    return up + along


def on_edges(px: Column, py: Column) -> Column:
    """The point lies on one of the cell's edges."""

    def on(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
        return (cross == 0) & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return F.exists("edges", on)
