"""Overlay of polygon layers: intersection, difference, union, symmetric
difference, dissolve and containment, and rings from the resulting edges.

Polygons are edge tables (id, eid, x1, y1, x2, y2), micro-degrees, interior left
of each edge.  An overlay

1. pairs edges that pass a common grid cell and cuts both where they cross or
   touch (crossing points are rounded to micro-degrees once, for both),
2. joins equal pieces, so that an edge shared by both polygons is one piece with
   a direction for each,
3. finds for every other piece whether it runs inside the other polygon, from
   the edges of its midpoint's own cell (:mod:`mapfold.operators.cells`),
4. keeps the pieces that have the wanted region on exactly one side, directed
   with that side on the left.

What is kept is the boundary of the result, again an edge table of the same
kind.  Pairs come from common cells only; no layer is matched against all of
another.

Polygons of at most ``SMALL`` edges, which most are, take these steps pair by pair
(:mod:`mapfold.operators.pairs`): a pair meets in one cell alone (that of its boxes'
common corner) and nothing is shuffled after that join.  Larger polygons are never
gathered; their edges go only to partners in their cells, except where parts outside
the partner belong to the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapfold.functions.geometry import MICRO, cell
from mapfold.operators.cells import EDGE, cell_table, edge_cells, parted, walked, winding
from mapfold.operators.linework import chains
from mapfold.operators.pairs import REGIONS, left_within_right, overlaid
from mapfold.operators.store import stored

GRID = 2 * MICRO

#: polygons of more edges are overlaid cell by cell, not in one row
SMALL = 64


def _named(edges: DataFrame, key: str, side: str) -> DataFrame:
    return edges.select(F.col(key).alias(f"{side}id"), F.col("eid").alias(f"{side}eid"), *[F.col(c).alias(f"{side}{c}") for c in EDGE])


def _ends(side: str) -> list[Column]:
    return [F.col(f"{side}{c}") for c in EDGE]


def _cuts(p: list[Column], q: list[Column]) -> tuple[Column, Column]:
    """Points that cut edge p and edge q, as arrays of (x, y); an edge is x1, y1, x2, y2."""
    (px1, py1, px2, py2), (qx1, qy1, qx2, qy2) = p, q
    dx, dy, ex, ey = px2 - px1, py2 - py1, qx2 - qx1, qy2 - qy1
    den = dx * ey - dy * ex
    t = (qx1 - px1) * ey - (qy1 - py1) * ex
    u = (qx1 - px1) * dy - (qy1 - py1) * dx
    sign = F.signum(den.cast("double")).cast("long")
    met = (den != 0) & (t * sign).between(F.lit(0), F.abs(den)) & (u * sign).between(F.lit(0), F.abs(den))
    at = t.cast("double") / den.cast("double")

    def vertex(x: Column, y: Column) -> Column:
        return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

    crossing = vertex(F.floor(px1 + at * dx + 0.5), F.floor(py1 + at * dy + 0.5))
    in_line = (den == 0) & (t == 0) & (u == 0)

    def held(x1, y1, x2, y2, x, y) -> Column:
        inside = x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
        return F.when(in_line & inside, vertex(x, y))

    one = F.when(met, crossing)
    on_p = F.array_compact(F.array(one, held(px1, py1, px2, py2, qx1, qy1), held(px1, py1, px2, py2, qx2, qy2)))
    on_q = F.array_compact(F.array(one, held(qx1, qy1, qx2, qy2, px1, py1), held(qx1, qy1, qx2, qy2, px2, py2)))
    return on_p, on_q


def _middle() -> dict[str, Column]:
    """Twice the midpoint of a piece, exact."""
    return {"mx": F.col("ax") + F.col("bx"), "my": F.col("ay") + F.col("by")}


def _pieces(rows: DataFrame, ids: list[str]) -> DataFrame:
    """Pieces of edges: ``rows`` (ids.., eid, x1..y2, cuts) hold an edge any number of times.

    Returns (ids.., eid, ax, ay, bx, by, turn): a before b in (x, y) order, turn 1
    if the edge runs from a to b, else -1.
    """
    whole = rows.groupBy(*ids, "eid", *EDGE).agg(F.flatten(F.collect_list("cuts")).alias("cuts"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def placed(x: Column, y: Column) -> Column:
        return F.struct((dx * (x - F.col("x1")) + dy * (y - F.col("y1"))).alias("at"), x.alias("x"), y.alias("y"))

    ends = F.array(placed(F.col("x1"), F.col("y1")), placed(F.col("x2"), F.col("y2")))
    # equal points stand side by side once sorted, nothing lies between them
    whole = whole.withColumn("p", F.array_sort(F.concat(ends, F.transform("cuts", lambda c: placed(c["x"], c["y"])))))
    step = F.explode(F.sequence(F.lit(0), F.size("p") - 2))
    parts = whole.select(*ids, "eid", "p", step.alias("i"))
    parts = parts.select(*ids, "eid", F.get("p", F.col("i")).alias("s"), F.get("p", F.col("i") + 1).alias("e")).where("s != e")
    ahead = F.struct("s.x", "s.y") < F.struct("e.x", "e.y")
    a, b = F.when(ahead, F.col("s")).otherwise(F.col("e")), F.when(ahead, F.col("e")).otherwise(F.col("s"))
    parts = parts.select(*ids, "eid", a.alias("a"), b.alias("b"), F.when(ahead, 1).otherwise(-1).alias("turn"))
    return parts.select(*ids, "eid", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"), "turn")


def meeting_pairs(left_cells: DataFrame, right_cells: DataFrame) -> DataFrame:
    """(lid, rid) of polygons that have a common cell."""
    return left_cells.select("lid", "cx", "cy").join(right_cells.select("rid", "cx", "cy"), ["cx", "cy"]).select("lid", "rid").distinct()


def _layer(edges: DataFrame, key: str, name: str) -> DataFrame:
    return edges.select(F.col(key).alias(name), "eid", *EDGE).dropna()


def _by_size(layer: DataFrame, key: str, small: int) -> tuple[DataFrame, DataFrame | None]:
    """The edges of small polygons and, if there are any, those of large ones."""
    large = stored(layer.groupBy(key).count().where(F.col("count") > small).select(key), "overlay-large")
    if large.isEmpty():
        return layer, None
    return layer.join(large, key, "left_anti"), layer.join(large, key, "left_semi")


def _shapes(layer: DataFrame, s: str, grid: int, corner: bool = False) -> DataFrame:
    """({s}id, {s}e, box, cx, cy): each polygon with its edges, once per cell of its box or,
    if ``corner``, in that of its lower left corner alone.  An edge that occurs again is not ``once``."""
    low = {f"{s}{a}0": F.min(F.least(f"{a}1", f"{a}2")) for a in "xy"}
    high = {f"{s}{a}9": F.max(F.greatest(f"{a}1", f"{a}2")) for a in "xy"}
    box = layer.groupBy(f"{s}id").agg(F.collect_list(F.struct("eid", *EDGE)).alias("e"), *[v.alias(k) for k, v in (low | high).items()])
    edges = F.transform("e", lambda e, i: F.struct(*[e[c].alias(c) for c in EDGE], (F.array_position("e", e) == i + 1).alias("once")))
    box = box.select(f"{s}id", edges.alias(f"{s}e"), *low, *high)
    for a in "xy":
        first, last = cell(f"{s}{a}0", grid), cell(f"{s}{a}9", grid)
        box = box.withColumn(f"c{a}", first if corner else F.explode(F.sequence(first, last)))
    return box


def _met(left: DataFrame, right: DataFrame, grid: int, held: bool = False) -> DataFrame:
    """One row per pair of polygons whose boxes meet, in the cell of the boxes' common corner; if
    ``held``, per pair with the left box in the right one, where that is the left one's corner."""
    met = _shapes(left, "l", grid, held).join(_shapes(right, "r", grid), ["cx", "cy"])
    if held:
        return met.where(reduce_and((F.col(f"l{a}0") >= F.col(f"r{a}0")) & (F.col(f"l{a}9") <= F.col(f"r{a}9")) for a in "xy"))
    boxes = reduce_and((F.col(f"l{a}0") <= F.col(f"r{a}9")) & (F.col(f"r{a}0") <= F.col(f"l{a}9")) for a in "xy")
    home = reduce_and(F.col(f"c{a}") == cell(F.greatest(f"l{a}0", f"r{a}0"), grid) for a in "xy")
    return met.where(boxes & home)


def overlay(left: DataFrame, right: DataFrame, region: str, lid: str = "lid", rid: str = "rid", grid: int = GRID, overlapping: bool = True, small: int = SMALL) -> DataFrame:
    """(lid, rid, x1, y1, x2, y2): boundary of the region of every pair whose insides
    overlap; if not ``overlapping``, of every pair whose boxes meet (where one polygon has
    over ``small`` edges: that has a common cell)."""
    l, r = _layer(left, lid, "lid"), _layer(right, rid, "rid")
    (ls, ll), (rs, rl) = _by_size(l, "lid", small), _by_size(r, "rid", small)
    out = overlaid(_met(ls, rs, 2 * grid), region, overlapping)
    if ll is not None:
        out = out.unionByName(_overlay_cells(ll, r, region, grid, overlapping))
    if rl is not None:
        out = out.unionByName(_overlay_cells(ls, rl, region, grid, overlapping))
    return out


def _overlay_cells(left: DataFrame, right: DataFrame, region: str, grid: int, overlapping: bool) -> DataFrame:
    """The overlay of layers (lid, eid, x1..y2) and (rid, eid, x1..y2) by cells, for polygons of any size."""
    inside = REGIONS[region]
    sides = {"l": _named(left, "lid", "l"), "r": _named(right, "rid", "r")}
    plain = {s: df.toDF(f"{s}id", "eid", *EDGE) for s, df in sides.items()}
    tables = {s: cell_table(df, f"{s}id", grid) for s, df in plain.items()}
    other = {"l": "r", "r": "l"}
    passed = {s: edge_cells(df, grid) for s, df in plain.items()}

    # edges that can have a part in the result, and the cuts of those that meet
    none = F.array().cast("array<struct<x:bigint,y:bigint>>").alias("cuts")
    whole = {"intersection": "", "difference": "l", "union": "lr", "symdiff": "lr"}[region]
    pairs = meeting_pairs(tables["l"], tables["r"]) if whole else None
    rows = []
    for s, o in other.items():
        if s in whole:
            part = plain[s].join(pairs, f"{s}id")
        else:
            part = passed[s].join(tables[o].select(f"{o}id", "cx", "cy"), ["cx", "cy"])
        rows.append(part.select(F.lit(s).alias("side"), "lid", "rid", "eid", *EDGE, none))
    near = {s: passed[s].toDF(f"{s}id", f"{s}eid", *[f"{s}{c}" for c in EDGE], "cx", "cy") for s in "lr"}
    boxes = reduce_and(
        (F.greatest(f"l{a}1", f"l{a}2") >= F.least(f"r{a}1", f"r{a}2")) & (F.least(f"l{a}1", f"l{a}2") <= F.greatest(f"r{a}1", f"r{a}2")) for a in "xy"
    )
    on_l, on_r = _cuts(_ends("l"), _ends("r"))
    met = near["l"].join(near["r"], ["cx", "cy"]).where(boxes).withColumn("on_l", on_l).withColumn("on_r", on_r).where(F.size("on_l") + F.size("on_r") > 0)
    # one row per crossing edge pair carries both edges with their cuts
    both = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}eid").alias("eid"), *[F.col(f"{s}{c}").alias(c) for c in EDGE], F.col(f"on_{s}").alias("cuts")) for s in "lr"])
    rows.append(met.select("lid", "rid", F.inline(both)).select("side", "lid", "rid", "eid", *EDGE, "cuts"))
    cut = rows[0].unionByName(rows[1]).unionByName(rows[2])

    pieces = _pieces(cut, ["side", "lid", "rid"]).withColumns(_middle())
    per = pieces.groupBy("lid", "rid", "ax", "ay", "bx", "by", "mx", "my").agg(
        *[F.sum(F.when(F.col("side") == s, F.col("turn"))).alias(f"turn_{s}") for s in "lr"]
    )
    # a piece of one polygon alone is judged by the other's cell under its midpoint
    alone = F.when(F.col("turn_l").isNull(), F.lit("l")).when(F.col("turn_r").isNull(), F.lit("r"))
    per = per.withColumn("judge", alone).withColumn("jid", F.when(F.col("judge") == "l", F.col("lid")).when(F.col("judge") == "r", F.col("rid")))
    per = per.withColumns({"cx": cell("mx", 2 * grid), "cy": cell("my", 2 * grid)})
    cells = tables["l"].select(F.lit("l").alias("judge"), F.col("lid").alias("jid"), "cx", "cy", "w0", "edges").unionByName(
        tables["r"].select(F.lit("r").alias("judge"), F.col("rid").alias("jid"), "cx", "cy", "w0", "edges")
    )
    # shared pieces need no judge; they would all meet under the null key
    shared = per.where(F.col("judge").isNull()).withColumn("within", F.lit(None).cast("boolean"))
    judged = per.where(F.col("judge").isNotNull()).join(cells, ["judge", "jid", "cx", "cy"], "left")
    judged = judged.withColumn("within", F.pmod(winding(F.col("mx"), F.col("my"), grid, scale=2), F.lit(2)) == 1).select(*shared.columns)
    per = judged.unionByName(shared)

    def beside(s: str, left_side: bool) -> Column:
        turn = F.col(f"turn_{s}")
        return F.when(turn.isNull(), F.col("within")).when(turn == 0, F.lit(True)).otherwise(turn > 0 if left_side else turn < 0)

    if overlapping and region != "intersection":
        per = stored(per, "overlay-pieces")  # asked twice: for the region and for the overlap
    left_side, right_side = ([beside(s, on_left) for s in "lr"] for on_left in (True, False))
    kept = _directed(per.withColumn("on_left", inside(*left_side)).withColumn("on_right", inside(*right_side)), ["lid", "rid"])
    if not overlapping or region == "intersection":
        return kept
    common = per.where((left_side[0] & left_side[1]) != (right_side[0] & right_side[1])).select("lid", "rid").distinct()
    return kept.join(common, ["lid", "rid"], "left_semi")


def reduce_and(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def _directed(per: DataFrame, ids: list[str]) -> DataFrame:
    """Pieces with the region on one side, which becomes their left."""
    kept = per.where(F.col("on_left") != F.col("on_right"))
    turned = {"x1": ("ax", "bx"), "y1": ("ay", "by"), "x2": ("bx", "ax"), "y2": ("by", "ay")}
    return kept.select(*ids, *[F.when(F.col("on_left"), F.col(a)).otherwise(F.col(b)).alias(c) for c, (a, b) in turned.items()])


def _cut_points(pairs: DataFrame, ids: list[str]) -> DataFrame:
    """(ids.., eid, x1..y2, x, y): the points inside an edge that cut it, from rows (ids.., size, cx, cy)
    of two edges l and r in a cell; each in the cell it lies in.  The ends of an edge do not cut it.

    The points of ``_cuts``, in steps small enough to be compiled; few pairs pass the second.
    """
    (px1, py1, px2, py2), (qx1, qy1, qx2, qy2) = _ends("l"), _ends("r")
    dx, dy, ex, ey = px2 - px1, py2 - py1, qx2 - qx1, qy2 - qy1
    kept = [*ids, "size", "cx", "cy", *[f"{s}{c}" for s in "lr" for c in ("eid", *EDGE)]]
    t, u = (qx1 - px1) * ey - (qy1 - py1) * ex, (qx1 - px1) * dy - (qy1 - py1) * dx
    signs = pairs.select(*kept, F.inline(F.array(F.struct((dx * ey - dy * ex).alias("den"), t.alias("t"), u.alias("u")))))
    den, t, u = F.col("den"), F.col("t"), F.col("u")
    between = lambda v: F.when(den > 0, (v >= 0) & (v <= den)).otherwise((v <= 0) & (v >= den))
    at_end = lambda v: (v == 0) | (v == den)
    met = signs.where(F.when(den == 0, (t == 0) & (u == 0)).otherwise(between(t) & between(u) & ~(at_end(t) & at_end(u))))
    at = t.cast("double") / F.when(den != 0, den.cast("double"))
    met = met.withColumns({"x": F.floor(px1 + at * dx + 0.5), "y": F.floor(py1 + at * dy + 0.5)})

    def point(s: str, on: Column, x: str, y: str) -> Column:
        return F.struct(F.lit(s).alias("side"), F.when(on, F.col(x)).alias("x"), F.when(on, F.col(y)).alias("y"))

    cross, line = den != 0, den == 0
    points = [point(s, cross, "x", "y") for s in "lr"] + [point(s, line, f"{o}x{k}", f"{o}y{k}") for s, o in ("lr", "rl") for k in (1, 2)]
    met = met.select(*kept, F.inline(F.array(*points))).where(F.col("x").isNotNull())
    cuts = met.select(*ids, "size", "cx", "cy", "x", "y", *[F.when(F.col("side") == "l", F.col(f"l{c}")).otherwise(F.col(f"r{c}")).alias(c) for c in ("eid", *EDGE)])
    here = reduce_and(F.col(f"c{a}") == cell(a, F.col("size")) for a in "xy")
    on = reduce_and(F.col(a).between(F.least(f"{a}1", f"{a}2"), F.greatest(f"{a}1", f"{a}2")) for a in "xy")
    inner = reduce_and((F.col("x") != F.col(f"x{k}")) | (F.col("y") != F.col(f"y{k}")) for k in (1, 2))
    return cuts.where(here & on & inner).select(*ids, "eid", *EDGE, "x", "y")


def _dissolve_cells(base: DataFrame, grid: int, crowd: int, parts: int, levels: int) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """(gid, oid, size, cx, cy, w0, edges) of the members' cells that no member covers as a whole, and
    for each size but the last its cells (gid, cx, cy) that were taken apart.  Cells with over ``crowd``
    edges fall into ``parts`` x ``parts`` smaller ones, of which again only those that nobody covers are
    left, up to ``levels`` times."""
    n = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at, size, left, apart = ["gid", "cx", "cy"], grid, [], []
    cells = cell_table(base, ["gid", "oid"], grid, "eid")
    for level in range(levels + 1):
        here = Window.partitionBy(*at)
        covered = F.max((F.size("edges") == 0) & (F.col("w0") > 0)).over(here)
        cells = cells.withColumns({"covered": covered, "n": F.sum(F.size("edges")).over(here)}).where(~F.col("covered")).drop("covered")
        cells = stored(cells, "dissolve-cells")
        found = cells.drop("n").withColumn("size", F.lit(size).cast("long"))
        if level == levels or size % parts:
            left.append(found)
            break
        crowded = stored(cells.where(F.col("n") > crowd).select(*at).distinct(), "dissolve-crowded")
        left.append(found.join(crowded, at, "left_anti"))
        if crowded.isEmpty():
            break
        apart.append((size, crowded))
        # few rows make much work: they are dealt to all tasks
        cells = parted(cells.where(F.col("n") > crowd).drop("n").repartition(n, "oid", *at), size, parts)
        size //= parts
    return reduce(DataFrame.unionByName, left), apart


def dissolve(edges: DataFrame, group: str, member: str, grid: int = GRID // 2, crowd: int = 64, parts: int = 4, levels: int = 3) -> DataFrame:
    """(group, x1, y1, x2, y2): boundary of the union of all polygons of a group.

    ``edges``: (group, member, eid, x1..y2), eid unique within the group.  Where
    the members' edges cancel or run under another member nothing is left.

    No boundary runs through a cell that one member covers as a whole: edges are
    neither cut nor judged there, so the work does not grow with what lies on top of
    each other.  Ends of boundary pieces lie in cells that nobody covers, where all
    their edges are found.  Cells with many edges are taken apart first (``_dissolve_cells``).

    In the cells that are left every edge meets every other and every piece every edge; both
    are plain row by row tests, and only what they find goes on: a point inside an edge, once,
    in the cell it lies in, and an edge that the walk to a piece's midpoint crosses.
    """
    base = edges.select(F.col(group).alias("gid"), F.col(member).alias("oid"), "eid", *EDGE).repartition("gid", "oid")
    cells, apart = _dissolve_cells(base, grid, crowd, parts, levels)
    at = ["gid", "size", "cx", "cy"]
    passed = cells.select(*at, "oid", F.inline("edges"))
    near = {s: passed.select(*at, *[F.col(c).alias(f"{s}{c}") for c in ("oid", "eid", *EDGE)]) for s in "lr"}
    boxes = reduce_and(
        (F.greatest(f"l{a}1", f"l{a}2") >= F.least(f"r{a}1", f"r{a}2")) & (F.least(f"l{a}1", f"l{a}2") <= F.greatest(f"r{a}1", f"r{a}2")) for a in "xy"
    )
    pairs = near["l"].join(near["r"], at).where((F.col("loid") < F.col("roid")) & boxes)
    cuts = _cut_points(pairs, ["gid"]).distinct().select("gid", "eid", *EDGE, F.array(F.struct("x", "y")).alias("cuts"))
    none = F.array().cast("array<struct<x:bigint,y:bigint>>").alias("cuts")
    rows = passed.select("gid", "eid", *EDGE).distinct().select("*", none).unionByName(cuts)
    pieces = _pieces(rows, ["gid"]).withColumns(_middle())
    place = [*at, "ax", "ay", "bx", "by"]
    per = pieces.groupBy("gid", "ax", "ay", "bx", "by", "mx", "my").agg(F.sum("turn").alias("turn"), F.collect_set("eid").alias("owners")).where(F.col("turn") != 0)
    table = cells.groupBy(*at).agg(F.sum("w0").alias("w0"), F.flatten(F.collect_list("edges")).alias("edges"))
    # a piece lies in one of the cells that are left, of whatever size, or in none
    per = per.withColumn("size", F.lit(grid).cast("long"))
    for size, crowded in apart:
        smaller = crowded.select("gid", F.lit(size).cast("long").alias("size"), *[F.col(c).alias(f"_{c}") for c in ("cx", "cy")], F.lit(size // parts).cast("long").alias("smaller"))
        per = per.withColumns({f"_c{a}": cell(f"m{a}", 2 * size) for a in "xy"}).join(smaller, ["gid", "size", "_cx", "_cy"], "left")
        per = per.withColumn("size", F.coalesce("smaller", "size")).drop("smaller", "_cx", "_cy")
    beside = per.withColumns({f"c{a}": cell(f"m{a}", F.col("size") * 2) for a in "xy"}).join(table, at)
    # each piece beside each edge of its cell; the corner's number goes with the first
    beside = beside.select(*place, "mx", "my", "turn", "owners", "w0", F.posexplode("edges").alias("pos", "e"))
    x0, y0 = F.col("cx") * (2 * F.col("size")), F.col("cy") * (2 * F.col("size"))
    ends = [(F.col("e")[c] * 2).alias(c) for c in EDGE]
    corner = F.when(F.col("pos") == 0, F.col("w0"))
    beside = beside.select(*place, "mx", "my", "turn", "owners", F.inline(F.array(F.struct(F.col("e")["eid"].alias("eid"), *ends, x0.alias("x0"), y0.alias("y0"), corner.alias("corner")))))
    crosses = lambda a, at: (F.col(f"{a}1") > F.col(at)) != (F.col(f"{a}2") > F.col(at))
    beside = beside.where(F.col("corner").isNotNull() | crosses("x", "x0") | crosses("y", "my"))
    change = walked([F.col(c) for c in EDGE], F.col("x0"), F.col("y0"), F.col("mx"), F.col("my"), F.array_contains("owners", F.col("eid")))
    beside = beside.select(*place, "turn", "corner", change.alias("change"))
    # the walk ends west of a piece (north of a level one): its left unless it falls
    judged = beside.groupBy(*place, "turn").agg((F.sum("change") + F.sum("corner")).alias("end")).withColumn("falls", F.col("by") < F.col("ay"))
    judged = judged.withColumn("on_left", F.when(F.col("falls"), F.col("end") + F.col("turn")).otherwise(F.col("end")) > 0)
    judged = judged.withColumn("on_right", F.when(F.col("falls"), F.col("end")).otherwise(F.col("end") - F.col("turn")) > 0)
    return _directed(judged, ["gid"]).withColumnRenamed("gid", group)


def within(left: DataFrame, right: DataFrame, lid: str = "lid", rid: str = "rid", grid: int = GRID, small: int = SMALL) -> DataFrame:
    """(lid, rid) where the left polygon lies wholly in the right one: nothing of it is left outside."""
    l, r = _layer(left, lid, "lid"), _layer(right, rid, "rid")
    (ls, ll), (rs, rl) = _by_size(l, "lid", small), _by_size(r, "rid", small)
    out = left_within_right(_met(ls, rs, 2 * grid, held=True))
    for some, others in ((ll, r), (ls, rl)):
        if some is not None and others is not None:
            outside = _overlay_cells(some, others, "difference", grid, False).select("lid", "rid").distinct()
            pairs = meeting_pairs(cell_table(some, "lid", grid), cell_table(others, "rid", grid))
            out = out.unionByName(pairs.join(outside, ["lid", "rid"], "left_anti"))
    return out.toDF(lid, rid)


def doubled_area(edges: DataFrame, *keys: str) -> DataFrame:
    """Twice the area per key in square micro-degrees (exact)."""
    wide = [F.col(c).cast("decimal(20,0)") for c in EDGE]
    return edges.groupBy(*keys).agg(F.sum(wide[0] * wide[3] - wide[2] * wide[1]).alias("area2"))


def rings(edges: DataFrame, *keys: str) -> DataFrame:
    """(keys.., line, seq, x1, y1, x2, y2, closed): the directed edges as ordered rings;
    rings that touch in a vertex stay apart."""
    return chains(edges, list(keys))
