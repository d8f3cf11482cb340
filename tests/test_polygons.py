"""Overlays of hand-made polygons: holes, shared edges, vertex touches, area identities."""

import pytest

from mapfold.functions.geometry import MICRO as M
from mapfold.operators import polygons as P

SCHEMA = "id long, eid long, x1 long, y1 long, x2 long, y2 long"


def layer(spark, *polygons):
    """Polygons as (id, rings); outer rings counter-clockwise, holes clockwise."""
    rows, eid = [], 0
    for pid, rings in polygons:
        for ring in rings:
            for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
                rows.append((pid, eid, round(a * M), round(b * M), round(c * M), round(d * M)))
                eid += 1
    return spark.createDataFrame(rows, SCHEMA)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def hole(x0, y0, x1, y1):
    return box(x0, y0, x1, y1)[::-1]


def areas(edges, *keys):
    return {tuple(r[: len(keys)]): float(r["area2"]) / 2 / M / M for r in P.doubled_area(edges, *keys).collect()}


def pair_area(left, right, region, grid=2 * M):
    return areas(P.overlay(left, right, region, "id", "id", grid, overlapping=False), "lid", "rid")


@pytest.mark.parametrize("grid", [M // 2, 2 * M, 100 * M])
def test_crossing_boxes(spark, grid):
    a, b = layer(spark, (1, [box(0, 0, 10, 10)])), layer(spark, (7, [box(5, -3, 20, 4)]))
    want = {"intersection": 20.0, "difference": 80.0, "union": 100 + 105 - 20.0, "symdiff": 100 + 105 - 40.0}
    for region, area in want.items():
        assert pair_area(a, b, region, grid) == {(1, 7): area}


def test_hole_against_box(spark):
    a, b = layer(spark, (1, [box(0, 0, 10, 10), hole(4, 4, 6, 6)])), layer(spark, (2, [box(5, 5, 12, 9)]))
    assert pair_area(a, b, "intersection") == {(1, 2): 19.0}
    assert pair_area(a, b, "symdiff") == {(1, 2): 96 + 28 - 38.0}
    # a box that fills the hole exactly: only shared edges, opposite ways
    c = layer(spark, (3, [box(4, 4, 6, 6)]))
    assert pair_area(a, c, "intersection") == {}
    assert pair_area(a, c, "union") == {(1, 3): 100.0}
    assert pair_area(a, c, "difference") == {(1, 3): 96.0}


def test_shared_edge_and_vertex_touch(spark):
    a = layer(spark, (1, [box(0, 0, 2, 2)]))
    b = layer(spark, (1, [box(2, 0, 4, 2)]), (2, [box(2, 2, 3, 3)]), (3, [box(0, 0, 2, 1)]))
    assert pair_area(a, b, "intersection") == {(1, 3): 2.0}
    joined = P.overlay(a, b, "union", "id", "id", overlapping=False)
    assert areas(joined, "lid", "rid") == {(1, 1): 8.0, (1, 2): 5.0, (1, 3): 4.0}
    # the shared edge of the neighbours is gone; both keep their outline where they touch in a vertex
    assert joined.where("rid = 1 and x1 = 2000000 and x2 = 2000000").count() == 0
    lines = P.rings(joined, "lid", "rid").collect()
    assert {(r.rid, r.line) for r in lines} == {(1, 0), (2, 0), (2, 1), (3, 0)}
    assert all(r.closed for r in lines)


def test_skew_crossings_area_identities_and_closed_rings(spark):
    a = layer(spark, (1, [[(0, 0), (13.7, 1.3), (9.1, 11.9)]]), (2, [[(-3, 2), (4.4, -7), (12, 3.3), (5, 5), (6, 12)]]))
    b = layer(spark, (5, [[(1, -2), (11, 4.7), (3, 9)]]), (6, [[(2, 2), (8, 2.5), (7, 8)], [(4, 3), (6, 5), (6.5, 3.2)]]))
    parts = {r: pair_area(a, b, r) for r in P.REGIONS}
    for pair, both in parts["intersection"].items():
        assert both > 0
        alone = {1: 0.5 * abs(13.7 * 11.9 - 9.1 * 1.3)}.get(pair[0])
        if alone:
            assert parts["difference"][pair] + both == pytest.approx(alone, abs=1e-4)
        assert parts["union"][pair] - both == pytest.approx(parts["symdiff"][pair], abs=1e-9)
    rings = P.rings(P.overlay(a, b, "symdiff", "id", "id"), "lid", "rid").collect()
    assert rings and all(r.closed for r in rings)
    ends = {}
    for r in rings:
        ends.setdefault((r.lid, r.rid, r.line), []).append(r)
    for ring in ends.values():
        ring.sort(key=lambda r: r.seq)
        assert [r.seq for r in ring] == list(range(len(ring)))
        assert all((p.x2, p.y2) == (q.x1, q.y1) for p, q in zip(ring, ring[1:] + ring[:1]))


def test_pairs_that_only_touch_are_no_overlap(spark):
    a, b = layer(spark, (1, [box(0, 0, 2, 2)])), layer(spark, (1, [box(2, 0, 4, 2)]), (2, [box(2, 2, 3, 3)]), (3, [box(1, 1, 3, 3)]))
    got = areas(P.overlay(a, b, "symdiff", "id", "id"), "lid", "rid")
    assert got == {(1, 3): 6.0}


def test_dissolve_leaves_no_inner_edge(spark):
    edges = layer(spark, (1, [box(0, 0, 2, 2)]), (2, [box(2, 0, 4, 2)]), (3, [box(1, 1, 3, 5)]), (4, [box(10, 10, 11, 11)]))
    made = P.dissolve(edges.selectExpr("0 as g", "id", "eid", "x1", "y1", "x2", "y2"), "g", "id")
    assert areas(made, "g") == {(0,): 8 + 8 - 2 + 1.0}
    assert made.where("x1 = 2000000 and x2 = 2000000").count() == 0
    assert {r.line for r in P.rings(made, "g").collect()} == {0, 1}


def test_dissolve_skew_members(spark):
    edges = layer(spark, (1, [[(0, 0), (10, 1), (6, 9)]]), (2, [[(3, -2), (9, 4), (2, 6)]]), (3, [[(0, 0), (10, 1), (6, 9)]]))
    made = P.dissolve(edges.selectExpr("0 as g", "id", "eid", "x1", "y1", "x2", "y2"), "g", "id")
    two = edges.where("id = 1"), edges.where("id = 2")
    assert areas(made, "g")[(0,)] == pytest.approx(pair_area(*two, "union")[(1, 2)], abs=1e-6)
    assert all(r.closed for r in P.rings(made, "g").collect())


def test_within_respects_holes_and_partial_overlap(spark):
    areas_ = layer(spark, (1, [box(0, 0, 10, 10), hole(4, 4, 6, 6)]), (2, [box(20, 0, 30, 10)]))
    lakes = layer(
        spark, (1, [box(1, 1, 3, 3)]), (2, [box(3, 3, 7, 7)]), (3, [box(4.5, 4.5, 5, 5)]), (4, [box(9, 1, 11, 2)]),
        (5, [box(0, 0, 4, 10)]), (6, [box(21, 1, 22, 2), box(8, 8, 9, 9)]), (7, [box(4, 1, 6, 4)]), (8, [box(20, 0, 30, 10)]),
    )
    got = {tuple(r) for r in P.within(lakes, areas_.withColumnRenamed("id", "area_id"), "id", "area_id").collect()}
    assert got == {(1, 1), (5, 1), (7, 1), (8, 2)}


def edges_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_and_cells_give_the_same_overlay(spark):
    a = layer(spark, (1, [box(0, 0, 10, 10), hole(4, 4, 6, 6)]), (2, [[(1, 1), (9, 2), (3, 7)]]))
    b = layer(spark, (7, [box(5, -3, 20, 5)]), (8, [box(0, 0, 12, 12)]), (9, [box(30, 30, 31, 31)]))
    by_row = edges_of(P.overlay(a, b, "symdiff", "id", "id"))
    assert by_row and by_row == edges_of(P.overlay(a, b, "symdiff", "id", "id", small=4))
    held = [edges_of(P.within(a.withColumnRenamed("id", "lid"), b.withColumnRenamed("id", "rid"), small=n)) for n in (4, 64)]
    assert held == [[(1, 8), (2, 8)]] * 2


def test_small_polygons_are_shuffled_only_to_meet(spark):
    a, b = layer(spark, (1, [box(0, 0, 10, 10)])), layer(spark, (7, [box(5, -3, 20, 4)]))
    plan = P.overlay(a, b, "symdiff", "id", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4, plan


@pytest.mark.parametrize("grid", [M, 100 * M])
def test_dissolve_leaves_out_what_lies_under_a_member(spark, grid):
    under = [(n, [box(3 + n / 100, 3 + n / 50, 6 - n / 70, 6)]) for n in range(2, 12)]
    rows = layer(spark, (1, [box(0, 0, 10, 10)]), *under, (20, [box(8, 8, 14, 12)]))
    out = P.dissolve(rows.selectExpr("0L gid", "id oid", "eid", "x1", "y1", "x2", "y2"), "gid", "oid", grid)
    assert areas(out, "gid") == {(0,): 120.0} and out.count() == 8


def test_dissolve_cuts_no_edges_in_covered_cells(spark):
    rows = layer(spark, *[(n, [box(0 - n, 0 - n, 20 + n, 20 + n)]) for n in (1, 2)]).selectExpr("0L gid", "id oid", "eid", "x1", "y1", "x2", "y2")
    plan = P.dissolve(rows, "gid", "oid")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") >= 3


def test_dissolve_takes_crowded_cells_apart(spark):
    # many polygons stand on one corner, so the cell there and those along the axes are never covered as a whole
    fans = [(n, [box(0, 0, 3 + n / 10, 2 + n / 7)] if n % 2 else [[(0, 0), (4 + n / 9, n / 8), (n / 5, 5)]]) for n in range(1, 25)]
    rows = layer(spark, *fans, (30, [box(-1, -1, 0, 0)]), (31, [box(-0.5, 0.25, 0.125, 0.75)])).selectExpr("0L gid", "id oid", "eid", "x1", "y1", "x2", "y2")
    whole = edges_of(P.dissolve(rows, "gid", "oid", levels=0))
    assert whole and whole == edges_of(P.dissolve(rows, "gid", "oid", crowd=8, levels=2))
    cells = P._dissolve_cells(rows.select("gid", "oid", "eid", *P.EDGE), M, 8, 4, 2)[0]
    assert cells.select("size").distinct().count() == 3


def test_dissolve_judges_pieces_row_by_row(spark):
    rows = layer(spark, (1, [box(0, 0, 2, 2)]), (2, [box(1, 1, 3, 3)])).selectExpr("0L gid", "id oid", "eid", "x1", "y1", "x2", "y2")
    plan = P.dissolve(rows, "gid", "oid")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(edges" not in plan and "array_distinct" not in plan


def test_pairs_are_overlaid_many_at_once_in_bounded_steps(spark, monkeypatch):
    import pyarrow as pa

    from mapfold.operators import pairs

    a = layer(spark, *[(n, [box(n, 0, n + 9, 9), hole(n + 2, 2, n + 4, 4)]) for n in range(6)], (7, [box(0, 0, 2, 2)]))
    b = layer(spark, *[(n, [[(n, -1), (n + 8, 3.5), (n + 1, 7)]]) for n in range(5)], (8, [box(2, 0, 4, 2)]))
    met = P._met(*(P._layer(e, "id", k) for e, k in ((a, "lid"), (b, "rid"))), 4 * M).select("lid", "rid", "le", "re").toArrow().combine_chunks()
    batch = met.to_batches()[0]
    want = edges_of(P.overlay(a, b, "symdiff", "id", "id", small=1))
    for step in (1, 400, 1 << 18):
        monkeypatch.setattr(pairs, "STEP", step)
        got, most = [], 0
        for part, l, r in pairs._steps(batch):
            pair, ends, overlap = pairs.outlines(l, r, "symdiff")
            most = max(most, len(part))
            got += [(part["lid"][k].as_py(), part["rid"][k].as_py(), *map(int, e)) for k, *e in zip(pair.tolist(), *ends) if overlap[k]]
        assert sorted(got) == want and (most == 1) == (step == 1)
    assert isinstance(batch["le"], pa.ListArray)
    plan = P.overlay(a, b, "symdiff", "id", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan


def test_repeated_edges_count_once_as_edges_and_each_time_inside(spark):
    a, b = layer(spark, (1, [box(0, 0, 10, 10)])), layer(spark, (7, [box(5, -3, 20, 4)]))
    twice = b.unionByName(b)
    for region in ("intersection", "symdiff"):
        by_row = edges_of(P.overlay(a, twice, region, "id", "id", overlapping=False))
        # a point in the repeated polygon has an even number of edges to its west
        assert by_row == edges_of(P.overlay(a, twice, region, "id", "id", overlapping=False, small=5)) != edges_of(P.overlay(a, b, region, "id", "id", overlapping=False))


def test_contained_polygons_are_looked_for_in_one_cell(spark):
    wide = layer(spark, (1, [box(0, 0, 90, 90)]), (2, [box(-4, -4, 30, 30)]))
    shapes = P._shapes(P._layer(wide, "id", "lid"), "l", 4 * M, corner=True)
    assert sorted(tuple(r) for r in shapes.select("lid", "cx", "cy").collect()) == [(1, 0, 0), (2, -1, -1)]
    within = P.within(wide.withColumnRenamed("id", "lid"), wide.withColumnRenamed("id", "rid"))
    assert edges_of(within) == [(1, 1), (2, 2)]


def test_containment_is_judged_many_pairs_at_once(spark):
    lakes = layer(spark, *[(n, [box(n, 1, n + 2, 3)]) for n in range(8)])
    land = layer(spark, (1, [box(0, 0, 5, 5)]), (2, [[(3, 0), (9.5, 0), (9.5, 5), (8, 2.5), (3, 5)]]))
    found = P.within(lakes.withColumnRenamed("id", "lid"), land.withColumnRenamed("id", "rid"))
    assert edges_of(found) == [(0, 1), (1, 1), (2, 1), (3, 1), (3, 2), (4, 2), (5, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # no lambda works through the edges of a pair; the left polygons are not repeated per cell
    assert "MapInArrow" in plan and plan.count("Generate explode") == 2
