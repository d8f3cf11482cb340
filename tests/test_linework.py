"""Goldens of linework by kind, geometry dedupe, ring repair, centroids and mosaics."""

import pytest
from pyspark.sql import functions as F

from mapfold.operators import overlay as OV
from mapfold.operators import raster as RA
from mapfold.plans.lines import clip_by_kind

EDGES = "row_id long, part int, ring int, eid int, x1 long, y1 long, x2 long, y2 long"
M = 10**6


def edges(spark, *shapes):
    rows = []
    for rid, rings in shapes:
        e = 0
        for (part, ring), pts in rings.items():
            for (a, b), (c, d) in zip(pts, pts[1:] + pts[:1]):
                rows.append((rid, part, ring, e, a * M, b * M, c * M, d * M))
                e += 1
    return spark.createDataFrame(rows, EDGES)


SQUARE, HOLE = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 2), (2, 2), (2, 1)]


def test_linework_by_kind_of_the_first_feature(spark):
    feats = spark.createDataFrame(
        [(1, 10, "Polygon"), (1, 11, "MultiPolygon"), (1, 12, "Polygon"), (2, 20, "LineString"), (2, 21, "LineString"), (3, 30, "Point"), (3, 31, "Polygon")],
        "file_id long, row_id long, kind string",
    )
    geo = edges(spark, (10, {(0, 0): SQUARE, (0, 1): HOLE}), (11, {(0, 0): SQUARE, (0, 1): HOLE}), (12, {(0, 0): SQUARE}), (20, {(0, 0): SQUARE}), (21, {(0, 0): SQUARE}), (31, {(0, 0): SQUARE}))
    got = sorted((r.file_id, r.row_id or 0, r.status, r.ring, r.n_vertices) for r in OV.linework(feats, geo).collect())
    # 11 has the geometry of 10; equal lines both stay; a file that begins with a point is one error
    assert got == [(1, 10, "ok", 0, 5), (1, 10, "ok", 1, 5), (1, 12, "ok", 0, 5), (2, 20, "ok", 0, 5), (2, 21, "ok", 0, 5), (3, 0, "unsupported Point", None, None)]
    line = OV.ring_lines(geo.where("row_id = 12"), "row_id").first().line
    assert line == "0 0, 4000000 0, 4000000 4000000, 0 4000000, 0 0"


def test_equal_geometries_whatever_the_start_and_direction(spark):
    geo = edges(spark, (1, {(0, 0): SQUARE}), (2, {(0, 0): SQUARE[2:] + SQUARE[:2]}), (3, {(0, 0): SQUARE[::-1]}), (4, {(0, 0): HOLE}))
    assert sorted(tuple(r) for r in OV.distinct_geometries(geo, "row_id").collect()) == [(1, 3), (4, 1)]


def test_rings_are_closed_without_repeats_and_short_ones_go(spark):
    ring = [(0, 0), (4, 0), (4, 0), (4, 4), (0, 4)]
    geo = edges(spark, (1, {(0, 0): ring}), (2, {(0, 0): [(0, 0), (1, 1)]})).where("not (row_id = 1 and eid = 4)")
    got = [tuple(v // M for v in r) for r in OV.repair_rings(geo, "row_id").orderBy("row_id", "eid").select("x1", "y1", "x2", "y2").collect()]
    assert got == [(0, 0, 4, 0), (4, 0, 4, 4), (4, 4, 0, 0)]


def test_centroids_of_a_polygon_with_a_hole_a_line_and_a_point(spark):
    rows = edges(spark, (1, {(0, 0): SQUARE, (0, 1): HOLE})).withColumn("areal", F.lit(True))
    line = spark.createDataFrame([(2, 0, 0, 10 * M, 0, False), (2, 10 * M, 0, 10 * M, 2 * M, False), (3, 5, 6, 5, 6, False)], "row_id long, x1 long, y1 long, x2 long, y2 long, areal boolean")
    cols = ["row_id", "x1", "y1", "x2", "y2", "areal"]
    got = {r.row_id: (r.cx, r.cy) for r in OV.centroids(rows.select(*cols).unionByName(line.select(*cols)), "row_id").collect()}
    assert got[1] == (2.033333, 2.033333)  # (16 * 2 - 1 * 1.5) / 15
    assert got[2] == (round(70 / 12, 6), round(2 / 12, 6)) and got[3] == (0.000005, 0.000006)


def test_mosaic_at_the_finest_resolution(spark):
    tiles = spark.createDataFrame([("a", 1, 1, 0, 0, 5), ("a", 1, 1, 3, 3, 6), ("a", 2, 2, 0, 0, 9), ("b", 1, 2, 1, 1, 7)], "k string, tile_order long, res int, r long, c long, v long")
    got = {(r.k, r.r, r.c): r.v for r in RA.mosaic_finest(tiles, ("k",)).collect()}
    assert got == {("a", 0, 0): 9, ("a", 0, 1): 9, ("a", 1, 0): 9, ("a", 1, 1): 9, ("a", 3, 3): 6, ("b", 1, 1): 7}


def test_unknown_kinds_are_an_error(spark):
    with pytest.raises(ValueError):
        clip_by_kind(spark.range(1), "raster", spark.range(1), "id")
