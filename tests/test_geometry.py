"""Hand-made geometry goldens: squares, holes, notches, boundary points."""

import pytest
from pyspark.sql import functions as F

from mapfold.operators import overlay as OV
from mapfold.operators import spatial_join as sj

M = 1_000_000


def ring(area_id, pts):
    return [(area_id, i, pts[i][0] * M, pts[i][1] * M, pts[(i + 1) % len(pts)][0] * M, pts[(i + 1) % len(pts)][1] * M)
            for i in range(len(pts))]


def segs_df(spark, rows):
    return spark.createDataFrame(rows, "area_id long, seq int, x1 long, y1 long, x2 long, y2 long")


def pts_df(spark, pts):
    return spark.createDataFrame([(i, int(x * M), int(y * M)) for i, (x, y) in enumerate(pts)], "pid long, x long, y long")


def hits(df):
    return sorted((r[0], r[1]) for r in df.collect())


def test_unit_square_inside_edge_vertex(spark):
    segs = segs_df(spark, ring(1, [(0, 0), (1, 0), (1, 1), (0, 1)]))
    pts = pts_df(spark, [(0.5, 0.5), (1, 0.5), (0, 0), (2, 2), (0.999999, 0.000001)])
    within = hits(sj.points_in_areas(pts, segs, "pid", "area_id", "within"))
    inter = hits(sj.points_in_areas(pts, segs, "pid", "area_id", "intersects"))
    assert within == [(0, 1), (4, 1)]
    assert inter == [(0, 1), (1, 1), (2, 1), (4, 1)]


def test_square_with_hole(spark):
    rows = ring(1, [(0, 0), (10, 0), (10, 10), (0, 10)]) + [(1, 10 + i, *r[2:]) for i, r in enumerate(ring(1, [(4, 4), (6, 4), (6, 6), (4, 6)]))]
    segs = segs_df(spark, rows)
    pts = pts_df(spark, [(5, 5), (2, 2), (4, 5)])
    assert hits(sj.points_in_areas(pts, segs, "pid", "area_id", "within")) == [(1, 1)]
    assert hits(sj.points_in_areas(pts, segs, "pid", "area_id", "intersects")) == [(1, 1), (2, 1)]


def test_notched_area_grid_independent(spark):
    segs = segs_df(spark, ring(7, [(0, 0), (72, 0), (72, 36), (36, 12), (0, 36)]))
    pts = pts_df(spark, [(36, 20), (36, 5), (10, 20), (60, 20), (36, 12), (10, 30)])
    for g in (M, 2 * M, 50 * M):
        assert hits(sj.points_in_areas(pts, segs, "pid", "area_id", "within", grid=g)) == [(1, 7), (2, 7), (3, 7)]


def test_line_crossing_notch_twice_gives_two_pieces(spark):
    segs = segs_df(spark, ring(7, [(0, 0), (72, 0), (72, 36), (36, 12), (0, 36)]))
    lines = spark.createDataFrame([(1, 0, -10 * M, 20 * M, 80 * M, 20 * M)], "line_id long, seq int, x1 long, y1 long, x2 long, y2 long")
    pieces = sj.clip_lines(lines, segs, "line_id", "area_id")
    runs = sj.merge_runs(pieces, "line_id", "area_id").orderBy("t0").collect()
    assert len(runs) == 2
    total = sum((r.t1 - r.t0) * 90 for r in runs)
    # inside from x=0..24 and x=48..72 at y=20
    assert abs(total - 48) < 1e-6


def test_collinear_line_on_shared_edge_intersects_both(spark):
    rows = ring(1, [(0, 0), (1, 0), (1, 1), (0, 1)]) + ring(2, [(1, 0), (2, 0), (2, 1), (1, 1)])
    segs = segs_df(spark, rows)
    lines = spark.createDataFrame([(9, M, 0, M, M)], "line_id long, x1 long, y1 long, x2 long, y2 long")
    assert hits(sj.lines_intersect_areas(lines, segs)) == [(9, 1), (9, 2)]


def test_shared_edge_appears_once(spark):
    rows = ring(1, [(0, 0), (1, 0), (1, 1), (0, 1)]) + ring(2, [(1, 0), (2, 0), (2, 1), (1, 1)])
    n = OV.neighbour_lines(segs_df(spark, rows))
    assert n.count() == 7
    shared = n.where(F.col("right_id").isNotNull()).collect()
    assert [(r.left_id, r.right_id, r.n) for r in shared] == [(1, 2, 2)]


def test_centroid_and_area(spark):
    c = OV.centroid(segs_df(spark, ring(1, [(0, 0), (2, 0), (2, 2), (0, 2)]))).first()
    assert (c.cx, c.cy, c.area_deg2) == (1.0, 1.0, 4.0)


def test_null_and_empty_geometries_are_not_present(spark):
    areas = spark.createDataFrame([(1,), (2,), (3,), (4,)], "area_id long")
    segs = spark.createDataFrame([(1, 0, 0, 0, 5, 5), (1, 1, 5, 5, 0, 0), (2, 0, None, None, None, None), (4, 0, 1, 1, None, None)], "area_id long, seq int, x1 long, y1 long, x2 long, y2 long")
    assert [r.area_id for r in OV.present(areas, segs).select("area_id").collect()] == [1]


def test_within_first_needs_to_know_the_feature(spark):
    segs = spark.createDataFrame([(1, 0, 0), (1, 1, 1)], "area_id long, seq int, feature_seq int")
    assert [r.seq for r in sj.within_first(segs).collect()] == [0]
    with pytest.raises(ValueError):
        sj.within_first(segs.drop("feature_seq"))
