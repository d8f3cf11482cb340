"""Rasters told apart by a key are never mixed."""

from mapfold.operators import raster as R


def test_slope_and_mosaic_keep_rasters_apart(spark):
    rows = [("a", r, c, 10 * c) for r in range(3) for c in range(3)] + [("b", r, c, 7) for r in range(3) for c in range(3)]
    both = spark.createDataFrame(rows, "raster_id string, r long, c long, v long")
    got = {(x.raster_id, x.r, x.c): x.slope for x in R.slope(both, key=("raster_id",)).collect()}
    assert len(got) == 18
    for name in "ab":
        alone = R.slope(both.where(f"raster_id = '{name}'").drop("raster_id")).collect()
        assert {(name, x.r, x.c): x.slope for x in alone} == {k: v for k, v in got.items() if k[0] == name}
    assert got["a", 1, 1] == 18.434949 and got["b", 1, 1] == 0.0 and got["a", 0, 1] is None
    tiles = spark.createDataFrame([("a", 1, 0, 0, 5), ("a", 2, 0, 0, 6), ("b", 1, 0, 0, 9)], "raster_id string, tile_order long, r long, c long, v long")
    assert sorted(tuple(x) for x in R.mosaic(tiles, ("raster_id",)).collect()) == [("a", 0, 0, 6), ("b", 0, 0, 9)]


def test_pixels_of_one_raster_do_not_meet_in_one_task(spark):
    rows = [(0, o, 1 + o % 2, r, c, r + c) for o in range(2) for r in range(2) for c in range(2)]
    t = spark.createDataFrame(rows, "raster int, tile_order long, res int, r long, c long, v long")
    for df in (R.mosaic_finest(t, ("raster",)), R.tiles(t, 2, ("raster",))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert R.mosaic_finest(t, ("raster",)).count() == 16
