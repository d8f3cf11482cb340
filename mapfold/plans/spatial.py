"""Spatial join queries: points, lines and polygons against all areas at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import spatial_join as sj
from mapfold.plans import query
from mapfold.plans.sqlsnip import intersects_having, within_having

# -- points ---------------------------------------------------------------

_WITHIN_SQL = f"""
select p.pid, s.area_id from fx_points p, fx_segments s
group by p.pid, s.area_id having {within_having('p', 's')}
"""


@query("join_within_area", _WITHIN_SQL)
def join_within_area(spark: SparkSession, sf: str) -> DataFrame:
    pts = view(spark, sf, "fx_points")
    segs = view(spark, sf, "fx_segments")
    return sj.points_in_areas(pts, segs, "pid", "area_id", "within")


def _layer_points(spark: SparkSession, sf: str) -> DataFrame:
    """Point layer rows for every area: (iso, pid, country, x, y)."""
    pts = view(spark, sf, "fx_points")
    areas = view(spark, sf, "fx_areas").select("area_id", "iso")
    hits = sj.points_in_areas(pts, view(spark, sf, "fx_segments"), "pid", "area_id", "within", payload=["country", "x", "y"])
    return hits.join(areas, "area_id").select("iso", "pid", "country", "x", "y")


_LAYER_POINTS_SQL = f"""
select a.iso, p.pid, p.country, p.x, p.y
from (select p.pid, s.area_id from fx_points p, fx_segments s
      group by p.pid, s.area_id having {within_having('p', 's')}) h
join fx_areas a on a.area_id = h.area_id join fx_points p on p.pid = h.pid
"""


@query("nat_airports", _LAYER_POINTS_SQL)
def nat_airports(spark: SparkSession, sf: str) -> DataFrame:
    return _layer_points(spark, sf)


@query("nat_border_crossings", _LAYER_POINTS_SQL)
def nat_border_crossings(spark: SparkSession, sf: str) -> DataFrame:
    return _layer_points(spark, sf)


@query("nat_dams", _LAYER_POINTS_SQL)
def nat_dams(spark: SparkSession, sf: str) -> DataFrame:
    return _layer_points(spark, sf)


@query("nat_places", _LAYER_POINTS_SQL)
def nat_places(spark: SparkSession, sf: str) -> DataFrame:
    return _layer_points(spark, sf)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Airports layer for all areas at once, counted per area."""
    return _layer_points(spark, sf).groupBy("iso").agg(F.count("*").alias("n_features"))


@query(
    "join_within_area_counts",
    f"""
select a.iso, count(*) n_features
from (select p.pid, s.area_id from fx_points p, fx_segments s
      group by p.pid, s.area_id having {within_having('p', 's')}) h
join fx_areas a on a.area_id = h.area_id group by a.iso
""",
)
def join_within_area_counts(spark: SparkSession, sf: str) -> DataFrame:
    return flagship(spark, sf)


@query(
    "join_intersects_points",
    f"""
select p.pid, s.area_id from fx_points p, fx_segments s
group by p.pid, s.area_id having {intersects_having('p', 's')}
""",
)
def join_intersects_points(spark: SparkSession, sf: str) -> DataFrame:
    pts = view(spark, sf, "fx_points")
    segs = view(spark, sf, "fx_segments")
    return sj.points_in_areas(pts, segs, "pid", "area_id", "intersects")
