"""Geometry scalar functions and linework overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions import geometry as G
from mapfold.operators import overlay as OV
from mapfold.plans import query

_NORM = """
(select *, case when x1 < x2 or (x1 = x2 and y1 <= y2) then x1 else x2 end nx1,
  case when x1 < x2 or (x1 = x2 and y1 <= y2) then y1 else y2 end ny1,
  case when x1 < x2 or (x1 = x2 and y1 <= y2) then x2 else x1 end nx2,
  case when x1 < x2 or (x1 = x2 and y1 <= y2) then y2 else y1 end ny2 from {t})
"""

_NEIGH_SQL = f"""
select nx1 x1, ny1 y1, nx2 x2, ny2 y2, min(area_id) left_id, case when count(*) > 1 then max(area_id) end right_id,
  count(*) n from {_NORM.format(t='fx_segments')} s group by nx1, ny1, nx2, ny2
"""


@query("ov_neighbour_lines", _NEIGH_SQL)
def ov_neighbour_lines(spark: SparkSession, sf: str) -> DataFrame:
    return OV.neighbour_lines(view(spark, sf, "fx_segments"))


@query("ov_remove_duplicate_linework", f"select x1, y1, x2, y2, n from ({_NEIGH_SQL}) t")
def ov_remove_duplicate_linework(spark: SparkSession, sf: str) -> DataFrame:
    return OV.neighbour_lines(view(spark, sf, "fx_segments")).select("x1", "y1", "x2", "y2", "n")


_SNAP = "cast(floor(({c} + 5) / 10) * 10 as bigint)"


@query(
    "geom_buffer_snap",
    f"select line_id, {_SNAP.format(c='x1')} x1, {_SNAP.format(c='y1')} y1, {_SNAP.format(c='x2')} x2, "
    f"{_SNAP.format(c='y2')} y2 from fx_lines",
)
def geom_buffer_snap(spark: SparkSession, sf: str) -> DataFrame:
    l = view(spark, sf, "fx_lines")
    return l.select("line_id", *[OV.snap(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(
    "ov_coincident_lines",
    f"""
select nx1 x1, ny1 y1, nx2 x2, ny2 y2, count(*) n from {_NORM.format(t=f"(select {_SNAP.format(c='x1')} x1, {_SNAP.format(c='y1')} y1, {_SNAP.format(c='x2')} x2, {_SNAP.format(c='y2')} y2 from fx_lines)")} s
where not (x1 = x2 and y1 = y2) group by 1, 2, 3, 4
""",
)
def ov_coincident_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Near-coincident lines merged: snap to 1e-5 degree, then one row per edge."""
    l = view(spark, sf, "fx_lines").select(*[OV.snap(c).alias(c) for c in ("x1", "y1", "x2", "y2")])
    n = OV.normalise(OV.repair(l))
    return n.groupBy("nx1", "ny1", "nx2", "ny2").agg(F.count("*").alias("n")).select(
        F.col("nx1").alias("x1"), F.col("ny1").alias("y1"), F.col("nx2").alias("x2"), F.col("ny2").alias("y2"), "n"
    )


@query(
    "glob_admin_lines",
    "select a.iso, s.seq, s.x1, s.y1, s.x2, s.y2 from fx_segments s join fx_areas a on a.area_id = s.area_id",
)
def glob_admin_lines(spark: SparkSession, sf: str) -> DataFrame:
    """World country polygons -> boundary lines (one row per edge)."""
    s = view(spark, sf, "fx_segments")
    return s.join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id").select("iso", "seq", "x1", "y1", "x2", "y2")


@query("geom_type", "select osm_id, kind from fx_osm")
def geom_type(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_osm").select("osm_id", "kind")


@query(
    "filt_all_points",
    "select el_type, bool_and(kind = 'Point') all_points from fx_osm group by el_type",
)
def filt_all_points(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_osm").groupBy("el_type").agg(F.bool_and(F.col("kind") == "Point").alias("all_points"))


@query(
    "agg_any_all",
    "select kind, bool_or(name is not null) any_named, bool_and(name is not null) all_named from fx_osm group by kind",
)
def agg_any_all(spark: SparkSession, sf: str) -> DataFrame:
    o = view(spark, sf, "fx_osm")
    return o.groupBy("kind").agg(F.bool_or(F.col("name").isNotNull()).alias("any_named"), F.bool_and(F.col("name").isNotNull()).alias("all_named"))


@query(
    "filt_polygon_layer",
    "select el_type, bool_and(kind in ('Polygon', 'MultiPolygon')) is_polygon_layer from fx_osm group by el_type",
)
def filt_polygon_layer(spark: SparkSession, sf: str) -> DataFrame:
    o = view(spark, sf, "fx_osm")
    return o.groupBy("el_type").agg(F.bool_and(F.col("kind").isin("Polygon", "MultiPolygon")).alias("is_polygon_layer"))


@query(
    "agg_empty",
    "select a.area_id, count(p.pid) = 0 is_empty from fx_areas a left join fx_points p on p.nat = a.area_id group by a.area_id",
)
def agg_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Per area: is its attribute-matched result empty?"""
    a = view(spark, sf, "fx_areas").select("area_id")
    p = view(spark, sf, "fx_points").select(F.col("nat").alias("area_id"), "pid")
    return a.join(p, "area_id", "left").groupBy("area_id").agg((F.count("pid") == 0).alias("is_empty"))


@query(
    "proj_points_from_xy",
    "select pid, 'Point' kind, x, y from fx_points",
)
def proj_points_from_xy(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "fx_points").select("pid", G.point("x", "y").alias("geom"))
    return p.select("pid", "geom.kind", F.col("geom.parts")[0][0][0]["x"].alias("x"), F.col("geom.parts")[0][0][0]["y"].alias("y"))


@query("geom_from_xy", "select pid, 'Point' kind, x, y from fx_points")
def geom_from_xy(spark: SparkSession, sf: str) -> DataFrame:
    return proj_points_from_xy(spark, sf)


_XY_TEXT = "case when pid % 10 = 0 then 'n/a' else cast(x as varchar) end"


@query(
    "filt_valid_xy",
    f"select pid, round(try_cast({_XY_TEXT} as double) / 1e6, 6) lon, round(y / 1e6, 6) lat from fx_points "
    f"where try_cast({_XY_TEXT} as double) is not null",
)
def filt_valid_xy(spark: SparkSession, sf: str) -> DataFrame:
    """Text -> number with bad values as NULL; rows lacking a coordinate dropped."""
    return _valid_xy(spark, sf)


def _valid_xy(spark: SparkSession, sf: str, *carried: str) -> DataFrame:
    p = view(spark, sf, "fx_points")
    txt = F.when(F.col("pid") % 10 == 0, F.lit("n/a")).otherwise(F.col("x").cast("string"))
    out = p.select("pid", *carried, F.round(txt.try_cast("double") / 1e6, 6).alias("lon"), F.round(F.col("y") / 1e6, 6).alias("lat"))
    return out.na.drop(subset=["lon", "lat"])


@query(
    "nat_power_plants",
    f"""
select a.iso, p.pid, round(try_cast({_XY_TEXT} as double) / 1e6, 6) lon, round(p.y / 1e6, 6) lat
from fx_points p join fx_areas a on upper(p.country) = upper(a.iso) where try_cast({_XY_TEXT} as double) is not null
""",
)
def nat_power_plants(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute filter by code (case-insensitive), coordinates coerced, points built."""
    a = view(spark, sf, "fx_areas").select("iso")
    return _valid_xy(spark, sf, "country").join(a, F.upper("country") == F.upper("iso")).select("iso", "pid", "lon", "lat")


@query(
    "nat_ports",
    f"""
select a.iso, p.pid, round(try_cast({_XY_TEXT} as double) / 1e6, 6) lon, round(p.y / 1e6, 6) lat
from fx_points p join fx_areas a on lower(p.country) = lower(a.name_en) where try_cast({_XY_TEXT} as double) is not null
""",
)
def nat_ports(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute filter by country name (case-insensitive equality, see D2)."""
    a = view(spark, sf, "fx_areas").select("iso", "name_en")
    return _valid_xy(spark, sf, "country").join(a, F.lower("country") == F.lower("name_en")).select("iso", "pid", "lon", "lat")


@query(
    "geom_is_empty",
    "select a.area_id, count(s.seq) = 0 is_empty from fx_areas a left join fx_segments s on s.area_id = a.area_id group by a.area_id",
)
def geom_is_empty(spark: SparkSession, sf: str) -> DataFrame:
    a, s = view(spark, sf, "fx_areas"), view(spark, sf, "fx_segments")
    return a.join(s, "area_id", "left").groupBy("area_id").agg((F.count("seq") == 0).alias("is_empty"))


@query(
    "filt_bbox",
    "select line_id from fx_lines where greatest(x1, x2) >= -36000000 and least(x1, x2) <= 36000000 "
    "and greatest(y1, y2) >= -18000000 and least(y1, y2) <= 18000000",
)
def filt_bbox(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding-box prefilter with plain min/max comparisons (pushed to the scan)."""
    l = view(spark, sf, "fx_lines")
    return l.where(
        (F.greatest("x1", "x2") >= -36000000) & (F.least("x1", "x2") <= 36000000)
        & (F.greatest("y1", "y2") >= -18000000) & (F.least("y1", "y2") <= 18000000)
    ).select("line_id")
