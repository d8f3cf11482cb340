"""Polygon overlays and containment: layers of polygons against areas and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import polygons as P
from mapfold.plans import query
from mapfold.plans.sqlpoly import dissolve_ctes, overlay_ctes

EDGE = P.EDGE

_POLYS = "lp as (select poly_id id, eid, x1, y1, x2, y2 from fx_polys)"
_AREAS = "la as (select area_id id, seq eid, x1, y1, x2, y2 from fx_segments)"
_ZONES = "lz as (select zone_id id, eid, x1, y1, x2, y2 from fx_zones)"


def polys(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_polys").select(F.col("poly_id").alias("lid"), "eid", *EDGE)


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_segments").select(F.col("area_id").alias("rid"), F.col("seq").alias("eid"), *EDGE)


def zones(spark: SparkSession, sf: str, key: str = "rid") -> DataFrame:
    return view(spark, sf, "fx_zones").select(F.col("zone_id").alias(key), "eid", *EDGE)


def _ids(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.withColumnsRenamed({"lid": left, "rid": right})


@query("ov_intersection_polygon", f"with {_POLYS}, {_AREAS}, {overlay_ctes('o', 'lp', 'la', 'intersection')} select lid poly_id, rid area_id, x1, y1, x2, y2 from o")
def ov_intersection_polygon(spark: SparkSession, sf: str) -> DataFrame:
    """Outline of each polygon's part inside each area, as directed edges."""
    return _ids(P.overlay(polys(spark, sf), areas(spark, sf), "intersection"), "poly_id", "area_id")


@query("ov_symdiff", f"with {_POLYS}, {_ZONES}, {overlay_ctes('o', 'lp', 'lz', 'symdiff')} select lid poly_id, rid zone_id, x1, y1, x2, y2 from o")
def ov_symdiff(spark: SparkSession, sf: str) -> DataFrame:
    """Outline of what only one of an overlapping polygon and zone covers."""
    return _ids(P.overlay(polys(spark, sf), zones(spark, sf), "symdiff"), "poly_id", "zone_id")


_NATS = "ln as (select nat gid, poly_id oid, poly_id*100+eid eid, x1, y1, x2, y2 from fx_polys)"


@query("ov_union", f"with {_NATS}, {dissolve_ctes('o', 'ln')} select gid nat, x1, y1, x2, y2 from o")
def ov_union(spark: SparkSession, sf: str) -> DataFrame:
    """All polygons of a nation dissolved into one outline."""
    rows = view(spark, sf, "fx_polys").select("nat", "poly_id", (F.col("poly_id") * 100 + F.col("eid")).alias("eid"), *EDGE)
    return P.dissolve(rows, "nat", "poly_id")


_WITHIN = f"""{overlay_ctes('o', 'lp', 'la', 'difference', overlapping=False)},
w as (select lid poly_id, rid area_id from o_p where (lid, rid) not in (select lid, rid from o))"""


@query("join_polygon_within_area", f"with {_POLYS}, {_AREAS}, {_WITHIN} select poly_id, area_id from w")
def join_polygon_within_area(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons that lie wholly inside an area; partly overlapping ones are left out."""
    return _ids(P.within(polys(spark, sf), areas(spark, sf)), "poly_id", "area_id")


@query(
    "nat_reservoirs",
    f"""with {_POLYS}, {_AREAS}, {_WITHIN} select a.iso, p.pid reservoir_id, p.country, concat(a.iso, '_phys_res_py_s0_geodar_pp_reservoirs') layer_name
from w join fx_areas a on a.area_id = w.area_id join fx_points p on p.pid = w.poly_id""",
)
def nat_reservoirs(spark: SparkSession, sf: str) -> DataFrame:
    """The reservoir layer of every area: polygons wholly within it, with their attributes."""
    hits = P.within(polys(spark, sf), areas(spark, sf))
    named = view(spark, sf, "fx_areas").select(F.col("area_id").alias("rid"), "iso")
    attrs = view(spark, sf, "fx_points").select(F.col("pid").alias("lid"), "country")
    layer = F.concat("iso", F.lit("_phys_res_py_s0_geodar_pp_reservoirs"))
    return hits.join(named, "rid").join(attrs, "lid").select("iso", F.col("lid").alias("reservoir_id"), "country", layer.alias("layer_name"))


_FIRST = "lf as (select zone_id id, eid, x1, y1, x2, y2 from fx_zones where part = 0)"


@query(
    "nat_lakes",
    f"""with {_POLYS}, {_FIRST}, {overlay_ctes('o', 'lp', 'lf', 'difference', overlapping=False)}
select rid zone_id, lid lake_id from o_p where (lid, rid) not in (select lid, rid from o)""",
)
def nat_lakes(spark: SparkSession, sf: str) -> DataFrame:
    """Lakes wholly within the first feature of a zone of several features.

    The reference first asks whether any lake meets the zone and then takes those
    within its first feature; a lake within it meets it, so the gate removes nothing here.
    """
    first = view(spark, sf, "fx_zones").where("part = 0").select(F.col("zone_id").alias("rid"), "eid", *EDGE)
    return P.within(polys(spark, sf), first).select(F.col("rid").alias("zone_id"), F.col("lid").alias("lake_id"))


_ALL_ZONES = "lg as (select 0 gid, zone_id oid, zone_id*100+eid eid, x1, y1, x2, y2 from fx_zones)"


@query(
    "nat_feather",
    f"""with {_ZONES}, {_AREAS}, {_ALL_ZONES}, {overlay_ctes('o', 'lz', 'la', 'difference')}, {dissolve_ctes('d', 'lg')},
dn as (select gid id, row_number() over (order by x1, y1, x2, y2) eid, x1, y1, x2, y2 from d), {overlay_ctes('c', 'la', 'dn', 'difference')}
select a.iso, f.part, f.zone_id, f.x1, f.y1, f.x2, f.y2 from (
  select rid area_id, 'background' part, lid zone_id, x1, y1, x2, y2 from o
  union all select lid, 'country', null, x1, y1, x2, y2 from c) f join fx_areas a on a.area_id = f.area_id""",
)
def nat_feather(spark: SparkSession, sf: str) -> DataFrame:
    """Background zones and an area without what both cover, for every area.

    A symmetric difference of layers: each zone that overlaps the area loses the
    area, and the area loses the union of the zones.  Zones that do not meet the
    area are the same in every feather and stay in the background layer.
    """
    background = P.overlay(zones(spark, sf, "lid"), areas(spark, sf), "difference")
    background = background.select(F.col("rid").alias("area_id"), F.lit("background").alias("part"), F.col("lid").alias("zone_id"), *EDGE)
    members = view(spark, sf, "fx_zones").select(F.lit(0).cast("long").alias("rid"), "zone_id", (F.col("zone_id") * 100 + F.col("eid")).alias("eid"), *EDGE)
    union = P.stored(P.dissolve(members, "rid", "zone_id").withColumn("eid", F.xxhash64(*EDGE)), "feather-union")
    country = P.overlay(areas(spark, sf).withColumnRenamed("rid", "lid"), union, "difference")
    country = country.select(F.col("lid").alias("area_id"), F.lit("country").alias("part"), F.lit(None).cast("long").alias("zone_id"), *EDGE)
    named = view(spark, sf, "fx_areas").select("area_id", "iso")
    return background.unionByName(country).join(named, "area_id").select("iso", "part", "zone_id", *EDGE)
