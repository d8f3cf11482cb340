"""OSM layer queries (20 layers) and the tag-filter / schema operators they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import osm as O
from mapfold.plans import query
from mapfold.plans.sqlsnip import exact_ratio, intersects_having, seg_intersect, within_having

FX_TAG_KEYS = ["amenity", "atm", "waterway", "name", "highway", "railway", "place", "capital", "water", "route", "landuse", "harbour", "border"]


def osm_elements(spark: SparkSession, sf: str) -> DataFrame:
    """fx_osm with its sparse tag columns folded into a tag map."""
    o = view(spark, sf, "fx_osm")
    return o.select("osm_id", "el_type", "kind", O.tags_from_columns(o, FX_TAG_KEYS).alias("tags"), "x", "y")


def geometry(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_osm_geom")


# The oracle of each layer is spelled out on its own: filter, class, columns and name as text.
_NULL = "cast(null as varchar)"
_NAMES = f'o.name, {_NULL} "name:en", {_NULL} name_en'


def layer_sql(tail: str, where: str, fclass: str, columns: str, shaped: bool = False) -> str:
    if shaped:
        place = """pl as (select el_type, osm_id, string_agg(line, '; ' order by part, ring) geometry from (
    select el_type, osm_id, part, ring, concat(string_agg(concat(x1, ' ', y1), ', ' order by eid), ', ', arg_max(concat(x2, ' ', y2), eid)) line from ed group by el_type, osm_id, part, ring) r group by el_type, osm_id
  union all select el_type, osm_id, concat(x, ' ', y) from el where kind = 'Point')"""
        shown = "p.geometry"
    else:
        place = f"""pl as (select el_type, osm_id, case when kind like '%Polygon' then {exact_ratio('sx * sign(a)', '3 * abs(a)')} / 1e6 else round(lx / l, 6) end lon,
    case when kind like '%Polygon' then {exact_ratio('sy * sign(a)', '3 * abs(a)')} / 1e6 else round(ly / l, 6) end lat
  from (select el_type, osm_id, kind, sum(k) a, sum((x1+x2)*k) sx, sum((y1+y2)*k) sy, sum(l) l, sum((x1/1e6+x2/1e6)/2*l) lx, sum((y1/1e6+y2/1e6)/2*l) ly from (
    select *, x1*y2-x2*y1 k, sqrt((x2/1e6-x1/1e6)*(x2/1e6-x1/1e6)+(y2/1e6-y1/1e6)*(y2/1e6-y1/1e6)) l from (
      select el_type, osm_id, kind, x1::hugeint x1, y1::hugeint y1, x2::hugeint x2, y2::hugeint y2 from ed) e) e group by el_type, osm_id, kind) s
  union all select el_type, osm_id, round(x/1e6, 6), round(y/1e6, 6) from el where kind = 'Point')"""
        shown = "p.lon, p.lat"
    return f"""with el as (select * from fx_osm o where {where}), ed as (select g.* from fx_osm_geom g join el on el.el_type = g.el_type and el.osm_id = g.osm_id),
h as (select o.el_type, o.osm_id, s.area_id from el o, fx_segments s where o.kind = 'Point' group by o.el_type, o.osm_id, s.area_id having {intersects_having('o', 's')}
  union select l.el_type, l.osm_id, s.area_id from ed l, fx_segments s where {seg_intersect('l', 's')}
  union select l.el_type, l.osm_id, s.area_id from ed l, fx_segments s group by l.el_type, l.osm_id, l.eid, s.area_id having {within_having('l', 's', 'x1', 'y1')}),
{place}
select a.iso, concat(a.iso, '_{tail}') layer_name, o.el_type, o.osm_id, {fclass + ' fclass, ' if fclass else ''}{columns}, {shown}
from h join fx_areas a on a.area_id = h.area_id join el o on o.el_type = h.el_type and o.osm_id = h.osm_id join pl p on p.el_type = h.el_type and p.osm_id = h.osm_id"""


_LINE, _AREA = "o.kind in ('LineString', 'MultiLineString')", "o.kind in ('Polygon', 'MultiPolygon')"
_POI = "o.amenity in ('school', 'bank', 'hospital', 'atm', 'university')"
ORACLES = {
    "osm_railway": layer_sql("tran_rst_pt_s2_osm_pp_railwayline", f"o.railway = 'rail' and {_LINE}", "o.railway", f'o.name, {_NULL} name_en, {_NULL} "name:en", {_NULL} gauge', True),
    "osm_dam": layer_sql("phys_dam_pt_s2_osm_pp_dam", "o.waterway = 'dam'", "'dam'", _NAMES),
    "osm_school": layer_sql(
        "educ_edu_pt_s3_osm_pp_schools", "o.amenity = 'school'", "'school'",
        f'{_NULL} "operator", {_NULL} operator_1, {_NULL} capacity, {_NULL} grades, {_NULL} min_age, {_NULL} max_age, {_NULL} "school:ge1", {_NAMES}, {_NULL} operator_2, {_NULL} "operator:t", {_NULL} "school:ge2", {_NULL} school_gen, {_NULL} osmid'),
    "osm_education": layer_sql("educ_edu_pt_s3_osm_pp_university", "o.amenity in ('university', 'college')", "o.amenity", _NAMES),
    "osm_ferry_terminal": layer_sql("tran_fte_pt_s2_osm_pp_ferryterminal", "o.amenity = 'ferry_terminal'", "", _NAMES),
    "osm_ferry_route": layer_sql("tran_fer_ln_s2_osm_pp_ferryroute", "o.route = 'ferry'", "", _NAMES, True),
    "osm_port": layer_sql("tran_por_pt_s0_osm_pp_port", "o.landuse = 'harbour' or o.harbour = 'port'", "coalesce(o.landuse, o.harbour)", _NAMES),
    "osm_bank": layer_sql("cash_bnk_pt_s0_osm_pp_bank", "o.amenity = 'bank'", "o.amenity", _NAMES),
    "osm_atm": layer_sql("cash_atm_pt_s3_osm_pp_atm", "o.amenity = 'atm' or (o.amenity = 'bank' and o.atm = 'yes')", "o.amenity", f"{_NAMES}, {_NULL} osmid"),
    "osm_health": layer_sql("heal_hea_pt_s3_osm_pp_healthfacilities", "o.amenity in ('clinic', 'doctors', 'hospital', 'pharmacy', 'health_post')", "o.amenity", _NAMES),
    "osm_hospital": layer_sql(
        "heal_hea_pt_s3_osm_pp_hospital", "o.amenity = 'hospital'", "'hospital'",
        f'{_NAMES}, {_NULL} emergency, {_NULL} "operator", {_NULL} "operator:t", {_NULL} beds, {_NULL} operator_1, {_NULL} operator_2'),
    "osm_border_control": layer_sql("pois_bor_pt_s3_osm_pp_bordercrossing", "o.border = 'border_control'", "", _NAMES),
    "osm_settlement": layer_sql(
        "stle_stl_pt_s3_osm_pp_settlements", "o.place in ('city', 'borough', 'town', 'village', 'hamlet') or o.capital is not null",
        "case when o.capital = 'yes' then 'national_capital' else o.place end", _NAMES),
    "osm_lake": layer_sql("phys_lak_py_s3_osm_pp_lake", f"o.water in ('lake', 'reservoir') and {_AREA}", "o.water", _NAMES, True),
    "osm_large_river": layer_sql("phys_riv_py_s3_osm_pp_rivers", f"o.water = 'river' and {_AREA}", "o.water", _NAMES, True),
    "osm_river": layer_sql("phys_riv_ln_s3_osm_pp_rivers", "o.waterway = 'river' and o.kind = 'LineString'", "'river'", _NAMES, True),
    "osm_canal": layer_sql("phys_can_ln_s3_osm_pp_canal", "o.waterway = 'canal'", "'canal'", _NAMES, True),
    "osm_rail_station": layer_sql("tran_rst_pt_s2_osm_pp_railwaystations", "o.railway in ('station', 'halt')", "o.railway", f"{_NAMES}, o.amenity, {_NULL} passenger, {_NULL} cargo"),
    "osm_poi_point": layer_sql("pois_pt_s3_osm_pp_pois", _POI, "o.amenity", "o.name"),
    "osm_poi_polygon": layer_sql("pois_py_s3_osm_pp_pois", f"o.amenity in ('school', 'bank', 'hospital', 'university') and {_AREA}", "o.amenity", "o.name", True),
}


def _register(spec: O.LayerSpec) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return O.osm_layer(osm_elements(spark, sf), geometry(spark, sf), view(spark, sf, "fx_segments"), view(spark, sf, "fx_areas"), spec)

    run.__name__ = spec.layer
    query(spec.layer, ORACLES[spec.layer])(run)


for _s in O.LAYERS:
    _register(_s)


@query("osm_atm", ORACLES["osm_atm"])
def osm_atm(spark: SparkSession, sf: str) -> DataFrame:
    return O.osm_atm(osm_elements(spark, sf), geometry(spark, sf), view(spark, sf, "fx_segments"), view(spark, sf, "fx_areas"))


@query(
    "filt_osm_tags",
    """
select osm_id from fx_osm
where coalesce(amenity in ('bank'), false) or coalesce(atm in ('yes'), false) or name is not null
""",
)
def filt_osm_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tag dictionary with OR across keys; a True value means 'key present'."""
    el = osm_elements(spark, sf)
    return el.where(O.tag_filter(F.col("tags"), {"amenity": ("bank",), "atm": ("yes",), "name": True})).select(
        "osm_id"
    )


@query(
    "scan_osm_features",
    f"""
with el as (select * from fx_osm o where o.waterway in ('dam', 'river')), ed as (select g.* from fx_osm_geom g join el on el.el_type = g.el_type and el.osm_id = g.osm_id)
select o.el_type, o.osm_id, s.area_id from el o, fx_segments s where o.kind = 'Point' group by o.el_type, o.osm_id, s.area_id having {intersects_having('o', 's')}
union select l.el_type, l.osm_id, s.area_id from ed l, fx_segments s where {seg_intersect('l', 's')}
union select l.el_type, l.osm_id, s.area_id from ed l, fx_segments s group by l.el_type, l.osm_id, l.eid, s.area_id having {within_having('l', 's', 'x1', 'y1')}
""",
)
def scan_osm_features(spark: SparkSession, sf: str) -> DataFrame:
    """Elements whose geometry meets an area and whose tags match a tag dictionary."""
    el = osm_elements(spark, sf).where(O.tag_filter(F.col("tags"), {"waterway": ("dam", "river")}))
    edges = geometry(spark, sf).join(el.select(*O.ELEMENT), O.ELEMENT, "left_semi")
    return O.elements_in_areas(el, edges, view(spark, sf, "fx_segments"))


@query(
    "filt_geom_type",
    "select osm_id, kind from fx_osm where kind in ('Polygon', 'MultiPolygon')",
)
def filt_geom_type(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_osm").where(F.col("kind").isin(*O.POLY_KINDS)).select("osm_id", "kind")


@query(
    "filt_in_not_in",
    """
select osm_id, waterway from fx_osm
where waterway in ('river', 'canal', 'dam') and waterway not in ('canal', 'ditch', 'drain', 'stream')
""",
)
def filt_in_not_in(spark: SparkSession, sf: str) -> DataFrame:
    o = view(spark, sf, "fx_osm")
    return o.where(F.col("waterway").isin("river", "canal", "dam") & ~F.col("waterway").isin("canal", "ditch", "drain", "stream")).select("osm_id", "waterway")


@query(
    "proj_flags",
    """
select osm_id, cast(contains(coalesce(waterway, ''), 'river') as int) is_river,
  cast(contains(coalesce(waterway, ''), 'can') as int) is_canal from fx_osm
""",
)
def proj_flags(spark: SparkSession, sf: str) -> DataFrame:
    """One 0/1 column per class by substring test."""
    o = view(spark, sf, "fx_osm")
    w = F.coalesce(F.col("waterway"), F.lit(""))
    return o.select("osm_id", w.contains("river").cast("int").alias("is_river"), w.contains("can").cast("int").alias("is_canal"))


_BANK = next(s for s in O.LAYERS if s.layer == "osm_bank")
_ONLY_ATM = layer_sql("cash_atm_pt_s3_osm_pp_atm", "o.amenity = 'atm'", "o.amenity", f"{_NAMES}, {_NULL} osmid")


@query(
    "set_union_all",
    f"""
select iso, layer_name, el_type, osm_id, fclass, name, "name:en", name_en, cast(null as varchar) osmid, lon, lat from ({ORACLES['osm_bank']}) b
union all
select iso, layer_name, el_type, osm_id, fclass, name, "name:en", name_en, osmid, lon, lat from ({_ONLY_ATM}) a
""",
)
def set_union_all(spark: SparkSession, sf: str) -> DataFrame:
    """Two layers concatenated by column name; missing columns become NULL."""
    segs, areas, el, edges = view(spark, sf, "fx_segments"), view(spark, sf, "fx_areas"), osm_elements(spark, sf), geometry(spark, sf)
    b = O.osm_layer(el, edges, segs, areas, _BANK)
    a = O.osm_layer(el, edges, segs, areas, O.ATM_PARTS[0])
    return b.unionByName(a, allowMissingColumns=True)
