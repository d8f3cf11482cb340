"""Column discovery, units with geometry, road edges, tag classes, GeoJSON geometry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import admin as A
from mapfold.operators import admin_columns as AC
from mapfold.operators import geojson as GJ
from mapfold.operators import osm as O
from mapfold.operators import roads
from mapfold.operators.spatial_join import points_in_areas
from mapfold.plans import query
from mapfold.plans.sqlsnip import intersects_having
from mapfold.session import shared_dir
from mapfold.sinks import writers as W
from mapfold.sources import readers as R

# -- columns ---------------------------------------------------------------

# oracle: the patterns of each kind as a fixed list, spelled out
_RULES = """rules as (select * from (values
  ('name',0,'ADM#_[A-Z]{2}'),('name',1,'NAME_#_[A-Z]{2}'),('name',2,'NAME_#'),('name',3,'VARNAME_#'),('name',4,'NL_NAME_#'),('name',5,'adm#_name'),('name',6,'admin#Name'),('name',7,'NAMA#'),
  ('type',0,'ADM#_TYPE'),('type',1,'TYPE_#'),('type',2,'ENGTYPE_#'),('type',3,'Type#'),
  ('pcode',0,'ADM#_PCODE'),('pcode',1,'ADM#_CODE'),('pcode',2,'P_CODE'),('pcode',3,'PCODE'),('pcode',4,'CODE'),('pcode',5,'admin#Pcod'),('pcode',6,'SHN#')) r(kind, priority, rule))"""

_REGEX = f"""{_RULES}, hits as (
  select c.file_id, r.kind, c.col, row_number() over (partition by c.file_id, r.kind order by r.priority, c.pos) k from fx_file_columns c
  join rules r on regexp_matches(c.col, concat('(?i)^', replace(r.rule, '#', cast(c.adm_level as varchar))))
), found as (
  select f.file_id, max(case when kind = 'name' then col end) name_col, max(case when kind = 'type' then col end) type_col, max(case when kind = 'pcode' then col end) pcode_col
  from (select distinct file_id from fx_file_columns) f left join hits h on h.file_id = f.file_id and h.k = 1 group by f.file_id
)"""


def file_columns(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_file_columns").select("file_id", "adm_level", "pos", "col")


@query("proj_admin_columns_regex", f"with {_REGEX} select file_id, name_col, type_col, pcode_col from found")
def proj_admin_columns_regex(spark: SparkSession, sf: str) -> DataFrame:
    return AC.by_pattern(file_columns(spark, sf))


_EXACT = """cand as (select * from (values ('name',0,'ADM#_EN'),('name',1,'ADM#_NAME'),('name',2,'ADM#_DESCR'),('name',3,'NAME_#'),('name',4,'NAME_EN'),('name',5,'NAME'),('name',6,'ADMIN_NAME'),
  ('pcode',0,'ADM#_PCODE'),('pcode',1,'ADM#_CODE'),('pcode',2,'P_CODE'),('pcode',3,'PCODE'),('pcode',4,'CODE')) r(kind, priority, rule)
), ehits as (
  select c.file_id, r.kind, r.priority, c.col, case when c.col = replace(r.rule, '#', cast(c.adm_level as varchar)) then 0 else 1 end low from fx_file_columns c
  join cand r on c.col in (replace(r.rule, '#', cast(c.adm_level as varchar)), lower(replace(r.rule, '#', cast(c.adm_level as varchar))))
), best as (select file_id, kind, min(low) low from ehits group by file_id, kind
), efound as (
  select f.file_id, coalesce(list(h.col order by h.priority) filter (where h.kind = 'name'), []::varchar[]) name_cols, arg_min(h.col, h.priority) filter (where h.kind = 'pcode') pcode_col
  from (select distinct file_id from fx_file_columns) f left join (ehits join best using (file_id, kind, low)) h on h.file_id = f.file_id group by f.file_id
)"""


@query("proj_admin_columns_exact", f"with {_EXACT} select file_id, name_cols, pcode_col from efound")
def proj_admin_columns_exact(spark: SparkSession, sf: str) -> DataFrame:
    return AC.exact(file_columns(spark, sf))


_BY_NAME = f"""{_EXACT}, v as (select file_id, row_id, col, val from fx_unit_attrs
), nu as (
  select u.row_id, u.file_order, u.adm_level, u.area_id, n.n_name folder, e.name_cols,
    (select val from v where v.row_id = u.row_id and v.col = e.pcode_col) pcode,
    case when list_contains(e.name_cols, concat('ADM', u.adm_level, '_EN')) then concat('ADM', u.adm_level, '_EN')
      when list_contains(e.name_cols, concat('ADM', u.adm_level, '_', upper(substr(n.n_name, 1, 2)))) then concat('ADM', u.adm_level, '_', upper(substr(n.n_name, 1, 2))) else e.name_cols[1] end chosen,
    (select max(col) from v where v.row_id = u.row_id and v.col = concat('ADM', u.adm_level, '_TYPE')) up_type, (select max(col) from v where v.row_id = u.row_id and v.col = concat('adm', u.adm_level, '_type')) low_type,
    (select max(col) from v where v.row_id = u.row_id and v.col = 'ADM0_EN') up_land, (select max(col) from v where v.row_id = u.row_id and v.col = 'adm0_en') low_land
  from (select distinct row_id, file_order, adm_level, area_id, file_id from fx_unit_attrs) u join efound e on e.file_id = u.file_id and e.pcode_col is not null
  join nation n on n.n_nationkey = u.area_id
), named as (
  select nu.*, (select val from v where v.row_id = nu.row_id and v.col = nu.chosen) name from nu
), byname as (
  select row_id, file_order, adm_level, folder, pcode, case when coalesce(name, '') <> '' then [lower(name)] else []::varchar[] end names,
    case when coalesce(up_type, low_type) is null then '' else (select val from v where v.row_id = named.row_id and v.col = coalesce(up_type, low_type)) end admin_type,
    case when coalesce(up_land, low_land) is null then folder else (select val from v where v.row_id = named.row_id and v.col = coalesce(up_land, low_land)) end country_name
  from named where pcode is not null
)"""


def unit_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Units of all files with their attributes as a map."""
    rows = view(spark, sf, "fx_unit_attrs")
    return AC.attribute_maps(rows, "row_id", "file_order", "file_id", "adm_level", "area_id")


def units_by_name(spark: SparkSession, sf: str) -> DataFrame:
    land = view(spark, sf, "nation").select(F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("folder"), F.upper(F.substring("n_name", 1, 2)).alias("iso2"))
    return AC.units_by_name(unit_maps(spark, sf).join(land, "area_id"), file_columns(spark, sf))


@query("proj_name_fallback", f"with {_BY_NAME} select row_id, pcode, names, admin_type, country_name from byname")
def proj_name_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Name, type and country of every unit through the chains of column names."""
    return units_by_name(spark, sf).select("row_id", "pcode", "names", "admin_type", "country_name")


@query(
    "pcode_dictionary",
    f"""with {_BY_NAME} select pcode, arg_max(names, file_order) names, arg_max(adm_level, file_order) admin_lvl, arg_max(folder, file_order) country_iso,
  arg_max(country_name, file_order) country_name, arg_max(admin_type, file_order) admin_type from byname where adm_level <= 3 group by pcode""",
)
def pcode_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Levels 0 to 3 of all countries in one dictionary by code; the last file wins."""
    u = units_by_name(spark, sf).where("adm_level <= 3").withColumnsRenamed({"adm_level": "admin_lvl", "folder": "country_iso"})
    return A.last_wins(u, ["pcode"], "file_order", ["names", "admin_lvl", "country_iso", "country_name", "admin_type"])


# -- units with geometry -----------------------------------------------------

_DEG = "concat(case when {v} < 0 then '-' else '' end, cast(abs({v}) // 1000000 as varchar), '.', lpad(cast(abs({v}) % 1000000 as varchar), 6, '0'))"
_SHAPES = f"""ring_t as (select zone_id, part, ring, concat('[', string_agg(v, ',' order by eid), ',', arg_min(v, eid), ']') t from (
    select zone_id, part, ring, eid, concat('[', {_DEG.format(v='x1')}, ',', {_DEG.format(v='y1')}, ']') v from fx_zones) p group by zone_id, part, ring
), part_t as (select zone_id, part, concat('[', string_agg(t, ',' order by ring), ']') t from ring_t group by zone_id, part
), shape as (select zone_id, case when count(*) = 1 then 'Polygon' else 'MultiPolygon' end kind, case when count(*) = 1 then max(t) else concat('[', string_agg(t, ',' order by part), ']') end coordinates
  from part_t group by zone_id)"""

_UNITS = f"""{_REGEX}, pu as (
  select a.row_id, a.file_order, a.adm_level, a.area_id, max(case when a.col = f.name_col then a.val end) name_en, max(case when a.col = f.pcode_col then a.val end) pcode,
    case when f.type_col is null then '' else max(case when a.col = f.type_col then a.val end) end admin_type
  from fx_unit_attrs a join found f on f.file_id = a.file_id and f.name_col is not null and f.pcode_col is not null where a.adm_level <= 2 group by a.row_id, a.file_order, a.adm_level, a.area_id, f.type_col
), lastu as (
  select pcode, arg_max(row_id, file_order) row_id from pu where pcode is not null and row_id % 17 <> 0 group by pcode
), {_SHAPES}, unit as (
  select upper(n.n_name) iso, n.n_name country_name, u.pcode, u.name_en, u.admin_type, u.adm_level admin_level, s.kind, s.coordinates
  from lastu l join pu u on u.row_id = l.row_id join nation n on n.n_nationkey = u.area_id join shape s on s.zone_id = u.row_id)"""


def units(spark: SparkSession, sf: str) -> DataFrame:
    """Units of levels 0 to 2 by discovered columns, with geometry; a unit without one is
    not emitted, and the last file wins per code."""
    rows = AC.units_by_pattern(unit_maps(spark, sf).where("adm_level <= 2"), file_columns(spark, sf))
    # every 17th unit of the fixture has no geometry
    shapes = GJ.polygon_texts(view(spark, sf, "fx_zones").where("zone_id % 17 <> 0"), "zone_id")
    rows = rows.join(shapes.withColumnRenamed("zone_id", "row_id"), "row_id")
    land = view(spark, sf, "nation").select(F.col("n_nationkey").alias("area_id"), F.col("n_name").alias("country_name"))
    kept = A.last_wins(rows, ["pcode"], "file_order", ["name", "admin_type", "adm_level", "area_id", "kind", "coordinates"])
    return kept.join(land, "area_id").select(F.upper("country_name").alias("iso"), "country_name", "pcode", F.col("name").alias("name_en"), "admin_type", F.col("adm_level").alias("admin_level"), "kind", "coordinates")


@query("pcode_units", f"with {_UNITS} select * from unit")
def pcode_units(spark: SparkSession, sf: str) -> DataFrame:
    return units(spark, sf)


@query(
    "sink_unit_geojson",
    f"""with {_UNITS} select u.pcode, u.iso, u.name_en, u.admin_type, u.admin_level, 'urn:ogc:def:crs:OGC:1.3:CRS84' crs, u.kind, z.part, z.ring, z.eid, z.x1, z.y1, z.x2, z.y2
from unit u join lastu l on l.pcode = u.pcode join fx_zones z on z.zone_id = l.row_id""",
)
def sink_unit_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """One FeatureCollection document per code with crs, properties and geometry, written and read back."""
    u = units(spark, sf)
    crs = F.to_json(F.struct(F.lit("name").alias("type"), F.struct(F.lit("urn:ogc:def:crs:OGC:1.3:CRS84").alias("name")).alias("properties")))
    props = F.to_json(F.struct("iso", "name_en", "pcode", "admin_type", "admin_level", "country_name"))
    doc = F.concat(
        F.lit('{"type":"FeatureCollection","name":'), F.to_json(F.struct("pcode")).substr(F.lit(10), F.length(F.to_json(F.struct("pcode"))) - 10), F.lit(',"crs":'), crs,
        F.lit(',"features":[{"type":"Feature","properties":'), props, F.lit(',"geometry":{"type":"'), F.col("kind"), F.lit('","coordinates":'), F.col("coordinates"), F.lit("}}]}"),
    )
    path = shared_dir(spark, "units")
    W.write_text(u.select(doc.alias("value")), path)
    back = spark.read.text(path)
    shape = "name string, crs struct<type:string,properties:struct<name:string>>, features array<struct<properties:struct<iso:string,name_en:string,admin_type:string,admin_level:int>,geometry:struct<type:string,coordinates:string>>>"
    d = F.from_json("value", shape)
    f = d["features"][0]
    props = ["iso", "name_en", "admin_type", "admin_level"]
    told = back.select(d["name"].alias("pcode"), d["crs"]["properties"]["name"].alias("crs"), *[f["properties"][c].alias(c) for c in props], f["geometry"]["type"].alias("geom_type"), f["geometry"]["coordinates"].alias("coordinates"))
    return GJ.edges(told, "pcode", "crs", *props)


# -- GeoJSON geometry ----------------------------------------------------------

@query("scan_geojson", "select concat('z', cast(zone_id as varchar)) name, part, ring, eid, x1, y1, x2, y2, case when max(part) over (partition by zone_id) > 0 then 'MultiPolygon' else 'Polygon' end kind from fx_zones")
def scan_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """FeatureCollections with polygons of several rings and parts, written over several lines
    each, parsed into edges.  A collection holds the zones of a thousand ids: a file is parsed by
    one task, but a file per zone is too many of them."""
    shapes = GJ.polygon_texts(view(spark, sf, "fx_zones"), "zone_id")
    feature = F.concat(F.lit('  {"type": "Feature", "properties": {"id": "z'), F.col("zone_id").cast("string"), F.lit('"},\n   "geometry": {"type": "'), "kind", F.lit('", "coordinates":\n    '), "coordinates", F.lit("}}"))
    files = shapes.groupBy(F.floor(F.col("zone_id") / 1000).cast("long").alias("file")).agg(F.collect_list(feature).alias("features"))
    doc = F.concat(F.lit('{\n "type": "FeatureCollection",\n "features": [\n'), F.array_join("features", ",\n"), F.lit("\n ]\n}"))
    path = shared_dir(spark, "collections")
    W.write_text(files.select("file", doc.alias("value")), path, partition_by="file")
    f = R.read_geojson(spark, path, multiline=True)
    named = f.select(F.try_element_at("properties", F.lit("id")).alias("name"), "geom_type", "coordinates")
    return GJ.edges(named, "name")


# -- roads ---------------------------------------------------------------------

ROAD_ATTRS = ["highway", "name", "maxspeed", "oneway_tag"]

_ROADS = f"""with recursive na as (
  select p.node_id, s.area_id from fx_nodes p, fx_segments s group by p.node_id, s.area_id having {intersects_having('p', 's')}
), st as (
  select a.area_id, n.way_id, n.seq, n.node_id, w.highway, w.name, w.maxspeed, w.oneway from fx_way_nodes n join fx_ways w on w.way_id = n.way_id and w.highway <> 'footway' join na a on a.node_id = n.node_id
), step as (
  select a.area_id, a.way_id, a.seq, a.node_id u, b.node_id v, a.highway, a.name, a.maxspeed, a.oneway from st a
  join st b on b.area_id = a.area_id and b.way_id = a.way_id and b.seq = a.seq + 1 and b.node_id <> a.node_id
), sg as (
  select area_id, way_id, u, v, highway, name, maxspeed, oneway from step union all select area_id, way_id, v, u, highway, name, maxspeed, oneway from step where not oneway
), touch as (
  select area_id, u node, v other, 1 o, 0 i from sg union all select area_id, v, u, 0, 1 from sg
), thr as (
  select area_id, node from (select area_id, node, other, sum(o) o, sum(i) i from touch group by all) t group by area_id, node
  having count(*) = 2 and max(greatest(o, i)) = 1 and sum(o) = sum(i)
), walk as (
  select s.area_id, s.u, s.v, s.v tip, s.u prev, 1 n, [s.u, s.v] nodes, [s.way_id] ways, [s.highway] hw, [s.name] nm, [s.maxspeed] sp, [s.oneway] ow
  from sg s where (s.area_id, s.u) not in (select area_id, node from thr)
  union all
  select w.area_id, w.u, w.v, s.v, s.u, w.n + 1, list_append(w.nodes, s.v), list_append(w.ways, s.way_id), list_append(w.hw, s.highway), list_append(w.nm, s.name), list_append(w.sp, s.maxspeed), list_append(w.ow, s.oneway)
  from walk w join thr t on t.area_id = w.area_id and t.node = w.tip join sg s on s.area_id = w.area_id and s.u = w.tip and s.v <> w.prev
), done as (select * from walk where (area_id, tip) not in (select area_id, node from thr))
select area_id, u, tip v, n n_segments, array_to_string(list_sort(list_distinct(ways)), ', ') osmid, array_to_string(list_sort(list_distinct(hw)), ', ') highway,
  nullif(array_to_string(list_sort(list_distinct(list_filter(nm, lambda x: x is not null))), ', '), '') as name, nullif(array_to_string(list_sort(list_distinct(list_filter(sp, lambda x: x is not null))), ', '), '') maxspeed,
  array_to_string(list_sort(list_distinct(ow)), ', ') oneway, array_to_string(nodes, ' ') nodes from done"""


def road_network(spark: SparkSession, sf: str, node_columns: Sequence[str] = ()) -> DataFrame:
    """Edges of the drivable network inside each area."""
    inside = points_in_areas(view(spark, sf, "fx_nodes"), view(spark, sf, "fx_segments"), "node_id", "area_id", "intersects", payload=node_columns)
    ways = view(spark, sf, "fx_ways").where("highway <> 'footway'").withColumn("oneway_tag", F.col("oneway").cast("string"))
    steps = view(spark, sf, "fx_way_nodes").join(ways, "way_id").join(inside, "node_id")
    return roads.road_edges(steps, ["area_id"], ROAD_ATTRS, node_columns)


@query("scan_road_edges", _ROADS)
def scan_road_edges(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x.cast("string")), ", "))
    e = road_network(spark, sf)
    return e.select("area_id", "u", "v", F.col("n_segments").cast("long").alias("n_segments"), text("way_ids").alias("osmid"), text("highway").alias("highway"), text("name").alias("name"), text("maxspeed").alias("maxspeed"), text("oneway_tag").alias("oneway"), F.array_join(F.transform("nodes", lambda n: n.cast("string")), " ").alias("nodes"))


_ROAD_CLASSES = "'motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'unclassified', 'residential', 'motorway_link', 'trunk_link', 'primary_link', 'secondary_link', 'tertiary_link', 'living_street', 'service', 'track', 'road'"


@query(
    "osm_roads",
    _ROADS[: _ROADS.index("select area_id, u, tip v")]
    + f"""select a.iso, concat(a.iso, '_tran_rds_ln_s0_osm_pp_roads') layer_name, c.fclass, array_to_string(list_sort(list_distinct(d.ways)), ', ') osmid,
  nullif(array_to_string(list_sort(list_distinct(list_filter(nm, lambda x: x is not null))), ', '), '') as name, array_to_string(list_sort(list_distinct(ow)), ', ') oneway,
  nullif(array_to_string(list_sort(list_distinct(list_filter(sp, lambda x: x is not null))), ', '), '') maxspeed, cast(null as varchar) bridge, cast(null as varchar) tunnel, cast(null as varchar) surface, g.geometry
from (select row_number() over () id, * from done) d join fx_areas a on a.area_id = d.area_id
cross join unnest(list_filter(list_distinct(d.hw), lambda x: x in ({_ROAD_CLASSES}))) c(fclass)
join (select id, string_agg(concat(n.x, ' ', n.y), ', ' order by k) geometry from (select id, unnest(nodes) node_id, generate_subscripts(nodes, 1) k from (select row_number() over () id, * from done) z) q join fx_nodes n on n.node_id = q.node_id group by id) g on g.id = d.id""",
)
def osm_roads(spark: SparkSession, sf: str) -> DataFrame:
    """Road layer: the edges of the network inside each area, once per road class they carry, with
    list values joined and the geometry as a line."""
    e = road_network(spark, sf, ["x", "y"])
    line = F.array_join(F.zip_with("x", "y", lambda x, y: F.concat_ws(" ", x, y)), ", ").alias("geometry")
    text = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x.cast("string")), ", "))
    fclass = F.explode(F.array_intersect("highway", F.array(*map(F.lit, O.ROAD_CLASSES)))).alias("fclass")
    rows = e.select("area_id", "way_ids", "name", "oneway_tag", "maxspeed", line, fclass)
    rows = rows.join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id")
    absent = [F.lit(None).cast("string").alias(c) for c in ("bridge", "tunnel", "surface")]
    return rows.select("iso", F.concat("iso", F.lit("_tran_rds_ln_s0_osm_pp_roads")).alias("layer_name"), "fclass", text("way_ids").alias("osmid"), text("name").alias("name"), text("oneway_tag").alias("oneway"), text("maxspeed").alias("maxspeed"), *absent, "geometry")


# -- tag classes -----------------------------------------------------------------

TAG_COLUMNS = ["amenity", "waterway", "highway", "place", "water", "landuse", "harbour", "name", "natural", "area", "building", "created_by", "source"]

_KEYS = " ".join(f"when {k} is not null then true" for k in ("amenity", "area", "building", "harbour", "landuse", "place", "water"))


@query(
    "filt_osm_class",
    f"""select el_type, osm_id, case el_type when 'node' then 'point' when 'relation' then 'relation' else
  case when closed and (case {_KEYS} when natural_tag <> 'coastline' then true when waterway = 'riverbank' then true else false end) then 'polygon' else 'line' end end geometry,
  (select count(*) from (values (amenity), (waterway), (highway), (place), (water), (landuse), (harbour), (name), (natural_tag), (area), (building)) t(v) where v is not null) n_tags
from fx_osm_tagged where coalesce(amenity, waterway, highway, place, water, landuse, harbour, name, natural_tag, area, building) is not null""",
)
def filt_osm_class(spark: SparkSession, sf: str) -> DataFrame:
    """Tag rules decide polygon or line for closed ways; dropped tags go, and elements left without any."""
    el = view(spark, sf, "fx_osm_tagged").withColumnRenamed("natural_tag", "natural")
    el = el.select("el_type", "osm_id", "closed", O.tags_from_columns(el, TAG_COLUMNS).alias("tags"))
    kept = O.without_tags(F.col("tags"))
    made = el.select("el_type", "osm_id", O.element_geometry(F.col("el_type"), F.col("closed"), F.col("tags")).alias("geometry"), F.size(kept).cast("long").alias("n_tags"))
    return made.where("n_tags > 0")
