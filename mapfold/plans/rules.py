"""Small rules on names, paths, kinds and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions import geometry as G
from mapfold.functions import names as N
from mapfold.operators import osm as O
from mapfold.operators import overlay as OV
from mapfold.operators import spatial_join as sj
from mapfold.plans import query
from mapfold.plans.admin import _SELECTED_SQL, _UNITS_SQL, selected_areas, units
from mapfold.plans.catalog import _HREFS_SQL, hrefs
from mapfold.plans.geometry import _NEIGH_SQL
from mapfold.plans.schema_ops import _GRPS_SQL, _NAMES_SQL, _WANTED_SQL, WANTED, names_table
from mapfold.plans.sqlsnip import within_having


def _suffix_sql(c: str) -> str:
    return f"(ends_with({c}, '.zip') or ends_with({c}, '.csv') or contains({c}, '.zip'))"


@query(
    "filt_resource_suffix",
    f"""select 'page' kind, page_id id, href from ({_HREFS_SQL}) h where {_suffix_sql("href")}
union all select 'file', file_id, path from fx_files where {_suffix_sql("path")}""",
)
def filt_resource_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Resources by suffix: .zip or .csv at the end, or .zip anywhere; all links of pages and all paths of files."""
    links = hrefs(spark, sf).select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), "href")
    files = view(spark, sf, "fx_files").select(F.lit("file").alias("kind"), F.col("file_id").alias("id"), F.col("path").alias("href"))
    h = F.col("href")
    return links.unionByName(files).where(h.endswith(".zip") | h.endswith(".csv") | h.contains(".zip"))


@query(
    "filt_country_name",
    """select p.pid, a.iso from (select pid, case when pid % 2 = 0 then concat(upper(left(country, 1)), lower(substr(country, 2))) else country end country from fx_points) p
join fx_areas a on p.country = concat(upper(left(a.name_en, 1)), lower(substr(a.name_en, 2)))""",
)
def filt_country_name(spark: SparkSession, sf: str) -> DataFrame:
    """Column equals the capitalised area name, case-sensitive; every second row of the fixture is written so."""
    shown = F.when(F.col("pid") % 2 == 0, N.capitalize("country")).otherwise(F.col("country"))
    p = view(spark, sf, "fx_points").select("pid", shown.alias("country"))
    return p.join(view(spark, sf, "fx_areas").select("iso", N.capitalize("name_en").alias("country")), "country").select("pid", "iso")


@query("fn_now", "select event_id, strftime(processed_at, '%Y-%m-%d %H:%M:%S') date_processed, true formed, true recent from fx_ledger")
def fn_now(spark: SparkSession, sf: str) -> DataFrame:
    """Processing time as ledger text: the time every row was processed at, and the time of this run,
    stamped on every row; of the latter, which no SQL can know, the row says whether it is well formed and recent."""
    stamped = view(spark, sf, "fx_ledger").withColumn("stamp", N.time_text(F.current_timestamp()))
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("stamp", "yyyy-MM-dd HH:mm:ss")
    formed = F.col("stamp").rlike("^[0-9]{4}(-[0-9]{2}){2} [0-9]{2}(:[0-9]{2}){2}$")
    return stamped.select("event_id", N.time_text(F.col("processed_at")).alias("date_processed"), formed.alias("formed"), age.between(0, 1).alias("recent"))


_NESTED_SQL = "(select file_id, case when file_id % 3 = 0 then regexp_replace(path, '/([^/]+)$', '/shp/adm/\\1') else path end path from fx_files)"


@query("fn_country_from_path", f"select file_id, case when string_split(path, '/')[-3] = 'in' then string_split(path, '/')[-2] else string_split(path, '/')[-4] end iso from {_NESTED_SQL} f")
def fn_country_from_path(spark: SparkSession, sf: str) -> DataFrame:
    """ISO code: the file's folder directly under the input folder, else the folder two above it."""
    f = view(spark, sf, "fx_files")
    path = F.when(F.col("file_id") % 3 == 0, F.regexp_replace("path", "/([^/]+)$", "/shp/adm/$1")).otherwise(F.col("path"))
    return f.select("file_id", N.country_from_path(path, "in").alias("iso"))


@query("missing_countries", "select a.iso from fx_areas a where not exists (select 1 from fx_units u where u.area_id = a.area_id and u.adm_level = 0)")
def missing_countries(spark: SparkSession, sf: str) -> DataFrame:
    """Areas without a unit of level 0."""
    return view(spark, sf, "fx_areas").join(view(spark, sf, "fx_units").where("adm_level = 0"), "area_id", "left_anti").select("iso")


@query("join_pcodes", f"select s.iso, u.pcode, u.name_en, u.admin_type, u.admin_level from ({_SELECTED_SQL}) s left join ({_UNITS_SQL}) u on u.iso = upper(s.iso)")
def join_pcodes(spark: SparkSession, sf: str) -> DataFrame:
    """Selected areas with each of their units; areas without units stay with one empty row."""
    u = units(spark, sf).select(F.col("iso").alias("uiso"), "pcode", "name_en", "admin_type", "admin_level")
    s = selected_areas(spark, sf).select("iso", F.upper("iso").alias("uiso"))
    return s.join(u, "uiso", "left").drop("uiso")


@query(
    "win_last_file_wins",
    "select concat(split_part(path, '/', 4), '_', regexp_extract(path, '([a-z]+)$', 1)) target, max(path) path, arg_max(file_id, (path, file_id)) file_id, count(*) n_files from fx_files group by 1",
)
def win_last_file_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Several files map to one target name; the last in path order stays."""
    target = F.concat(F.split_part("path", F.lit("/"), F.lit(4)), F.lit("_"), F.regexp_extract("path", "([a-z]+)$", 1))
    f = view(spark, sf, "fx_files").select(target.alias("target"), "path", "file_id")
    return f.groupBy("target").agg(F.max("path").alias("path"), F.max_by("file_id", F.struct("path", "file_id")).alias("file_id"), F.count("*").alias("n_files"))


@query("filt_valid_geometry", "select u.row_id from fx_units u where u.row_id % 17 <> 0 and exists (select 1 from fx_zones z where z.zone_id = u.row_id)")
def filt_valid_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Units whose geometry is neither null nor empty; every 17th unit of the fixture has only null coordinates."""
    edge = ["x1", "y1", "x2", "y2"]
    z = view(spark, sf, "fx_zones").select(F.col("zone_id").alias("row_id"), *[F.when(F.col("zone_id") % 17 != 0, F.col(c)).alias(c) for c in edge])
    return OV.present(view(spark, sf, "fx_units").select("row_id"), z, "row_id")


@query("filt_aoi_polygonal", "select el_type, osm_id, case when kind in ('Polygon', 'MultiPolygon') then 'accepted' else concat('rejected: ', kind) end status from fx_osm")
def filt_aoi_polygonal(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of interest must be polygons; every other kind is rejected with its reason."""
    good = F.col("kind").isin(*O.POLY_KINDS)
    return view(spark, sf, "fx_osm").select("el_type", "osm_id", F.when(good, F.lit("accepted")).otherwise(F.concat(F.lit("rejected: "), "kind")).alias("status"))


@query(
    "admin_poly_to_line",
    f"""
select concat(a.iso, '_admn_ad0_ln_s0_hdx_pp_country') layer_name, t.x1, t.y1, t.x2, t.y2, case when a.area_id = t.left_id then t.right_id else t.left_id end neighbour
from ({_NEIGH_SQL}) t join fx_areas a on a.area_id in (t.left_id, t.right_id)
""",
)
def admin_poly_to_line(spark: SparkSession, sf: str) -> DataFrame:
    """Polygon layers -> line layers ('_py_' -> '_ln_'); a shared edge belongs to both layers, each naming the other."""
    lines = OV.neighbour_lines(OV.repair(view(spark, sf, "fx_segments")))
    sides = F.array(F.struct(F.col("left_id").alias("area_id"), F.col("right_id").alias("neighbour")), F.struct(F.col("right_id").alias("area_id"), F.col("left_id").alias("neighbour")))
    rows = lines.select("x1", "y1", "x2", "y2", F.inline(sides)).where(F.col("area_id").isNotNull())
    a = view(spark, sf, "fx_areas").select("area_id", "iso")
    name = F.regexp_replace(F.concat("iso", F.lit("_admn_ad0_py_s0_hdx_pp_country")), "_py_", "_ln_")
    return rows.join(a, "area_id").select(name.alias("layer_name"), "x1", "y1", "x2", "y2", "neighbour")


@query(
    "proj_fill_missing",
    f"""select g.grp, w.name as wanted, exists (select 1 from {_NAMES_SQL} t where t.grp = g.grp and t.name = w.name) present,
  cast(null as bigint) osm_id, cast(null as varchar) el_type, cast(null as varchar) as name, cast(null as varchar) highway, cast(null as varchar) surface, cast(null as varchar) oneway
from {_GRPS_SQL} g, {_WANTED_SQL} w
union all select null, null, null, osm_id, el_type, name, highway, null, null from fx_osm""",
)
def proj_fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted columns that a layer lacks are added as null: every wanted column of every schema with
    whether it is there or added, and the rows of a layer with its absent columns filled."""
    names = names_table(spark, sf).select("grp", F.col("name").alias("wanted"), F.lit(True).alias("present"))
    grid = names.select("grp").distinct().select("grp", F.explode(F.array(*map(F.lit, WANTED))).alias("wanted"))
    schemas = grid.join(names, ["grp", "wanted"], "left").select("grp", "wanted", F.coalesce("present", F.lit(False)).alias("present"))
    layer = view(spark, sf, "fx_osm").select("osm_id", "el_type", "name", "highway")
    return schemas.unionByName(O.filled(layer, ["name", "highway", "surface", "oneway"]), allowMissingColumns=True)


@query("join_within_first", f"select p.pid, s.zone_id from fx_points p, (select zone_id, x1, y1, x2, y2 from fx_zones where part = 0) s group by p.pid, s.zone_id having {within_having('p', 's')}")
def join_within_first(spark: SparkSession, sf: str) -> DataFrame:
    """Points within the first feature of a zone; the parts of a zone are its features."""
    first = sj.within_first(view(spark, sf, "fx_zones").withColumnRenamed("part", "feature_seq"))
    return sj.points_in_areas(view(spark, sf, "fx_points"), first, "pid", "zone_id", "within")


_MERC = 20037508.342789244
_LAYER_SQL = f"""(select pid, case when pid % 3 = 0 then 'EPSG:3857' else 'EPSG:4326' end crs,
  case when pid % 3 = 0 then round(x / 1e6 * {_MERC} / 180, 1) else x / 1e6 end a,
  case when pid % 3 = 0 then round(ln(tan((90 + y / 1e6) * pi() / 360)) / pi() * {_MERC}, 1) else y / 1e6 end b from fx_points where abs(y) < 85000000)"""


@query(
    "geom_crs_align",
    f"""select pid, crs, round(case when crs = 'EPSG:4326' then a else a * 180 / {_MERC} end, 5) lon,
  round(case when crs = 'EPSG:4326' then b else atan(exp(b * pi() / {_MERC})) * 360 / pi() - 90 end, 5) lat from {_LAYER_SQL} t""",
)
def geom_crs_align(spark: SparkSession, sf: str) -> DataFrame:
    """Points brought to the areas' reference system: only rows in another one are projected."""
    pi = 3.141592653589793
    p = view(spark, sf, "fx_points").where(F.abs("y") < 85000000)
    lon, lat, other = F.col("x") / 1e6, F.col("y") / 1e6, F.col("pid") % 3 == 0
    layer = p.select(
        "pid", F.when(other, F.lit("EPSG:3857")).otherwise(F.lit("EPSG:4326")).alias("crs"),
        F.when(other, F.round(lon * _MERC / 180, 1)).otherwise(lon).alias("a"),
        F.when(other, F.round(F.log(F.tan((90 + lat) * F.lit(pi) / 360)) / F.lit(pi) * _MERC, 1)).otherwise(lat).alias("b"),
    )
    x, y = G.aligned("crs", "a", "b", "EPSG:4326")
    return layer.select("pid", "crs", F.round(x, 5).alias("lon"), F.round(y, 5).alias("lat"))


@query(
    "nat_worldpop_catalog",
    """
select iso, res, concat('https://data.worldpop.invalid/2020/', upper(iso), '/', lower(iso), case res when '100m' then '_ppp_2020_UNadj.tif' else '_pd_2020_1km_UNadj.tif' end) url,
  concat(lower(iso), '_popu_pop_ras_s1_worldpop_pp_', res, '.tif') target
from (select iso, unnest(['100m', '1km']) res from fx_areas) t
""",
)
def nat_worldpop_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Area x resolution -> url and target file name (the resolutions are a fixed pair)."""
    a = view(spark, sf, "fx_areas").select("iso", F.explode(F.array(F.lit("100m"), F.lit("1km"))).alias("res"))
    tail = F.when(F.col("res") == "100m", F.lit("_ppp_2020_UNadj.tif")).otherwise(F.lit("_pd_2020_1km_UNadj.tif"))
    url = F.concat(F.lit("https://data.worldpop.invalid/2020/"), F.upper("iso"), F.lit("/"), F.lower("iso"), tail)
    return a.select("iso", "res", url.alias("url"), F.concat(F.lower("iso"), F.lit("_popu_pop_ras_s1_worldpop_pp_"), "res", F.lit(".tif")).alias("target"))


@query(
    "srtm_tile_plan",
    """
select area_id, tile, concat('https://elevation.invalid/skadi/', left(tile, 3), '/', tile, '.hgt.gz') url from (
  select a.area_id, concat(case when la >= 0 then 'N' else 'S' end, lpad(cast(abs(la) as varchar), 2, '0'),
    case when lo >= 0 then 'E' else 'W' end, lpad(cast(abs(lo) as varchar), 3, '0')) tile
  from (select area_id, unnest(range(cast(y0 / 1000000 as int), cast(y0 / 1000000 as int) + 36)) la, x0 from fx_areas) a,
    lateral (select unnest(range(cast(a.x0 / 1000000 as int), cast(a.x0 / 1000000 as int) + 72)) lo) b) t
""",
)
def srtm_tile_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding box -> every 1x1 degree tile key (signed range, both hemispheres) and its address."""
    degree = lambda f, pick, a, b: f(pick(F.least(a, b) if pick is F.min else F.greatest(a, b)) / 1000000).cast("int")
    box = view(spark, sf, "fx_segments").groupBy("area_id").agg(
        degree(F.floor, F.min, "x1", "x2").alias("lo0"), degree(F.ceil, F.max, "x1", "x2").alias("lo1"),
        degree(F.floor, F.min, "y1", "y2").alias("la0"), degree(F.ceil, F.max, "y1", "y2").alias("la1"),
    )
    t = box.select("area_id", "lo0", "lo1", F.explode(F.sequence("la0", F.col("la1") - 1)).alias("la"))
    t = t.select("area_id", "la", F.explode(F.sequence("lo0", F.col("lo1") - 1)).alias("lo")).select("area_id", N.tile_key("la", "lo").alias("tile"))
    return t.select("area_id", "tile", F.concat(F.lit("https://elevation.invalid/skadi/"), F.substring("tile", 1, 3), F.lit("/"), "tile", F.lit(".hgt.gz")).alias("url"))
