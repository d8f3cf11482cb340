"""Source and sink queries: each writes Spark-derived data to the shared
folder and reads it back through the source operator under test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions import names as N
from mapfold.plans import query
from mapfold.plans.spatial import _LAYER_POINTS_SQL, _layer_points
from mapfold.session import shared_dir
from mapfold.sinks import writers as W
from mapfold.sources import readers as R


@query("sink_layer", _LAYER_POINTS_SQL)
def sink_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Point layer written once, partitioned by area, then read back."""
    path = shared_dir(spark, "layers")
    W.write_layer(_layer_points(spark, sf), path, ("iso",))
    return spark.read.parquet(path).select("iso", "pid", "country", "x", "y")


@query(
    "scan_dir",
    f"select distinct iso, true has_files from ({_LAYER_POINTS_SQL}) t",
)
def scan_dir(spark: SparkSession, sf: str) -> DataFrame:
    """Recursive listing of a written layer tree; area taken from the folder name."""
    path = shared_dir(spark, "layers")
    W.write_layer(_layer_points(spark, sf), path, ("iso",))
    files = R.list_files(spark, path, "*.parquet")
    iso = F.regexp_extract("path", "/iso=([^/]+)/", 1)
    return files.groupBy(iso.alias("iso")).agg((F.count("*") > 0).alias("has_files"))


def _area_docs(spark: SparkSession, sf: str, drop_name_every: int = 0) -> DataFrame:
    """One FeatureCollection per area from its ring (first vertex of every edge)."""
    s = view(spark, sf, "fx_segments").select("area_id", "seq", F.col("x1").alias("x"), F.col("y1").alias("y"))
    a = view(spark, sf, "fx_areas").select("area_id", "iso", "name_en")
    if drop_name_every:
        a = a.withColumn("name_en", F.when(F.col("area_id") % drop_name_every != 0, F.col("name_en")))
    return W.polygon_feature_collection(s.join(a, "area_id"), "area_id", ["iso", "name_en"], F.col("iso"))


@query(
    "scan_area_list",
    "select iso, case when area_id % 7 <> 0 then name_en end name_en, "
    "case when area_id % 7 = 0 then 'missing_property' else 'ok' end status from fx_areas",
)
def scan_area_list(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "areas")
    W.write_text(_area_docs(spark, sf, drop_name_every=7).select("value"), path)
    return R.area_list(R.read_geojson(spark, path))


@query(
    "sink_pcode_dict",
    """
select pcode, arg_max(name, file_order) name, arg_max(adm_level, file_order) admin_lvl
from fx_units where pcode is not null group by pcode
""",
)
def sink_pcode_dict(spark: SparkSession, sf: str) -> DataFrame:
    """Key-unique dictionary (later row wins) written as JSON lines and read back."""
    from mapfold.plans.admin import pcode_last

    d = pcode_last(spark, sf).select("pcode", "name", F.col("adm_level").alias("admin_lvl"))
    path = shared_dir(spark, "pcodes")
    W.write_json(d, path)
    return spark.read.schema("pcode string, name string, admin_lvl int").json(path)


@query(
    "sink_ledger",
    "select event_id, iso, level, filepath, processed_at from fx_ledger",
)
def sink_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger appended in two batches, then dumped."""
    l = view(spark, sf, "fx_ledger")
    path = shared_dir(spark, "ledger")
    W.append_ledger(l.where(F.col("event_id") % 2 == 0), path)
    W.append_ledger(l.where(F.col("event_id") % 2 == 1), path)
    return spark.read.parquet(path)


@query(
    "sink_sidecar",
    """
select iso, concat(iso, '_admn_ad0_py_s0_hdx_pp_country') layer_name, coalesce(source, 'unknown') source,
  concat('10.0000/', iso) doi from fx_areas a left join fx_level_names n using (iso)
""",
)
def sink_sidecar(spark: SparkSession, sf: str) -> DataFrame:
    """Small metadata records beside each layer, one JSON table."""
    a = view(spark, sf, "fx_areas").select("iso")
    n = view(spark, sf, "fx_level_names").select("iso", "source")
    meta = a.join(n, "iso", "left").select(
        "iso", F.concat("iso", F.lit("_admn_ad0_py_s0_hdx_pp_country")).alias("layer_name"),
        F.coalesce("source", F.lit("unknown")).alias("source"), F.concat(F.lit("10.0000/"), "iso").alias("doi"),
    )
    path = shared_dir(spark, "sidecar")
    W.write_json(meta, path)
    return spark.read.schema("iso string, layer_name string, source string, doi string").json(path)


@query(
    "scan_csv",
    "select pid, country, x, y from fx_points",
)
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Header CSV read back with an explicit schema."""
    path = shared_dir(spark, "csv")
    view(spark, sf, "fx_points").select("pid", "country", "x", "y").write.mode("overwrite").option("header", True).csv(path)
    return R.read_csv(spark, path, "pid long, country string, x long, y long")


@query(
    "scan_tag_list",
    "select osm_id, amenity from fx_osm where amenity in (select distinct amenity from fx_osm where amenity is not null and amenity <> 'atm')",
)
def scan_tag_list(spark: SparkSession, sf: str) -> DataFrame:
    """One-column class list (fclass) -> semi-join of the elements on it."""
    o = view(spark, sf, "fx_osm")
    path = shared_dir(spark, "fclass")
    o.where(F.col("amenity").isNotNull() & (F.col("amenity") != "atm")).select(F.col("amenity").alias("fclass")).distinct() \
        .write.mode("overwrite").option("header", True).csv(path)
    wanted = R.read_csv(spark, path, "fclass string")
    return o.join(wanted, o.amenity == wanted.fclass, "left_semi").select("osm_id", "amenity")


@query(
    "scan_text_set",
    "select distinct iso value from fx_areas",
)
def scan_text_set(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, stripped, as a set."""
    path = shared_dir(spark, "textset")
    a = view(spark, sf, "fx_areas")
    a.select(F.concat(F.lit("  "), "iso", F.lit(" ")).alias("value")).unionByName(a.select(F.col("iso").alias("value"))) \
        .write.mode("overwrite").text(path)
    return R.read_text_set(spark, path)


@query(
    "scan_ckan_package",
    """
select concat('pkg', cast(file_id as varchar)) package, u.download_url, strftime(modified, '%Y-%m-%d') last_modified
from fx_files, lateral (select unnest([path, concat(path, '.meta')]) download_url) u
""",
)
def scan_ckan_package(spark: SparkSession, sf: str) -> DataFrame:
    """Package JSON documents -> one row per resource."""
    f = view(spark, sf, "fx_files")
    day = F.date_format("modified", "yyyy-MM-dd")
    res = F.array(F.struct(F.col("path").alias("download_url"), day.alias("last_modified")),
                  F.struct(F.concat("path", F.lit(".meta")).alias("download_url"), day.alias("last_modified")))
    docs = f.select(F.struct(F.struct(F.concat(F.lit("pkg"), F.col("file_id").cast("string")).alias("name"), res.alias("resources")).alias("result")).alias("d"))
    path = shared_dir(spark, "packages")
    docs.select(F.to_json("d").alias("value")).write.mode("overwrite").text(path)
    return R.read_packages(spark, path)


@query(
    "scan_raster",
    "select r, c, v from fx_pixels",
)
def scan_raster(spark: SparkSession, sf: str) -> DataFrame:
    """Pixel table stored by tile, every tile read back."""
    path = shared_dir(spark, "pixels")
    p = view(spark, sf, "fx_pixels").withColumn("tile", F.floor(F.col("c") / 25).cast("int"))
    p.write.mode("overwrite").partitionBy("tile").parquet(path)
    return spark.read.parquet(path).select("r", "c", "v")


@query(
    "export_manifest",
    """
select path local_path, concat('DataPipeline/', split_part(path, '/', 4), '/', regexp_extract(regexp_replace(path, '[?#].*$', ''), '([^/]*)$', 1)) remote_path,
  false is_dir from fx_files
""",
)
def export_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Local -> remote path mapping (the transfer itself is not built)."""
    f = view(spark, sf, "fx_files")
    remote = F.concat(F.lit("DataPipeline/"), F.split_part("path", F.lit("/"), F.lit(4)), F.lit("/"), N.basename("path"))
    return f.select(F.col("path").alias("local_path"), remote.alias("remote_path"), F.lit(False).alias("is_dir"))


@query(
    "join_existing_files",
    """
select m.file_id, case when e.file_id is null then 'fetch' when e.size_bytes = m.size_bytes then 'skip' else 'overwrite' end action
from fx_files m left join (select file_id, case when file_id % 3 = 0 then size_bytes else size_bytes + 1 end size_bytes
  from fx_files where file_id % 2 = 0) e on e.file_id = m.file_id
""",
)
def join_existing_files(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest vs. present files: absent -> fetch, same size -> skip, else overwrite."""
    m = view(spark, sf, "fx_files")
    present = m.where(F.col("file_id") % 2 == 0).select(
        "file_id", F.when(F.col("file_id") % 3 == 0, F.col("size_bytes")).otherwise(F.col("size_bytes") + 1).alias("have")
    )
    j = m.join(present, "file_id", "left")
    act = F.when(F.col("have").isNull(), F.lit("fetch")).when(F.col("have") == F.col("size_bytes"), F.lit("skip")).otherwise(F.lit("overwrite"))
    return j.select("file_id", act.alias("action"))


@query(
    "fetch_plan",
    """
select m.file_id, case when e.file_id is null then 'fetch' when e.size_bytes = m.size_bytes then 'skip' else 'overwrite' end action
from fx_files m left join (select file_id, case when file_id % 3 = 0 then size_bytes else size_bytes + 1 end size_bytes
  from fx_files where file_id % 2 = 0) e on e.file_id = m.file_id
""",
)
def fetch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return join_existing_files(spark, sf)


@query(
    "fn_rename_member",
    """
select concat(split_part(path, '/', 4), regexp_extract(path, '(\\.[^./]*)$', 1)) target, arg_max(path, file_id) path
from fx_files group by 1
""",
)
def fn_rename_member(spark: SparkSession, sf: str) -> DataFrame:
    """Every member -> '{rename}{ext}'; clashing targets keep the last member."""
    f = view(spark, sf, "fx_files")
    target = F.concat(F.split_part("path", F.lit("/"), F.lit(4)), F.regexp_extract("path", r"(\.[^./]*)$", 1))
    return f.groupBy(target.alias("target")).agg(F.max_by("path", "file_id").alias("path"))


_META_SQL = """
(select concat('c', cast(a.area_id as varchar)) folder, case when len(list_filter(string_split(name, ' '), lambda w: regexp_matches(w, '^[A-Z]'))) > 0
   then lower(array_to_string(list_transform(list_filter(string_split(name, ' '), lambda w: regexp_matches(w, '^[A-Z]')), lambda w: substr(w, 1, 1)), ''))
   else lower(string_split(name, ' ')[1]) end src from fx_level_names n join fx_areas a on a.iso = n.iso)
"""


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    """One metadata record per area folder: source abbreviation from the area name."""
    n = view(spark, sf, "fx_level_names").select("iso", N.source_abbr("name").alias("src"))
    a = view(spark, sf, "fx_areas").select("iso", F.concat(F.lit("c"), F.col("area_id").cast("string")).alias("folder"))
    return n.join(a, "iso").select("folder", "src")


@query(
    "nat_population_sadd",
    f"""
select f.file_id, concat(split_part(f.path, '/', 4), '_popu_pop_tab_', coalesce(string_split(regexp_extract(f.path, '([^/]*)$', 1), '_')[3], ''),
  '_', m.src, '_', cast(year(f.modified) as varchar), '.csv') target
from fx_files f join {_META_SQL} m on m.folder = split_part(f.path, '/', 4) where ends_with(f.path, '.csv')
""",
)
def nat_population_sadd(spark: SparkSession, sf: str) -> DataFrame:
    """Population tables renamed from one metadata record per area (join_metadata_broadcast)."""
    f = view(spark, sf, "fx_files").where(F.col("path").endswith(".csv")).withColumn("folder", F.split_part("path", F.lit("/"), F.lit(4)))
    j = f.join(_meta(spark, sf), "folder").withColumn("iso", F.col("folder"))
    scale = F.coalesce(F.try_element_at(F.split(N.basename("path"), "_"), F.lit(3)), F.lit(""))
    return j.select("file_id", F.concat("iso", F.lit("_popu_pop_tab_"), scale, F.lit("_"), "src", F.lit("_"),
                                        F.year("modified").cast("string"), F.lit(".csv")).alias("target"))


@query(
    "join_metadata_broadcast",
    f"select f.file_id, m.src from fx_files f join {_META_SQL} m on m.folder = split_part(f.path, '/', 4)",
)
def join_metadata_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "fx_files").withColumn("folder", F.split_part("path", F.lit("/"), F.lit(4)))
    return f.join(_meta(spark, sf), "folder").select("file_id", "src")


@query(
    "join_first_match",
    "select split_part(path, '/', 4) iso, min(file_id) file_id from fx_files where ends_with(path, '.csv') group by 1",
)
def join_first_match(spark: SparkSession, sf: str) -> DataFrame:
    """First record per code (partial min per task)."""
    f = view(spark, sf, "fx_files").where(F.col("path").endswith(".csv"))
    return f.groupBy(F.split_part("path", F.lit("/"), F.lit(4)).alias("iso")).agg(F.min("file_id").alias("file_id"))


@query(
    "join_regex_match",
    "select f.file_id, a.area_id from fx_files f join fx_areas a on regexp_matches(f.path, concat('(?i)/C', cast(a.area_id as varchar), '_'))",
)
def join_regex_match(spark: SparkSession, sf: str) -> DataFrame:
    """Case-insensitive match of area codes in paths: the codes are taken out of the path and joined by value."""
    codes = F.array_distinct(F.regexp_extract_all("path", F.lit("(?i)/C(0|[1-9][0-9]*)_"), F.lit(1)))
    f = view(spark, sf, "fx_files").select("file_id", F.explode(F.transform(codes, lambda c: c.try_cast("int"))).alias("area_id"))
    return f.join(view(spark, sf, "fx_areas").select("area_id"), "area_id").select("file_id", "area_id")


@query(
    "source_catalog",
    """
select a.iso, s.dataset, concat('data/input/', a.iso, '/', s.folder) folder, s.zipped, s.file_name
from fx_areas a, (values ('roads', 'ne_10m_roads', true, 'ne_10m_roads.zip'),
  ('rivers', 'ne_10m_rivers', true, 'ne_10m_rivers_lake_centerlines.zip'), ('lakes', 'ne_10m_lakes', true, 'ne_10m_lakes.zip'),
  ('places', 'ne_10m_populated_places', true, 'ne_10m_populated_places.zip'), ('airports', 'ourairports', false, 'airports.csv'),
  ('ports', 'worldports', false, 'worldports.csv'), ('power_plants', 'power_plants', false, 'global_power_plant_database.csv'),
  ('railways', 'wfp_railroads', true, 'wfp_railroads.zip'), ('dams', 'geodar', true, 'geodar.zip')) s(dataset, folder, zipped, file_name)
""",
)
def source_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Global datasets as rows per area (fixed list exploded per area, no join)."""
    # Global sources (dataset, folder, zipped, file name).
    src = [("roads", "ne_10m_roads", True, "ne_10m_roads.zip"),
           ("rivers", "ne_10m_rivers", True, "ne_10m_rivers_lake_centerlines.zip"),
           ("lakes", "ne_10m_lakes", True, "ne_10m_lakes.zip"),
           ("places", "ne_10m_populated_places", True, "ne_10m_populated_places.zip"),
           ("airports", "ourairports", False, "airports.csv"),
           ("ports", "worldports", False, "worldports.csv"),
           ("power_plants", "power_plants", False, "global_power_plant_database.csv"),
           ("railways", "wfp_railroads", True, "wfp_railroads.zip"),
           ("dams", "geodar", True, "geodar.zip")]
    arr = F.array(*[F.struct(F.lit(d).alias("dataset"), F.lit(f).alias("folder"), F.lit(z).alias("zipped"), F.lit(n).alias("file_name"))
                    for d, f, z, n in src])
    a = view(spark, sf, "fx_areas").select("iso", F.explode(arr).alias("s"))
    return a.select("iso", "s.dataset", F.concat(F.lit("data/input/"), "iso", F.lit("/"), "s.folder").alias("folder"), "s.zipped", "s.file_name")
