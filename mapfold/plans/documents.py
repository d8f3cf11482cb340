"""Documents written and read back: feature collections, service answers, dictionaries, layers without rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions import names as N
from mapfold.operators import geojson as GJ
from mapfold.plans import query
from mapfold.plans.discovery import _DEG
from mapfold.session import shared_dir
from mapfold.sinks import writers as W
from mapfold.sources import readers as R


def _shape_sql(table: str, key: str) -> str:
    return f"""ring_t as (select {key}, part, ring, concat('[', string_agg(v, ',' order by eid), ',', arg_min(v, eid), ']') t from (
    select {key}, part, ring, eid, concat('[', {_DEG.format(v='x1')}, ',', {_DEG.format(v='y1')}, ']') v from {table}) p group by {key}, part, ring
), part_t as (select {key}, part, concat('[', string_agg(t, ',' order by ring), ']') t from ring_t group by {key}, part
), shape as (select {key}, case when count(*) = 1 then 'Polygon' else 'MultiPolygon' end kind, case when count(*) = 1 then max(t) else concat('[', string_agg(t, ',' order by part), ']') end coordinates
  from part_t group by {key})"""


@query("geom_to_geojson", f"""with {_shape_sql('fx_polys', 'poly_id')} select poly_id, concat('{{"type":"', kind, '","coordinates":', coordinates, '}}') geojson from shape""")
def geom_to_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons with holes and several parts as GeoJSON geometry."""
    shapes = GJ.polygon_texts(view(spark, sf, "fx_polys"), "poly_id")
    return shapes.select("poly_id", F.concat(F.lit('{"type":"'), "kind", F.lit('","coordinates":'), "coordinates", F.lit("}")).alias("geojson"))


def collections(features: DataFrame, group: str) -> DataFrame:
    """(group, value): one FeatureCollection per group of (group, id, properties json, kind, coordinates).

    The document is one value, so its features are gathered; a group is one file of the result.
    """
    one = F.concat(F.lit('{"type":"Feature","properties":'), "properties", F.lit(',"geometry":{"type":"'), "kind", F.lit('","coordinates":'), "coordinates", F.lit("}}"))
    g = features.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("id", one.alias("f")))).alias("fs"))
    return g.select(group, F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("fs.f", ","), F.lit("]}")).alias("value"))


@query("sink_geojson", "select nat, poly_id, case when max(part) over (partition by poly_id) > 0 then 'MultiPolygon' else 'Polygon' end kind, part, ring, eid, x1, y1, x2, y2 from fx_polys")
def sink_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """One collection per nation, written and read back edge by edge."""
    p = view(spark, sf, "fx_polys")
    shapes = GJ.polygon_texts(p, "poly_id", "nat")
    props = F.to_json(F.struct(F.col("poly_id").cast("string").alias("id"), F.col("nat").cast("string").alias("nat")))
    path = shared_dir(spark, "collections")
    W.write_text(collections(shapes.select("nat", F.col("poly_id").alias("id"), props.alias("properties"), "kind", "coordinates"), "nat").select("value"), path)
    f = R.read_geojson(spark, path)
    get = lambda k: F.try_element_at("properties", F.lit(k)).cast("long")
    return GJ.edges(f.select(get("nat").cast("int").alias("nat"), get("id").alias("poly_id"), "geom_type", "coordinates"), "nat", "poly_id")


@query("scan_rest_features", "select pid, country, x, y from fx_points")
def scan_rest_features(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a feature service, landed page by page: all fields and the point of every feature."""
    p = view(spark, sf, "fx_points")
    spot = F.concat(F.lit("["), GJ.degrees(F.col("x")), F.lit(","), GJ.degrees(F.col("y")), F.lit("]"))
    props = F.to_json(F.struct(F.col("pid").cast("string").alias("pid"), "country"))
    rows = p.select((F.col("pid") % 16).alias("page"), F.col("pid").alias("id"), props.alias("properties"), F.lit("Point").alias("kind"), spot.alias("coordinates"))
    path = shared_dir(spark, "answers")
    W.write_text(collections(rows, "page").select("value"), path)
    f = R.read_geojson(spark, path).select(F.try_element_at("properties", F.lit("pid")).cast("long").alias("pid"), F.try_element_at("properties", F.lit("country")).alias("country"), "geom_type", "coordinates")
    return GJ.edges(f, "pid", "country").select("pid", "country", F.col("x1").alias("x"), F.col("y1").alias("y"))


@query(
    "scan_json_dict",
    """
select pcode key, arg_max(name, file_order) name, arg_max(adm_level, file_order) admin_lvl
from fx_units where pcode is not null group by pcode
""",
)
def scan_json_dict(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionaries of many codes over many lines, a file each -> (key, fields) rows."""
    from mapfold.plans.admin import pcode_last

    d = pcode_last(spark, sf)
    entry = F.concat(F.lit('  "'), "pcode", F.lit('": '), F.to_json(F.struct("name", F.col("adm_level").alias("admin_lvl"))))
    g = d.groupBy(F.col("adm_level").alias("file")).agg(F.array_sort(F.collect_list(entry)).alias("es"))  # a dictionary is one document
    path = shared_dir(spark, "dict")
    W.write_text(g.select("file", F.concat(F.lit("{\n"), F.array_join("es", ",\n"), F.lit("\n}")).alias("value")), path, partition_by="file")
    r = R.read_json_dict(spark, path, "struct<name:string,admin_lvl:int>", whole=True)
    return r.select("key", "v.name", "v.admin_lvl")


@query(
    "sink_skip_empty",
    "select a.area_id, count(p.pid) n, case when count(p.pid) > 0 then 'written' else 'skipped' end status from fx_areas a left join fx_points p on p.nat = a.area_id and p.nat % 3 <> 0 group by a.area_id",
)
def sink_skip_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Layers written area by area; an area without rows has no folder, which its status tells."""
    a = view(spark, sf, "fx_areas").select("area_id")
    layer = view(spark, sf, "fx_points").where("nat % 3 <> 0").select(F.col("nat").alias("area_id"), "pid")
    path = shared_dir(spark, "layers")
    W.write_layer(layer, path, ("area_id",))
    made = spark.read.schema("pid long, area_id long").parquet(path).groupBy("area_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    return a.join(made, "area_id", "left").select("area_id", n.alias("n"), F.when(n > 0, F.lit("written")).otherwise(F.lit("skipped")).alias("status"))


@query(
    "nat_population_catalog",
    """with f as (select split_part(path, '/', 4) iso, path, right(path, 3) ext from fx_files where right(path, 4) in ('.csv', '.zip'))
select f.iso, f.path url, concat('223_popu/', f.iso, '_popu_pop_tab_', regexp_extract(f.path, '([^/]+)[.][a-z]+$', 1), '.csv') target
from (select distinct * from f) f join (select iso, min(ext) ext from f group by iso) e on e.iso = f.iso and e.ext = f.ext""",
)
def nat_population_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of a list of countries with their files, landed as documents: the first entry of a
    country counts, one row per file with its url and target name."""
    f = view(spark, sf, "fx_files").where(F.col("path").endswith(".csv") | F.col("path").endswith(".zip"))
    iso, stem = F.split_part("path", F.lit("/"), F.lit(4)), F.regexp_extract("path", "([^/]+)[.][a-z]+$", 1)
    item = F.struct(F.col("path").alias("download_url"), F.concat(iso, F.lit("_popu_pop_tab_"), stem).alias("ma_file_name"))
    g = f.groupBy(iso.alias("country_code"), F.when(F.col("path").endswith(".csv"), 0).otherwise(1).alias("place")).agg(F.array_sort(F.collect_set(item)).alias("val"))
    path = shared_dir(spark, "population")
    W.write_json(g, path)
    entries = spark.read.schema("country_code string, place int, val array<struct<download_url:string,ma_file_name:string>>").json(path)
    first = entries.groupBy("country_code").agg(F.min_by("val", "place").alias("val"))
    return first.select(F.col("country_code").alias("iso"), F.inline("val")).select("iso", F.col("download_url").alias("url"), F.concat(F.lit("223_popu/"), "ma_file_name", F.lit(".csv")).alias("target"))


_DATASETS = """(select p_partkey k, [p_type, p_brand] tags, case when p_partkey % 11 <> 0 then p_brand end organization, concat('m', p_size) maintainer,
  case when p_partkey % 3 <> 0 then concat('[', 1990 + p_size, ']') end dataset_date, case when p_partkey % 7 = 0 then '2020-01-05' else cast(p_partkey * 86400 + 1600000000 as varchar) end modified,
  cast(p_partkey * 86400 + 1500000000 as varchar) created, case when p_size % 2 = 0 then 'Every year' end frequency, case when p_size % 5 <> 0 then 'cc-by' end license,
  case when p_size % 2 = 0 then ['SHP', 'CSV', 'SHP'] else ['GeoJSON'] end formats from part)"""
_DAY = "case when regexp_matches({c}, '^[0-9]+$') then strftime(make_timestamp(cast({c} as bigint) * 1000000), '%d %B %Y') else {c} end"


@query(
    "tag_catalog",
    f"""with d as {_DATASETS}, x as (select unnest(tags) tag, * from d)
select tag, regexp_replace(tag, '[ -]', '_', 'g') folder, arg_max(coalesce(organization, 'N/A'), k) as source, arg_max(coalesce(maintainer, 'N/A'), k) contributor, arg_max(coalesce(dataset_date, 'N/A'), k) time_period,
  arg_max({_DAY.format(c='modified')}, k) modified, arg_max({_DAY.format(c='created')}, k) added, arg_max(coalesce(frequency, 'N/A'), k) frequency, 'all' as location, 'N/A' visibility,
  arg_max(coalesce(license, 'N/A'), k) license, 'N/A' methodology, 'N/A' caveats, arg_max(array_to_string(tags, ', '), k) tags, arg_max(array_to_string(list_sort(list_distinct(formats)), ', '), k) file_format from x group by tag""",
)
def tag_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """One row per tag with the thirteen metadata fields of its last dataset; absent fields are N/A."""
    p = view(spark, sf, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    d = p.select(
        k.alias("k"), F.array("p_type", "p_brand").alias("tags"), F.when(k % 11 != 0, F.col("p_brand")).alias("organization"), F.concat(F.lit("m"), size.cast("string")).alias("maintainer"),
        F.when(k % 3 != 0, F.concat(F.lit("["), (1990 + size).cast("string"), F.lit("]"))).alias("dataset_date"),
        F.when(k % 7 == 0, F.lit("2020-01-05")).otherwise((k * 86400 + 1600000000).cast("string")).alias("metadata_modified"), (k * 86400 + 1500000000).cast("string").alias("metadata_created"),
        F.when(size % 2 == 0, F.lit("Every year")).alias("data_update_frequency"), F.when(size % 5 != 0, F.lit("cc-by")).alias("license_id"),
        F.when(size % 2 == 0, F.array(F.lit("SHP"), F.lit("CSV"), F.lit("SHP"))).otherwise(F.array(F.lit("GeoJSON"))).alias("formats"),
    )
    return catalogue(d, "k", "all")


def catalogue(datasets: DataFrame, order: str, location: str) -> DataFrame:
    """Datasets with lists of tags and formats -> one metadata row per tag, of the dataset found last."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("N/A")) if c in datasets.columns else F.lit("N/A")
    fields = {
        "source": known("organization"), "contributor": known("maintainer"), "time_period": known("dataset_date"), "modified": N.epoch_date("metadata_modified"), "added": N.epoch_date("metadata_created"),
        "frequency": known("data_update_frequency"), "location": F.lit(location), "visibility": known("visibility"), "license": known("license_id"), "methodology": known("methodology"), "caveats": known("caveats"),
        "tags": F.array_join("tags", ", "), "file_format": F.array_join(F.array_sort(F.array_distinct("formats")), ", "),
    }
    rows = datasets.select(F.col(order).alias("_order"), F.explode("tags").alias("tag"), *[c.alias(n) for n, c in fields.items()])
    last = rows.groupBy("tag").agg(F.max_by(F.struct(*fields), "_order").alias("r"))
    return last.select("tag", F.regexp_replace("tag", "[ -]", "_").alias("folder"), "r.*")
