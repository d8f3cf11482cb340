"""Sources: GeoJSON FeatureCollections, CSV with explicit schema, text sets,
keyed JSON dictionaries, package JSON, directory listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_COLLECTION = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            # coordinates nest differently per type: kept as text, parsed per type
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def read_geojson(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """scan_geojson: one row per feature (file, properties map, geometry type, coordinates text)."""
    df = (spark.read.schema(FEATURE_COLLECTION).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", multiline).json(path))
    df = df.withColumn("file", F.col("_metadata.file_path"))
    return df.select("file", "name", "_corrupt_record", F.posexplode_outer("features").alias("fpos", "f")).select(
        "file", "name", "_corrupt_record", "fpos",
        F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def vertex_count(coords_text) -> F.Column:
    """Number of positions in the coordinates text of any geometry type, over all rings and parts."""
    return F.regexp_count(coords_text, F.lit(r"\[\s*-?[0-9]"))


def area_list(features: DataFrame) -> DataFrame:
    """scan_area_list: (lower(iso), name_en) per feature plus a status for bad rows."""
    iso = F.try_element_at("properties", F.lit("iso"))
    name = F.try_element_at("properties", F.lit("name_en"))
    status = (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("undecodable"))
        .when(F.col("fpos").isNull(), F.lit("no_features"))
        .when(iso.isNull() | name.isNull(), F.lit("missing_property"))
        .otherwise(F.lit("ok"))
    )
    return features.select(F.lower(iso).alias("iso"), name.alias("name_en"), status.alias("status"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """scan_csv: header CSV with an explicit schema (no inference)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_text_set(spark: SparkSession, path: str) -> DataFrame:
    """scan_text_set: stripped non-empty lines as a distinct set."""
    t = spark.read.text(path).select(F.trim("value").alias("value"))
    return t.where(F.col("value") != "").distinct()


def read_json_dict(spark: SparkSession, path: str, value_schema: str, whole: bool = False) -> DataFrame:
    """scan_json_dict: JSON objects keyed by code -> (key, value struct) rows; an object per
    line, or one object per file over any number of lines (``whole``)."""
    raw = spark.read.text(path, wholetext=whole)
    m = F.from_json("value", f"map<string,{value_schema}>")
    return raw.select(F.explode(m).alias("key", "v"))


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """scan_ckan_package: one row per resource (download_url, last_modified)."""
    s = "result struct<name:string,resources:array<struct<download_url:string,last_modified:string>>>"
    p = spark.read.schema(s).json(path)
    return p.select(F.col("result.name").alias("package"), F.explode("result.resources").alias("r")).select(
        "package", "r.download_url", "r.last_modified"
    )


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """scan_dir: recursive listing (path, length, modificationTime) without reading contents."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")
