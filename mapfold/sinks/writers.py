"""Layer sinks: partitioned Parquet layers, GeoJSON text, dictionaries, ledger.

All writes go to the shared folder named by ``spark.checkpoint.dir`` (or a
path the caller gives); no machine-local temporary folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_layer(df: DataFrame, path: str, partition_by=("iso",)) -> None:
    """sink_layer: one folder per area (and layer); dynamic partition overwrite."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def polygon_feature_collection(rings: DataFrame, key: str, props: list[str], name: Column | None = None) -> DataFrame:
    """sink_geojson / sink_unit_geojson: one FeatureCollection document per ``key``.

    ``rings``: (key, props.., seq, x, y) vertices of one ring per key, in micro-degrees.
    The ring of one area is bounded by its vertex count; it is gathered per key.
    """
    v = F.struct("seq", F.array((F.col("x") / 1e6).cast("double"), (F.col("y") / 1e6).cast("double")).alias("xy"))
    g = rings.groupBy(key, *props).agg(F.array_sort(F.collect_list(v)).alias("vs"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[F.col(p) for p in props]).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(F.col("vs.xy")).alias("coordinates")).alias("geometry"),
    )
    doc = F.struct(
        F.lit("FeatureCollection").alias("type"),
        (name if name is not None else F.col(key).cast("string")).alias("name"),
        F.struct(F.lit("name").alias("type"), F.struct(F.lit("urn:ogc:def:crs:OGC:1.3:CRS84").alias("name")).alias("properties")).alias("crs"),
        F.array(feature).alias("features"),
    )
    return g.select(key, F.to_json(doc).alias("value"))


def write_text(docs: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = docs.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_ledger(df: DataFrame, path: str) -> None:
    """sink_ledger: append (iso, level, filepath, processed_at) rows."""
    df.select("event_id", "iso", F.col("level").cast("string").alias("level"), "filepath", "processed_at") \
        .write.mode("append").parquet(path)
