"""Geometry as GeoJSON text and back: parts, rings and vertices of any type.

Vertices are written from integer micro-degrees with six decimals, so writing and
reading is exact.  A feature's geometry is one value of one row, as everywhere in
GeoJSON; rings are gathered per feature only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapfold.functions.geometry import MICRO


def degrees(v: Column) -> Column:
    """Micro-degrees as decimal text."""
    a = F.abs(v)
    whole = F.call_function("div", a, F.lit(MICRO)).cast("string")
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), whole, F.lit("."), F.lpad((a % MICRO).cast("string"), 6, "0"))


def _list(parts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def polygon_texts(edges: DataFrame, *keys: str) -> DataFrame:
    """(keys.., kind, coordinates) of polygon edges (keys.., part, ring, eid, x1, y1): ring 0 of a
    part is its outline, the others its holes; several parts make a MultiPolygon."""
    vertex = F.concat(F.lit("["), degrees(F.col("x1")), F.lit(","), degrees(F.col("y1")), F.lit("]"))
    rings = edges.groupBy(*keys, "part", "ring").agg(F.array_sort(F.collect_list(F.struct("eid", vertex.alias("v")))).alias("vs"))
    closed = F.concat(F.col("vs.v"), F.array(F.get("vs", F.lit(0))["v"]))
    rings = rings.select(*keys, "part", "ring", _list(closed).alias("text"))
    parts = rings.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("ring", "text"))).alias("rs"))
    parts = parts.select(*keys, "part", _list(F.col("rs.text")).alias("text"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("ps"))
    one = F.size("ps") == 1
    kind = F.when(one, F.lit("Polygon")).otherwise(F.lit("MultiPolygon"))
    return whole.select(*keys, kind.alias("kind"), F.when(one, F.get("ps", F.lit(0))["text"]).otherwise(_list(F.col("ps.text"))).alias("coordinates"))


#: depth of the coordinates of each geometry type, as arrays around numbers
DEPTH = {"Point": 1, "MultiPoint": 2, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def parsed(kind: Column, coordinates: Column) -> Column:
    """array<part: array<ring: array<vertex: array<double>>>> of any geometry; null if the text does not fit its type."""
    out = F.lit(None).cast("array<array<array<array<double>>>>")
    for name, depth in DEPTH.items():
        shape = "double"
        for _ in range(depth):
            shape = f"array<{shape}>"
        value = F.from_json(coordinates, shape, {"mode": "PERMISSIVE"})
        # points are parts of one vertex, lines parts of one open ring
        if name in ("Point", "LineString"):
            value = F.array(F.array(F.array(value))) if name == "Point" else F.array(F.array(value))
        elif name in ("MultiPoint", "MultiLineString"):
            wrap = (lambda v: F.array(F.array(v))) if name == "MultiPoint" else (lambda v: F.array(v))
            value = F.transform(value, wrap)
        elif name == "Polygon":
            value = F.array(value)
        out = F.when(kind == name, value).otherwise(out)
    return out


def edges(features: DataFrame, *keys: str) -> DataFrame:
    """(keys.., kind, part, ring, eid, x1, y1, x2, y2) of features with geom_type and coordinates:
    one row per edge, eid counting through the feature; points have the one edge of length zero.
    Features whose coordinates do not fit their type, or are empty, have no rows."""
    micro = lambda v, i: F.round(v[i] * MICRO).cast("long")
    rows = features.select(*keys, F.col("geom_type").alias("kind"), F.posexplode(parsed(F.col("geom_type"), F.col("coordinates"))).alias("part", "rings"))
    rows = rows.select(*keys, "kind", "part", F.posexplode("rings").alias("ring", "vs"))
    last = F.greatest(F.size("vs") - 2, F.lit(0))
    rows = rows.where(F.size("vs") > 0).select(*keys, "kind", "part", "ring", "vs", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    a, b = F.get("vs", F.col("at")), F.coalesce(F.get("vs", F.col("at") + 1), F.get("vs", F.col("at")))
    rows = rows.select(*keys, "kind", "part", "ring", "at", micro(a, 0).alias("x1"), micro(a, 1).alias("y1"), micro(b, 0).alias("x2"), micro(b, 1).alias("y2"))
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy("part", "ring", "at")
    return rows.withColumn("eid", F.row_number().over(order) - 1).select(*keys, "kind", "part", "ring", "eid", "x1", "y1", "x2", "y2")
