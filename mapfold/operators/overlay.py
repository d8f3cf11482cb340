"""Linework overlays on the exploded edge table ``(key.., seq, x1, y1, x2, y2)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normalise(segs: DataFrame) -> DataFrame:
    """Orient every edge from its smaller to its larger end point (nx1..ny2)."""
    first = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") <= F.col("y2")))
    return segs.withColumns({
        "nx1": F.when(first, F.col("x1")).otherwise(F.col("x2")),
        "ny1": F.when(first, F.col("y1")).otherwise(F.col("y2")),
        "nx2": F.when(first, F.col("x2")).otherwise(F.col("x1")),
        "ny2": F.when(first, F.col("y2")).otherwise(F.col("y1")),
    })


def neighbour_lines(segs: DataFrame, key: str = "area_id") -> DataFrame:
    """Each distinct edge once, with the polygons on either side (left=min, right=max key).

    A ``groupBy`` on the normalised edge: partial aggregation keeps one row
    per edge per task, so shared edges cost no pairwise join.
    """
    n = normalise(segs)
    return n.groupBy("nx1", "ny1", "nx2", "ny2").agg(
        F.min(key).alias("left_id"),
        F.when(F.count("*") > 1, F.max(key)).alias("right_id"),
        F.count("*").alias("n"),
    ).select(F.col("nx1").alias("x1"), F.col("ny1").alias("y1"), F.col("nx2").alias("x2"), F.col("ny2").alias("y2"),
             "left_id", "right_id", "n")


def dedupe_edges(segs: DataFrame) -> DataFrame:
    """Drop edges of identical geometry (direction ignored)."""
    n = normalise(segs)
    return n.select(F.col("nx1").alias("x1"), F.col("ny1").alias("y1"), F.col("nx2").alias("x2"), F.col("ny2").alias("y2")).distinct()


def snap(col, step: int = 10):
    """Round a micro-degree coordinate to the nearest multiple of ``step`` (1e-5 deg for 10)."""
    return (F.floor((F.col(col) + step // 2) / step) * step).cast("long")


def repair(segs: DataFrame) -> DataFrame:
    """Drop zero-length edges (repeated vertices)."""
    return segs.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def repair_rings(edges: DataFrame, *keys: str) -> DataFrame:
    """Rings (keys.., part, ring, eid, x1..y2) without repeated vertices, closed, and of three edges or more.

    An edge starts where the one before it ends, whatever was in between, and the
    last ends where the first starts.
    """
    ring = Window.partitionBy(*keys, "part", "ring").orderBy("eid")
    rows = repair(edges)
    whole = Window.partitionBy(*keys, "part", "ring")
    start = F.first(F.struct("x1", "y1")).over(ring)
    nxt = F.coalesce(F.lead(F.struct("x1", "y1")).over(ring), start)
    rows = rows.withColumn("_n", nxt).withColumns({"x2": F.col("_n.x1"), "y2": F.col("_n.y1")}).drop("_n")
    rows = repair(rows).withColumn("_size", F.count("*").over(whole)).where("_size >= 3")
    return rows.drop("_size")


def distinct_geometries(edges: DataFrame, key: str) -> DataFrame:
    """(key, n_same) of one feature per geometry: the same edges whatever their order and direction; the least key stays."""
    n = normalise(edges)
    edge = F.xxhash64("nx1", "ny1", "nx2", "ny2")
    # per feature: number of edges and three independent sums over them, added up before the shuffle
    sums = [F.sum(F.xxhash64("nx1", "ny1", "nx2", "ny2", F.lit(k)).cast("decimal(20,0)")).alias(f"s{k}") for k in (1, 2)]
    per = n.groupBy(key).agg(F.count("*").alias("n"), F.bit_xor(edge).alias("s0"), *sums)
    return per.groupBy("n", "s0", "s1", "s2").agg(F.min(key).alias(key), F.count("*").alias("n_same")).select(key, "n_same")


def present(areas: DataFrame, segs: DataFrame, key: str = "area_id") -> DataFrame:
    """The areas whose geometry is neither null nor empty: at least one edge has all its coordinates."""
    whole = segs.dropna(subset=["x1", "y1", "x2", "y2"])
    return areas.join(whole.select(key), key, "left_semi")


def ring_lines(edges: DataFrame, *keys: str) -> DataFrame:
    """Polygon -> boundary: (keys.., part, ring, n_vertices, line), a ring's vertices in order as
    "x y, x y, .." with the first again at the end.  ``keys`` may carry attributes."""
    point = lambda a, b: F.concat(F.col(a).cast("string"), F.lit(" "), F.col(b).cast("string"))
    vs = F.array_sort(F.collect_list(F.struct("eid", point("x1", "y1").alias("v"), point("x2", "y2").alias("w"))))
    rings = edges.groupBy(*keys, "part", "ring").agg(vs.alias("vs"))  # a line is one value of one row
    line = F.array_join(F.concat(F.col("vs.v"), F.array(F.element_at("vs", -1)["w"])), ", ")
    return rings.select(*keys, "part", "ring", (F.size("vs") + 1).alias("n_vertices"), line.alias("line"))


def linework(features: DataFrame, edges: DataFrame, file: str = "file_id", feature: str = "row_id") -> DataFrame:
    """(file, feature, status, part, ring, n_vertices, line) of the features (file, feature, kind) of boundary files.

    The kind of a file's first feature decides: polygons become their boundaries
    and features of equal geometry count once, lines stay as they are, and any other
    kind is one row that says so.
    """
    first = features.groupBy(file).agg(F.min_by("kind", feature).alias("file_kind"))
    areal, lines = F.col("file_kind").isin("Polygon", "MultiPolygon"), F.col("file_kind") == "LineString"
    rows = features.select(file, feature).join(first.where(areal | lines), file).join(ring_lines(edges, feature), feature)
    whole = rows.groupBy(file, feature, "file_kind").agg(F.array_sort(F.collect_list(F.struct("part", "ring", "n_vertices", "line"))).alias("rings"))
    # equal geometry: the same rings, by a digest; lines are never merged
    same = F.when(areal, F.sha2(F.to_json(F.struct("rings")), 256)).otherwise(F.col(feature).cast("string"))
    kept = whole.groupBy(file, same.alias("shape")).agg(F.min(feature).alias(feature), F.min_by("rings", feature).alias("rings"))
    made = kept.select(file, feature, F.lit("ok").alias("status"), F.inline("rings"))
    other = first.where(~(areal | lines)).select(file, F.concat(F.lit("unsupported "), "file_kind").alias("status"))
    return made.unionByName(other, allowMissingColumns=True)


def _rounded(num, den):
    """num / den to the nearest integer (halves up), exact for decimals; den > 0."""
    n, d = 2 * num + den, 2 * den
    down = F.call_function("div", n, d)
    return down - F.when((n % d) < 0, 1).otherwise(0)


def centroids(edges: DataFrame, *keys: str, areal: str = "areal") -> DataFrame:
    """(keys.., cx, cy) in degrees of features of any kind: by area where ``areal`` (exact, to the nearest
    micro-degree), else by length, and the mean of the end points where a feature has no length
    (points are edges of length zero)."""
    wide = {c: F.col(c).cast("decimal(12,0)") for c in ("x1", "y1", "x2", "y2")}
    cross = (wide["x1"] * wide["y2"] - wide["x2"] * wide["y1"]).cast("decimal(19,0)")
    x1, y1, x2, y2 = (F.col(c).cast("double") / 1e6 for c in ("x1", "y1", "x2", "y2"))
    length = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    moment = lambda a, b: F.sum(((wide[a] + wide[b]).cast("decimal(12,0)") * cross).cast("decimal(28,0)")).cast("decimal(36,0)")
    g = edges.groupBy(*keys).agg(
        F.max(areal).alias("_areal"), F.sum(cross).cast("decimal(26,0)").alias("a0"), moment("x1", "x2").alias("a1"), moment("y1", "y2").alias("a2"),
        F.sum(length).alias("l0"), F.sum((x1 + x2) / 2 * length).alias("l1"), F.sum((y1 + y2) / 2 * length).alias("l2"),
        F.avg((x1 + x2) / 2).alias("p1"), F.avg((y1 + y2) / 2).alias("p2"),
    )
    turn = F.signum(F.col("a0").cast("double")).cast("int")

    def pick(i: int):
        exact = _rounded(F.col(f"a{i}") * turn, 3 * F.abs("a0")).cast("double") / 1e6
        return F.when(F.col("_areal") & (F.col("a0") != 0), exact).when(F.col("l0") > 0, F.round(F.col(f"l{i}") / F.col("l0"), 6)).otherwise(F.round(f"p{i}", 6))

    return g.select(*keys, pick(1).alias("cx"), pick(2).alias("cy"))


def centroid(segs: DataFrame, key: str = "area_id") -> DataFrame:
    """Area-weighted centroid and area of each polygon (shoelace over its edges), degrees."""
    x1, y1, x2, y2 = (F.col(c).cast("double") / 1e6 for c in ("x1", "y1", "x2", "y2"))
    cr = x1 * y2 - x2 * y1
    g = segs.groupBy(key).agg(F.sum(cr).alias("a2"), F.sum((x1 + x2) * cr).alias("sx"), F.sum((y1 + y2) * cr).alias("sy"))
    return g.select(
        key, F.round(F.col("sx") / (3 * F.col("a2")), 6).alias("cx"), F.round(F.col("sy") / (3 * F.col("a2")), 6).alias("cy"),
        F.round(F.abs(F.col("a2")) / 2, 6).alias("area_deg2"),
    )
