"""Raster queries on the pixel table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import raster as R
from mapfold.operators.spatial_join import points_in_areas
from mapfold.operators.store import stored
from mapfold.plans import query
from mapfold.plans.sqlsnip import within_having

_SLOPE_SQL = """
select p.r, p.c, round(degrees(atan(sqrt(((e.v - w.v) / 60.0) * ((e.v - w.v) / 60.0)
  + ((s.v - n.v) / 60.0) * ((s.v - n.v) / 60.0)))), 6) slope
from fx_pixels p
left join fx_pixels e on e.r = p.r and e.c = p.c + 1 left join fx_pixels w on w.r = p.r and w.c = p.c - 1
left join fx_pixels s on s.r = p.r + 1 and s.c = p.c left join fx_pixels n on n.r = p.r - 1 and n.c = p.c
"""


@query("ras_slope", _SLOPE_SQL)
def ras_slope(spark: SparkSession, sf: str) -> DataFrame:
    return R.slope(view(spark, sf, "fx_pixels"))


_CENTRES_SQL = (
    "(select r, c, v, -180000000 + c*100000 + 50000 x, 90000000 - r*100000 - 50000 y from fx_pixels)"
)
_CLIP_SQL = f"""
select s.area_id, p.r, p.c, p.v from {_CENTRES_SQL} p, fx_segments s
group by s.area_id, p.r, p.c, p.v, p.x, p.y having {within_having('p', 's')}
"""


def _clip(spark, sf):
    px = R.pixel_centres(view(spark, sf, "fx_pixels"))
    hits = points_in_areas(px, view(spark, sf, "fx_segments"), ["r", "c"], "area_id", "within", payload=["v"])
    return hits.select("area_id", "r", "c", "v")


@query("ras_clip", _CLIP_SQL)
def ras_clip(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels whose centre lies in the area (mask by centre)."""
    return _clip(spark, sf)


@query(
    "ras_mask_crop",
    f"""
select k.area_id, k.r - m.r0 r, k.c - m.c0 c, k.v from ({_CLIP_SQL}) k
join (select area_id, min(r) r0, min(c) c0 from ({_CLIP_SQL}) z group by area_id) m on m.area_id = k.area_id
""",
)
def ras_mask_crop(spark: SparkSession, sf: str) -> DataFrame:
    """Mask by areas and crop to their window: rows/cols re-based per area."""
    k = stored(_clip(spark, sf), "ras-clip")  # asked twice
    m = k.groupBy("area_id").agg(F.min("r").alias("r0"), F.min("c").alias("c0"))
    return k.join(m, "area_id").select("area_id", (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), "v")


_BOX_SQL = """
(select area_id, min(least(x1, x2)) x0, min(least(y1, y2)) y0, max(greatest(x1, x2)) x1, max(greatest(y1, y2)) y1
 from fx_segments group by area_id)
"""


def _boxes(spark, sf):
    s = view(spark, sf, "fx_segments")
    return s.groupBy("area_id").agg(
        F.min(F.least("x1", "x2")).alias("x0"), F.min(F.least("y1", "y2")).alias("y0"),
        F.max(F.greatest("x1", "x2")).alias("x1"), F.max(F.greatest("y1", "y2")).alias("y1"),
    )


def _grid_sql(n: int) -> str:
    return f"""
select b.area_id, k + 1 tile_no,
  b.x0 + (b.x1 - b.x0) * (k // {n}) // {n} bx0, b.y0 + (b.y1 - b.y0) * (k % {n}) // {n} by0,
  b.x0 + (b.x1 - b.x0) * (k // {n} + 1) // {n} bx1, b.y0 + (b.y1 - b.y0) * (k % {n} + 1) // {n} by1
from {_BOX_SQL} b, (select unnest(range(0, {n * n})) k) g
"""


for _qid in ("geom_tile_grid", "win_tile_number"):
    query(_qid, _grid_sql(16))(lambda spark, sf: R.tile_grid(_boxes(spark, sf), 16))


@query("agg_extent", f"select area_id, x0, y0, x1, y1 from {_BOX_SQL} b")
def agg_extent(spark: SparkSession, sf: str) -> DataFrame:
    return _boxes(spark, sf)


@query(
    "geom_bbox",
    "select min(least(x1, x2)) x0, min(least(y1, y2)) y0, max(greatest(x1, x2)) x1, max(greatest(y1, y2)) y1 from fx_lines",
)
def geom_bbox(spark: SparkSession, sf: str) -> DataFrame:
    """Total bounds of a layer (one row; partial min/max per task)."""
    l = view(spark, sf, "fx_lines")
    return l.agg(
        F.min(F.least("x1", "x2")).alias("x0"), F.min(F.least("y1", "y2")).alias("y0"),
        F.max(F.greatest("x1", "x2")).alias("x1"), F.max(F.greatest("y1", "y2")).alias("y1"),
    )


# Elevation products (resolution m, product, source, tiles per side).
PRODUCTS = [(30, "hsh", "srtm", 32), (30, "dtm", "srtm", 32), (90, "hsh", "srtm", 16), (90, "dtm", "srtm", 16),
            (250, "hsh", "gmted", 16), (250, "dtm", "gmted", 16)]


@query(
    "elevation_products",
    """
select a.iso, p.res, p.product, p.source, p.n * p.n n_tiles,
  concat(a.iso, '_elev_', p.product, '_ras_s0_', p.source, '_pp_', cast(p.res as varchar), 'm.tif') file_name
from fx_areas a, (values (30, 'hsh', 'srtm', 32), (30, 'dtm', 'srtm', 32), (90, 'hsh', 'srtm', 16),
  (90, 'dtm', 'srtm', 16), (250, 'hsh', 'gmted', 16), (250, 'dtm', 'gmted', 16)) p(res, product, source, n)
""",
)
def elevation_products(spark: SparkSession, sf: str) -> DataFrame:
    """Per area the fixed product matrix, as an explode of a literal array (no join)."""
    prods = F.array(*[F.struct(F.lit(r).alias("res"), F.lit(p).alias("product"), F.lit(s).alias("source"), F.lit(n).alias("n"))
                      for r, p, s, n in PRODUCTS])
    a = view(spark, sf, "fx_areas").select("iso", F.explode(prods).alias("p"))
    return a.select(
        "iso", "p.res", "p.product", "p.source", (F.col("p.n") * F.col("p.n")).alias("n_tiles"),
        F.concat("iso", F.lit("_elev_"), "p.product", F.lit("_ras_s0_"), "p.source", F.lit("_pp_"),
                 F.col("p.res").cast("string"), F.lit("m.tif")).alias("file_name"),
    )


_TILE_NAMES_SQL = f"""
select concat(a.iso, '_tile_', cast(g.tile_no as varchar), '_elev_', case when g.tile_no % 2 = 0 then 'hsh' else 'dtm' end,
  '_ras_s0_srtm_pp_90m.tif') name from ({_grid_sql(16)}) g join fx_areas a on a.area_id = g.area_id
"""


@query(
    "agg_group_tiles",
    f"""
select string_split(name, '_')[1] iso, string_split(name, '_')[5] product,
  regexp_extract(name, '_([0-9]+)m\\.tif$', 1) res, count(*) n_tiles
from ({_TILE_NAMES_SQL}) t group by 1, 2, 3
""",
)
def agg_group_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles grouped by (iso, product, resolution) parsed from the file names."""
    g = R.tile_grid(_boxes(spark, sf), 16).join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id")
    names = g.select(F.concat("iso", F.lit("_tile_"), F.col("tile_no").cast("string"), F.lit("_elev_"),
                              F.when(F.col("tile_no") % 2 == 0, F.lit("hsh")).otherwise(F.lit("dtm")),
                              F.lit("_ras_s0_srtm_pp_90m.tif")).alias("name"))
    parts = F.split("name", "_")
    return names.groupBy(
        F.element_at(parts, 1).alias("iso"), F.element_at(parts, 5).alias("product"),
        F.regexp_extract("name", r"_([0-9]+)m\.tif$", 1).alias("res"),
    ).agg(F.count("*").alias("n_tiles"))


# two rasters (rows under and over 75); tiles of 25 columns, and after each a coarser one over its last five
_PYRAMID_SQL = """
select cast(r >= 75 as int) raster, cast(floor(c / 25) as bigint) * 2 tile_order, 1 res, r, c, v from fx_pixels
union all
select cast(r >= 75 as int), cast(floor(c / 25) as bigint) * 2 + 1, 2, cast(floor(r / 2) as bigint), cast(floor(c / 2) as bigint), v + 1 from fx_pixels where c % 25 >= 20 and r % 2 = 0 and c % 2 = 0
"""


@query(
    "ras_mosaic",
    f"""with t as ({_PYRAMID_SQL}), fine as (
  select t.raster, t.tile_order, t.r * t.res + i.i r, t.c * t.res + j.j c, t.v from t join (values (0, 1), (0, 2), (1, 2)) i(i, res) on i.res = t.res join (values (0, 1), (0, 2), (1, 2)) j(j, res) on j.res = t.res)
select raster, r, c, arg_max(v, tile_order) v from fine group by raster, r, c""",
)
def ras_mosaic(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping tiles of several rasters merged at the finest resolution; the later tile lies on top."""
    p = view(spark, sf, "fx_pixels").withColumn("raster", (F.col("r") >= 75).cast("int"))
    order = F.floor(F.col("c") / 25).cast("long") * 2
    fine = p.select("raster", order.alias("tile_order"), F.lit(1).alias("res"), "r", "c", "v")
    coarse = p.where((F.col("c") % 25 >= 20) & (F.col("r") % 2 == 0) & (F.col("c") % 2 == 0))
    half = lambda c: F.floor(F.col(c) / 2).cast("long").alias(c)
    coarse = coarse.select("raster", (order + 1).alias("tile_order"), F.lit(2).alias("res"), half("r"), half("c"), (F.col("v") + 1).alias("v"))
    return R.mosaic_finest(fine.unionByName(coarse), ("raster",))


@query(
    "ras_tile",
    """with b as (select raster, min(r) r0, max(r) - min(r) + 1 h, min(c) c0, max(c) - min(c) + 1 w from (select cast(r >= 75 as int) raster, r, c from fx_pixels) p group by raster)
select p.raster, ((p.c - b.c0) * 4 // b.w) * 4 + (p.r - b.r0) * 4 // b.h + 1 tile_no, p.r, p.c, p.v from (select cast(r >= 75 as int) raster, * from fx_pixels) p join b on b.raster = p.raster""",
)
def ras_tile(spark: SparkSession, sf: str) -> DataFrame:
    """Every pixel with the number of its tile, four by four tiles over each raster."""
    p = view(spark, sf, "fx_pixels").withColumn("raster", (F.col("r") >= 75).cast("int"))
    return R.tiles(p, 4, ("raster",)).select("raster", "tile_no", "r", "c", "v")
