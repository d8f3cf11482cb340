"""Raster operators on pixel tables ``(r, c, v)``; ``key`` names the columns that tell rasters apart.

Neighbourhood stencils are expressed as one aggregation: every pixel sends its
value to itself and to its four neighbours keyed by the target cell, and a
``groupBy(r, c)`` gathers the stencil.  This costs one shuffle with map-side
partial aggregation and never groups a whole raster row or column in one task
(unlike windows partitioned by row or column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# pixel grid -> micro-degrees: origin at the top-left corner
ORIGIN_X = -180_000_000
ORIGIN_Y = 90_000_000
PIXEL = 100_000  # 0.1 degree


def pixel_centres(pixels: DataFrame) -> DataFrame:
    """(r, c, v) -> (r, c, v, x, y) with the pixel centre in micro-degrees."""
    return pixels.withColumns({
        "x": F.lit(ORIGIN_X) + F.col("c") * PIXEL + PIXEL // 2,
        "y": F.lit(ORIGIN_Y) - F.col("r") * PIXEL - PIXEL // 2,
    })


def slope(pixels: DataFrame, cell_m: float = 30.0, key: tuple[str, ...] = ()) -> DataFrame:
    """Slope in degrees from central differences; NULL where a neighbour is missing."""
    offs = [("vc", 0, 0), ("vw", 0, 1), ("ve", 0, -1), ("vn", 1, 0), ("vs", -1, 0)]
    # a pixel at (r, c) is the W neighbour of (r, c+1), the E neighbour of (r, c-1), ...
    sent = pixels.select(
        *key, F.explode(F.array(*[
            F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c"), F.lit(k).alias("k"), F.col("v").alias("v"))
            for k, dr, dc in offs
        ])).alias("s")
    ).select(*key, "s.*")
    g = sent.groupBy(*key, "r", "c").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(k) for k, _, _ in offs])
    dzdx = (F.col("ve") - F.col("vw")) / (2 * cell_m)
    dzdy = (F.col("vs") - F.col("vn")) / (2 * cell_m)
    s = F.round(F.degrees(F.atan(F.sqrt(dzdx * dzdx + dzdy * dzdy))), 6)
    return g.where(F.col("vc").isNotNull()).select(*key, "r", "c", s.alias("slope"))


def mosaic(tiles: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Tiles (tile_order, r, c, v) merged within ``key``: the later tile lies on top."""
    return tiles.groupBy(*key, "r", "c").agg(F.max_by("v", "tile_order").alias("v"))


def mosaic_finest(tiles: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """Tiles (key.., tile_order, res, r, c, v) of several resolutions merged on the finest grid of each
    raster: a pixel of a coarser tile covers a square of fine ones (``res`` is its side)."""
    finest = tiles.groupBy(*key).agg(F.min("res").alias("_finest"))  # one row per raster
    # broadcast: joined by shuffle, all pixels of a raster would meet in one task
    rows = tiles.join(F.broadcast(finest), list(key)) if key else tiles.crossJoin(F.broadcast(finest))
    side = F.sequence(F.lit(0), (F.col("res") / F.col("_finest")).cast("int") - 1)
    step = (F.col("res") / F.col("_finest")).cast("long")
    rows = rows.select("*", F.explode(side).alias("_i")).select("*", F.explode(side).alias("_j"))
    fine = rows.select(*key, "tile_order", (F.col("r") * step + F.col("_i")).alias("r"), (F.col("c") * step + F.col("_j")).alias("c"), "v")
    return mosaic(fine, key)


def tiles(pixels: DataFrame, n: int, key: tuple[str, ...] = ()) -> DataFrame:
    """Pixels (key.., r, c, ..) with ``tile_no`` of n x n tiles over each raster's extent; columns of tiles first."""
    box = pixels.groupBy(*key).agg(F.min("r").alias("_r0"), F.max("r").alias("_r1"), F.min("c").alias("_c0"), F.max("c").alias("_c1"))
    rows = pixels.join(F.broadcast(box), list(key)) if key else pixels.crossJoin(F.broadcast(box))
    part = lambda v: F.call_function("div", (F.col(v) - F.col(f"_{v}0")) * n, F.col(f"_{v}1") - F.col(f"_{v}0") + 1)
    return rows.withColumn("tile_no", part("c") * n + part("r") + 1).drop("_r0", "_r1", "_c0", "_c1")


def tile_grid(boxes: DataFrame, n: int, key: str = "area_id") -> DataFrame:
    """Each box (x0, y0, x1, y1) -> n x n boxes; outer loop x, inner y; number i*n+j+1."""
    t = boxes.select(key, "x0", "y0", "x1", "y1", F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("k"))
    i, j = (F.col("k") / n).cast("int"), F.col("k") % n
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return t.select(
        key, (F.col("k") + 1).alias("tile_no"),
        (F.col("x0") + F.expr(f"(x1 - x0) * cast(k / {n} as int) div {n}")).alias("bx0"),
        (F.col("y0") + F.expr(f"(y1 - y0) * (k % {n}) div {n}")).alias("by0"),
        (F.col("x0") + F.expr(f"(x1 - x0) * (cast(k / {n} as int) + 1) div {n}")).alias("bx1"),
        (F.col("y0") + F.expr(f"(y1 - y0) * (k % {n} + 1) div {n}")).alias("by1"),
    )
