"""Administrative boundaries: level routing, layer names, pcode dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Real names of administrative levels (default "Admin").
REALNAMES = {0: "country", 1: "parish", 2: "municipality", 3: "district", 4: "locality"}
# Level keys found in file names, in dictionary order.
LEVEL_KEYS = [("adm0", 0), ("adm1", 1), ("adm2", 2), ("adm3", 3), ("adm4", 4), ("disputed", 86), ("coastline", 99)]
# Level codes kept by the boundary filter.
VALID_LEVELS = [0, 1, 2, 3, 4, *range(80, 90), 99]
# Layer name formats (iso, level, source, realname).
FMT_POLY = "{iso}_admn_ad{level}_py_s1_{src}_pp_{real}"
FMT_DISPUTED = "{iso}_admn_ad0_ln_s0_{src}_pp_disputedBoundaries"
FMT_COAST = "{iso}_elev_cst_ln_s0_{src}_pp_coastline"


def realname(level: Column) -> Column:
    """join_level_realname: level -> real name, default 'Admin' (map lookup)."""
    kv = []
    for k, v in REALNAMES.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), level), F.lit("Admin"))


def _fmt(fmt: str, **cols: Column) -> Column:
    parts: list[Column] = []
    rest = fmt
    while "{" in rest:
        pre, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if pre:
            parts.append(F.lit(pre))
        parts.append(cols[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def route_levels(rows: DataFrame, iso: Column, level: Column, src: Column) -> DataFrame:
    """admin_route: 86/87 -> disputed, 99 -> coastline, else a polygon layer per
    level; ``linework`` marks the rows that also feed boundary lines."""
    name = (
        F.when(level.isin(86, 87), _fmt(FMT_DISPUTED, iso=iso, src=src))
        .when(level == 99, _fmt(FMT_COAST, iso=iso, src=src))
        .otherwise(_fmt(FMT_POLY, iso=iso, level=level, src=src, real=realname(level)))
    )
    return rows.withColumns({"layer_name": name, "linework": ~level.isin(86, 87, 99)})


def split_boundary(level: Column, admbndp: Column, max_level: int = 4) -> Column:
    """filt_boundary_split: boundary rows -> admin / coastline / disputed; others NULL."""
    return (
        F.when(admbndp != 1, F.lit(None).cast("string"))
        .when(level <= max_level, F.lit("admin"))
        .when(level == 99, F.lit("coastline"))
        .otherwise(F.lit("disputed"))
    )


def level_from_name(path: Column) -> Column:
    """join_level_by_name: first key (dictionary order) found in the file name."""
    out = F.lit(None).cast("int")
    for key, lvl in reversed(LEVEL_KEYS):
        out = F.when(path.contains(key), F.lit(lvl)).otherwise(out)
    return out


def last_wins(df: DataFrame, key: list[str], order: str, cols: list[str]) -> DataFrame:
    """agg_last_wins: per key keep the record with the greatest ``order``.

    ``max_by`` is a partial aggregate: each task keeps one candidate per key
    before the shuffle, so a hot key costs one row per task, not its size.
    """
    rec = F.max_by(F.struct(*cols), F.col(order)).alias("r")
    return df.groupBy(*key).agg(rec).select(*key, *[F.col(f"r.{c}").alias(c) for c in cols])
