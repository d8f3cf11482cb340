"""Administrative boundary routing, level names and pcode queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators import admin as A
from mapfold.plans import query

_REAL_SQL = (
    "coalesce(case {l} when 0 then 'country' when 1 then 'parish' when 2 then 'municipality' "
    "when 3 then 'district' when 4 then 'locality' end, 'Admin')"
)


def _rows_with_iso(spark, sf):
    rows = view(spark, sf, "fx_boundary_rows")
    return rows.join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id")


@query(
    "filt_levels",
    "select row_id, adm_level, area_id from fx_boundary_rows "
    "where adm_level in (0,1,2,3,4,80,81,82,83,84,85,86,87,88,89,99)",
)
def filt_levels(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_boundary_rows").where(F.col("adm_level").isin(A.VALID_LEVELS)).select(
        "row_id", "adm_level", "area_id"
    )


_ROUTE_SQL = f"""
select r.row_id, r.area_id, r.adm_level,
  case when r.adm_level in (86, 87) then concat(a.iso, '_admn_ad0_ln_s0_hdx_pp_disputedBoundaries')
       when r.adm_level = 99 then concat(a.iso, '_elev_cst_ln_s0_hdx_pp_coastline')
       else concat(a.iso, '_admn_ad', cast(r.adm_level as varchar), '_py_s1_hdx_pp_', {_REAL_SQL.format(l='r.adm_level')}) end layer_name,
  r.adm_level not in (86, 87, 99) linework
from fx_boundary_rows r join fx_areas a on a.area_id = r.area_id
"""


@query("admin_route", _ROUTE_SQL)
def admin_route(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows_with_iso(spark, sf)
    out = A.route_levels(rows, F.col("iso"), F.col("adm_level"), F.lit("hdx"))
    return out.select("row_id", "area_id", "adm_level", "layer_name", "linework")


@query(
    "admin_route_strict",
    f"""
select row_id, area_id, adm_level, case when adm_level in (0,1,2,3,4,86,87,99) then layer_name end layer_name,
  adm_level in (0,1,2,3,4,86,87,99) accepted
from ({_ROUTE_SQL}) x
""",
)
def admin_route_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Earlier router: levels outside 0-4, 86/87, 99 are reported, not routed."""
    ok = F.col("adm_level").isin(0, 1, 2, 3, 4, 86, 87, 99)
    r = admin_route(spark, sf)
    return r.select("row_id", "area_id", "adm_level", F.when(ok, F.col("layer_name")).alias("layer_name"), ok.alias("accepted"))


@query(
    "join_level_realname",
    f"select distinct adm_level, {_REAL_SQL.format(l='adm_level')} realname from fx_boundary_rows",
)
def join_level_realname(spark: SparkSession, sf: str) -> DataFrame:
    lv = view(spark, sf, "fx_boundary_rows").select("adm_level").distinct()
    return lv.select("adm_level", A.realname(F.col("adm_level")).alias("realname"))


@query(
    "agg_split_by_level",
    f"select layer_name, count(*) n_rows from ({_ROUTE_SQL}) x group by layer_name",
)
def agg_split_by_level(spark: SparkSession, sf: str) -> DataFrame:
    """Group by level: one output per group (here: its row count)."""
    return admin_route(spark, sf).groupBy("layer_name").agg(F.count("*").alias("n_rows"))


_SPLIT_SQL = """
select row_id, area_id, adm_level,
  case when admbndp <> 1 then null when adm_level <= 4 then 'admin' when adm_level = 99 then 'coastline'
       else 'disputed' end part
from fx_boundary_rows
"""


@query("filt_boundary_split", _SPLIT_SQL)
def filt_boundary_split(spark: SparkSession, sf: str) -> DataFrame:
    r = view(spark, sf, "fx_boundary_rows")
    return r.select("row_id", "area_id", "adm_level", A.split_boundary(F.col("adm_level"), F.col("admbndp")).alias("part"))


@query(
    "admin_split_hdx",
    f"""
select s.row_id, case s.part when 'admin' then concat(a.iso, '_admn_ad', cast(s.adm_level as varchar), '_ln_s0_pp')
  when 'coastline' then concat(a.iso, '_elev_cst_ln_s0_pp_coastline')
  else concat(a.iso, '_admn_ad0_ln_s0_pp_disputedBoundaries') end layer_name
from ({_SPLIT_SQL}) s join fx_areas a on a.area_id = s.area_id where s.part is not null
""",
)
def admin_split_hdx(spark: SparkSession, sf: str) -> DataFrame:
    s = filt_boundary_split(spark, sf).where(F.col("part").isNotNull())
    s = s.join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id")
    name = (
        F.when(F.col("part") == "admin", F.concat("iso", F.lit("_admn_ad"), F.col("adm_level").cast("string"), F.lit("_ln_s0_pp")))
        .when(F.col("part") == "coastline", F.concat("iso", F.lit("_elev_cst_ln_s0_pp_coastline")))
        .otherwise(F.concat("iso", F.lit("_admn_ad0_ln_s0_pp_disputedBoundaries")))
    )
    return s.select("row_id", name.alias("layer_name"))


@query(
    "nat_coastline_v2",
    "select r.row_id, a.iso from fx_boundary_rows r join fx_areas a on a.area_id = r.area_id where r.adm_level = 99",
)
def nat_coastline_v2(spark: SparkSession, sf: str) -> DataFrame:
    return _rows_with_iso(spark, sf).where(F.col("adm_level") == 99).select("row_id", "iso")


# -- level display names ---------------------------------------------------------------

_NAMES_SQL = """
select a.iso, l.adm_level,
  coalesce(case l.adm_level when 0 then n.adm0 when 1 then n.adm1 when 2 then n.adm2 end,
           concat('adminboundary', cast(l.adm_level as varchar))) display_name,
  coalesce(n.source, 'unknown') source
from (select distinct area_id, adm_level from fx_boundary_rows where adm_level <= 4) l
join fx_areas a on a.area_id = l.area_id left join fx_level_names n on n.iso = a.iso
"""


def level_names(spark: SparkSession, sf: str) -> DataFrame:
    lv = view(spark, sf, "fx_boundary_rows").where("adm_level <= 4").select("area_id", "adm_level").distinct()
    lv = lv.join(view(spark, sf, "fx_areas").select("area_id", "iso"), "area_id")
    names = view(spark, sf, "fx_level_names")
    disp = (
        F.when(F.col("adm_level") == 0, F.col("adm0"))
        .when(F.col("adm_level") == 1, F.col("adm1"))
        .when(F.col("adm_level") == 2, F.col("adm2"))
    )
    return lv.join(names, "iso", "left").select(
        "iso", "adm_level",
        F.coalesce(disp, F.concat(F.lit("adminboundary"), F.col("adm_level").cast("string"))).alias("display_name"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
    )


@query("join_level_names", _NAMES_SQL)
def join_level_names(spark: SparkSession, sf: str) -> DataFrame:
    return level_names(spark, sf)


@query(
    "join_no_cod_skip",
    "select a.area_id, a.iso from fx_areas a where not exists "
    "(select 1 from fx_level_names n where n.iso = a.iso and n.source = 'no cod data')",
)
def join_no_cod_skip(spark: SparkSession, sf: str) -> DataFrame:
    nocod = view(spark, sf, "fx_level_names").where(F.col("source") == "no cod data").select("iso")
    return view(spark, sf, "fx_areas").join(nocod, "iso", "left_anti").select("area_id", "iso")


@query(
    "fn_map_get_default",
    "select iso, coalesce(adm1, 'adm1') adm1_name, coalesce(adm2, '') adm2_name from fx_level_names",
)
def fn_map_get_default(spark: SparkSession, sf: str) -> DataFrame:
    n = view(spark, sf, "fx_level_names")
    return n.select("iso", F.coalesce("adm1", F.lit("adm1")).alias("adm1_name"), F.coalesce("adm2", F.lit("")).alias("adm2_name"))


@query(
    "admin_disputed",
    f"""
select r.row_id, case when r.adm_level = 99 then concat(a.iso, '_elev_cst_ln_s0_cod_pp_coastline')
  when r.adm_level between 80 and 89 then concat(a.iso, '_admn_ad0_ln_s0_cod_pp_disputed', cast(r.adm_level as varchar))
  else concat(a.iso, '_admn_ad', cast(r.adm_level as varchar), '_ln_s0_cod_pp_', n.display_name) end layer_name
from fx_boundary_rows r join fx_areas a on a.area_id = r.area_id
left join ({_NAMES_SQL}) n on n.iso = a.iso and n.adm_level = r.adm_level
where r.adm_level in (0,1,2,3,4,80,81,82,83,84,85,86,87,88,89,99)
""",
)
def admin_disputed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows_with_iso(spark, sf).where(F.col("adm_level").isin(A.VALID_LEVELS))
    names = level_names(spark, sf)
    j = rows.join(names, ["iso", "adm_level"], "left")
    lvl = F.col("adm_level").cast("string")
    name = (
        F.when(F.col("adm_level") == 99, F.concat("iso", F.lit("_elev_cst_ln_s0_cod_pp_coastline")))
        .when(F.col("adm_level").between(80, 89), F.concat("iso", F.lit("_admn_ad0_ln_s0_cod_pp_disputed"), lvl))
        .otherwise(F.concat("iso", F.lit("_admn_ad"), lvl, F.lit("_ln_s0_cod_pp_"), F.col("display_name")))
    )
    return j.select("row_id", name.alias("layer_name"))


# -- file-name driven routing ------------------------------------------------------------

_LEVEL_BY_NAME_SQL = (
    "case when contains({p}, 'adm0') then 0 when contains({p}, 'adm1') then 1 when contains({p}, 'adm2') then 2 "
    "when contains({p}, 'adm3') then 3 when contains({p}, 'adm4') then 4 when contains({p}, 'disputed') then 86 "
    "when contains({p}, 'coastline') then 99 end"
)


@query(
    "join_level_by_name",
    f"select file_id, {_LEVEL_BY_NAME_SQL.format(p='path')} adm_level from fx_files",
)
def join_level_by_name(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "fx_files")
    return f.select("file_id", A.level_from_name(F.col("path")).alias("adm_level"))


@query(
    "admin_route_by_name",
    f"""
select f.file_id, x.adm_level,
  case when x.adm_level = 86 then concat(x.iso, '_admn_ad0_ln_s0_', x.src, '_pp_disputedBoundaries')
       when x.adm_level = 99 then concat(x.iso, '_elev_cst_ln_s0_', x.src, '_pp_coastline')
       else concat(x.iso, '_admn_ad', cast(x.adm_level as varchar), '_py_s1_', x.src, '_pp_', {_REAL_SQL.format(l='x.adm_level')}) end layer_name
from fx_files f join (select file_id, {_LEVEL_BY_NAME_SQL.format(p='path')} adm_level,
  split_part(path, '/', 4) iso, case when contains(path, 'zimstat') then 'zimstat' else 'hdx' end src from fx_files) x
  on x.file_id = f.file_id
where x.adm_level is not null and ends_with(f.path, '.shp')
""",
)
def admin_route_by_name(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "fx_files").where(F.col("path").endswith(".shp"))
    f = f.select(
        "file_id",
        A.level_from_name(F.col("path")).alias("adm_level"),
        F.split_part(F.col("path"), F.lit("/"), F.lit(4)).alias("iso"),
        F.when(F.col("path").contains("zimstat"), F.lit("zimstat")).otherwise(F.lit("hdx")).alias("src"),
    ).where(F.col("adm_level").isNotNull())
    out = A.route_levels(f, F.col("iso"), F.col("adm_level"), F.col("src"))
    return out.select("file_id", "adm_level", "layer_name")


@query(
    "fn_source_from_path",
    "select file_id, case when contains(path, 'zimstat') then 'zimstat' else 'hdx' end source from fx_files",
)
def fn_source_from_path(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "fx_files")
    return f.select("file_id", F.when(F.col("path").contains("zimstat"), F.lit("zimstat")).otherwise(F.lit("hdx")).alias("source"))


@query(
    "filt_path_level",
    "select file_id, cast(regexp_extract(path, 'adm([0-9]+)', 1) as int) adm_level from fx_files "
    "where regexp_extract(path, 'adm([0-9]+)', 1) <> '' and cast(regexp_extract(path, 'adm([0-9]+)', 1) as int) between 0 and 2",
)
def filt_path_level(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "fx_files")
    lv = F.regexp_extract("path", r"adm([0-9]+)", 1)
    return f.where(lv != "").select("file_id", lv.cast("int").alias("adm_level")).where(F.col("adm_level").between(0, 2))


@query(
    "topk_first_file",
    "select split_part(path, '/', 4) iso, min(path) path from fx_files "
    "where contains(path, 'admALL') and contains(path, 'admbndl') group by split_part(path, '/', 4)",
)
def topk_first_file(spark: SparkSession, sf: str) -> DataFrame:
    """Per area folder, the first file (path order) whose name holds both markers."""
    f = view(spark, sf, "fx_files").where(F.col("path").contains("admALL") & F.col("path").contains("admbndl"))
    return f.groupBy(F.split_part("path", F.lit("/"), F.lit(4)).alias("iso")).agg(F.min("path").alias("path"))


@query(
    "join_shapefile_choice",
    """
with f as (select file_id, split_part(path, '/', 4) iso, path, contains(path, '_adm') has_level from fx_files
           where ends_with(path, '.shp'))
select f.file_id, f.iso from f join (select iso, bool_or(has_level) any_level from f group by iso) g on g.iso = f.iso
where (g.any_level and f.has_level) or (not g.any_level)
""",
)
def join_shapefile_choice(spark: SparkSession, sf: str) -> DataFrame:
    """Per area: if any file carries a level use only those, else all files."""
    f = view(spark, sf, "fx_files").where(F.col("path").endswith(".shp")).select(
        "file_id", F.split_part("path", F.lit("/"), F.lit(4)).alias("iso"), F.col("path").contains("_adm").alias("has_level")
    )
    g = f.groupBy("iso").agg(F.bool_or("has_level").alias("any_level"))
    return f.join(g, "iso").where((F.col("any_level") & F.col("has_level")) | ~F.col("any_level")).select("file_id", "iso")


# -- pcodes ------------------------------------------------------------------------------

_LAST_SQL = """
select pcode, arg_max(name, file_order) name, arg_max(adm_level, file_order) adm_level,
  arg_max(admin_type, file_order) admin_type, arg_max(area_id, file_order) area_id
from fx_units where pcode is not null group by pcode
"""


def pcode_last(spark: SparkSession, sf: str, max_level: int | None = None) -> DataFrame:
    u = view(spark, sf, "fx_units").where(F.col("pcode").isNotNull())
    if max_level is not None:
        u = u.where(F.col("adm_level") <= max_level)
    return A.last_wins(u, ["pcode"], "file_order", ["name", "adm_level", "admin_type", "area_id"])


@query("agg_last_wins", _LAST_SQL)
def agg_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return pcode_last(spark, sf)


_MERGE_SQL = """
select pcode, name, adm_level, admin_type, area_id from fx_units where pcode is not null
qualify row_number() over (partition by pcode order by case when file_order % 2 = 0 then 0 else 1 end, file_order desc) = 1
"""


@query("set_merge_override", _MERGE_SQL)
def set_merge_override(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary update: union of two dictionaries, the right one wins per key."""
    u = view(spark, sf, "fx_units").where(F.col("pcode").isNotNull())
    left, right = u.where(F.col("file_order") % 2 == 1), u.where(F.col("file_order") % 2 == 0)
    side = lambda df, n: df.withColumn("turn", F.struct(F.lit(n).alias("side"), F.col("file_order")))
    both = side(left, 0).unionByName(side(right, 1))
    return A.last_wins(both, ["pcode"], "turn", ["name", "adm_level", "admin_type", "area_id"])


@query("filt_notnull_key", "select row_id, pcode from fx_units where pcode is not null")
def filt_notnull_key(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_units").where(F.col("pcode").isNotNull()).select("row_id", "pcode")


_UNITS_SQL = """
select upper(a.iso) iso, a.name_en country_name, u.pcode, u.name name_en, u.admin_type, u.adm_level admin_level
from (select pcode, arg_max(name, file_order) name, arg_max(adm_level, file_order) adm_level,
  arg_max(admin_type, file_order) admin_type, arg_max(area_id, file_order) area_id
  from fx_units where pcode is not null and adm_level <= 2 group by pcode) u
join fx_areas a on a.area_id = u.area_id
"""


def units(spark: SparkSession, sf: str, max_level: int = 2) -> DataFrame:
    u = pcode_last(spark, sf, max_level)
    a = view(spark, sf, "fx_areas").select("area_id", "iso", "name_en")
    return u.join(a, "area_id").select(
        F.upper("iso").alias("iso"), F.col("name_en").alias("country_name"), "pcode",
        F.col("name").alias("name_en"), "admin_type", F.col("adm_level").alias("admin_level"),
    )


_SELECTED_SQL = """
select a.area_id, a.iso, a.name_en from fx_areas a
where a.region in (0, 1, 2) and not exists (select 1 from fx_level_names n where n.iso = a.iso and n.source = 'no cod data')
"""


def selected_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Areas in the to-process list (regions 0-2) and not in the missing list."""
    a = view(spark, sf, "fx_areas")
    todo = view(spark, sf, "region").where(F.col("r_regionkey").isin(0, 1, 2)).select(F.col("r_regionkey").alias("region"))
    missing = view(spark, sf, "fx_level_names").where(F.col("source") == "no cod data").select("iso")
    return a.join(todo, "region", "left_semi").join(missing, "iso", "left_anti").select("area_id", "iso", "name_en")


@query("join_semi_anti_countries", _SELECTED_SQL)
def join_semi_anti_countries(spark: SparkSession, sf: str) -> DataFrame:
    return selected_areas(spark, sf)


@query(
    "subnational_units",
    f"""
select u.pcode, s.iso, regexp_replace(u.name_en, '[^a-zA-Z0-9]', '_', 'g') slug, u.admin_type,
  concat('data/output/subnational/', s.iso, '/', u.pcode) out_dir
from ({_UNITS_SQL}) u join ({_SELECTED_SQL}) s on upper(s.iso) = u.iso
""",
)
def subnational_units(spark: SparkSession, sf: str) -> DataFrame:
    u = units(spark, sf).select("pcode", F.col("iso").alias("uiso"), "name_en", "admin_type")
    s = selected_areas(spark, sf).select(F.col("iso").alias("siso"), F.upper("iso").alias("uiso"))
    j = u.join(s, "uiso")
    return j.select(
        "pcode", F.col("siso").alias("iso"), F.regexp_replace("name_en", "[^a-zA-Z0-9]", "_").alias("slug"), "admin_type",
        F.concat(F.lit("data/output/subnational/"), F.col("siso"), F.lit("/"), F.col("pcode")).alias("out_dir"),
    )


@query(
    "country_units",
    """
select iso, name_en, concat('data/input/', iso) data_in, concat('data/output/country_extractions/', iso) data_out,
  concat('static_data/countries/', iso, '.json') area_file
from fx_areas
""",
)
def country_units(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "fx_areas")
    return a.select(
        "iso", "name_en",
        F.concat(F.lit("data/input/"), "iso").alias("data_in"),
        F.concat(F.lit("data/output/country_extractions/"), "iso").alias("data_out"),
        F.concat(F.lit("static_data/countries/"), "iso", F.lit(".json")).alias("area_file"),
    )
