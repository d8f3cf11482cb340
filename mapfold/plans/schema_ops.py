"""Schema operators as table operations over a names table derived from events:
(grp = area schema, pos = first position, name = attribute column name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.operators.schema import short_names_table
from mapfold.plans import query

_NAMES_SQL = """
(select cast(user_id % 25 as int) grp, cast(min(event_id) as bigint) pos,
  concat('attribute_', event_type, '_', cast(event_id % 3 as varchar)) name
 from events group by 1, 3)
"""

WANTED = ["attribute_view_0", "attribute_click_1", "attribute_error_2", "name"]


def names_table(spark: SparkSession, sf: str) -> DataFrame:
    e = view(spark, sf, "events")
    return e.groupBy(
        (F.col("user_id") % 25).cast("int").alias("grp"),
        F.concat(F.lit("attribute_"), "event_type", F.lit("_"), (F.col("event_id") % 3).cast("string")).alias("name"),
    ).agg(F.min("event_id").cast("long").alias("pos"))


@query(
    "proj_short_names_keep_first",
    f"""
select grp, pos, name, case when k = 1 then substr(name, 1, 10) else concat(substr(name, 1, 9), cast(k - 1 as varchar)) end short
from (select *, row_number() over (partition by grp, substr(name, 1, 10) order by pos) k from {_NAMES_SQL} t) x
""",
)
def proj_short_names_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return short_names_table(names_table(spark, sf), "keep_first")


@query(
    "proj_short_names_number_all",
    f"""
select grp, pos, name, case when n = 1 then substr(name, 1, 10)
  else concat(substr(substr(name, 1, 10), 1, 10 - length(cast(k as varchar))), cast(k as varchar)) end short
from (select *, row_number() over (partition by grp, substr(name, 1, 10) order by pos) k,
  count(*) over (partition by grp, substr(name, 1, 10)) n from {_NAMES_SQL} t) x
""",
)
def proj_short_names_number_all(spark: SparkSession, sf: str) -> DataFrame:
    return short_names_table(names_table(spark, sf), "number_all")


@query(
    "win_number_duplicates",
    f"""
select grp, pos, name, cast(row_number() over (partition by grp, substr(name, 1, 10) order by pos) as int) k
from {_NAMES_SQL} t
""",
)
def win_number_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Running number inside a group of equal cut names (groups are one schema's columns)."""
    w = Window.partitionBy("grp", F.substring("name", 1, 10)).orderBy("pos")
    return names_table(spark, sf).select("grp", "pos", "name", F.row_number().over(w).alias("k"))


@query(
    "proj_first_n_columns",
    f"select grp, name from (select *, row_number() over (partition by grp order by pos) r from {_NAMES_SQL} t) x where r <= 100",
)
def proj_first_n_columns(spark: SparkSession, sf: str) -> DataFrame:
    """First 100 columns of each schema."""
    w = Window.partitionBy("grp").orderBy("pos")
    return names_table(spark, sf).withColumn("r", F.row_number().over(w)).where("r <= 100").select("grp", "name")


def _wanted(spark):
    return spark.createDataFrame([(w,) for w in WANTED], "name string")


_WANTED_SQL = "(select unnest(['attribute_view_0', 'attribute_click_1', 'attribute_error_2', 'name']) name)"


@query("proj_available", f"select t.grp, t.name from {_NAMES_SQL} t where t.name in (select name from {_WANTED_SQL} w)")
def proj_available(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted attributes that exist in each schema."""
    return names_table(spark, sf).join(F.broadcast(_wanted(spark)), "name", "left_semi").select("grp", "name")


@query("set_intersect_columns", f"select t.grp, t.name from {_NAMES_SQL} t where t.name in (select name from {_WANTED_SQL} w)")
def set_intersect_columns(spark: SparkSession, sf: str) -> DataFrame:
    return proj_available(spark, sf)


_GRPS_SQL = f"(select distinct grp from {_NAMES_SQL} t)"


@query(
    "set_except_columns",
    f"""
select g.grp, w.name from {_GRPS_SQL} g, {_WANTED_SQL} w
where not exists (select 1 from {_NAMES_SQL} t where t.grp = g.grp and t.name = w.name)
""",
)
def set_except_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted minus present, per schema (reported as missing)."""
    names = names_table(spark, sf)
    grid = names.select("grp").distinct().select("grp", F.explode(F.array(*map(F.lit, WANTED))).alias("name"))
    return grid.join(names, ["grp", "name"], "left_anti")


@query("proj_drop", f"select grp, name from {_NAMES_SQL} t where name not like 'attribute_error%'")
def proj_drop(spark: SparkSession, sf: str) -> DataFrame:
    return names_table(spark, sf).where(~F.col("name").startswith("attribute_error")).select("grp", "name")


@query(
    "proj_move_first",
    f"""
select grp, name, cast(row_number() over (partition by grp order by case when name like 'attribute_click%' then 0 else 1 end, pos) as int) new_pos
from {_NAMES_SQL} t
""",
)
def proj_move_first(spark: SparkSession, sf: str) -> DataFrame:
    """A chosen column first, the rest in order (per schema)."""
    first = F.when(F.col("name").startswith("attribute_click"), 0).otherwise(1)
    w = Window.partitionBy("grp").orderBy(first, "pos")
    return names_table(spark, sf).select("grp", "name", F.row_number().over(w).alias("new_pos"))


@query(
    "proj_find_level_column",
    f"select grp, min(name) level_column from {_NAMES_SQL} t where lower(name) = 'attribute_view_0' group by grp",
)
def proj_find_level_column(spark: SparkSession, sf: str) -> DataFrame:
    """Case-insensitive exact find of one column name per schema."""
    n = names_table(spark, sf).where(F.lower("name") == "attribute_view_0")
    return n.groupBy("grp").agg(F.min("name").alias("level_column"))


@query(
    "proj_to_text",
    "select osm_id, cast(x as varchar) x_text, cast(atm as varchar) atm_text from fx_osm",
)
def proj_to_text(spark: SparkSession, sf: str) -> DataFrame:
    """Cast to text; NULL stays NULL (no 'nan')."""
    o = view(spark, sf, "fx_osm")
    return o.select("osm_id", F.col("x").cast("string").alias("x_text"), F.col("atm").cast("string").alias("atm_text"))


@query(
    "proj_fclass",
    """
select osm_id, 'dam' c_const, amenity c_tag, coalesce(amenity, 'poi') c_tag_else,
  case when waterway = 'river' then 'big_river' else waterway end c_cond from fx_osm
""",
)
def proj_fclass(spark: SparkSession, sf: str) -> DataFrame:
    """Class column: constant, tag copy, tag else constant, conditional."""
    o = view(spark, sf, "fx_osm")
    return o.select(
        "osm_id", F.lit("dam").alias("c_const"), F.col("amenity").alias("c_tag"),
        F.coalesce("amenity", F.lit("poi")).alias("c_tag_else"),
        F.when(F.col("waterway") == "river", F.lit("big_river")).otherwise(F.col("waterway")).alias("c_cond"),
    )


@query(
    "topk_first_feature",
    "select nat, min(pid) pid from fx_points group by nat",
)
def topk_first_feature(spark: SparkSession, sf: str) -> DataFrame:
    """First feature of each layer (partial min per task, no window)."""
    return view(spark, sf, "fx_points").groupBy("nat").agg(F.min("pid").alias("pid"))


@query(
    "join_country_codes",
    "select p.pid, a.area_id, a.name_en from fx_points p left join fx_areas a on lower(p.country) = a.iso",
)
def join_country_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Code -> name lookup on the (small, one row per area) code dimension; unknown -> NULL."""
    p = view(spark, sf, "fx_points").select("pid", F.lower("country").alias("iso"))
    a = view(spark, sf, "fx_areas").select("iso", "area_id", "name_en")
    return p.join(a, "iso", "left").select("pid", "area_id", "name_en")
