"""Catalogue, ledger, page-link and naming-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions import names as N
from mapfold.operators.relational import topk_per_group
from mapfold.plans import query

# -- dataset catalogue -------------------------------------------------------------------

@query("agg_distinct_sorted", "select distinct tag from fx_datasets order by tag")
def agg_distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_datasets").select("tag").distinct().orderBy("tag")


@query("sort_names", "select distinct organization from fx_datasets order by organization")
def sort_names(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_datasets").select("organization").distinct().orderBy("organization")


@query(
    "agg_join_strings",
    "select organization, array_to_string(list_sort(list_distinct(list(format))), ', ') formats, "
    "cast(count(distinct tag) as bigint) n_tags from fx_datasets group by organization",
)
def agg_join_strings(spark: SparkSession, sf: str) -> DataFrame:
    d = view(spark, sf, "fx_datasets")
    return d.groupBy("organization").agg(
        F.array_join(F.array_sort(F.collect_set("format")), ", ").alias("formats"),
        F.countDistinct("tag").alias("n_tags"),
    )


@query(
    "topk_limit",
    """
select tag, dataset_rank, title, cast(rank as int) rank from (
  select tag, dataset_rank, title, row_number() over (partition by tag order by dataset_rank) rank from fx_datasets) x
where rank <= 10
""",
)
def topk_limit(spark: SparkSession, sf: str) -> DataFrame:
    """First 10 hits per search (tag) in search order."""
    d = view(spark, sf, "fx_datasets").select("tag", "dataset_rank", "title")
    return topk_per_group(d, ["tag"], ["dataset_rank"], 10)


_PICK_SQL = """
select tag, min(dataset_rank) dataset_rank from (
  select tag, dataset_rank, format, row_number() over (partition by tag order by dataset_rank) rank from fx_datasets) x
where rank <= 10 and format = 'CSV' group by tag
"""


def _first_success(spark: SparkSession, sf: str) -> DataFrame:
    d = view(spark, sf, "fx_datasets").select("tag", "dataset_rank", "format")
    top = topk_per_group(d, ["tag"], ["dataset_rank"], 10)
    return top.where(F.col("format") == "CSV").groupBy("tag").agg(F.min("dataset_rank").alias("dataset_rank"))


@query("topk_first_success", _PICK_SQL)
def topk_first_success(spark: SparkSession, sf: str) -> DataFrame:
    """Of the first 10 datasets per search, the first with a loadable resource."""
    return _first_success(spark, sf)


@query("resource_pick", _PICK_SQL)
def resource_pick(spark: SparkSession, sf: str) -> DataFrame:
    return _first_success(spark, sf)


@query("fn_epoch_date", """
select dataset_rank, case when regexp_matches(metadata_modified, '^[0-9]+$')
  then strftime(make_timestamp(cast(metadata_modified as bigint)*1000000), '%d %B %Y') else metadata_modified end d
from fx_datasets
""")
def fn_epoch_date(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_datasets").select("dataset_rank", N.epoch_date("metadata_modified").alias("d"))


# -- ledger and layer catalogue ------------------------------------------------------------

_TOKENS_SQL = "string_split(regexp_extract(filepath, '^(.*?)(\\.[^./]*)?$', 1), '_')"


@query(
    "fn_layer_parse",
    f"select event_id, {_TOKENS_SQL}[1] iso, {_TOKENS_SQL}[8] free, "
    f"{_TOKENS_SQL}[len({_TOKENS_SQL})] last_token from fx_ledger",
)
def fn_layer_parse(spark: SparkSession, sf: str) -> DataFrame:
    t = N.layer_tokens("filepath")
    return view(spark, sf, "fx_ledger").select(
        "event_id", F.element_at(t, 1).alias("iso"), F.try_element_at(t, F.lit(8)).alias("free"),
        F.element_at(t, -1).alias("last_token"),
    )


@query(
    "layer_catalog",
    f"""
select {_TOKENS_SQL}[1] iso, {_TOKENS_SQL}[3] category, {_TOKENS_SQL}[4] geom,
  count(*) n_files, min(processed_at) first_processed, max(processed_at) last_processed
from fx_ledger group by 1, 2, 3
""",
)
def layer_catalog(spark: SparkSession, sf: str) -> DataFrame:
    t = N.layer_tokens("filepath")
    l = view(spark, sf, "fx_ledger").select(
        F.element_at(t, 1).alias("iso"), F.element_at(t, 3).alias("category"), F.element_at(t, 4).alias("geom"),
        "processed_at",
    )
    return l.groupBy("iso", "category", "geom").agg(
        F.count("*").alias("n_files"), F.min("processed_at").alias("first_processed"),
        F.max("processed_at").alias("last_processed"),
    )


@query(
    "fn_layer_name",
    "select area_id, concat_ws('_', iso, 'admn', concat('ad', cast(area_id % 5 as varchar)), 'py', 's1', 'hdx', 'pp', "
    "lower(replace(name_en, ' ', ''))) layer_name from fx_areas",
)
def fn_layer_name(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "fx_areas")
    return a.select(
        "area_id",
        N.layer_name(
            "iso", F.lit("admn"), F.concat(F.lit("ad"), (F.col("area_id") % 5).cast("string")), F.lit("py"),
            F.lit("s1"), F.lit("hdx"), F.lit("pp"), F.lower(F.regexp_replace("name_en", " ", "")),
        ).alias("layer_name"),
    )


# expected layers: theme x category with '*' wildcards, derived from events
_EXPECTED_SQL = """
select distinct event_type theme, concat('ad', cast(event_id % 6 as varchar)) category,
  case when event_id % 6 = 5 then '*' else 'src' end source from events
"""
_PRODUCED_SQL = f"""
select iso, {_TOKENS_SQL}[2] theme, {_TOKENS_SQL}[3] category, {_TOKENS_SQL}[6] source, processed_at from fx_ledger
"""


def _expected(spark, sf):
    e = view(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("theme"),
        F.concat(F.lit("ad"), (F.col("event_id") % 6).cast("string")).alias("category"),
        F.when(F.col("event_id") % 6 == 5, F.lit("*")).otherwise(F.lit("src")).alias("source"),
    ).distinct()


def _produced(spark, sf):
    t = N.layer_tokens("filepath")
    return view(spark, sf, "fx_ledger").select(
        "iso", F.element_at(t, 2).alias("theme"), F.element_at(t, 3).alias("category"),
        F.element_at(t, 6).alias("source"), "processed_at",
    )


def _wild(e, p, c):
    return e[c].isin("*", "") | (e[c] == p[c])


@query(
    "join_completeness",
    f"""
select e.theme, e.category, e.source, count(p.iso) n_layers, min(p.processed_at) first_processed
from ({_EXPECTED_SQL}) e left join ({_PRODUCED_SQL}) p on p.theme = e.theme
  and (e.category in ('*', '') or e.category = p.category) and (e.source in ('*', '') or e.source = p.source)
group by e.theme, e.category, e.source
""",
)
def join_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Expected layers (with '*' wildcards) left-joined to produced layers.

    The equi part (theme) drives a hash join; wildcards are residual filters.
    """
    e, p = _expected(spark, sf).alias("e"), _produced(spark, sf).alias("p")
    cond = (F.col("p.theme") == F.col("e.theme")) & (
        F.col("e.category").isin("*", "") | (F.col("e.category") == F.col("p.category"))
    ) & (F.col("e.source").isin("*", "") | (F.col("e.source") == F.col("p.source")))
    j = e.join(p, cond, "left")
    return j.groupBy("e.theme", "e.category", "e.source").agg(
        F.count("p.iso").alias("n_layers"), F.min("p.processed_at").alias("first_processed")
    )


@query(
    "completeness_report",
    f"""
select p.iso, count(distinct concat(e.theme, '/', e.category, '/', e.source)) n_expected_found
from ({_EXPECTED_SQL}) e join ({_PRODUCED_SQL}) p on p.theme = e.theme
  and (e.category in ('*', '') or e.category = p.category) and (e.source in ('*', '') or e.source = p.source)
group by p.iso
""",
)
def completeness_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per area: how many expected layers it has produced."""
    e, p = _expected(spark, sf).alias("e"), _produced(spark, sf).alias("p")
    cond = (F.col("p.theme") == F.col("e.theme")) & (
        F.col("e.category").isin("*", "") | (F.col("e.category") == F.col("p.category"))
    ) & (F.col("e.source").isin("*", "") | (F.col("e.source") == F.col("p.source")))
    j = e.join(p, cond, "inner")
    key = F.concat_ws("/", "e.theme", "e.category", "e.source")
    return j.groupBy("p.iso").agg(F.countDistinct(key).alias("n_expected_found"))


# -- pages ----------------------------------------------------------------------------------

_HREFS_SQL = """
select page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) href,
  generate_subscripts(regexp_extract_all(html, 'href="([^"]+)"', 1), 1) pos from pages
"""


def hrefs(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "pages")
    return p.select(
        "page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("pos0", "href")
    ).withColumn("pos", (F.col("pos0") + 1).cast("long")).drop("pos0")


@query(
    "page_links",
    f"""
select page_id, cast(pos as bigint) pos, case when starts_with(href, 'http') then href
  else concat(regexp_extract(url, '^(https?://[^/]+)', 1), href) end link
from ({_HREFS_SQL}) h
""",
)
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """All links of every page, made absolute (resource filters: filt_resource_suffix)."""
    h = hrefs(spark, sf)
    return h.select("page_id", "pos", N.absolute_url("href", "url").alias("link"))


@query("page_link_counts", f"select page_id, count(*) n_links from ({_HREFS_SQL}) h group by page_id")
def page_link_counts(spark: SparkSession, sf: str) -> DataFrame:
    return hrefs(spark, sf).groupBy("page_id").agg(F.count("*").alias("n_links"))


@query("agg_counts", f"select count(*) n_links, count(distinct page_id) n_pages from ({_HREFS_SQL}) h")
def agg_counts(spark: SparkSession, sf: str) -> DataFrame:
    return hrefs(spark, sf).agg(F.count("*").alias("n_links"), F.countDistinct("page_id").alias("n_pages"))


@query(
    "fn_absolute_url",
    f"""
select page_id, cast(pos as bigint) pos, case when starts_with(href, 'http') then href
  else concat(regexp_extract(url, '^(https?://[^/]+)', 1), href) end link from ({_HREFS_SQL}) h
""",
)
def fn_absolute_url(spark: SparkSession, sf: str) -> DataFrame:
    return hrefs(spark, sf).select("page_id", "pos", N.absolute_url("href", "url").alias("link"))


_BASE_SQL = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)"


@query(
    "fn_basename",
    f"""
select page_id, {_BASE_SQL} base, regexp_extract({_BASE_SQL}, '^(.*?)(\\.[^./]*)?$', 1) stem,
  regexp_extract({_BASE_SQL}, '^(.*?)(\\.[^./]*)?$', 2) ext from pages
""",
)
def fn_basename(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "pages")
    b = N.basename("url")
    stem, ext = N.split_ext(b)
    return p.select("page_id", b.alias("base"), stem.alias("stem"), ext.alias("ext"))


@query(
    "fn_header_filename",
    f"""
select page_id, coalesce(nullif(regexp_extract(coalesce(case when page_id % 2 = 0
  then concat('attachment; filename="p', cast(page_id as varchar), '.zip"') end, ''), 'filename="?([^";]+)"?', 1), ''),
  {_BASE_SQL}) file_name from pages
""",
)
def fn_header_filename(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "pages")
    cd = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('attachment; filename="p'), F.col("page_id").cast("string"), F.lit('.zip"')))
    return p.select("page_id", N.header_filename(cd, "url").alias("file_name"))


# -- string functions over the base tables ----------------------------------------------------

@query(
    "fn_case",
    "select n_nationkey, upper(n_name) up, lower(n_name) low, "
    "concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))) cap from nation",
)
def fn_case(spark: SparkSession, sf: str) -> DataFrame:
    n = view(spark, sf, "nation")
    return n.select("n_nationkey", F.upper("n_name").alias("up"), F.lower("n_name").alias("low"), N.capitalize("n_name").alias("cap"))


@query(
    "filt_country_ci",
    "select p.pid, a.iso from fx_points p join fx_areas a on upper(p.country) = upper(a.iso)",
)
def filt_country_ci(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "fx_points").select("pid", "country")
    a = view(spark, sf, "fx_areas").select("iso")
    return p.join(a, F.upper("country") == F.upper("iso")).select("pid", "iso")


@query(
    "fn_slug",
    "select c_custkey, regexp_replace(c_name, '[^a-zA-Z0-9]', '_', 'g') slug from customer",
)
def fn_slug(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "customer").select("c_custkey", N.slug("c_name").alias("slug"))


@query("fn_dir_name", "select p_partkey, translate(p_type, ' -', '__') d from part")
def fn_dir_name(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "part").select("p_partkey", N.dir_name("p_type").alias("d"))


_ABBR_IN = "case when n_nationkey % 2 = 0 then n_name else lower(n_name) end"


@query(
    "fn_source_abbr",
    f"""
select n_nationkey, case when len(list_filter(string_split({_ABBR_IN}, ' '), lambda w: regexp_matches(w, '^[A-Z]'))) > 0
  then lower(array_to_string(list_transform(list_filter(string_split({_ABBR_IN}, ' '), lambda w: regexp_matches(w, '^[A-Z]')),
    lambda w: substr(w, 1, 1)), ''))
  else lower(string_split({_ABBR_IN}, ' ')[1]) end abbr from nation
""",
)
def fn_source_abbr(spark: SparkSession, sf: str) -> DataFrame:
    n = view(spark, sf, "nation")
    src = F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.lower("n_name"))
    return n.select("n_nationkey", N.source_abbr(src).alias("abbr"))


_YEAR_IN = (
    "case when o_orderkey % 3 = 0 then o_orderpriority "
    "else concat(o_orderpriority, ' ', cast(year(o_orderdate) as varchar)) end"
)


@query(
    "fn_end_year",
    f"""
select o_orderkey, coalesce(list_filter(string_split(string_split({_YEAR_IN}, '-')[-1], ' '),
  lambda w: regexp_matches(w, '^[0-9]+$'))[-1], 'Not Found') end_year from orders
""",
)
def fn_end_year(spark: SparkSession, sf: str) -> DataFrame:
    o = view(spark, sf, "orders")
    txt = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(
        F.concat("o_orderpriority", F.lit(" "), F.year("o_orderdate").cast("string"))
    )
    return o.select("o_orderkey", N.end_year(txt).alias("end_year"))


@query(
    "fn_scale_token",
    "select event_id, string_split(filepath, '_')[3] scale from fx_ledger",
)
def fn_scale_token(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_ledger").select("event_id", F.element_at(F.split("filepath", "_"), 3).alias("scale"))


@query(
    "fn_pop_name",
    "select event_id, concat(iso, '_popu_pop_tab_', string_split(filepath, '_')[3], '_', "
    "string_split(filepath, '_')[6], '_', cast(year(processed_at) as varchar), '.csv') pop_name from fx_ledger",
)
def fn_pop_name(spark: SparkSession, sf: str) -> DataFrame:
    l = view(spark, sf, "fx_ledger")
    parts = F.split("filepath", "_")
    return l.select(
        "event_id",
        F.concat("iso", F.lit("_popu_pop_tab_"), F.element_at(parts, 3), F.lit("_"), F.element_at(parts, 6), F.lit("_"),
                 F.year("processed_at").cast("string"), F.lit(".csv")).alias("pop_name"),
    )


@query(
    "fn_add_suffix",
    "select event_id, concat(regexp_extract(filepath, '^(.*?)(\\.[^./]*)?$', 1), '_clip', "
    "regexp_extract(filepath, '^(.*?)(\\.[^./]*)?$', 2)) name from fx_ledger",
)
def fn_add_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "fx_ledger").select("event_id", N.add_suffix("filepath", "_clip").alias("name"))


@query(
    "fn_filename_year",
    "select event_id, concat(split_part(filepath, '.', 1), '_', string_split(concat('Updated ', "
    "cast(year(processed_at) as varchar)), ' ')[-1], '.', string_split(filepath, '.')[-1]) name from fx_ledger",
)
def fn_filename_year(spark: SparkSession, sf: str) -> DataFrame:
    l = view(spark, sf, "fx_ledger")
    upd = F.concat(F.lit("Updated "), F.year("processed_at").cast("string"))
    return l.select("event_id", N.filename_year("filepath", upd).alias("name"))


@query(
    "fn_list_ops",
    "select p_partkey, list_contains(string_split(p_name, ' '), 'red') has_red, "
    "string_split(p_name, ' ')[1] first_word, array_to_string(string_split(p_name, ' '), ', ') joined from part",
)
def fn_list_ops(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "part")
    w = F.split("p_name", " ")
    return p.select(
        "p_partkey", F.array_contains(w, "red").alias("has_red"), F.element_at(w, 1).alias("first_word"),
        F.array_join(w, ", ").alias("joined"),
    )


@query(
    "filt_list_contains",
    "select p_partkey from part where list_contains(string_split(p_name, ' '), 'red')",
)
def filt_list_contains(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "part").where(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey")


@query(
    "proj_list_join",
    "select p_partkey, array_to_string(string_split(p_type, ' '), ', ') type_text from part",
)
def proj_list_join(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "part").select("p_partkey", F.array_join(F.split("p_type", " "), ", ").alias("type_text"))


@query(
    "fn_route_layer",
    "select p_partkey, case when contains(p_name, 'red') then 'dams' when contains(p_name, 'blue') then 'reservoirs' end layer "
    "from part where contains(p_name, 'red') or contains(p_name, 'blue')",
)
def fn_route_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Name contains the layer-1 word, else the layer-2 word, else ignored."""
    p = view(spark, sf, "part")
    layer = F.when(F.col("p_name").contains("red"), F.lit("dams")).when(F.col("p_name").contains("blue"), F.lit("reservoirs"))
    return p.select("p_partkey", layer.alias("layer")).where(F.col("layer").isNotNull())


@query(
    "fn_json_io",
    "select event_id, cast(json_extract(props, '$.k') as bigint) k, "
    "concat('{\"event_id\":', cast(event_id as varchar), ',\"k\":', cast(json_extract(props, '$.k') as varchar), '}') doc from events",
)
def fn_json_io(spark: SparkSession, sf: str) -> DataFrame:
    e = view(spark, sf, "events")
    parsed = F.from_json("props", "k long")
    return e.select("event_id", parsed.k.alias("k"), F.to_json(F.struct("event_id", parsed.k.alias("k"))).alias("doc"))


@query(
    "fn_tile_key",
    """
select area_id, concat(case when la >= 0 then 'N' else 'S' end, lpad(cast(abs(la) as varchar), 2, '0'),
  case when lo >= 0 then 'E' else 'W' end, lpad(cast(abs(lo) as varchar), 3, '0')) tile
from (select area_id, cast(y0 / 1000000 as int) la, cast(x0 / 1000000 as int) lo from fx_areas) t
""",
)
def fn_tile_key(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "fx_areas").select(
        "area_id", (F.col("y0") / 1000000).cast("int").alias("la"), (F.col("x0") / 1000000).cast("int").alias("lo")
    )
    return a.select("area_id", N.tile_key("la", "lo").alias("tile"))


@query(
    "fn_url_template",
    """
select iso, res, concat('https://data.worldpop.invalid/', upper(iso), '/', lower(iso), '_ppp_2020_', res, '.tif') url
from (select iso, unnest(['100m', '1km']) res from fx_areas) t
""",
)
def fn_url_template(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "fx_areas").select("iso", F.explode(F.array(F.lit("100m"), F.lit("1km"))).alias("res"))
    return a.select(
        "iso", "res",
        F.concat(F.lit("https://data.worldpop.invalid/"), F.upper("iso"), F.lit("/"), F.lower("iso"), F.lit("_ppp_2020_"),
                 F.coalesce("res", F.lit("100m")), F.lit(".tif")).alias("url"),
    )
