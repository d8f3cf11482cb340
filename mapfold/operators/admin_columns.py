"""Finding the name, type and code columns of boundary files by their names.

A file's columns are rows (file_id, adm_level, pos, col).  Rules are data: a kind
of column, a priority and a pattern ('#' stands for the level); each column row is
put to all rules at once and an aggregate keeps the best hit per file and kind, so
the work is one pass over the names whatever the number of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns by kind in the order of priority; case does not count, the name must begin with the pattern.
PATTERNS = {
    "name": ["ADM#_[A-Z]{2}", "NAME_#_[A-Z]{2}", "NAME_#", "VARNAME_#", "NL_NAME_#", "adm#_name", "admin#Name", "NAMA#"],
    "type": ["ADM#_TYPE", "TYPE_#", "ENGTYPE_#", "Type#"],
    "pcode": ["ADM#_PCODE", "ADM#_CODE", "P_CODE", "PCODE", "CODE", "admin#Pcod", "SHN#"],
}
# Exact names by kind in the order of priority; as written first, else all in lower case.
EXACT = {
    "name": ["ADM#_EN", "ADM#_NAME", "ADM#_DESCR", "NAME_#", "NAME_EN", "NAME", "ADMIN_NAME"],
    "pcode": ["ADM#_PCODE", "ADM#_CODE", "P_CODE", "PCODE", "CODE"],
}


def _rules(table: dict[str, list[str]]) -> Column:
    """All rules with the row's level put in: array of (kind, priority, rule)."""
    level = F.col("adm_level").cast("string")
    return F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("priority"), F.replace(F.lit(rule), F.lit("#"), level).alias("rule")) for kind, rules in table.items() for i, rule in enumerate(rules)])


def by_pattern(columns: DataFrame, table: dict[str, list[str]] = PATTERNS) -> DataFrame:
    """(file_id, name_col, type_col, pcode_col): first hit by priority, then by place; null where none fits."""
    hits = columns.select("file_id", "pos", "col", F.explode(_rules(table)).alias("r")).where(F.regexp_like("col", F.concat(F.lit("(?i)^"), F.col("r.rule"))))
    best = {k: F.min_by(F.when(F.col("r.kind") == k, F.col("col")), F.when(F.col("r.kind") == k, F.struct("r.priority", "pos"))).alias(f"{k}_col") for k in table}
    return columns.select("file_id").distinct().join(hits.groupBy("file_id").agg(*best.values()), "file_id", "left")


def exact(columns: DataFrame, table: dict[str, list[str]] = EXACT) -> DataFrame:
    """(file_id, name_cols, pcode_col): every name hit in the order of the candidates, the
    first code hit; candidates in lower case only where none fits as written."""
    rows = columns.select("file_id", "col", F.explode(_rules(table)).alias("r"))
    rows = rows.where((F.col("col") == F.col("r.rule")) | (F.col("col") == F.lower("r.rule")))
    lower = (F.col("col") != F.col("r.rule")).cast("int")
    hits = rows.select("file_id", F.col("r.kind").alias("kind"), F.struct(lower.alias("lower"), F.col("r.priority").alias("priority"), "col").alias("hit"))
    per = hits.groupBy("file_id").agg(*[F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("hit")))).alias(k) for k in table])
    # hits are sorted, so the first tells whether there is one as written
    names = F.transform(F.filter("name", lambda h: h["lower"] == F.get("name", F.lit(0))["lower"]), lambda h: h["col"])
    found = per.select("file_id", names.alias("name_cols"), F.get("pcode", F.lit(0))["col"].alias("pcode_col"))
    return columns.select("file_id").distinct().join(found, "file_id", "left").withColumn("name_cols", F.coalesce("name_cols", F.array().cast("array<string>")))


def attribute_maps(attrs: DataFrame, *keys: str) -> DataFrame:
    """(keys.., attrs) of long rows (keys.., col, val): one map per unit, null values kept."""
    entry = F.struct(F.col("col").alias("key"), F.col("val").alias("value"))
    return attrs.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("attrs"))


def value(name: Column) -> Column:
    """The attribute of that name; null if the name is null or unknown."""
    return F.when(name.isNotNull(), F.try_element_at("attrs", name))


def has(name: Column) -> Column:
    return F.coalesce(F.map_contains_key("attrs", name), F.lit(False))


def units_by_pattern(units: DataFrame, columns: DataFrame) -> DataFrame:
    """Units (file_id, adm_level, attrs, ..) with name, pcode and admin_type ('' without a
    column); files without a name or code column and units without a code are left out."""
    found = by_pattern(columns).where(F.col("name_col").isNotNull() & F.col("pcode_col").isNotNull())
    rows = units.join(found, "file_id")
    rows = rows.withColumns({"name": value(F.col("name_col")), "pcode": value(F.col("pcode_col")), "admin_type": F.when(F.col("type_col").isNull(), F.lit("")).otherwise(value(F.col("type_col")))})
    return rows.where(F.col("pcode").isNotNull())


def units_by_name(units: DataFrame, columns: DataFrame) -> DataFrame:
    """Units (file_id, adm_level, folder, iso2, attrs, ..) with pcode, names (a list of one lower-case
    name or none), admin_type and country_name.

    The name comes from the English column, else the country's own, else the first
    candidate; the type from the type column as written or in lower case, else '';
    the country from its English column, else the folder's name.
    """
    rows = units.join(exact(columns).where(F.col("pcode_col").isNotNull()), "file_id")
    level = F.col("adm_level").cast("string")
    english, own = F.concat(F.lit("ADM"), level, F.lit("_EN")), F.concat(F.lit("ADM"), level, F.lit("_"), F.upper("iso2"))
    chosen = F.when(F.array_contains("name_cols", english), english).when(F.array_contains("name_cols", own), own).otherwise(F.get("name_cols", F.lit(0)))
    kind = F.concat(F.lit("ADM"), level, F.lit("_TYPE"))
    text = value(chosen)
    rows = rows.withColumns({
        "pcode": value(F.col("pcode_col")),
        "names": F.when(F.coalesce(text, F.lit("")) != "", F.array(F.lower(text))).otherwise(F.array().cast("array<string>")),
        "admin_type": F.when(has(kind), value(kind)).when(has(F.lower(kind)), value(F.lower(kind))).otherwise(F.lit("")),
        "country_name": F.when(has(F.lit("ADM0_EN")), value(F.lit("ADM0_EN"))).when(has(F.lit("adm0_en")), value(F.lit("adm0_en"))).otherwise(F.col("folder")),
    })
    return rows.where(F.col("pcode").isNotNull())
