from pyspark.sql import functions as F

from mapfold.functions import names as N
from mapfold.operators.schema import short_names_number_all, short_names_table


def keep_first(spark, cols):
    df = spark.createDataFrame([(0, i, c) for i, c in enumerate(cols)], "grp int, pos int, name string")
    return [r.short for r in short_names_table(df, "keep_first").orderBy("pos").collect()]


def test_keep_first_clashes_after_ten_chars(spark):
    cols = ["operator_type", "operator_typ", "operator_ty", "name"]
    assert keep_first(spark, cols) == ["operator_t", "operator_1", "operator_2", "name"]


def test_keep_first_passes_over_taken_names(spark):
    cols = ["operator_1", "operator_type", "operator_typ", "operator_2", "operator_2x"]
    assert keep_first(spark, cols) == ["operator_1", "operator_t", "operator_2", "operator_3", "operator_4"]


def test_number_all_suffixes_every_holder():
    cols = ["school:gender", "school:gen", "school_gen", "name"]
    assert short_names_number_all(cols) == ["school:ge1", "school:ge2", "school_gen", "name"]


def test_names_unique_and_short(spark):
    cols = [f"abcdefghijk{i}" for i in range(9)]  # keep-first grows past 10 chars from the 11th clash on
    for out in (keep_first(spark, cols), short_names_number_all(cols)):
        assert len(set(out)) == len(out)
        assert all(len(c) <= 10 for c in out)


def test_short_names_table_matches_driver_rule(spark):
    cols = ["school:gender", "school:gen", "school_gen", "name", "operator_type", "operator_t"]
    df = spark.createDataFrame([(0, i, c) for i, c in enumerate(cols)], "grp int, pos int, name string")
    got = [r.short for r in short_names_table(df, "number_all").orderBy("pos").collect()]
    assert got == short_names_number_all(cols)


def test_string_functions(spark):
    df = spark.createDataFrame(
        [("ANTIGUA-AND-BARBUDA", "Central Statistics Office", "Population 2010-2021 estimate", "a b.shp")],
        "n string, org string, period string, f string",
    )
    r = df.select(
        N.capitalize("n").alias("cap"), N.source_abbr("org").alias("abbr"), N.end_year("period").alias("yr"),
        N.end_year(F.lit("no year here")).alias("none"), N.slug("f").alias("slug"), N.add_suffix("f", "_x").alias("sfx"),
        N.tile_key(F.lit(-5), F.lit(12)).alias("tile"),
    ).first()
    assert r.cap == "Antigua-and-barbuda"
    assert r.abbr == "cso"
    assert r.yr == "2021"
    assert r.none == "Not Found"
    assert r.slug == "a_b_shp"
    assert r.sfx == "a b_x.shp"
    assert r.tile == "S05E012"


def test_end_year_last_digits_after_dash(spark):
    df = spark.createDataFrame([("Time Period: January 2015-December 2020",)], "t string")
    assert df.select(N.end_year("t")).first()[0] == "2020"
