"""Rules on links, times and columns do their whole job, on rows built here."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E

TABLES = {
    "pages": ("page_id long, url string, html string", [(1, "https://a.org/x", '<a href="/d/one.zip">1</a> <a href="/about">2</a>'), (2, "https://a.org/y", '<a href="https://b.org/two.csv">3</a>'), (3, None, None)]),
    "events": ("event_id long, ts timestamp, user_id long, event_type string, value double, props string", [(i, dt.datetime(2024, 1, 2, 3, 4, 5 + i), i % 2, t, 1.5, "{}") for i, t in enumerate(["view", "click", "view", "click", "signup"])]),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("rules")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return str(d)


def both(spark, d, name):
    """Rows of the query and of its SQL, by column name."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet/*.parquet')")
    df = E.queries()[name](spark, d)
    told = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in told.description]
    want = [tuple(r) for r in told.fetchall()]
    return [tuple(r) for r in df.select(*cols).collect()], want, cols


def test_suffix_filter_reads_links_of_pages_and_paths_of_files(spark, tables):
    got, want, cols = both(spark, tables, "filt_resource_suffix")
    assert cols == ["kind", "id", "href"] and sorted(got) == sorted(want)
    assert {r for r in got if r[0] == "page"} == {("page", 1, "/d/one.zip"), ("page", 2, "https://b.org/two.csv")}
    assert {r[1] for r in got if r[0] == "file"} == {0, 2, 4}


def test_now_tells_the_time_of_every_row_and_of_the_run(spark, tables):
    got, want, cols = both(spark, tables, "fn_now")
    assert sorted(got) == sorted(want) and len(got) == 5
    assert dict(zip(cols, sorted(got)[0])) == {"event_id": 0, "date_processed": "2024-01-02 03:04:05", "formed": True, "recent": True}


def test_missing_columns_of_every_schema_and_of_the_layer(spark, tables):
    got, want, cols = both(spark, tables, "proj_fill_missing")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    rows = [dict(zip(cols, r)) for r in got]
    present = {(r["grp"], r["wanted"]): r["present"] for r in rows if r["wanted"]}
    assert len(present) == 8 and {k for k, v in present.items() if v} == {(0, "attribute_view_0"), (1, "attribute_click_1")}
    layer = [r for r in rows if not r["wanted"]]
    assert len(layer) == 5 and all(r["surface"] is None and r["oneway"] is None for r in layer)


def test_collections_hold_many_zones_each(spark, tmp_path):
    spark.createDataFrame([(k, f"s{k}", k % 25) for k in range(40)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "p")], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    files = E.queries()["scan_geojson"](spark, str(tmp_path)).inputFiles()
    assert len(files) == 1
