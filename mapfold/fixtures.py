"""Derived test views over the driver's TPC-H-ish tables.

Each view is plain SQL that Spark and DuckDB both run unchanged (integer
arithmetic only).  In Spark they are registered as temp views over the parquet
tables of one scale-factor folder; in oracle SQL they are inlined as CTEs.
Coordinates are bigint micro-degrees (1e-6 degree).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed view definitions (ours, see FIXTURES.md).
FX: dict[str, str] = {
    "fx_points": (
        "select c_custkey pid, n_nationkey nat, upper(n_name) country, "
        "cast((c_custkey*7919)%36000 as bigint)*10000-180000000 x, "
        "cast((c_custkey*104729)%18000 as bigint)*10000-90000000 y "
        "from customer join nation on c_nationkey=n_nationkey"
    ),
    "fx_areas": (
        "select n_nationkey area_id, lower(n_name) iso, n_name name_en, n_regionkey region, "
        "cast(n_nationkey%5 as bigint)*72000000-180000000 x0, "
        "cast(floor(n_nationkey/5) as bigint)*36000000-90000000 y0 from nation"
    ),
    "fx_segments": (
        "select area_id, s.seq, x0+s.a*1000000 x1, y0+s.b*1000000 y1, x0+s.c*1000000 x2, "
        "y0+s.d*1000000 y2 from fx_areas cross join (values (0,0,0,72,0),(1,72,0,72,36),"
        "(2,72,36,36,12),(3,36,12,0,36),(4,0,36,0,0)) s(seq,a,b,c,d)"
    ),
    "fx_lines": (
        "select o_orderkey line_id, cast((o_orderkey*7919)%34000 as bigint)*10000-180000000 x1, "
        "cast((o_orderkey*104729)%17000 as bigint)*10000-90000000 y1, "
        "cast((o_orderkey*7919)%34000 as bigint)*10000-180000000+cast(o_custkey%2000 as bigint)*10000 x2, "
        "cast((o_orderkey*104729)%17000 as bigint)*10000-90000000+cast(o_orderkey%1000 as bigint)*10000 y2 "
        "from orders"
    ),
    "fx_osm": (
        "select cast(case event_id%4 when 0 then floor(event_id/4) when 3 then floor(event_id/4) else floor(event_id/4)*2+event_id%4-1 end as bigint) osm_id, "
        "case event_id%4 when 0 then 'node' when 3 then 'relation' else 'way' end el_type, "
        "case event_id%4 when 0 then 'Point' when 1 then 'LineString' when 2 then 'Polygon' else 'MultiPolygon' end kind, "
        "case when event_id%37=1 then 'university' when event_id%37=2 then 'ferry_terminal' "
        "when event_type='view' then 'school' when event_type='click' then 'bank' when event_type='error' then 'hospital' "
        "when event_type='signup' then 'atm' end amenity, case when event_id%7=0 then 'yes' end atm, "
        "case event_id%5 when 0 then 'river' when 1 then 'canal' when 2 then 'dam' end waterway, "
        "case event_id%11 when 1 then 'primary' when 3 then 'residential' when 6 then 'trunk' end highway, "
        "case event_id%13 when 1 then 'rail' when 2 then 'station' when 5 then 'miniature' when 7 then 'halt' end railway, "
        "case event_id%17 when 1 then 'city' when 2 then 'town' when 4 then 'hamlet' end place, "
        "case when event_id%34=1 then 'yes' end capital, "
        "case event_id%19 when 1 then 'lake' when 3 then 'reservoir' when 6 then 'river' end water, "
        "case when event_id%23=5 then 'ferry' end route, case when event_id%29=2 then 'harbour' end landuse, "
        "case when event_id%29=4 then 'port' end harbour, case when event_id%31=3 then 'border_control' end border, "
        "case when event_id%3=0 then concat('n',cast(user_id as varchar(20))) end name, "
        "cast((event_id*7919)%36000 as bigint)*10000-180000000 x, "
        "cast((event_id*104729)%18000 as bigint)*10000-90000000 y from events"
    ),
    "fx_pixels": (
        "select cast(floor(o_orderkey/100) as bigint) r, cast(o_orderkey%100 as bigint) c, "
        "cast((o_orderkey*o_orderkey)%997 as bigint) v from orders"
    ),
    "fx_units": (
        "select s_suppkey row_id, cast(s_suppkey%4 as int) adm_level, s_nationkey area_id, "
        "concat('P',cast(s_suppkey%60 as varchar(20))) pcode, s_name name, "
        "case when s_suppkey%5=0 then '' else 'district' end admin_type, s_suppkey file_order from supplier"
    ),
    "fx_boundary_rows": (
        "select l_orderkey*10+l_linenumber row_id, case cast(l_partkey%8 as int) when 0 then 0 when 1 then 1 "
        "when 2 then 2 when 3 then 3 when 4 then 4 when 5 then 86 when 6 then 87 else 99 end adm_level, "
        "cast(l_suppkey%2 as int) admbndp, cast(l_suppkey%25 as int) area_id from lineitem"
    ),
    "fx_ledger": (
        "select event_id, concat('c',cast(user_id%25 as varchar(20))) iso, event_type level, "
        "concat('c',cast(user_id%25 as varchar(20)),'_',event_type,'_ad',cast(event_id%5 as varchar(20)),"
        "'_py_s1_src_pp_layer.shp') filepath, ts processed_at from events"
    ),
    "fx_datasets": (
        "select p_partkey dataset_rank, p_name title, p_brand organization, p_type tag, "
        "cast(p_partkey*86400+1600000000 as varchar(20)) metadata_modified, "
        "case when p_size%2=0 then 'CSV' else 'SHP' end format from part"
    ),
    # ours: polygons around the points, four shapes (box with a hole, triangle, two triangles, arrow);
    # one in 13 stands on an area's corner and shares its edges; interior left of every edge
    "fx_shapes": (
        "select * from (values (0,0,0,0,0,0,10,0),(0,0,0,1,10,0,10,10),(0,0,0,2,10,10,0,10),(0,0,0,3,0,10,0,0),"
        "(0,0,1,4,4,4,4,6),(0,0,1,5,4,6,6,6),(0,0,1,6,6,6,6,4),(0,0,1,7,6,4,4,4),"
        "(1,0,0,0,0,0,10,2),(1,0,0,1,10,2,3,10),(1,0,0,2,3,10,0,0),"
        "(2,0,0,0,0,0,5,1),(2,0,0,1,5,1,1,6),(2,0,0,2,1,6,0,0),(2,1,0,3,6,5,10,6),(2,1,0,4,10,6,7,10),(2,1,0,5,7,10,6,5),"
        "(3,0,0,0,0,0,10,1),(3,0,0,1,10,1,9,9),(3,0,0,2,9,9,5,4),(3,0,0,3,5,4,1,10),(3,0,0,4,1,10,0,0)) s(kind,part,ring,eid,a,b,c,d)"
    ),
    "fx_polys": (
        "select p.poly_id, p.nat, s.part, s.ring, s.eid, p.x+s.a*p.w x1, p.y+s.b*p.h y1, p.x+s.c*p.w x2, p.y+s.d*p.h y2 from ("
        "select pid poly_id, nat, cast(pid%4 as int) kind, "
        "case when pid%13=0 then cast(pid%5 as bigint)*72000000-180000000 else x end x, "
        "case when pid%13=0 then cast(pid%5 as bigint)*36000000-90000000 else y end y, "
        "cast(100000+(pid%7)*100000+(pid%11)*1301 as bigint) w, cast(100000+(pid%5)*100000+(pid%9)*1709 as bigint) h from fx_points) p "
        "join fx_shapes s on s.kind=p.kind"
    ),
    # ours: a second, scaled layer of polygons
    "fx_zones": (
        "select z.zone_id, s.part, s.ring, s.eid, z.x+s.a*z.w x1, z.y+s.b*z.h y1, z.x+s.c*z.w x2, z.y+s.d*z.h y2 from ("
        "select s_suppkey zone_id, cast(s_suppkey%4 as int) kind, "
        "cast((s_suppkey*7919)%3400 as bigint)*100000-180000000 x, cast((s_suppkey*104729)%1600 as bigint)*100000-90000000 y, "
        "cast(600000+(s_suppkey%7)*100000+(s_suppkey%11)*1301 as bigint) w, cast(500000+(s_suppkey%5)*100000+(s_suppkey%9)*1709 as bigint) h from supplier) z "
        "join fx_shapes s on s.kind=z.kind"
    ),
    # ours: ways with their nodes; the first node may be a junction of many ways, the last is shared by two
    "fx_ways": (
        "select o_orderkey way_id, case substr(o_orderpriority,1,1) when '1' then 'primary' when '2' then 'secondary' when '3' then 'residential' "
        "when '4' then 'service' else 'footway' end highway, case when o_orderkey%3=0 then concat('street ',cast(o_custkey%40 as varchar(20))) end name, "
        "case o_orderkey%5 when 0 then '50' when 1 then '30' end maxspeed, o_orderkey%4=0 oneway from orders"
    ),
    "fx_way_nodes": (
        "select way_id, cast(seq as int) seq, case when seq=1 and way_id%3=0 then cast(way_id%211 as bigint) when seq=1 then 500000000+way_id "
        "when seq=n then 1000000000+cast(floor(way_id/2) as bigint) else 1000000+way_id*10+seq end node_id from ("
        "select l_orderkey way_id, row_number() over (partition by l_orderkey order by l_linenumber) seq, count(*) over (partition by l_orderkey) n "
        "from (select distinct l_orderkey, l_linenumber from lineitem) t) w"
    ),
    "fx_nodes": (
        "select node_id, cast((k*7919)%3600 as bigint)*100000-180000000+(node_id%10)*50000 x, cast((k*104729)%1800 as bigint)*100000-90000000+(node_id%7)*50000 y "
        "from (select distinct node_id, case when node_id<211 then node_id*71 when node_id>=1000000000 then node_id-1000000000 "
        "when node_id>=500000000 then cast(floor((node_id-500000000)/2) as bigint) else cast(floor((node_id-1000000)/20) as bigint) end k from fx_way_nodes) n"
    ),
    # ours: attribute columns of boundary files in six styles; '#' is the level, '@' the two-letter code
    "fx_file_columns": (
        "select f.area_id*10+f.adm_level file_id, f.area_id, f.adm_level, c.pos, "
        "replace(replace(c.name,'#',cast(f.adm_level as varchar(1))),'@',upper(substr(n.n_name,1,2))) col, c.holds "
        "from (select distinct area_id, adm_level from fx_units) f join nation n on n.n_nationkey=f.area_id join (select * from (values "
        "(0,0,'OBJECTID','id'),(0,1,'ADM#_EN','name'),(0,2,'ADM#_PCODE','pcode'),(0,3,'ADM#_TYPE','type'),(0,4,'ADM0_EN','country'),"
        "(1,0,'adm#_@','name'),(1,1,'adm#_pcode','pcode'),(1,2,'type_#','type'),(1,3,'adm#_type','type'),"
        "(2,0,'VARNAME_#','other'),(2,1,'NAME_#','name'),(2,2,'CODE','pcode'),(2,3,'ENGTYPE_#','type'),(2,4,'NAME_#_ES','other'),"
        "(3,0,'Shape_Area','id'),(3,1,'admin#Pcod','pcode'),(3,2,'admin#Name','name'),"
        "(4,0,'NAME','name'),(4,1,'P_CODE','pcode'),(4,2,'ADM#_DESCR','other'),"
        "(5,0,'Nama#','name'),(5,1,'shn#','pcode'),(5,2,'Type#','type')) s(style,pos,name,holds)) c on c.style=cast(n.n_nationkey%6 as int) "
        "where not (c.holds='country' and f.adm_level=0)"
    ),
    "fx_unit_attrs": (
        "select u.row_id, u.file_order, c.file_id, c.area_id, c.adm_level, c.col, case c.holds when 'name' then u.name when 'pcode' then u.pcode when 'type' then u.admin_type "
        "when 'country' then concat('land ',cast(u.area_id as varchar(20))) when 'other' then concat('x',cast(u.row_id as varchar(20))) else cast(u.row_id as varchar(20)) end val "
        "from fx_units u join fx_file_columns c on c.area_id=u.area_id and c.adm_level=u.adm_level"
    ),
    # ours: geometry of the elements that are no points: open lines, polygons (some with a hole), two-part polygons
    "fx_osm_geom": (
        "select o.el_type, o.osm_id, o.kind, s.part, s.ring, s.eid, o.x+s.a*o.w x1, o.y+s.b*o.h y1, o.x+s.c*o.w x2, o.y+s.d*o.h y2 from ("
        "select el_type, osm_id, kind, x, y, cast(20000+(osm_id%7)*30000 as bigint) w, cast(20000+(osm_id%5)*25000 as bigint) h, "
        "case kind when 'LineString' then 1 when 'MultiPolygon' then 2 else case when osm_id%2=0 then 0 else 3 end end shape from fx_osm where kind<>'Point') o "
        "join fx_shapes s on s.kind=o.shape where not (o.kind='LineString' and s.eid=2)"
    ),
    # ours: elements with more tags, and whether a way is closed
    "fx_osm_tagged": (
        "select el_type, osm_id, el_type='way' and osm_id%3<>0 closed, amenity, waterway, highway, place, water, landuse, harbour, name, "
        "case osm_id%23 when 1 then 'coastline' when 2 then 'wood' when 3 then 'water' end natural_tag, case osm_id%31 when 1 then 'yes' when 2 then 'no' end area, "
        "case when osm_id%19=4 then 'yes' end building, case when osm_id%13=5 then 'editor 1' end created_by, case when osm_id%11=6 then 'survey' end source from fx_osm"
    ),
    # ours: level display names per area, derived from nation and region
    "fx_level_names": (
        "select lower(n_name) iso, n_name name, 'country' adm0, "
        "case when n_nationkey%2=0 then lower(r_name) end adm1, "
        "case when n_nationkey%3=0 then 'district' end adm2, "
        "case when n_nationkey%7=0 then 'no cod data' else 'cod' end source "
        "from nation join region on n_regionkey=r_regionkey"
    ),
    # ours: file paths of landed boundary files, derived from events
    "fx_files": (
        "select event_id file_id, concat('/data/in/c', cast(user_id%25 as varchar(20)), '/', "
        "case when event_id%9<5 then concat('c', cast(user_id%25 as varchar(20)), '_adm', cast(event_id%9 as varchar(20)), '_', event_type) "
        "when event_id%9=5 then concat('c', cast(user_id%25 as varchar(20)), '_disputed_', event_type) "
        "when event_id%9=6 then concat('zimstat_coastline_', event_type) "
        "when event_id%9=7 then concat('c', cast(user_id%25 as varchar(20)), '_admALL_admbndl_', event_type) "
        "else concat('notes_', event_type) end, "
        "case when event_id%4=0 then '.zip' when event_id%4=1 then '.shp' when event_id%4=2 then '.csv' else '.geojson' end) path, "
        "cast(floor(value*1000) as bigint) size_bytes, ts modified from events"
    ),
}

_FX_RE = re.compile(r"\bfx_[a-z_]+\b")


def _deps(sql: str) -> list[str]:
    """fx views referenced by ``sql`` (transitively), dependencies first."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out or name not in FX:
            return
        for d in _FX_RE.findall(FX[name]):
            if d != name:
                visit(d)
        out.append(name)

    for n in _FX_RE.findall(sql):
        visit(n)
    return out


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every fx view it uses (oracle side)."""
    names = _deps(sql)
    if not names:
        return sql
    body = sql.strip()
    ctes = ", ".join(f"{n} as ({FX[n]})" for n in names)
    if body[:15].lower() == "with recursive ":
        return f"with recursive {ctes}, {body[15:]}"
    if body[:5].lower() == "with ":
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_REGISTERED: dict[tuple[int, str], str] = {}


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register base tables and the fx views named (plus their dependencies).

    Views already registered for the same session and folder are kept, so
    building a plan does not re-read parquet footers for every operator.
    """
    sid = id(spark)
    if all(_REGISTERED.get((sid, n)) == sf_dir for n in names):
        return
    fx = _deps(" ".join(names))
    needed = set(n for n in names if n in BASE_TABLES)
    for n in fx:
        for t in BASE_TABLES:
            if re.search(rf"\b{t}\b", FX[n]):
                needed.add(t)
    for t in sorted(needed):
        if _REGISTERED.get((sid, t)) != sf_dir:
            base(spark, sf_dir, t).createOrReplaceTempView(t)
            _REGISTERED[(sid, t)] = sf_dir
    for n in fx:
        if _REGISTERED.get((sid, n)) != sf_dir or any(_REGISTERED.get((sid, t)) != sf_dir for t in needed):
            spark.sql(FX[n]).createOrReplaceTempView(n)
            _REGISTERED[(sid, n)] = sf_dir


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Register ``name`` (fx view or base table) and return it as a DataFrame."""
    register(spark, sf_dir, name)
    return spark.table(name)
