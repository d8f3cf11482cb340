"""Goldens of list ranking, road contraction, column discovery, tag rules and GeoJSON geometry."""

import random

from pyspark.sql import functions as F

from mapfold.operators import admin_columns as AC
from mapfold.operators import geojson as GJ
from mapfold.operators import linework as L
from mapfold.operators import osm as O
from mapfold.operators import roads
from mapfold.sources import readers as R


def test_ranking_of_long_lines_and_rings(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10**6), 900)
    line, ring, alone = ids[:500], ids[500:898], ids[898:]
    links = [*zip(line, line[1:]), (line[-1], None), *zip(ring, ring[1:] + ring[:1]), (alone[0], None), (alone[1], alone[1])]
    got = {r.no: r for r in L.ranked(spark.createDataFrame(links, "no long, nxt long")).collect()}
    assert [(got[i].first, got[i].seq, got[i].size, got[i].closed) for i in line] == [(line[0], k, 500, False) for k in range(500)]
    at = ring.index(min(ring))
    assert [(got[i].first, got[i].seq, got[i].closed) for i in ring[at:] + ring[:at]] == [(min(ring), k, True) for k in range(398)]
    assert (got[alone[0]].size, got[alone[0]].closed, got[alone[1]].seq, got[alone[1]].closed) == (1, False, 0, True)


STEPS = "area long, way_id long, seq int, node_id long, oneway boolean, highway string, name string"


def network(spark, *ways):
    rows = [(1, w, k, n, one, hw, name) for w, (nodes, one, hw, name) in enumerate(ways) for k, n in enumerate(nodes) if n is not None]
    out = roads.road_edges(spark.createDataFrame(rows, STEPS), ["area"], ["highway", "name"]).collect()
    return {(r.u, r.v): (r.n_segments, list(r.way_ids), list(r.highway), list(r.name), list(r.nodes)) for r in out}


def test_ways_are_cut_at_junctions_and_joined_between_them(spark):
    got = network(spark, ([1, 2, 3, 4], False, "primary", "a"), ([4, 5, 6], False, "service", None), ([9, 3], False, "primary", "b"))
    assert got[(1, 3)] == (2, [0], ["primary"], ["a"], [1, 2, 3])
    # 4 only passes on from one way to the other
    assert got[(3, 6)] == (3, [0, 1], ["primary", "service"], ["a"], [3, 4, 5, 6])
    assert set(got) == {(1, 3), (3, 1), (3, 6), (6, 3), (3, 9), (9, 3)}


def test_one_way_streets_have_one_direction_and_end_where_traffic_changes(spark):
    got = network(spark, ([1, 2, 3], True, "primary", "a"), ([3, 4], False, "primary", "a"))
    assert got == {(1, 3): (2, [0], ["primary"], ["a"], [1, 2, 3]), (3, 4): (1, [1], ["primary"], ["a"], [3, 4]), (4, 3): (1, [1], ["primary"], ["a"], [4, 3])}


def test_missing_nodes_break_a_way_and_a_hub_is_a_junction(spark):
    got = network(spark, ([1, None, 3, 4], False, "road", "x"))
    assert set(got) == {(3, 4), (4, 3)}
    hub = network(spark, *[([0, k, 100 + k], False, "road", "h") for k in range(1, 60)])
    assert set(hub) == {(0, 100 + k) for k in range(1, 60)} | {(100 + k, 0) for k in range(1, 60)}


def test_stretches_of_ways_are_not_ordered_step_by_step(spark, monkeypatch):
    ranked, seen = roads.ranked, []
    monkeypatch.setattr(roads, "ranked", lambda links: seen.append(links.count()) or ranked(links))
    got = network(spark, (list(range(300)), False, "primary", "a"), ([0, 500, 501], False, "primary", "a"), ([0, 600], True, "road", "b"), ([299, 700], False, "road", "c"))
    assert got[(700, 0)] == (300, [0, 3], ["primary", "road"], ["a", "c"], [700, *range(299, -1, -1)])
    # of 303 two-way steps only two stretches go on into another way, in both directions
    assert seen == [4]


def edges_by_walking(ways):
    """The edges of whole ways (nodes, oneway), segment by segment: (ways, nodes) of each."""
    segs = []
    for w, (nodes, one) in enumerate(ways):
        there = [(u, v, w, k) for k, (u, v) in enumerate(zip(nodes, nodes[1:])) if None not in (u, v) and u != v]
        segs += there + [(v, u, w, k) for u, v, w, k in there if not one]
    met, into, out = {}, {}, {}
    for u, v, *_ in segs:
        met.setdefault(u, {}).setdefault(v, [0, 0])[0] += 1
        met.setdefault(v, {}).setdefault(u, [0, 0])[1] += 1
    through = {n for n, o in met.items() if len(o) == 2 and max(map(max, o.values())) == 1 and sum(a - b for a, b in o.values()) == 0}
    nxt = {s: t for s in segs for t in segs if s[1] == t[0] and s[1] in through and s[0] != t[1]}
    heads, seen, made = set(segs) - set(nxt.values()), set(), []
    for s in [*sorted(heads), *sorted(segs)]:
        line = []
        while s is not None and s not in seen:
            seen.add(s)
            line.append(s)
            s = nxt.get(s)
        if line:
            made.append((sorted({x[2] for x in line}), [line[0][0], *(x[1] for x in line)]))
    return sorted(made)


def test_networks_of_chance_have_the_edges_found_by_walking(spark):
    rng, rows, want = random.Random(11), [], []
    fixed = [
        [([2, 3, 4, 2], False)], [([7, 5, 6, 7], True)], [([1, 2, 3], False), ([3, 4], True), ([4, 5, 1], False)],
        [([8, 9, 5], True), ([5, 1, 8], True)], [([1, 2, 1], True), ([2, 9], False)], [([1, 2], False), ([2, 3], True), ([3, 2], True)], [([4, 4, 5, None, 6, 7, 8], False), ([8, 6], True)],
    ]
    drawn = [[([rng.randrange(n) for _ in range(rng.randint(2, 6))], rng.random() < 0.4) for _ in range(rng.randint(1, 5))] for n in (4, 6, 9, 14, 25) for _ in range(30)]
    for area, ways in enumerate(fixed + drawn):
        rows += [(area, w, k, n, one, "road", None, -n) for w, (nodes, one) in enumerate(ways) for k, n in enumerate(nodes) if n is not None]
        want += [(area, w, nodes) for w, nodes in edges_by_walking(ways)]
    out = roads.road_edges(spark.createDataFrame(rows, STEPS + ", x long"), ["area"], ["highway", "name"], ["x"]).collect()
    assert sorted((r.area, list(r.way_ids), list(r.nodes)) for r in out) == sorted(want)
    assert all([-n for n in r.nodes] == list(r.x) and (r.u, r.v, r.n_segments, list(r.name)) == (r.nodes[0], r.nodes[-1], len(r.nodes) - 1, []) for r in out)


def test_edges_carry_the_columns_of_their_nodes_without_a_second_join(spark):
    rows = [(1, w, k, n, False, "road", None, 10 * n, -n) for w, nodes in enumerate(([1, 2, 3], [1, 2, 3], [3, 4, 5])) for k, n in enumerate(nodes)]
    out = roads.road_edges(spark.createDataFrame(rows, STEPS + ", x long, y long"), ["area"], ["highway"], ["x", "y"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 0
    got = sorted((list(r.way_ids), list(zip(r.x, r.y))) for r in out.collect())
    # two ways between the same nodes keep a line each
    assert got == sorted(([w], p[::d]) for w, p in [(w, [(a, -a // 10), (a + 10, -a // 10 - 1)]) for w in (0, 1) for a in (10, 20)] + [(2, [(30, -3), (40, -4), (50, -5)])] for d in (1, -1))


def columns(spark, *files):
    rows = [(f, level, pos, c) for f, (level, names) in enumerate(files) for pos, c in enumerate(names)]
    return spark.createDataFrame(rows, "file_id long, adm_level int, pos int, col string")


def test_columns_by_pattern(spark):
    got = {r.file_id: tuple(r)[1:] for r in AC.by_pattern(columns(
        spark, (1, ["adm1_pcode", "Adm1_fr", "ADM1_TYPE"]), (2, ["NAME_2", "name_2_es", "CODE_X", "Type2"]), (1, ["OBJECTID", "xADM1_EN"]), (0, ["ADMIN0NAME", "admin0Pcod"]), (2, ["ADM1_EN", "VARNAME_2", "SHN2"]),
    )).collect()}
    # "adm1_pc" fits ADM1_xx too and stands first; a level's rules do not take another's columns
    assert got == {0: ("adm1_pcode", "ADM1_TYPE", "adm1_pcode"), 1: ("name_2_es", "Type2", "CODE_X"), 2: (None, None, None), 3: ("ADMIN0NAME", None, "admin0Pcod"), 4: ("VARNAME_2", None, "SHN2")}


def test_columns_by_exact_name(spark):
    got = {r.file_id: (list(r.name_cols), r.pcode_col) for r in AC.exact(columns(
        spark, (1, ["NAME", "ADM1_EN", "adm1_name", "PCODE", "ADM1_CODE"]), (1, ["name_en", "adm1_en", "code"]), (2, ["ADM1_EN", "x"]), (0, ["name", "NAME_EN", "p_code", "CODE"]),
    )).collect()}
    assert got == {0: (["ADM1_EN", "NAME"], "ADM1_CODE"), 1: (["adm1_en", "name_en"], "code"), 2: ([], None), 3: (["NAME_EN"], "CODE")}


def test_unit_names_types_and_countries_fall_back(spark):
    files = columns(spark, (1, ["ADM1_EN", "ADM1_PCODE", "ADM1_TYPE", "ADM0_EN"]), (1, ["NAME_1", "PCODE", "adm1_type", "adm0_en"]), (1, ["NAME", "x"]), (2, ["p_code"]))
    rows = [
        (0, 1, "ZWE", "ZW", {"ADM1_EN": "Ha Rare", "ADM1_PCODE": "A", "ADM1_TYPE": "city", "ADM0_EN": "Zim"}), (0, 1, "ZWE", "ZW", {"ADM1_EN": None, "ADM1_PCODE": "B", "ADM1_TYPE": None, "ADM0_EN": None}),
        (0, 1, "ZWE", "ZW", {"ADM1_EN": "no code", "ADM1_PCODE": None, "ADM1_TYPE": "", "ADM0_EN": ""}), (1, 1, "FJI", "FJ", {"NAME_1": "Ba", "PCODE": "C", "adm1_type": "t", "adm0_en": "Fiji"}),
        (2, 1, "X", "X", {"NAME": "n", "x": "y"}), (3, 2, "TON", None, {"p_code": "D"}),
    ]
    units = spark.createDataFrame(rows, "file_id long, adm_level int, folder string, iso2 string, attrs map<string,string>")
    got = {r.pcode: (list(r.names), r.admin_type, r.country_name) for r in AC.units_by_name(units, files).collect()}
    assert got == {"A": (["ha rare"], "city", "Zim"), "B": ([], None, None), "C": (["ba"], "t", "Fiji"), "D": ([], "", "TON")}


def test_tag_rules(spark):
    rows = [
        ("way", True, {"natural": "coastline"}), ("way", True, {"natural": "wood"}), ("way", True, {"waterway": "river"}), ("way", True, {"waterway": "riverbank"}),
        ("way", False, {"building": "yes"}), ("way", True, {"building": "yes"}), ("node", False, {"amenity": "bank"}), ("relation", False, {}), ("way", True, {"highway": "service", "source": "x", "created_by": "y"}),
    ]
    df = spark.createDataFrame(rows, "el_type string, closed boolean, tags map<string,string>")
    got = df.select(O.element_geometry(F.col("el_type"), F.col("closed"), F.col("tags")).alias("g"), F.map_keys(O.without_tags(F.col("tags"))).alias("k")).collect()
    assert [r.g for r in got] == ["line", "polygon", "line", "polygon", "line", "polygon", "point", "relation", "line"]
    assert got[8].k == ["highway"] and len(O.AREA_TAGS) == 21


def test_geojson_of_every_type_is_parsed_and_polygons_round_trip(spark, tmp_path):
    (tmp_path / "a.json").write_text("""{"type": "FeatureCollection",
     "features": [
      {"type": "Feature", "properties": {"id": "p"}, "geometry": {"type": "Point", "coordinates": [1.5, -2]}},
      {"type": "Feature", "properties": {"id": "l"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1, 9],
         [2, 0]]}},
      {"type": "Feature", "properties": {"id": "ml"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[5, 5], [6, 6]]]}},
      {"type": "Feature", "properties": {"id": "h"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [9, 0], [9, 9], [0, 0]], [[2, 1], [3, 1.0000005], [3, 2], [2, 1]]]}},
      {"type": "Feature", "properties": {"id": "mp"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [-1, 0], [0, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
      {"type": "Feature", "properties": {"id": "bad"}, "geometry": {"type": "Polygon", "coordinates": "nothing"}},
      {"type": "Feature", "properties": {"id": "none"}, "geometry": null}
     ]}""")
    f = R.read_geojson(spark, str(tmp_path), multiline=True).select(F.try_element_at("properties", F.lit("id")).alias("id"), "geom_type", "coordinates")
    rows = GJ.edges(f, "id").orderBy("id", "eid").collect()
    per = {}
    for r in rows:
        per.setdefault(r.id, []).append((r.part, r.ring, r.x1, r.y1, r.x2, r.y2))
    M = 10**6
    assert per["p"] == [(0, 0, 1500000, -2 * M, 1500000, -2 * M)]
    assert per["l"] == [(0, 0, 0, 0, M, M), (0, 0, M, M, 2 * M, 0)]
    assert [x[0] for x in per["ml"]] == [0, 1] and [x[:2] for x in per["h"]] == [(0, 0)] * 3 + [(0, 1)] * 3 and [x[0] for x in per["mp"]] == [0] * 3 + [1] * 3
    assert set(per) == {"p", "l", "ml", "h", "mp"}
    back = GJ.polygon_texts(GJ.edges(f.where("geom_type like '%Polygon'"), "id"), "id").collect()
    assert {r.id: r.kind for r in back} == {"h": "Polygon", "mp": "MultiPolygon"}
    again = GJ.edges(spark.createDataFrame([(r.id, r.kind, r.coordinates) for r in back], "id string, geom_type string, coordinates string"), "id").orderBy("id", "eid").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in rows if r.id in ("h", "mp")]
