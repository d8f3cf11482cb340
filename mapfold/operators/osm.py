"""OSM layer extraction: one parametrised operator plus a table of layer specs.

Elements are rows ``(osm_id, el_type, kind, tags map<string,string>, x, y)``, the
place of points in micro-degrees, and edges ``(el_type, osm_id, kind, part, ring,
eid, x1, y1, x2, y2)`` of lines and polygons.  A layer is: tag filter (OR across
keys) -> geometry-kind filter -> spatial join with every area at once -> geometry
or its centroid -> class column -> wanted attributes -> short names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapfold.operators.overlay import centroids, ring_lines
from mapfold.operators.schema import short_names_number_all
from mapfold.operators.spatial_join import lines_intersect_areas, points_in_areas

POINT_KINDS = ("Point",)
LINE_KINDS = ("LineString", "MultiLineString")
POLY_KINDS = ("Polygon", "MultiPolygon")

# Point-of-interest classes (point layer), in source order.
POI_POINT_CLASSES = """
tourist_info hotel restaurant bank school archaeological attraction post_box clothes guesthouse
supermarket toilet garden_centre convenience fast_food clinic gift_shop telephone swimming_pool
bench waste_basket town_hall playground picnic_site fire_station camp_site hostel lighthouse
viewpoint tower alpine_hut bar water_tower shelter comms_tower chalet observation_tower fountain
police motel cafe bakery laundry museum ruins university water_well veterinary artwork memorial
bookshop greengrocer post_office general doityourself community_centre butcher pharmacy park
beverages caravan_site arts_centre computer_shop hairdresser atm stationery mobile_phone_shop
car_dealership beauty_shop shoe_shop jeweller monument bicycle_shop courthouse market_place
travel_agent optician nightclub dentist pitch doctors sports_centre car_rental car_wash florist
embassy pub department_store drinking_water hospital furniture_shop hunting_stand library
food_court kindergarten water_works vending_any water_mill wastewater_plant college
bicycle_rental camera_surveillance outdoor_shop chemist stadium mall
""".split()

# Point-of-interest classes (polygon layer), in source order.
POI_POLYGON_CLASSES = """
archaeological attraction pitch swimming_pool park hotel museum community_centre graveyard
university post_office hospital school college restaurant public_building police town_hall
travel_agent market_place stadium supermarket guesthouse bicycle_rental doityourself
department_store convenience clinic camp_site sports_centre track bar water_tower shelter
picnic_site toilet tower observation_tower car_rental butcher motel doctors furniture_shop
stationery library pharmacy clothes bank gift_shop car_dealership playground bakery beverages
embassy courthouse mobile_phone_shop arts_centre general nightclub cafe tourist_info
bicycle_shop pub hairdresser hostel laundry fast_food dentist beauty_shop computer_shop
shoe_shop florist bookshop optician wastewater_plant car_wash fire_station artwork veterinary
greengrocer toy_shop water_works drinking_water cinema mall garden_centre sports_shop
video_shop jeweller kindergarten chalet monument water_well prison kiosk zoo alpine_hut
comms_tower lighthouse ruins memorial
""".split()

# Drivable highway classes of the road layer.
ROAD_CLASSES = """
motorway trunk primary secondary tertiary unclassified residential motorway_link trunk_link
primary_link secondary_link tertiary_link living_street service track road
""".split()

# Tags that make a closed way an area; "key", "key=value" or "key!=value".
AREA_TAGS = """
aeroway amenity area building harbour historic landuse leisure man_made military natural!=coastline
office place power public_transport shop sport tourism water waterway=riverbank wetland
""".split()
# Tags that are dropped.
DROPPED_TAGS = ["created_by", "source"]

NAME3 = ["name", "name:en", "name_en"]
ELEMENT = ["el_type", "osm_id"]  # nodes, ways and relations number their ids apart


@dataclass(frozen=True)
class LayerSpec:
    layer: str
    tags: dict  # key -> tuple of values, or True for "key present"; OR across keys
    category: str
    tail: str  # layer name after the iso prefix
    attributes: tuple = tuple(NAME3)
    kinds: tuple | None = None  # geometry kinds kept, None = any
    exclude: dict = field(default_factory=dict)  # key -> values removed
    require: dict = field(default_factory=dict)  # key -> values that must also match (AND)
    fclass: str | None = "const"  # const | tag | tag_else | none | settlement | port
    fclass_value: str | None = None  # constant or tag key
    fclass_default: str | None = None
    shaped: bool = False  # keeps the geometry; other layers take its centroid


def _t(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def tag_filter(tags: Column, spec: dict) -> Column:
    """OR across keys: value in list, or key present when the value is True."""
    cond = F.lit(False)
    for k, v in spec.items():
        c = F.map_contains_key(tags, k) if v is True else _t(tags, k).isin(list(v))
        cond = cond | F.coalesce(c, F.lit(False))
    return cond


def matches_rule(tags: Column, rule: str) -> Column:
    """One tag rule: key present, key with that value, or key with another value."""
    if "!=" in rule:
        key, value = rule.split("!=")
        test = _t(tags, key) != value
    elif "=" in rule:
        key, value = rule.split("=")
        test = _t(tags, key) == value
    else:
        test = F.map_contains_key(tags, rule)
    return F.coalesce(test, F.lit(False))


def element_geometry(el_type: Column, closed: Column, tags: Column, rules: list[str] = AREA_TAGS) -> Column:
    """point, line, polygon or relation: closed ways with an area tag are polygons."""
    area = F.lit(False)
    for rule in rules:
        area = area | matches_rule(tags, rule)
    way = F.when(closed & area, F.lit("polygon")).otherwise(F.lit("line"))
    return F.when(el_type == "node", F.lit("point")).when(el_type == "relation", F.lit("relation")).otherwise(way)


def without_tags(tags: Column, dropped: list[str] = DROPPED_TAGS) -> Column:
    return F.map_filter(tags, lambda k, v: ~k.isin(dropped))


def fclass_expr(tags: Column, s: LayerSpec) -> Column | None:
    if s.fclass == "const":
        return F.lit(s.fclass_value)
    if s.fclass == "tag":
        return _t(tags, s.fclass_value)
    if s.fclass == "tag_else":
        return F.coalesce(_t(tags, s.fclass_value), F.lit(s.fclass_default))
    if s.fclass == "settlement":
        return F.when(_t(tags, "capital") == "yes", F.lit("national_capital")).otherwise(_t(tags, "place"))
    if s.fclass == "port":
        return F.coalesce(_t(tags, "landuse"), _t(tags, "harbour"))
    return None


def select_elements(osm: DataFrame, s: LayerSpec) -> DataFrame:
    """Tag, exclusion and geometry-kind filters of one layer (no spatial step)."""
    tags = F.col("tags")
    df = osm.where(tag_filter(tags, s.tags))
    for k, vals in s.require.items():
        df = df.where(F.coalesce(_t(tags, k).isin(list(vals)), F.lit(False)))
    for k, vals in s.exclude.items():
        df = df.where(~F.coalesce(_t(tags, k).isin(list(vals)), F.lit(False)))
    if s.kinds is not None:
        df = df.where(F.col("kind").isin(list(s.kinds)))
    return df


def elements_in_areas(el: DataFrame, edges: DataFrame, segs: DataFrame) -> DataFrame:
    """Distinct (el_type, osm_id, area_id) where an element's geometry meets the closed area.

    Points (x, y of kind Point) by their place, lines and polygons by their edges;
    a polygon also meets an area that lies inside it, which one vertex of the area tells.
    """
    points = points_in_areas(el.where(F.col("kind") == "Point"), segs, ELEMENT, "area_id", "intersects")
    lines = lines_intersect_areas(edges, segs, ELEMENT, "area_id")
    corner = segs.groupBy("area_id").agg(F.min(F.struct("x1", "y1")).alias("v")).select("area_id", F.col("v.x1").alias("x"), F.col("v.y1").alias("y"))
    holding = points_in_areas(corner, edges.where(F.col("kind").isin(*POLY_KINDS)), "area_id", ELEMENT, "intersects")
    return points.unionByName(lines).unionByName(holding).distinct()


def places(el: DataFrame, edges: DataFrame, shaped: bool) -> DataFrame:
    """(el_type, osm_id, lon, lat) centroids, or (el_type, osm_id, geometry): every ring or line as text, in order."""
    if shaped:
        rings = ring_lines(edges, *ELEMENT).groupBy(*ELEMENT).agg(F.array_sort(F.collect_list(F.struct("part", "ring", "line"))).alias("r"))
        lines = rings.select(*ELEMENT, F.array_join("r.line", "; ").alias("geometry"))
        dots = el.where(F.col("kind") == "Point").select(*ELEMENT, F.concat_ws(" ", "x", "y").alias("geometry"))
        return lines.unionByName(dots)
    areal = edges.select(*ELEMENT, F.col("kind").isin(*POLY_KINDS).alias("areal"), "x1", "y1", "x2", "y2")
    dots = el.where(F.col("kind") == "Point").select(*ELEMENT, F.lit(False).alias("areal"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return centroids(areal.unionByName(dots), *ELEMENT).withColumnsRenamed({"cx": "lon", "cy": "lat"})


def osm_layer(osm: DataFrame, edges: DataFrame, segs: DataFrame, areas: DataFrame, s: LayerSpec) -> DataFrame:
    """One layer for every area: (iso, layer_name, el_type, osm_id, [fclass], attributes.., lon, lat or geometry).

    Elements belong to every area that their whole geometry meets; centroids are
    taken after that.
    """
    el = select_elements(osm, s)
    own = edges.join(el.select(*ELEMENT), ELEMENT, "left_semi")
    hits = elements_in_areas(el, own, segs)
    df = hits.join(areas.select("area_id", "iso"), "area_id").join(el.select(*ELEMENT, "tags"), ELEMENT).join(places(el, own, s.shaped), ELEMENT)
    tags = F.col("tags")
    cols = [F.col("iso"), F.concat(F.col("iso"), F.lit("_" + s.tail)).alias("layer_name"), *map(F.col, ELEMENT)]
    fc = fclass_expr(tags, s)
    if fc is not None:
        cols.append(fc.alias("fclass"))
    names = short_names_number_all(list(s.attributes))
    cols += [_t(tags, a).alias(n) for a, n in zip(s.attributes, names)]
    cols += [F.col("geometry")] if s.shaped else [F.col("lon"), F.col("lat")]
    return df.select(*cols)


def filled(layer: DataFrame, wanted: list[str]) -> DataFrame:
    """``layer`` with those of the ``wanted`` columns it lacks, as null text."""
    return layer.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in layer.columns})


def tags_from_columns(df: DataFrame, keys: list[str]) -> Column:
    """Sparse tag columns -> map<string,string> without NULL values."""
    kv = []
    for k in keys:
        kv += [F.lit(k), F.col(k).cast("string")]
    return F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull())


LAYERS: list[LayerSpec] = [
    LayerSpec("osm_railway", {"railway": ("rail", "narrow_gauge", "subway")}, "232_tran",
              "tran_rst_pt_s2_osm_pp_railwayline", attributes=("name", "name_en", "name:en", "gauge"),
              kinds=LINE_KINDS, exclude={"railway": ("miniature",)}, fclass="tag", fclass_value="railway", shaped=True),
    LayerSpec("osm_dam", {"waterway": ("dam",)}, "221_phys", "phys_dam_pt_s2_osm_pp_dam",
              fclass="const", fclass_value="dam"),
    LayerSpec("osm_school", {"amenity": ("school",)}, "210_educ", "educ_edu_pt_s3_osm_pp_schools",
              attributes=("operator", "operator_type", "capacity", "grades", "min_age", "max_age",
                          "school:gender", "name", "name:en", "name_en", "operator_t", "operator:t",
                          "school:gen", "school_gen", "osmid"),
              fclass="const", fclass_value="school"),
    LayerSpec("osm_education", {"amenity": ("university", "college")}, "210_educ",
              "educ_edu_pt_s3_osm_pp_university", fclass="tag", fclass_value="amenity"),
    LayerSpec("osm_ferry_terminal", {"amenity": ("ferry_terminal",)}, "232_tran",
              "tran_fte_pt_s2_osm_pp_ferryterminal", fclass=None),
    LayerSpec("osm_ferry_route", {"route": ("ferry",)}, "232_tran", "tran_fer_ln_s2_osm_pp_ferryroute",
              fclass=None, shaped=True),
    LayerSpec("osm_port", {"landuse": ("harbour",), "harbour": ("port",)}, "232_tran",
              "tran_por_pt_s0_osm_pp_port", fclass="port"),
    LayerSpec("osm_bank", {"amenity": ("bank",)}, "208_cash", "cash_bnk_pt_s0_osm_pp_bank",
              fclass="tag", fclass_value="amenity"),
    LayerSpec("osm_health", {"amenity": ("clinic", "doctors", "hospital", "pharmacy", "health_post")},
              "215_heal", "heal_hea_pt_s3_osm_pp_healthfacilities", fclass="tag_else",
              fclass_value="amenity", fclass_default="health_facility"),
    LayerSpec("osm_hospital", {"amenity": ("hospital",)}, "215_heal", "heal_hea_pt_s3_osm_pp_hospital",
              attributes=("name", "name:en", "name_en", "emergency", "operator", "operator:type", "beds",
                          "operator_type", "operator_ty"),
              fclass="const", fclass_value="hospital"),
    LayerSpec("osm_border_control", {"border": ("border_control",)}, "222_pois",
              "pois_bor_pt_s3_osm_pp_bordercrossing", fclass=None),
    LayerSpec("osm_settlement", {"place": ("city", "borough", "town", "village", "hamlet"), "capital": True},
              "229_stle", "stle_stl_pt_s3_osm_pp_settlements", fclass="settlement"),
    LayerSpec("osm_lake", {"water": ("lake", "reservoir")}, "221_phys", "phys_lak_py_s3_osm_pp_lake",
              kinds=POLY_KINDS, fclass="tag", fclass_value="water", shaped=True),
    LayerSpec("osm_large_river", {"water": ("river",)}, "221_phys", "phys_riv_py_s3_osm_pp_rivers",
              kinds=POLY_KINDS, fclass="tag", fclass_value="water", shaped=True),
    LayerSpec("osm_river", {"waterway": ("river",)}, "221_phys", "phys_riv_ln_s3_osm_pp_rivers",
              kinds=("LineString",), exclude={"waterway": ("stream", "canal", "ditch", "drain")},
              fclass="const", fclass_value="river", shaped=True),
    LayerSpec("osm_canal", {"waterway": ("canal",)}, "232_tran", "phys_can_ln_s3_osm_pp_canal",
              fclass="const", fclass_value="canal", shaped=True),
    LayerSpec("osm_rail_station", {"railway": ("station", "halt")}, "232_tran",
              "tran_rst_pt_s2_osm_pp_railwaystations",
              attributes=("name", "name:en", "name_en", "amenity", "passenger", "cargo"),
              fclass="tag", fclass_value="railway"),
    LayerSpec("osm_poi_point", {"amenity": tuple(POI_POINT_CLASSES)}, "222_pois", "pois_pt_s3_osm_pp_pois",
              attributes=("name",), kinds=None, fclass="tag_else", fclass_value="amenity",
              fclass_default="point_of_interest"),
    LayerSpec("osm_poi_polygon", {"amenity": tuple(POI_POLYGON_CLASSES)}, "222_pois",
              "pois_py_s3_osm_pp_pois", attributes=("name",), kinds=POLY_KINDS, fclass="tag_else",
              fclass_value="amenity", fclass_default="polygon_of_interest", shaped=True),
]

# ATM layer (bank with ATM is an AND of two tags, deduplicated by element)
ATM_PARTS = [
    LayerSpec("osm_atm", {"amenity": ("atm",)}, "208_cash", "cash_atm_pt_s3_osm_pp_atm",
              attributes=("name", "name:en", "name_en", "osmid"), fclass="tag", fclass_value="amenity"),
    LayerSpec("osm_atm", {"amenity": ("bank",)}, "208_cash", "cash_atm_pt_s3_osm_pp_atm",
              attributes=("name", "name:en", "name_en", "osmid"), require={"atm": ("yes",)},
              fclass="tag", fclass_value="amenity"),
]


def osm_atm(osm: DataFrame, edges: DataFrame, segs: DataFrame, areas: DataFrame) -> DataFrame:
    """Cash machines and banks with one: both rules in one filter, so every element is joined and counted once."""
    either = [select_elements(osm, s).select(*ELEMENT) for s in ATM_PARTS]
    wanted = osm.join(either[0].unionByName(either[1]).distinct(), ELEMENT, "left_semi")
    both = replace(ATM_PARTS[0], tags={"amenity": ("atm", "bank")}, require={})
    return osm_layer(wanted, edges, segs, areas, both)
