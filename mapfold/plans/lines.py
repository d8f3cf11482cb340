"""Line queries: intersects (uncut) and overlay / clip (cut to the area)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.functions.geometry import seg_len_deg
from mapfold.operators import polygons as P
from mapfold.operators import spatial_join as sj
from mapfold.operators.cells import EDGE
from mapfold.plans import query
from mapfold.plans.sqlpoly import overlay_ctes
from mapfold.plans.sqlsnip import intersects_having, seg_intersect, within_having


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """fx_lines as one-segment polylines (line_id, seq, x1, y1, x2, y2)."""
    return view(spark, sf, "fx_lines").withColumn("seq", F.lit(0))


_INTERSECTS_SQL = f"""
select distinct line_id, area_id from (
  select l.line_id, s.area_id from fx_lines l, fx_segments s where {seg_intersect('l', 's')}
  union all
  select l.line_id, s.area_id from fx_lines l, fx_segments s
  group by l.line_id, s.area_id, l.x1, l.y1 having {within_having('l', 's', 'x1', 'y1')}
) u
"""


@query("join_intersects", _INTERSECTS_SQL)
def join_intersects(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "fx_lines")
    return sj.lines_intersect_areas(lines, view(spark, sf, "fx_segments"), "line_id", "area_id")


@query(
    "nat_hydro_rivers",
    f"""
select a.iso, l.line_id, l.x1, l.y1, l.x2, l.y2
from ({_INTERSECTS_SQL}) h join fx_areas a on a.area_id = h.area_id join fx_lines l on l.line_id = h.line_id
""",
)
def nat_hydro_rivers(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "fx_lines")
    hits = sj.lines_intersect_areas(lines, view(spark, sf, "fx_segments"), "line_id", "area_id")
    areas = view(spark, sf, "fx_areas").select("area_id", "iso")
    return hits.join(areas, "area_id").join(lines, "line_id").select("iso", "line_id", "x1", "y1", "x2", "y2")


@query(
    "join_intersects_gate",
    f"""
select a.area_id, a.iso from fx_areas a
where exists (select 1 from ({_INTERSECTS_SQL}) h where h.area_id = a.area_id)
""",
)
def join_intersects_gate(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "fx_lines")
    hits = sj.lines_intersect_areas(lines, view(spark, sf, "fx_segments"), "line_id", "area_id")
    return view(spark, sf, "fx_areas").join(hits, "area_id", "left_semi").select("area_id", "iso")


# -- clip --------------------------------------------------------------------

_CLIP_SQL = f"""
with pr as (
  select l.line_id, s.area_id, l.x1 lx1, l.y1 ly1, l.x2 lx2, l.y2 ly2, s.x1, s.y1, s.x2, s.y2,
    (l.x2-l.x1)*(s.y2-s.y1)-(l.y2-l.y1)*(s.x2-s.x1) den,
    (s.x1-l.x1)*(s.y2-s.y1)-(s.y1-l.y1)*(s.x2-s.x1) tn,
    (s.x1-l.x1)*(l.y2-l.y1)-(s.y1-l.y1)*(l.x2-l.x1) un,
    (l.x2-l.x1)*(l.x2-l.x1)+(l.y2-l.y1)*(l.y2-l.y1) dd
  from fx_lines l, fx_segments s),
cuts as (
  select line_id, area_id, case when (den>0 and tn>=0 and tn<=den and un>=0 and un<=den)
    or (den<0 and tn<=0 and tn>=den and un<=0 and un>=den) then cast(tn as double)/cast(den as double) end t from pr
  union all
  select line_id, area_id, case when (lx2-lx1)*(y1-ly1)-(ly2-ly1)*(x1-lx1)=0
    and x1 between least(lx1,lx2) and greatest(lx1,lx2) and y1 between least(ly1,ly2) and greatest(ly1,ly2) and dd>0
    then cast((x1-lx1)*(lx2-lx1)+(y1-ly1)*(ly2-ly1) as double)/cast(dd as double) end from pr
  union all
  select line_id, area_id, case when (lx2-lx1)*(y2-ly1)-(ly2-ly1)*(x2-lx1)=0
    and x2 between least(lx1,lx2) and greatest(lx1,lx2) and y2 between least(ly1,ly2) and greatest(ly1,ly2) and dd>0
    then cast((x2-lx1)*(lx2-lx1)+(y2-ly1)*(ly2-ly1) as double)/cast(dd as double) end from pr),
cand as (
  select distinct line_id, area_id from cuts where t is not null
  union
  select l.line_id, s.area_id from fx_lines l, fx_segments s
  group by l.line_id, s.area_id, l.x1, l.y1
  having sum({'{'}c{'}'}) % 2 = 1 or max({'{'}o{'}'}) = 1
),
ts as (
  select c.line_id, c.area_id, t from cand c join cuts u on u.line_id=c.line_id and u.area_id=c.area_id where t is not null
  union select line_id, area_id, 0.0 from cand
  union select line_id, area_id, 1.0 from cand),
iv as (
  select line_id, area_id, t t0, lead(t) over (partition by line_id, area_id order by t) t1 from ts),
mid as (
  select iv.line_id, iv.area_id, t0, t1,
    l.x1 + ((t0+t1)/2)*(l.x2-l.x1) px, l.y1 + ((t0+t1)/2)*(l.y2-l.y1) py,
    sqrt(cast((l.x2-l.x1)*(l.x2-l.x1)+(l.y2-l.y1)*(l.y2-l.y1) as double))/1000000 len,
    l.x1 lx1, l.y1 ly1, l.x2 lx2, l.y2 ly2
  from iv join fx_lines l on l.line_id = iv.line_id where t1 is not null),
kept as (
  select m.line_id, m.area_id, m.t0, m.t1, m.len, m.lx1, m.ly1, m.lx2, m.ly2
  from mid m join fx_segments s on s.area_id = m.area_id
  group by m.line_id, m.area_id, m.t0, m.t1, m.len, m.lx1, m.ly1, m.lx2, m.ly2
  having sum(case when ((cast(s.y1 as double)>m.py)<>(cast(s.y2 as double)>m.py)) and (case when s.y2>s.y1
      then (m.py-s.y1)*cast(s.x2-s.x1 as double) > (m.px-s.x1)*cast(s.y2-s.y1 as double)
      else (m.py-s.y1)*cast(s.x2-s.x1 as double) < (m.px-s.x1)*cast(s.y2-s.y1 as double) end) then 1 else 0 end) % 2 = 1
    or max(case when abs(cast(s.x2-s.x1 as double)*(m.py-s.y1)-cast(s.y2-s.y1 as double)*(m.px-s.x1))
        / greatest(sqrt(cast((s.x2-s.x1)*(s.x2-s.x1)+(s.y2-s.y1)*(s.y2-s.y1) as double)), 1.0) <= 1.0
      and m.px between least(s.x1,s.x2)-1.0 and greatest(s.x1,s.x2)+1.0
      and m.py between least(s.y1,s.y2)-1.0 and greatest(s.y1,s.y2)+1.0 then 1 else 0 end) = 1),
st as (
  select *, case when lag(t1) over w is null or lag(t1) over w <> t0 then 1 else 0 end st
  from kept window w as (partition by line_id, area_id order by t0)),
rn as (select *, sum(st) over (partition by line_id, area_id order by t0) run from st),
runs as (
  select line_id, area_id, run, min(t0) t0, max(t1) t1, any_value(len) len,
    any_value(lx1) lx1, any_value(ly1) ly1, any_value(lx2) lx2, any_value(ly2) ly2
  from rn group by line_id, area_id, run)
"""
_CLIP_SQL = _CLIP_SQL.replace("{c}", "case when ((s.y1>l.y1)<>(s.y2>l.y1)) and (case when s.y2>s.y1 then (l.y1-s.y1)*(s.x2-s.x1) > (l.x1-s.x1)*(s.y2-s.y1) else (l.y1-s.y1)*(s.x2-s.x1) < (l.x1-s.x1)*(s.y2-s.y1) end) then 1 else 0 end")
_CLIP_SQL = _CLIP_SQL.replace("{o}", "case when (s.x2-s.x1)*(l.y1-s.y1)-(s.y2-s.y1)*(l.x1-s.x1)=0 and l.x1 between least(s.x1,s.x2) and greatest(s.x1,s.x2) and l.y1 between least(s.y1,s.y2) and greatest(s.y1,s.y2) then 1 else 0 end")


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf)
    pieces = sj.clip_lines(lines, view(spark, sf, "fx_segments"), "line_id", "area_id")
    return sj.merge_runs(pieces, "line_id", "area_id")


@query(
    "join_overlay_lines",
    _CLIP_SQL
    + """
select line_id, area_id, cast(count(*) as bigint) n_pieces, round(sum((t1-t0)*len), 4) length_deg
from runs group by line_id, area_id
""",
)
def join_overlay_lines(spark: SparkSession, sf: str) -> DataFrame:
    r = _runs(spark, sf)
    return r.groupBy("line_id", "area_id").agg(
        F.count("*").alias("n_pieces"),
        F.round(F.sum((F.col("t1") - F.col("t0")) * seg_len_deg("x1", "y1", "x2", "y2")), 4).alias("length_deg"),
    )


_PIECES_TAIL = """
select a.iso, r.line_id, cast(r.run as bigint) piece,
  cast(round(lx1 + t0*(lx2-lx1)) as bigint) x1, cast(round(ly1 + t0*(ly2-ly1)) as bigint) y1,
  cast(round(lx1 + t1*(lx2-lx1)) as bigint) x2, cast(round(ly1 + t1*(ly2-ly1)) as bigint) y2
from runs r join fx_areas a on a.area_id = r.area_id
"""


def _pieces(spark: SparkSession, sf: str) -> DataFrame:
    r = _runs(spark, sf)
    areas = view(spark, sf, "fx_areas").select("area_id", "iso")

    def at(t, a, b):
        return F.round(F.col(a) + F.col(t) * (F.col(b) - F.col(a))).cast("long")

    return r.join(areas, "area_id").select(
        "iso", "line_id", F.col("run").cast("long").alias("piece"),
        at("t0", "x1", "x2").alias("x1"), at("t0", "y1", "y2").alias("y1"),
        at("t1", "x1", "x2").alias("x2"), at("t1", "y1", "y2").alias("y2"),
    )


for _qid in ("nat_roads", "nat_railroads", "nat_rivers", "nat_coastline_v1"):
    query(_qid, _CLIP_SQL + _PIECES_TAIL)(_pieces)


_PARTS = "lp as (select poly_id id, eid, x1, y1, x2, y2 from fx_polys), la as (select area_id id, seq eid, x1, y1, x2, y2 from fx_segments)"


@query(
    "join_clip",
    _CLIP_SQL
    + f""", {_PARTS}, {overlay_ctes('o', 'lp', 'la', 'intersection')}
select 'line' kind, iso, line_id id, x1, y1, x2, y2 from ({_PIECES_TAIL}) t
union all select 'polygon', a.iso, o.lid, o.x1, o.y1, o.x2, o.y2 from o join fx_areas a on a.area_id = o.rid
union all select 'point', a.iso, h.pid, h.x, h.y, h.x, h.y from (select p.pid, p.x, p.y, s.area_id from fx_points p, fx_segments s
  group by p.pid, p.x, p.y, s.area_id having {intersects_having('p', 's')}) h join fx_areas a on a.area_id = h.area_id""",
)
def join_clip(spark: SparkSession, sf: str) -> DataFrame:
    """Layers of any geometry cut to every area: points stay, lines give pieces, polygons the outline of their part."""
    lines = _pieces(spark, sf).select(F.lit("line").alias("kind"), "iso", F.col("line_id").alias("id"), *EDGE)
    named = view(spark, sf, "fx_areas").select("area_id", "iso")
    segs = view(spark, sf, "fx_segments")
    cut = P.overlay(view(spark, sf, "fx_polys").select(F.col("poly_id").alias("lid"), "eid", *EDGE), segs.select(F.col("area_id").alias("rid"), F.col("seq").alias("eid"), *EDGE), "intersection")
    polys = cut.join(named, cut["rid"] == named["area_id"]).select(F.lit("polygon").alias("kind"), "iso", F.col("lid").alias("id"), *EDGE)
    hits = sj.points_in_areas(view(spark, sf, "fx_points"), segs, "pid", "area_id", "intersects", payload=["x", "y"]).join(named, "area_id")
    points = hits.select(F.lit("point").alias("kind"), "iso", F.col("pid").alias("id"), *[F.col(c[0]).alias(c) for c in EDGE])
    return lines.unionByName(polys).unionByName(points)


def clip_by_kind(layer: DataFrame, kind: str, segs: DataFrame, id_col: str) -> DataFrame:
    """(id, area_id) of a layer clipped the way its declared kind asks: polygons and points that lie
    within an area, railways that have a piece inside; any other kind is an error."""
    if kind == "point":
        return sj.points_in_areas(layer, segs, id_col, "area_id", "within").withColumnRenamed(id_col, "id")
    if kind == "polygon":
        return P.within(layer, segs.withColumn("eid", F.col("seq")), id_col, "area_id").withColumnRenamed(id_col, "id")
    if kind == "railway":
        return sj.clip_lines(layer, segs, id_col, "area_id").select(F.col(id_col).alias("id"), "area_id").distinct()
    raise ValueError(f"unknown geometry kind {kind}")


@query(
    "join_clip_by_kind",
    _CLIP_SQL
    + f""", {_PARTS}, {overlay_ctes('o', 'lp', 'la', 'difference', overlapping=False)}
select 'railway' kind, line_id id, area_id from runs group by line_id, area_id
union all select 'polygon', lid, rid from o_p where (lid, rid) not in (select lid, rid from o)
union all
select 'point' kind, p.pid, s.area_id from fx_points p, fx_segments s
group by p.pid, s.area_id having {within_having('p', 's')}
""",
)
def join_clip_by_kind(spark: SparkSession, sf: str) -> DataFrame:
    """Three layers, each clipped by its kind."""
    segs = view(spark, sf, "fx_segments")
    layers = {"point": (view(spark, sf, "fx_points"), "pid"), "polygon": (view(spark, sf, "fx_polys").select("poly_id", "eid", *EDGE), "poly_id"), "railway": (_lines(spark, sf), "line_id")}
    made = [clip_by_kind(df, kind, segs, col).select(F.lit(kind).alias("kind"), "id", "area_id") for kind, (df, col) in layers.items()]
    return made[0].unionByName(made[1]).unionByName(made[2])
