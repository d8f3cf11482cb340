"""SQL text of polygon overlays for the oracle: every edge of a pair against
every other, midpoints judged by whole polygons, no grid.

Layers are CTEs (id, eid, x1, y1, x2, y2).  Only the meaning of a result is
shared with the Spark plans: crossing points are rounded to micro-degrees from
the left (or lower) edge, pieces are directed with the region on their left.
"""

from __future__ import annotations

REGION = {"intersection": "({a} and {b})", "difference": "({a} and not {b})", "union": "({a} or {b})", "symdiff": "({a} <> {b})"}


def _cut_points(l: str, r: str) -> list[str]:
    """(condition, x, y, which edges it cuts) of the crossing of edges l and r."""
    den = f"(({l}.x2-{l}.x1)*({r}.y2-{r}.y1)-({l}.y2-{l}.y1)*({r}.x2-{r}.x1))"
    t = f"(({r}.x1-{l}.x1)*({r}.y2-{r}.y1)-({r}.y1-{l}.y1)*({r}.x2-{r}.x1))"
    u = f"(({r}.x1-{l}.x1)*({l}.y2-{l}.y1)-({r}.y1-{l}.y1)*({l}.x2-{l}.x1))"
    met = f"{den} <> 0 and {t}*sign({den}) between 0 and abs({den}) and {u}*sign({den}) between 0 and abs({den})"
    at = f"({t}::double/{den}::double)"
    cross = [(met, f"cast(floor({l}.{c}1 + {at}*({l}.{c}2-{l}.{c}1) + 0.5) as bigint)") for c in "xy"]

    def held(e: str, f: str, end: int) -> str:
        on = " and ".join(f"{f}.{c}{end} between least({e}.{c}1,{e}.{c}2) and greatest({e}.{c}1,{e}.{c}2)" for c in "xy")
        return f"{den} = 0 and {t} = 0 and {u} = 0 and {on}"

    return [(cross[0][0], cross[0][1], cross[1][1], "lr")] + [
        (held(l, r, k), f"{r}.x{k}", f"{r}.y{k}", "l") for k in (1, 2)
    ] + [(held(r, l, k), f"{l}.x{k}", f"{l}.y{k}", "r") for k in (1, 2)]


def _west(e: str, px: str, py: str) -> str:
    """1, -1 or 0: edge e passes west of the point, going down, up or not at all."""
    side = f"(({e}.x1*2-{px})*({e}.y2-{e}.y1)*2 + ({py}-{e}.y1*2)*({e}.x2-{e}.x1)*2)*sign({e}.y2-{e}.y1)"
    return f"case when ({e}.y1*2 > {py}) <> ({e}.y2*2 > {py}) and {side} < 0 then (case when {e}.y2 < {e}.y1 then 1 else -1 end) else 0 end"


def _pieces(ids: str, points: str) -> str:
    """Directed pieces from points (ids.., eid, x1..y2 of the edge, x, y)."""
    at = "((x2-x1)*(x-x1)+(y2-y1)*(y-y1))"
    return f"""select {ids}, eid, case when s < e then sx else ex end ax, case when s < e then sy else ey end ay,
  case when s < e then ex else sx end zx, case when s < e then ey else sy end zy, case when s < e then 1 else -1 end turn
from (select {ids}, eid, x sx, y sy, (x, y) s, lead((x, y)) over w e, lead(x) over w ex, lead(y) over w ey
  from (select distinct {ids}, eid, x1, y1, x2, y2, x, y from ({points}) q) q window w as (partition by {ids}, eid order by {at}, x, y)) t where ex is not null"""


def overlay_ctes(name: str, left: str, right: str, region: str, overlapping: bool = True) -> str:
    """CTEs ending in ``name`` (lid, rid, x1, y1, x2, y2)."""
    n = name
    boxes = {s: f"{n}_{s}b as (select id, min(least(x1,x2)) x0, max(greatest(x1,x2)) x9, min(least(y1,y2)) y0, max(greatest(y1,y2)) y9 from {t} group by id)" for s, t in (("l", left), ("r", right))}
    ends = " union all ".join(
        f"select '{s}' side, p.lid, p.rid, e.eid, e.x1, e.y1, e.x2, e.y2, e.x{k} x, e.y{k} y from {n}_p p join {t} e on e.id = p.{s}id" for s, t in (("l", left), ("r", right)) for k in (1, 2)
    )
    cuts = " union all ".join(
        f"select '{s}' side, p.lid, p.rid, {s}.eid, {s}.x1, {s}.y1, {s}.x2, {s}.y2, {x} x, {y} y from {n}_p p join {left} l on l.id = p.lid join {right} r on r.id = p.rid where {on}"
        for on, x, y, cut in _cut_points("l", "r") for s in cut
    )
    a_l, b_l = ("case when turn_{s} is null then inside when turn_{s} = 0 then true else turn_{s} > 0 end".format(s=s) for s in "lr")
    a_r, b_r = ("case when turn_{s} is null then inside when turn_{s} = 0 then true else turn_{s} < 0 end".format(s=s) for s in "lr")
    only = f"where (lid, rid) in (select lid, rid from {n}_f where ({a_l} and {b_l}) <> ({a_r} and {b_r}))" if overlapping else ""
    return f"""{boxes['l']}, {boxes['r']},
{n}_p as (select l.id lid, r.id rid from {n}_lb l join {n}_rb r on l.x0 <= r.x9 and r.x0 <= l.x9 and l.y0 <= r.y9 and r.y0 <= l.y9),
{n}_s as ({_pieces('side, lid, rid', ends + ' union all ' + cuts)}),
{n}_g as (select lid, rid, ax, ay, zx, zy, sum(case when side = 'l' then turn end) turn_l, sum(case when side = 'r' then turn end) turn_r from {n}_s group by all),
{n}_j as (select g.lid, g.rid, g.ax, g.ay, g.zx, g.zy, abs(sum({_west('o', '(g.ax+g.zx)', '(g.ay+g.zy)')})) % 2 = 1 inside from {n}_g g
  join (select 'l' side, * from {left} union all select 'r' side, * from {right}) o on (g.turn_l is null and o.side = 'l' and o.id = g.lid) or (g.turn_r is null and o.side = 'r' and o.id = g.rid) group by all),
{n}_f as (select g.*, j.inside from {n}_g g left join {n}_j j using (lid, rid, ax, ay, zx, zy)),
{n}_k as (select *, {REGION[region].format(a=a_l, b=b_l)} on_left, {REGION[region].format(a=a_r, b=b_r)} on_right from {n}_f {only}),
{n} as (select lid, rid, case when on_left then ax else zx end x1, case when on_left then ay else zy end y1, case when on_left then zx else ax end x2, case when on_left then zy else ay end y2 from {n}_k where on_left <> on_right)"""


def dissolve_ctes(name: str, layer: str) -> str:
    """CTEs ending in ``name`` (gid, x1, y1, x2, y2); ``layer`` has (gid, oid, eid, x1..y2), eid unique in a group."""
    n = name
    ends = " union all ".join(f"select gid, eid, x1, y1, x2, y2, x{k} x, y{k} y from {layer}" for k in (1, 2))
    cuts = " union all ".join(
        f"select l.gid, {s}.eid, {s}.x1, {s}.y1, {s}.x2, {s}.y2, {x} x, {y} y from {layer} l join {layer} r on l.gid = r.gid and l.oid < r.oid where {on}"
        for on, x, y, cut in _cut_points("l", "r") for s in cut
    )
    return f"""{n}_s as ({_pieces('gid', ends + ' union all ' + cuts)}),
{n}_g as (select gid, ax, ay, zx, zy, sum(turn) turn, list(distinct eid) owners from {n}_s group by all having sum(turn) <> 0),
{n}_j as (select g.gid, g.ax, g.ay, g.zx, g.zy, g.turn, sum(case when list_contains(g.owners, o.eid) then 0 else {_west('o', '(g.ax+g.zx)', '(g.ay+g.zy)')} end) w
  from {n}_g g join {layer} o on o.gid = g.gid group by all),
{n}_k as (select *, case when zy < ay then w + turn else w end > 0 on_left, case when zy < ay then w else w - turn end > 0 on_right from {n}_j),
{n} as (select gid, case when on_left then ax else zx end x1, case when on_left then ay else zy end y1, case when on_left then zx else ax end x2, case when on_left then zy else ay end y2 from {n}_k where on_left <> on_right)"""
