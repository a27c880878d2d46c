"""SQL counterparts of the queries, for DuckDB over the same tables."""

from __future__ import annotations

import math

from roadloom.sources.schemas import PERIODS
from workload.fixtures import with_clause

_HOP = 1 << 20
_TIMES = [(f"cost_time_{p}", f"reverse_cost_time_{p}", p) for p in PERIODS]


def _minutes(kmh: str) -> str:
    return f"length/1000/coalesce({kmh}+0.01, 48e0)*60"


_TIME_COLUMNS = ", ".join(
    f"case when directionality='in opposite direction' then -1e0 else {_minutes(p + 'a')} end as {f}, "
    f"case directionality when 'in direction' then -1e0 when 'in opposite direction' then {_minutes(p + 'a')} else {_minutes(p + 'b')} end as {r}"
    for f, r, p in _TIMES
)
_NODES = {
    "nodes": """select row_number() over (order by node, x, y) as id, node, x, y from (
      select concat(startnode,startgrade) as node, x1 as x, y1 as y from links union select concat(endnode,endgrade), x2, y2 from links) e"""
}
_BASIC = _NODES | {
    "basic": """select row_number() over (order by ogc_fid, b.id, c.id) as id, l.id as fid, l.* exclude (id), b.id as source, c.id as target,
      case when directionality='in opposite direction' then -1e0 else length end as cost_distance,
      case when directionality='in direction' then -1e0 else length end as reverse_cost_distance
    from links l join nodes b on concat(startnode,startgrade)=b.node join nodes c on concat(endnode,endgrade)=c.node"""
}
_SPEEDS = _BASIC | {"timed": f"select basic.*, {_TIME_COLUMNS} from basic left join speeds on fid=roadlinkid"}
_TERMINALS = {
    "terminals": """select id, list(identifier order by role, identifier) as e from elements
      where id in (select id from elements where role='RoadNode') group by id"""
}
_FERRIES = _TERMINALS | {
    "boats": """select row_number() over (order by ogc_fid) + 6000000 as id, f.id as fid,
      (select n.id from nodes n where n.node = concat(b.e[2], 0)) as source, (select n.id from nodes n where n.node = concat(c.e[2], 0)) as target,
      sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) as length, x1, y1, x2, y2
    from ferries f join terminals b on f.startnode=b.e[1] join terminals c on f.endnode=c.e[1]"""
}
_ROUND2 = "cast(round(cast(length as decimal(24,9)), 2) as double)"
_COST_COLUMNS = ["cost_distance", "reverse_cost_distance", *[c for f, r, _ in _TIMES for c in (f, r)]]
_EDGES = _SPEEDS | _FERRIES | {
    "edges": f"""select id, source, target, length, routehierarchy, {', '.join(_COST_COLUMNS)}, x1, y1, 3 as n_vertices,
      least(x1,xm,x2) as xmin, least(y1,ym,y2) as ymin, greatest(x1,xm,x2) as xmax, greatest(y1,ym,y2) as ymax, xm, ym, x2, y2 from timed
    union all select id, source, target, length, 'Ferry Route', {_ROUND2}, {_ROUND2}, {', '.join('1e0' for _ in _COST_COLUMNS[2:])}, x1, y1, 2,
      least(x1,x2), least(y1,y2), greatest(x1,x2), greatest(y1,y2), null, null, x2, y2 from boats"""
}
_ALL = ("links", "speeds", "elements", "ferries")


def _arc_union(table: str, kinds: list[tuple[str, str, str, int]], where: str = "true") -> str:
    """(kind, edge, u, v, w, cost, box) over both directions of every kind of cost."""
    parts = []
    for kind, forward, reverse, scale in kinds:
        for u, v, c in (("source", "target", forward), ("target", "source", reverse)):
            parts.append(
                f"select '{kind}' as kind, id as edge, {u} as u, {v} as v, cast(floor({c}*{scale}e0+0.5) as bigint)*{_HOP}+1 as w, {c} as cost, "
                f"xmin, ymin, xmax, ymax from {table} where {c}>=0 and source is not null and target is not null and source<>target and {where}"
            )
    return " union all ".join(parts)


_DISTANCE = [("distance", "cost_distance", "reverse_cost_distance", 1000)]
_TIMED = [(f"time_{p}", f, r, 1000000) for f, r, p in _TIMES]
_ARCS = _EDGES | {"arc": _arc_union("edges", _DISTANCE + _TIMED)}
_AREA_ARCS = _EDGES | {"arc": _arc_union("edges", _TIMED, "routehierarchy <> 'Ferry Route'")}

# --- pedestrian ---------------------------------------------------------------------------------------------------

_POINTS = {"pts": "select distinct roadlink as fid, x, y from cutpoints where roadlink <> ''"}
_SPLIT = _POINTS | {
    "seg": """select id as fid, 0 as i, x1 as p1x, y1 as p1y, xm as p2x, ym as p2y from links union all select id, 1, xm, ym, x2, y2 from links""",
    "hit": """select distinct seg.fid, i + ((x-p1x)*(p2x-p1x)+(y-p1y)*(p2y-p1y))/((p2x-p1x)*(p2x-p1x)+(p2y-p1y)*(p2y-p1y)) as pos, x, y from seg join pts on seg.fid=pts.fid
      where abs((x-p1x)*(p2y-p1y)-(y-p1y)*(p2x-p1x)) <= 1e-6*sqrt((p2x-p1x)*(p2x-p1x)+(p2y-p1y)*(p2y-p1y))
        and (x-p1x)*(p2x-p1x)+(y-p1y)*(p2y-p1y) between 0 and (p2x-p1x)*(p2x-p1x)+(p2y-p1y)*(p2y-p1y)""",
    "marks": """select fid, pos, max(cut) as cut, min(x) as x, min(y) as y from (
      select fid, pos, x, y, 1 as cut from hit where pos>0 and pos<2
      union all select id, 0, x1, y1, 0 from links where id in (select fid from pts)
      union all select id, 1, xm, ym, 0 from links where id in (select fid from pts)
      union all select id, 2, x2, y2, 0 from links where id in (select fid from pts)) m group by fid, pos""",
    "counted": "select *, 1 + coalesce(sum(cut) over (partition by fid order by pos rows between unbounded preceding and 1 preceding), 0) as n from marks",
    "members": "select fid, n, pos, x, y from counted union all select fid, n+1, pos, x, y from counted where cut=1",
    "steps": "select *, sqrt(power(x-lag(x) over q,2)+power(y-lag(y) over q,2)) as step from members window q as (partition by fid, n order by pos)",
    "pieces": """select fid, cast(n as bigint) as n, count(*) as n_vertices, arg_min(x,pos) as x1, arg_min(y,pos) as y1, arg_max(x,pos) as x2, arg_max(y,pos) as y2,
      coalesce(sum(step),0) as length, min(x) as xmin, min(y) as ymin, max(x) as xmax, max(y) as ymax from steps group by fid, n""",
}
_LINE3_LENGTH = "sqrt((xm-x1)*(xm-x1)+(ym-y1)*(ym-y1))+sqrt((x2-xm)*(x2-xm)+(y2-ym)*(y2-ym))"
_LINE2_LENGTH = "sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))"
_NETWORK = _SPLIT | {
    "network": f"""select p.fid, n, 'RoadLink' as type, routehierarchy, formofway, n_vertices, p.x1, p.y1, p.x2, p.y2, p.length, p.xmin, p.ymin, p.xmax, p.ymax
        from pieces p join links l on l.id=p.fid
      union all select id, 1, 'RoadLink', routehierarchy, formofway, 3, x1, y1, x2, y2, {_LINE3_LENGTH},
        least(x1,xm,x2), least(y1,ym,y2), greatest(x1,xm,x2), greatest(y1,ym,y2) from links l where not exists (select 1 from pieces p where p.fid=l.id)
      union all select id, 1, 'PathLink', '', formofway, 2, x1, y1, x2, y2, {_LINE2_LENGTH}, least(x1,x2), least(y1,y2), greatest(x1,x2), greatest(y1,y2) from paths
      union all select id, 1, 'ConnectingLink', '', '', 2, x1, y1, x2, y2, {_LINE2_LENGTH}, least(x1,x2), least(y1,y2), greatest(x1,x2), greatest(y1,y2) from connectors"""
}


def _mm(c: str) -> str:
    return f"cast(floor(({c})*1000+0.5) as bigint)"


def _wkt(x: str, y: str) -> str:
    return f"concat('POINT(', cast(cast({x} as decimal(12,3)) as varchar), ' ', cast(cast({y} as decimal(12,3)) as varchar), ')')"


_WALK = _NETWORK | {
    "walk_nodes": f"""select row_number() over (order by {_wkt('xm/1000e0', 'ym/1000e0')}) as id, xm as x_mm, ym as y_mm, xm/1000e0 as x, ym/1000e0 as y, {_wkt('xm/1000e0', 'ym/1000e0')} as p
      from (select {_mm('x1')} as xm, {_mm('y1')} as ym from network union select {_mm('x2')}, {_mm('y2')} from network) e""",
    "walk_edges": f"""select row_number() over (order by fid, type, n) as id, g.*, b.id as source, c.id as target from network g
      join walk_nodes b on {_mm('x1')}=b.x_mm and {_mm('y1')}=b.y_mm join walk_nodes c on {_mm('x2')}=c.x_mm and {_mm('y2')}=c.y_mm""",
}
_WALKS = ("links", "cutpoints", "paths", "connectors")
_WALK_ARCS = _WALK | {"arc": _arc_union("walk_edges", [("walk", "length", "length", 1000)], "routehierarchy <> 'Motorway'")}

# --- requests and shortest paths ----------------------------------------------------------------------------------


def _snapped(nodes: str) -> dict[str, str]:
    return {
        "snapped": f"""select req_id, role, node_id, d2 from (
          select req_id, role, n.id as node_id, (n.x-px)*(n.x-px)+(n.y-py)*(n.y-py) as d2,
            row_number() over (partition by req_id, role order by (n.x-px)*(n.x-px)+(n.y-py)*(n.y-py), n.id) as k
          from (select req_id, 'source' as role, src_x as px, src_y as py from od_request union all select req_id, 'target', dst_x, dst_y from od_request) p
          cross join {nodes} n) s where k=1"""
    }


def _requests(nodes: str, kind: str, ends: tuple[str, str] = ("source", "target")) -> dict[str, str]:
    """(req, kind, source, target, box); ``kind`` is an expression or a list of choices per request."""
    return _snapped(nodes) | {
        "ends": f"""select q.*, s.node_id as source, t.node_id as target,
          least(a.x,b.x)-20000 as lo_x, least(a.y,b.y)-20000 as lo_y, greatest(a.x,b.x)+20000 as hi_x, greatest(a.y,b.y)+20000 as hi_y
          from od_request q join snapped s on s.req_id=q.req_id and s.role='{ends[0]}' join snapped t on t.req_id=q.req_id and t.role='{ends[1]}'
          join {nodes} a on a.id=s.node_id join {nodes} b on b.id=t.node_id""",
        "req": f"select *, {kind} as kind from ends where source<>target",
    }


_OWN = "case when opt='distance' then 'distance' else concat('time_', period) end"
_EVERY = "unnest([" + ", ".join(f"'{k[0]}'" for k in _DISTANCE + _TIMED) + "])"
_LABELS = {
    "lab(req_id, kind, node, label)": f"""select req_id, kind, source, cast(0 as bigint) from req
      union
      select r.req_id, r.kind, a.v, min(r.label+a.w) from lab r
        join req q on q.req_id=r.req_id and q.kind=r.kind
        join arc a on a.u=r.node and a.kind=r.kind and a.xmax>=q.lo_x and a.xmin<=q.hi_x and a.ymax>=q.lo_y and a.ymin<=q.hi_y
        left join recurring.lab k on k.req_id=r.req_id and k.kind=r.kind and k.node=a.v
      group by r.req_id, r.kind, a.v, k.label having min(r.label+a.w) < coalesce(k.label, {1 << 62})""",
}
_PREDS = {
    "tree": f"""select l.req_id, l.kind, l.node, l.label, arg_min(a.edge, a.edge*10000000+a.u) as edge, arg_min(a.u, a.edge*10000000+a.u) as prev,
        arg_min(a.cost, a.edge*10000000+a.u) as cost
      from lab l join req q on q.req_id=l.req_id and q.kind=l.kind
      join arc a on a.v=l.node and a.kind=l.kind and a.xmax>=q.lo_x and a.xmin<=q.hi_x and a.ymax>=q.lo_y and a.ymin<=q.hi_y
      join lab p on p.req_id=l.req_id and p.kind=l.kind and p.node=a.u and p.label+a.w=l.label group by 1, 2, 3, 4""",
    "walked(req_id, kind, node, label, edge, prev, cost)": """select t.* from tree t join req q on q.req_id=t.req_id and q.kind=t.kind and t.node=q.target
      union all select t.* from walked w join tree t on t.req_id=w.req_id and t.kind=w.kind and t.node=w.prev""",
    "rows0": f"""select req_id, label%{_HOP} as seq, prev as node, edge, cost from walked
      union all select w.req_id, label%{_HOP}+1, w.node, -1, 0e0 from walked w join req q on q.req_id=w.req_id and q.kind=w.kind and w.node=q.target""",
    "rows": "select *, coalesce(sum(cost) over (partition by req_id order by seq rows between unbounded preceding and 1 preceding), 0) as agg_cost from rows0",
}


def _sql(tables: tuple[str, ...], ctes: dict[str, str], select: str) -> str:
    """Assemble the statement; the label search keeps one row per key."""
    text = with_clause(*tables, extra=ctes)
    text = text.replace("lab(req_id, kind, node, label) as (", "lab(req_id, kind, node, label) using key (req_id, kind, node) as (")
    if "using key" in text or "walked(" in text:
        text = text.replace("with ", "with recursive ", 1)
    return text + select


def _route(select: str, kind: str = _OWN, ends=("source", "target"), paths: bool = False, walk: bool = False) -> str:
    base, nodes, tables = (_WALK_ARCS, "walk_nodes", _WALKS) if walk else (_ARCS, "nodes", _ALL)
    ctes = base | _requests(nodes, kind, ends) | _LABELS | (_PREDS if paths else {})
    return _sql((*tables, "od_request"), ctes, select)


def _route_labels(columns: str = "") -> str:
    return f"""select q.req_id, {columns} q.source, q.target, l.label//{_HOP} as cost_fixed, l.label%{_HOP} as hops
      from lab l join req q on q.req_id=l.req_id and q.kind=l.kind and l.node=q.target"""


_AREA_E3 = "cast(floor(area2/2000000e0*1000+0.5) as bigint)"
_HULLS = {
    "reached": f"select distinct req_id, {_mm('x')} as x, {_mm('y')} as y from lab join nodes on nodes.id=lab.node",
    "columns": "select req_id, x, min(y) as low, max(y) as high from reached group by req_id, x",
    # a column's lowest point is a corner when the outline turns left there, its highest when it turns right
    "turns": """select c.req_id, c.x, c.low, c.high,
      max(case when o.x<c.x then (c.low-o.low)/(c.x-o.x) end) as low_before, min(case when o.x>c.x then (o.low-c.low)/(o.x-c.x) end) as low_after,
      min(case when o.x<c.x then (c.high-o.high)/(c.x-o.x) end) as high_before, max(case when o.x>c.x then (o.high-c.high)/(o.x-c.x) end) as high_after
      from columns c join columns o on o.req_id=c.req_id group by c.req_id, c.x, c.low, c.high""",
    "corners": """select req_id, x, low as y, -1 as side from turns where coalesce(low_before < low_after, true)
      union all select req_id, x, high, 1 from turns where coalesce(high_before > high_after, true)""",
    "trapezoids": """select req_id, x, y, side*(lead(x) over w - x)*(lead(y) over w + y) as part from corners window w as (partition by req_id, side order by x)""",
    "convex": "select req_id, count(distinct (x, y)) as n, cast(sum(part) as double) as area2 from trapezoids group by req_id having sum(part) > 0",
}


def _area(select: str, bands: bool = False, paths: bool = False, hulls: bool = False) -> str:
    minutes = "unnest([5e0, 10e0, 15e0])" if bands else "minutes"
    kind = "concat('time_', period)"
    key = "cast(req_id*100+minutes as bigint)" if bands else "req_id"
    req = {
        "asked": f"select req_id, period, src_x, src_y, {minutes} as minutes from od_request",
        "req": f"""select {key} as req_id, req_id as own_id, {kind} as kind, minutes, s.id as source, -1 as target,
          s.x-1860*minutes as lo_x, s.y-1860*minutes as lo_y, s.x+1860*minutes as hi_x, s.y+1860*minutes as hi_y
          from asked join (select sn.req_id as r, n.* from snapped sn join nodes n on n.id=sn.node_id where role='source') s on s.r=asked.req_id""",
    }
    label = {k: v.replace(" having ", " , q.minutes having ") + f" and min(r.label+a.w)//{_HOP} <= cast(floor(q.minutes*1000000e0+0.5) as bigint)" for k, v in _LABELS.items()}
    tree = {"tree": _PREDS["tree"]} if paths else {}
    return _sql((*_ALL, "od_request"), _AREA_ARCS | _snapped("nodes") | req | label | tree | (_HULLS if hulls else {}), select)


def _hms(seconds: str) -> str:
    s = f"(cast({seconds} as bigint)%86400)"
    return f"concat(lpad(cast({s}//3600 as varchar),2,'0'),':',lpad(cast({s}%3600//60 as varchar),2,'0'),':',lpad(cast({s}%60 as varchar),2,'0'))"


# --- grid projection ----------------------------------------------------------------------------------------------

# Fixed values of the published guide to the national grid, written out here so that the module under test is not its own measure:
# ellipsoids (semi-axes in metres), scale and origin of the projection, shift from WGS84 (metres, parts per million, seconds).
_WGS84 = (6378137.0, 6356752.3141)
_AIRY = (6377563.396, 6356256.909)
_SCALE = 0.9996012717
_LAT, _LON = math.radians(49), math.radians(-2)
_SHIFT, _PPM, _SECONDS = (-446.448, 125.157, -542.060), 20.4894, (-0.1502, -0.2470, -0.8421)


def _flat(ellipsoid) -> float:
    return 1 - (ellipsoid[1] / ellipsoid[0]) ** 2


def _cartesian(source: str, ellipsoid) -> str:
    a, e2 = ellipsoid[0], _flat(ellipsoid)
    return f"""select k, nu*cos(phi)*cos(lam) as x, nu*cos(phi)*sin(lam) as y, {1 - e2!r}*nu*sin(phi) as z
      from (select *, {a}/sqrt(1-{e2!r}*sin(phi)*sin(phi)) as nu from {source}) c"""


def _shift(source: str, sign: int) -> str:
    tx, ty, tz = (sign * t for t in _SHIFT)
    s = 1 + sign * _PPM * 1e-6
    rx, ry, rz = (sign * math.radians(r / 3600) for r in _SECONDS)
    return f"""select k, {tx}+{s!r}*x-({rz!r})*y+({ry!r})*z as x, {ty}+({rz!r})*x+{s!r}*y-({rx!r})*z as y, {tz}-({ry!r})*x+({rx!r})*y+{s!r}*z as z from {source}"""


def _geodetic(source: str, ellipsoid) -> str:
    a, e2 = ellipsoid[0], _flat(ellipsoid)
    text = f"(select k, atan2(y,x) as lam, sqrt(x*x+y*y) as r, z, atan2(z, sqrt(x*x+y*y)*{1 - e2!r}) as phi from {source})"
    for _ in range(6):
        text = f"(select k, lam, r, z, atan2(z+{e2!r}*{a}/sqrt(1-{e2!r}*sin(phi)*sin(phi))*sin(phi), r) as phi from {text} g)"
    return f"select k, lam, phi from {text} g"


def _meridian(phi: str) -> str:
    a, b = _AIRY
    n, o = (a - b) / (a + b), _LAT
    return (
        f"({b * _SCALE!r}*({1 + n + 5 / 4 * n**2 + 5 / 4 * n**3!r}*({phi}-{o!r})-{3 * n + 3 * n**2 + 21 / 8 * n**3!r}*sin({phi}-{o!r})*cos({phi}+{o!r})"
        f"+{15 / 8 * n**2 + 15 / 8 * n**3!r}*sin(2*({phi}-{o!r}))*cos(2*({phi}+{o!r}))-{35 / 24 * n**3!r}*sin(3*({phi}-{o!r}))*cos(3*({phi}+{o!r}))))"
    )


_A = _AIRY[0] * _SCALE
_E = _flat(_AIRY)
_NU = f"{_A!r}/sqrt(1-{_E!r}*sin(phi)*sin(phi))"
_RHO = f"{_A * (1 - _E)!r}/power(1-{_E!r}*sin(phi)*sin(phi), 1.5)"


def _project(source: str) -> str:
    return f"""select k,
      400000+nu*c*d+nu/6*power(c,3)*(nu/rho-t2)*power(d,3)+nu/120*power(c,5)*(5-18*t2+t2*t2+14*eta-58*t2*eta)*power(d,5) as x,
      m-100000+nu/2*s*c*d*d+nu/24*s*power(c,3)*(5-t2+9*eta)*power(d,4)+nu/720*s*power(c,5)*(61-58*t2+t2*t2)*power(d,6) as y
      from (select *, nu/rho-1 as eta from (select k, lam-({_LON!r}) as d, sin(phi) as s, cos(phi) as c, tan(phi)*tan(phi) as t2, {_NU} as nu, {_RHO} as rho, {_meridian('phi')} as m
        from {source}) p) p"""


def _unproject(source: str) -> str:
    text = f"(select k, x-400000 as e, y+100000 as n, (y+100000)/{_A!r}+{_LAT!r} as phi from {source})"
    for _ in range(4):
        text = f"(select k, e, n, phi+(n-{_meridian('phi')})/{_A!r} as phi from {text} u)"
    return f"""select k,
      phi-t/(2*rho*nu)*e*e+t/(24*rho*power(nu,3))*(5+3*t*t+eta-9*t*t*eta)*power(e,4)-t/(720*rho*power(nu,5))*(61+90*t*t+45*power(t,4))*power(e,6) as phi,
      {_LON!r}+sec/nu*e-sec/(6*power(nu,3))*(nu/rho+2*t*t)*power(e,3)+sec/(120*power(nu,5))*(5+28*t*t+24*power(t,4))*power(e,5)
        -sec/(5040*power(nu,7))*(61+662*t*t+1320*power(t,4)+720*power(t,6))*power(e,7) as lam
      from (select *, nu/rho-1 as eta from (select k, e, phi, tan(phi) as t, 1/cos(phi) as sec, {_NU} as nu, {_RHO} as rho from {text} u) u) u"""


def _to_lonlat(points: str) -> dict[str, str]:
    """CTE chain ending in ``lonlat(k, lam, phi)`` from ``points`` selecting (k, x, y)."""
    return {
        "xy": points, "local": _unproject("xy"), "c1": _cartesian("local", _AIRY), "c2": _shift("c1", -1), "lonlat": _geodetic("c2", _WGS84),
    }


_TO_GRID = {
    "here": "select c_custkey as k, radians(-6 + (c_custkey*37%7000)/1000e0) as lam, radians(50 + (c_custkey*53%8000)/1000e0) as phi from customer",
    "c1": _cartesian("here", _WGS84), "c2": _shift("c1", 1), "local": _geodetic("c2", _AIRY), "xy": _project("local"),
}


def _e(c: str, places: int) -> str:
    return f"cast(floor(({c})*{10**places}e0+0.5) as bigint)"


def all_oracles() -> dict[str, str]:
    e = _e
    times = [c for f, r, _ in _TIMES for c in (f, r)]
    long_times = " union all ".join(
        f"select id, '{p}' as period, {e(f, 9)} as cost_e9, {e(r, 9)} as reverse_cost_e9 from edges" for f, r, p in _TIMES
    )
    arc = lambda name, kinds: " union all ".join(
        f"select {name(k)} id as edge, {u} as u, {v} as v, cast(floor({c}*{s}e0+0.5) as bigint) as w from edges where {c}>=0 and source is not null and target is not null"
        for k, f, r, s in kinds for u, v, c in (("source", "target", f), ("target", "source", r))
    )
    piece = f"n_vertices, {_mm('x1')} as x1_mm, {_mm('y1')} as y1_mm, {_mm('x2')} as x2_mm, {_mm('y2')} as y2_mm, {_mm('length')} as length_mm"
    totals = """totals as (select req_id, sum(cast(floor(cost*100000+0.5) as bigint)) as c, sum(cast(floor(length*1000000+0.5) as bigint)) as l, count(*) as n
      from rows join edges on edges.id=rows.edge group by req_id) """
    summary = _route("@", paths=True)
    summary = summary[: summary.rindex("@")].rstrip() + ",\n" + totals + f"""select e.req_id, e.source, e.target,
      case when opt='distance' then 'N/A' else {_hms('coalesce(c,0)*60//100000')} end as time, cast((coalesce(l,0)+5000)//10000 as bigint) as distance_e2
      from ends e left join totals t on t.req_id=e.req_id"""
    response = summary.replace("as distance_e2", "as distance_e2, coalesce(n, 0) as n_features")
    walked = _route("@", kind="'walk'", paths=True, walk=True)
    walked = walked[: walked.rindex("@")] + f"""select e.req_id, e.source, e.target, {_hms('floor(coalesce(t.total,0)/1.4)')} as time,
      {e('round(cast(coalesce(t.total,0) as decimal(24,9)),2)', 2)} as distance_e2
      from ends e left join (select req_id, agg_cost as total from rows where edge=-1) t on t.req_id=e.req_id"""
    features = _route("@", paths=True)
    lonlat = ", ".join(f"{n} as ({s})" for n, s in _to_lonlat(
        "select id*3 as k, x1 as x, y1 as y from edges union all select id*3+1, xm, ym from edges where n_vertices=3 union all select id*3+n_vertices-1, x2, y2 from edges"
    ).items())
    features = features[: features.rindex("@")].rstrip() + ",\n" + lonlat + f""" select req_id, cast(seq as bigint) as seq, 'LineString' as kind, cast(k%3 as bigint) as place,
      {e('cost', 5)} as cost_e5, {e('round(degrees(lam),7)', 7)} as lon_e7, {e('round(degrees(phi),7)', 7)} as lat_e7
      from rows join lonlat on lonlat.k//3=rows.edge"""
    return {
        "scan_roadlink": _sql(("links",), {}, "select ogc_fid, id, startnode, endnode, directionality, length, 3 as n_vertices from links"),
        "table_roundtrip": _sql(("elements",), {}, "select * from elements"),
        "node_table": _sql(("links",), _NODES, "select id, node, x, y from nodes"),
        "edge_table_basic": _sql(("links",), _BASIC, """select id, fid, ref, routehierarchy, formofway, operationalstate, directionality, length, source, target,
          cost_distance, reverse_cost_distance, x1, y1, x2, y2 from basic"""),
        "edge_table_speeds": _sql(("links", "speeds"), _SPEEDS, f"select id, fid, source, target, {', '.join(f'{e(c, 9)} as {c}_e9' for c in times)} from timed"),
        "speeds_by_period": _sql(_ALL, _EDGES, long_times),
        "ferryterminal": _sql(("elements",), _TERMINALS, "select id, unnest(range(len(e))) as place, unnest(e) as element from terminals"),
        "ferry_edges": _sql(("links", "elements", "ferries"), _NODES | _FERRIES, f"""select id, fid, source, target, 'Ferry Route' as routehierarchy, 'Open' as operationalstate,
          'both directions' as directionality, 0 as n_names, {_mm('length')} as length_mm, {e(_ROUND2, 2)} as cost_distance_e2, 1e0 as cost_time_weekend0719, x1, y1, x2, y2 from boats"""),
        "connectingnode_used": _sql(("cutpoints",), {}, "select roadlink as fid, x, y from cutpoints where roadlink <> ''"),
        "collect_connectingnode": _sql(("cutpoints",), _POINTS, "select fid as roadlink, x, y from pts"),
        "split_roadlink": _sql(("links", "cutpoints"), _SPLIT, f"select fid, n, {piece} from pieces"),
        "non_split_roadlink": _sql(("links", "cutpoints"), {}, """select id as fid, cast(1 as bigint) as n, 'RoadLink' as type, routehierarchy, formofway from links
          where not exists (select 1 from cutpoints c where c.roadlink=links.id)"""),
        "network_geom": _sql(_WALKS, _NETWORK, f"select fid, n, type, routehierarchy, formofway, {piece} from network"),
        "node_wkt": _sql(_WALKS, _WALK, "select id, p as point from walk_nodes"),
        "edge_table_pedestrian": _sql(_WALKS, _WALK, f"""select id, type, routehierarchy, formofway, source, target, {_mm('length')} as cost_mm, {_mm('length')} as reverse_cost_mm,
          x1, y1, x2, y2 from walk_edges"""),
        "walkable_edges": _sql(_WALKS, _WALK, "select id, routehierarchy from walk_edges where routehierarchy <> 'Motorway'"),
        "duplicate_nodes": _sql(("links",), _NODES, "select x, y, count(*) as copies from nodes group by x, y having count(*) > 1"),
        "dense_id": _sql(("speeds",), {}, "select roadlinkid, row_number() over (order by roadlinkid desc) + 1000 as id from speeds"),
        "edge_endpoints": _sql(("links",), {}, "select id, x1, y1, x2, y2 from links"),
        "line_length": _sql(("links",), {}, f"select id, {_mm(_LINE3_LENGTH)} as length_mm from links"),
        "to_lonlat": _sql(("links",), _NODES | _to_lonlat("select id as k, x, y from nodes"), f"select k as id, {e('degrees(lam)', 7)} as lon_e7, {e('degrees(phi)', 7)} as lat_e7 from lonlat"),
        "to_grid": _sql((), _TO_GRID, f"select k as point_id, {_mm('x')} as x_mm, {_mm('y')} as y_mm from xy"),
        "parse_requests": """select s_suppkey as req_id, cast(3 as bigint) as n_points,
          cast(concat('-', s_nationkey%4, '.', 1000+s_suppkey%9000) as double) as lon1, cast(concat('5', s_nationkey%8, '.', 1000+(s_suppkey*7)%9000) as double) as lat1,
          cast(concat('-', s_nationkey%3, '.', 1000+(s_suppkey*3)%9000) as double) as lon2, cast(concat('5', s_nationkey%7, '.', 1000+(s_suppkey*11)%9000) as double) as lat2 from supplier""",
        "snap_nearest": _sql(("links", "od_request"), _NODES | _snapped("nodes"), "select * from snapped"),
        "clip_edges": _sql((*_ALL, "od_request"), _EDGES, """select req_id, id as edge from edges join od_request on
          xmax>=least(src_x,dst_x)-500 and xmin<=greatest(src_x,dst_x)+500 and ymax>=least(src_y,dst_y)-500 and ymin<=greatest(src_y,dst_y)+500"""),
        "arcs_distance": _sql(_ALL, _EDGES, arc(lambda k: "", _DISTANCE)),
        "arcs_by_period": _sql(_ALL, _EDGES, arc(lambda k: f"'{k[5:]}' as period,", _TIMED)),
        "route_distance": _route(_route_labels(), kind="'distance'"),
        "route_time": _route(_route_labels(), kind="concat('time_', period)"),
        "route_astar": _route(_route_labels("q.kind as cost_name,")),
        "route_walk": _route(_route_labels(), kind="'walk'", walk=True),
        "route_reverse": _route(_route_labels(), kind="'distance'", ends=("target", "source")),
        "route_all_periods": _route(_route_labels("q.kind as cost_name,"), kind=_EVERY),
        "route_edges": _route(f"select req_id, cast(seq as bigint) as seq, node, edge, {e('cost', 6)} as cost_e6, {e('agg_cost', 5)} as agg_cost_e5 from rows", paths=True),
        "route_summary": summary,
        "route_response": response,
        "walk_summary": walked,
        "geojson_features": features,
        "service_area_nodes": _area(f"select req_id, node, label//{_HOP} as cost_fixed from lab"),
        "service_area_edges": _area(f"select req_id, node, edge, label//{_HOP} as cost_fixed from tree", paths=True),
        "drive_time_bands": _area(f"""select own_id as req_id, node, min(minutes) as band, arg_min(label//{_HOP}, minutes) as cost_fixed
          from lab join req on req.req_id=lab.req_id group by 1, 2""", bands=True),
        "area_summary": _area("""select req_id, source, case opt when 'distance' then 'alphashape' else 'drivingdistance' end as option, req.minutes as cost
          from req join od_request using (req_id)"""),
        "rejected_requests": """select * from (select s_suppkey as req_id, case when s_suppkey%5 in (0, 1) then 'the second point is not a longitude and a latitude'
          when s_suppkey%3=2 and s_suppkey%2=0 then 'unknown option' when s_suppkey%3=1 and s_suppkey%4=0 then 'unknown period' end as reason from supplier) r
          where reason is not null""",
        "hull_convex": _area(f"select req_id, cast(n+1 as bigint) as n_points, {_AREA_E3} as area_e3, {_AREA_E3} as convex_area_e3 from convex", hulls=True),
        "hull_concave": _area(f"""select req_id, {_AREA_E3} as convex_area_e3, true as closed, true as share_kept, cast(0 as bigint) as n_foreign
          from convex""", hulls=True),
        "service_area": _area("""select req_id, 'LineString' as kind, count(*) as features from tree join od_request using (req_id) where opt<>'distance' group by req_id
          union all select req_id, 'Polygon', 1 from convex join od_request using (req_id) where opt='distance'""", paths=True, hulls=True),
    }
