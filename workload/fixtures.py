"""Link and request tables derived from the driver's tables.

Each entry is one CTE body, in SQL that Spark and DuckDB read alike; later
entries build on earlier ones. Coordinates are whole or dyadic, so geometry is
exact in both engines.
"""

from __future__ import annotations

import re

from roadloom.sources.schemas import PERIODS

_MONTHS = dict(zip(PERIODS, [(1, 2), (3, 4), (5, 6), (7, 8), (9, 10), (11, 12)]))


def _speed(period: str, side: str) -> str:
    a, b = _MONTHS[period]
    status = {"a": "F", "b": "O"}[side]
    return f"avg(case when month(l_shipdate) in ({a},{b}) and l_linestatus='{status}' then l_quantity end) as {period}{side}"


TABLES = {
    "size": "select count(*) as n from part",
    "fx_node": """select p_partkey as k,
  cast(400000 + 200*(p_partkey%40) + (p_partkey*37)%50 as double) as x,
  cast(100000 + 200*((p_partkey - p_partkey%40)/40) + (p_partkey*53)%50 as double) as y
from part""",
    "links": """select 2*p_partkey as ogc_fid, concat('L',2*p_partkey) as id,
  concat('N',p_partkey) as startnode, 0 as startgrade, concat('N',p_partkey+1) as endnode, 0 as endgrade,
  cast(200+p_size as double) as length,
  case p_size%5 when 0 then 'in direction' when 1 then 'in opposite direction' else 'both directions' end as directionality,
  case when p_partkey%400<40 then 'A Road' when p_partkey%50=0 then null else 'Local Road' end as routehierarchy,
  p_type as formofway, p_name as roadname, p_brand as ref,
  case when p_partkey%97=0 then 'Under Construction' else 'Open' end as operationalstate,
  a.x as x1, a.y as y1, (a.x+b.x)/2 + p_partkey%11 - 5 as xm, (a.y+b.y)/2 + p_partkey%13 - 6 as ym, b.x as x2, b.y as y2
from part join fx_node a on a.k=p_partkey join fx_node b on b.k=p_partkey+1 where p_partkey%40<39
union all
select 2*p_partkey+1, concat('L',2*p_partkey+1),
  concat('N',p_partkey), case when p_partkey%7=0 then 1 else 0 end, concat('N',p_partkey+40), case when (p_partkey+40)%7=0 then 1 else 0 end,
  cast(200+(p_size*3)%50 as double),
  case (p_size+2)%5 when 0 then 'in direction' when 1 then 'in opposite direction' else 'both directions' end,
  case when p_partkey%40=0 then 'Motorway' else 'Local Road' end,
  p_type, p_name, p_brand, case when p_partkey%97=0 then 'Under Construction' else 'Open' end,
  a.x, a.y, (a.x+b.x)/2 + p_partkey%11 - 5, (a.y+b.y)/2 + p_partkey%13 - 6, b.x, b.y
from part join fx_node a on a.k=p_partkey join fx_node b on b.k=p_partkey+40""",
    "observed": "select l_partkey, "
    + ", ".join(_speed(p, side) for p in PERIODS for side in "ab")
    + """
from lineitem group by l_partkey""",
    "speeds": " union all ".join(
        f"select concat('L',2*l_partkey+{d}) as roadlinkid, " + ", ".join(f"{p}{side}" for p in PERIODS for side in "ab") + " from observed" for d in (0, 1)
    ),
    "ports": "select s_suppkey as k, s_nationkey as nation, s_acctbal as balance, (s_suppkey*61)%(select n from size) as node from supplier",
    "elements": """select concat('T',k) as id, concat('F',k) as identifier, 'FerryNode' as role from ports
union all
select concat('T',k), case when nation=3 then 'N999999999' else concat('N',node) end, 'RoadNode' from ports where balance >= 0""",
    "ferries": """select s.k as ogc_fid, concat('FL',s.k) as id, concat('F',s.k) as startnode, concat('F',e.k) as endnode,
  a.x as x1, a.y as y1, b.x as x2, b.y as y2
from ports s join ports e on e.k=s.k+1 join fx_node a on a.k=s.node join fx_node b on b.k=e.node""",
    "cutters": "select c_custkey as id, c_acctbal as balance, 2*((c_custkey*7)%(select n from size)) as fid from customer",
    "cutpoints": """select c.id, case when c.balance < 0 then '' when c.balance < 300 then null else r.id end as roadlink,
  case c.id%7 when 3 then r.xm when 4 then r.x1 when 5 then r.x1 else r.x1+(r.xm-r.x1)*(c.id%7%4+1)*0.25 end as x,
  case c.id%7 when 3 then r.ym when 4 then r.y1 when 5 then r.y1+1 else r.y1+(r.ym-r.y1)*(c.id%7%4+1)*0.25 end as y
from cutters c join links r on r.ogc_fid=c.fid""",
    "trips": """select s_suppkey as id, s_nationkey as nation, (s_suppkey*17)%(select n from size) as here,
  (s_suppkey*17+53*(s_nationkey+1))%(select n from size) as there from supplier""",
    "paths": """select concat('P',t.id) as id, 'Path' as formofway, cn.x+30 as x1, cn.y+40 as y1, nd.x as x2, nd.y as y2
from trips t join cutpoints cn on cn.id=3*t.id join fx_node nd on nd.k=t.here""",
    "connectors": """select concat('C',t.id) as id, cn.x as x1, cn.y as y1, cn.x+30 as x2, cn.y+40 as y2
from trips t join cutpoints cn on cn.id=3*t.id""",
    "od_request": """select t.id as req_id, s.x+3 as src_x, s.y-2 as src_y, d.x-4 as dst_x, d.y+1 as dst_y,
  case when nation%2=0 then 'distance' else 'time' end as opt,
  case nation%6 """
    + " ".join(f"when {i} then '{p}'" for i, p in enumerate(PERIODS))
    + """ end as period, cast(5 + 5*(nation%3) as double) as minutes
from trips t join fx_node s on s.k=t.here join fx_node d on d.k=t.there""",
}

_NEEDS = {name: [t for t in TABLES if t != name and re.search(rf"(from|join) {t}\b", sql)] for name, sql in TABLES.items()}


def with_clause(*names: str, extra: dict[str, str] | None = None) -> str:
    """``with ...`` text for the named tables and all they build on, in order; ``extra`` CTEs follow."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _NEEDS[name]:
                add(other)

    for name in names:
        add(name)
    parts = [f"{name} as ({sql})" for name, sql in TABLES.items() if name in wanted]
    parts += [f"{name} as ({sql})" for name, sql in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" if parts else ""
