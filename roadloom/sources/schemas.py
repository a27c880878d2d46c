"""Declared schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The six time-of-week speed periods, in table order.
PERIODS = [
    "peakam0709monfri",
    "peakpm1619monfri",
    "offpeak1016monfri",
    "eveningspeed1923everyday",
    "nighttime0004everyday",
    "weekend0719",
]

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(POINT)
TEXTS = T.ArrayType(T.StringType())


def _schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

ROADLINK = _schema(
    ogc_fid=_L, id=_S, roadname=TEXTS, alternatename=TEXTS, roadclassificationnumber=_S, roadclassification=_S,
    routehierarchy=_S, formofway=_S, operationalstate=_S, directionality=_S, length=_D,
    startnode=_S, startgradeseparation=_I, endnode=_S, endgradeseparation=_I, geom=LINE,
)
AVERAGE_SPEEDS = _schema(roadlinkid=_S, **{f"{p}{side}": _D for p in PERIODS for side in "ab"})
FERRYLINK = _schema(ogc_fid=_L, id=_S, startnode=_S, endnode=_S, geom=LINE)
FERRYTERMINAL_ELEMENT = _schema(id=_S, identifier=_S, role=_S)
CONNECTINGNODE = _schema(roadlink=_S, geom=LINE)
PATHLINK = _schema(id=_S, formofway=_S, geom=LINE)
CONNECTINGLINK = _schema(id=_S, geom=LINE)

INPUTS = {
    "roadlink": ROADLINK,
    "average_speeds": AVERAGE_SPEEDS,
    "ferrylink": FERRYLINK,
    "ferryterminal_element": FERRYTERMINAL_ELEMENT,
    "connectingnode": CONNECTINGNODE,
    "pathlink": PATHLINK,
    "connectinglink": CONNECTINGLINK,
}

VEHICLE_NODES = _schema(id=_L, node=_S, x=_D, y=_D)
WALK_NODES = _schema(id=_L, x=_D, y=_D)

# Distance costs followed by one forward/reverse pair per period.
DISTANCE_COSTS = ["cost_distance", "reverse_cost_distance"]
TIME_COSTS = [f"{way}cost_time_{p}" for p in PERIODS for way in ("", "reverse_")]
BOX = ["xmin", "ymin", "xmax", "ymax"]

_LINK_COLUMNS = dict(
    id=_L, fid=_S, name=TEXTS, alt_name=TEXTS, ref=_S, roadclassification=_S, routehierarchy=_S, formofway=_S,
    operationalstate=_S, directionality=_S, length=_D, source=_L, target=_L,
)
_ENDS = dict(x1=_D, y1=_D, x2=_D, y2=_D, geom=LINE, **{b: _D for b in BOX})

VEHICLE_EDGES = _schema(**_LINK_COLUMNS, **{c: _D for c in DISTANCE_COSTS}, **_ENDS)
SPEED_EDGES = _schema(**_LINK_COLUMNS, **{c: _D for c in DISTANCE_COSTS + TIME_COSTS}, **_ENDS)
WALK_EDGES = _schema(
    id=_L, type=_S, routehierarchy=_S, formofway=_S, source=_L, target=_L, cost=_D, reverse_cost=_D, **_ENDS
)
