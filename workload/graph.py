"""Reference-shaped input tables from the fixtures, and the graphs built from them.

The graphs are written once per session and data folder, as a user would keep
them, and every routing query reads the written tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom import ship
from roadloom.operators.blocks import ROWS_PER_BLOCK
from roadloom.operators.snap import NodeIndex, node_index
from roadloom.plans import vehicle, walk
from roadloom.plans.area import area_router
from roadloom.plans.route import Router, vehicle_router, walk_router
from roadloom.sources.schemas import INPUTS
from roadloom.sources.scratch import materialize
from roadloom.sources.tables import conform
from workload.fixtures import with_clause

CHECKED_ROWS_PER_BLOCK = 4096  # small enough that the checked routes cross blocks

RAW = ["part", "supplier", "customer", "lineitem"]

_LINE3 = "array(named_struct('x',x1,'y',y1),named_struct('x',xm,'y',ym),named_struct('x',x2,'y',y2)) as geom"
_LINE2 = "array(named_struct('x',x1,'y',y1),named_struct('x',x2,'y',y2)) as geom"

_SELECTS = {
    "roadlink": (
        "links",
        f"""ogc_fid, id, array(roadname) as roadname, cast(array() as array<string>) as alternatename, ref as roadclassificationnumber,
        cast(null as string) as roadclassification, routehierarchy, formofway, operationalstate, directionality, length,
        startnode, startgrade as startgradeseparation, endnode, endgrade as endgradeseparation, {_LINE3}""",
    ),
    "average_speeds": ("speeds", "*"),
    "ferrylink": ("ferries", f"ogc_fid, id, startnode, endnode, {_LINE2}"),
    "ferryterminal_element": ("elements", "*"),
    "connectingnode": ("cutpoints", "roadlink, array(named_struct('x',x,'y',y)) as geom"),
    "pathlink": ("paths", f"id, formofway, {_LINE2}"),
    "connectinglink": ("connectors", f"id, {_LINE2}"),
}


class Workload:
    def __init__(self, spark: SparkSession, sf_dir: str, rows_per_block: int = ROWS_PER_BLOCK):
        self.spark, self.sf_dir, self.rows_per_block = spark, sf_dir, rows_per_block
        self._tables: dict[str, DataFrame] = {}

    def sql(self, query: str, *tables: str) -> DataFrame:
        """Run ``query`` over the named fixture tables."""
        for name in RAW:
            self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet").createOrReplaceTempView(name)
        return self.spark.sql(with_clause(*tables) + query)

    def table(self, name: str) -> DataFrame:
        """An input table, written on first use."""
        if name not in self._tables:
            fixture, columns = _SELECTS[name]
            self._tables[name] = materialize(conform(self.sql(f"select {columns} from {fixture}", fixture), INPUTS[name]), name)
        return self._tables[name]

    @property
    def roadlink(self) -> DataFrame:
        return self.table("roadlink")

    @cached_property
    def nodes(self) -> DataFrame:
        return materialize(vehicle.vehicle_nodes(self.roadlink), "nodes")

    @cached_property
    def edges(self) -> DataFrame:
        """Speeds graph with ferries, which are numbered once the road edges are written and counted."""
        roads = materialize(vehicle.vehicle_edges(self.roadlink, self.nodes, self.table("average_speeds")), "edges")
        offset = vehicle.ferry_offset(roads)
        ferries = vehicle.ferry_edges(self.table("ferrylink"), self.table("ferryterminal_element"), self.nodes, timed=True, offset=offset)
        return vehicle.add_ferries(roads, materialize(ferries, "ferries"), offset)

    @cached_property
    def network(self) -> DataFrame:
        split = materialize(walk.split_road_links(self.roadlink, self.table("connectingnode")), "split")
        return materialize(walk.network_geometry(self.roadlink, split, self.table("pathlink"), self.table("connectinglink")), "network")

    @cached_property
    def walk_nodes(self) -> DataFrame:
        return materialize(walk.walk_nodes(self.network), "walk-nodes")

    @cached_property
    def walk_edges(self) -> DataFrame:
        return materialize(walk.walk_edges(self.network, self.walk_nodes), "walk-edges")

    @cached_property
    def index(self) -> NodeIndex:
        """Places of the vehicle nodes; snapping needs no edges."""
        return node_index(self.nodes)

    @cached_property
    def vehicles(self) -> Router:
        return vehicle_router(self.nodes, self.edges, self.rows_per_block)

    @cached_property
    def walkers(self) -> Router:
        return walk_router(self.walk_nodes, self.walk_edges, self.rows_per_block)

    @cached_property
    def areas(self) -> Router:
        return area_router(self.nodes, self.edges, self.rows_per_block)

    @cached_property
    def requests(self) -> DataFrame:
        """One route request per supplier."""
        return materialize(
            self.sql("select req_id, src_x, src_y, dst_x, dst_y, opt as option, period, minutes from od_request", "od_request"), "od"
        )

    @cached_property
    def origins(self) -> DataFrame:
        """One service-area request per supplier."""
        kind = F.when(F.col("option") == "distance", "alphashape").otherwise("drivingdistance").alias("option")
        return self.requests.select("req_id", F.col("src_x").alias("x"), F.col("src_y").alias("y"), kind, "minutes", "period")


_OPEN: dict[tuple[str, str], Workload] = {}


def workload(spark: SparkSession, sf_dir: str, rows_per_block: int = CHECKED_ROWS_PER_BLOCK) -> Workload:
    """The workload of this session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        ship(spark)
        _OPEN[key] = Workload(spark, sf_dir, rows_per_block)
    return _OPEN[key]
