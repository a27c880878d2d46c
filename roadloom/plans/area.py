"""Batch service areas: every node, edge or outline within a drive time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions import geojson
from roadloom.functions.geometry import envelope
from roadloom.operators import blocks as B
from roadloom.operators.clip import AREA_EXCLUDED, without_hierarchy
from roadloom.operators.hull import TARGET_SHARE, concave_hull
from roadloom.operators.ids import unique
from roadloom.operators.skew import split_join
from roadloom.operators.snap import node_index, snap
from roadloom.plans.route import Router, vehicle_costs
from roadloom.sources.requests import AREA_OPTIONS, area_cost_name, area_option
from roadloom.sources.scratch import materialize

KM_PER_MINUTE = 1.86  # fixed value: half-side of the square searched, per minute
BANDS = [5.0, 10.0, 15.0]  # fixed value: minutes offered


def area_router(nodes: DataFrame, edges: DataFrame, rows_per_block: int = B.ROWS_PER_BLOCK) -> Router:
    """Service areas do not board ferries."""
    costs = {n: c for n, c in vehicle_costs(edges).items() if n != "distance"}
    open_edges = without_hierarchy(edges, AREA_EXCLUDED)
    return Router(nodes, edges, node_index(nodes), B.block_graph(nodes, open_edges, costs, rows_per_block))


def attach_origin(router: Router, requests: DataFrame) -> DataFrame:
    """(req_id, x, y, minutes, period, ...) with the ``source`` node and the square round it."""
    requests = unique(requests, ["req_id"], "req_id")
    points = requests.select("req_id", F.col("x").alias("px"), F.col("y").alias("py"))
    at = router.nodes.select(F.col("id").alias("node_id"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    origin = snap(points, router.index, ["req_id"]).join(at, "node_id").select("req_id", F.col("node_id").alias("source"), "nx", "ny")
    box = envelope([(F.col("nx"), F.col("ny"))], F.col("minutes") * KM_PER_MINUTE * 1000)
    return requests.join(origin, "req_id").withColumns(box).drop("nx", "ny")


def spread_area(router: Router, origins: DataFrame) -> B.Spread:
    ready = origins.withColumn("cost", area_cost_name(F.col("period"))).withColumn("max_cost", F.col("minutes"))
    return B.spread(router.blocks, ready.drop("target"))


def area_nodes(run: B.Spread) -> DataFrame:
    """(req_id, node, edge, prev, cost_fixed, agg_cost, x, y): reached nodes and where they are; the origin has edge -1."""
    who = run.requests.select("req_no", "req_id", "scale")
    fixed = F.shiftright("label", B.HOP_BITS)
    return B.labels(run).join(who, "req_no").select(
        "req_id", "node", "edge", "prev", fixed.alias("cost_fixed"), (fixed / F.col("scale")).alias("agg_cost"), "x", "y"
    )


def area_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(req_id, node, edge, cost_fixed, geom): the edge each node was reached by."""
    shapes = edges.select(F.col("id").alias("edge"), "geom")
    driven = materialize(nodes.where("edge >= 0").select("req_id", "node", "edge", "cost_fixed"), "driven")  # an origin was reached by no edge
    return split_join(driven, shapes, ["edge"], ["req_id", "node"]).where("geom is not null").select("req_id", "node", "edge", "cost_fixed", "geom")


def area_points(nodes: DataFrame) -> DataFrame:
    """(req_id, x, y): positions of the reached nodes."""
    return nodes.select("req_id", "x", "y")


def drive_time_bands(router: Router, requests: DataFrame, bands: list[float] | None = None) -> DataFrame:
    """(req_id, node, band, cost_fixed): the smallest limit whose own area holds the node.

    All limits are searched in one batch, each within its own square.
    """
    limits = F.array(*[F.lit(float(b)) for b in (bands or BANDS)])
    each = attach_origin(router, requests.withColumn("minutes", F.lit(max(bands or BANDS)))).drop("lo_x", "lo_y", "hi_x", "hi_y")
    at = router.nodes.select(F.col("id").alias("source"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    each = each.join(at, "source").withColumn("minutes", F.explode(limits))
    each = each.withColumns(envelope([(F.col("nx"), F.col("ny"))], F.col("minutes") * KM_PER_MINUTE * 1000))
    each = each.withColumn("req_id", F.struct("req_id", F.col("minutes").alias("band")))
    nodes = area_nodes(spread_area(router, each))
    return (
        nodes.select("req_id.req_id", "node", F.struct("req_id.band", "cost_fixed").alias("b"))
        .groupBy("req_id", "node").agg(F.min("b").alias("b")).select("req_id", "node", "b.band", "b.cost_fixed")
    )


@dataclass
class AreaResult:
    """Reached ``nodes``, and GeoJSON ``features``: outlines or driven edges, as each request's option asks."""

    nodes: DataFrame
    features: DataFrame
    summary: DataFrame


def service_area(router: Router, requests: DataFrame, share: float = TARGET_SHARE) -> AreaResult:
    """Answer a batch of requests: (req_id, x, y, option, minutes, period); option is alphashape or drivingdistance."""
    other = requests.where(~F.coalesce(F.col("option").isin(AREA_OPTIONS), F.lit(False))).select("option").first()
    if other:
        raise ValueError(f"option must be one of {', '.join(AREA_OPTIONS)}, not {other.option}")
    known = requests.withColumn("option", area_option(F.col("option")))
    origins = materialize(attach_origin(router, known), "origins")
    nodes = materialize(area_nodes(spread_area(router, origins)), "area-nodes")
    wanted = origins.select("req_id", "option")
    outlined = nodes.join(wanted.where("option = 'alphashape'"), "req_id", "left_semi")
    driven = nodes.join(wanted.where("option = 'drivingdistance'"), "req_id", "left_semi")
    outline = concave_hull(area_points(outlined), share).select(
        "req_id", geojson.feature_json(geojson.polygon_geometry(F.col("ring")), {}).alias("feature")
    )
    lines = area_edges(driven, router.edges).select(
        "req_id", geojson.feature_json(geojson.line_geometry(F.col("geom")), {}).alias("feature")
    )
    summary = origins.select("req_id", "source", "option", F.col("minutes").alias("cost"))
    return AreaResult(nodes, outline.unionByName(lines), summary)
