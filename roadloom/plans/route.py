"""Batch routing: snap both ends, settle, follow the path back, attach edges, sum up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.functions import geojson
from roadloom.functions.costs import WALK_METRES_PER_SECOND, hms, round_to
from roadloom.functions.geometry import envelope
from roadloom.operators import blocks as B
from roadloom.operators.clip import CLIP_METRES, WALK_EXCLUDED, cost_columns, without_hierarchy
from roadloom.operators.ids import unique
from roadloom.operators.skew import split_join
from roadloom.operators.snap import NodeIndex, node_index, snap
from roadloom.sources.requests import cost_name
from roadloom.sources.schemas import PERIODS
from roadloom.sources.scratch import materialize

WALK = "walk"


@dataclass
class Router:
    """A prepared graph: build once, answer any number of request batches."""

    nodes: DataFrame
    edges: DataFrame
    index: NodeIndex
    blocks: B.BlockGraph


def vehicle_costs(edges: DataFrame) -> dict[str, B.Cost]:
    costs = {"distance": B.Cost(*cost_columns("distance"), B.METRE_SCALE)}
    if "cost_time_" + PERIODS[0] in edges.columns:
        costs |= {f"time_{p}": B.Cost(*cost_columns("time", p), B.MINUTE_SCALE) for p in PERIODS}
    return costs


def vehicle_router(nodes: DataFrame, edges: DataFrame, rows_per_block: int = B.ROWS_PER_BLOCK) -> Router:
    return Router(nodes, edges, node_index(nodes), B.block_graph(nodes, edges, vehicle_costs(edges), rows_per_block))


def walk_router(nodes: DataFrame, edges: DataFrame, rows_per_block: int = B.ROWS_PER_BLOCK) -> Router:
    """Walkers keep off motorways."""
    open_edges = without_hierarchy(edges, WALK_EXCLUDED)
    cost = {WALK: B.Cost("cost", "reverse_cost", B.METRE_SCALE)}
    return Router(nodes, edges, node_index(nodes), B.block_graph(nodes, open_edges, cost, rows_per_block))


def snap_ends(index: NodeIndex, requests: DataFrame) -> DataFrame:
    """(req_id, role, node_id, d2): nearest node of the source and target of each request."""
    ends = F.array(
        F.struct(F.lit("source").alias("role"), F.col("src_x").alias("px"), F.col("src_y").alias("py")),
        F.struct(F.lit("target").alias("role"), F.col("dst_x").alias("px"), F.col("dst_y").alias("py")),
    )
    points = requests.select("req_id", F.explode(ends).alias("e")).select("req_id", "e.*")
    return snap(points, index, ["req_id", "role"])


def attach_ends(router: Router, requests: DataFrame, clip: float = CLIP_METRES) -> DataFrame:
    """Requests with ``source`` and ``target`` nodes and the box their routes stay near."""
    requests = unique(requests, ["req_id"], "req_id")
    at = router.nodes.select(F.col("id").alias("node_id"), "x", "y")
    snapped = snap_ends(router.index, requests).join(at, "node_id")
    pick = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    ends = snapped.groupBy("req_id").agg(
        *[pick(role, c).alias(f"{role}_{c}") for role in ("source", "target") for c in ("node_id", "x", "y")]
    )
    box = envelope([(F.col("source_x"), F.col("source_y")), (F.col("target_x"), F.col("target_y"))], clip)
    return requests.join(
        ends.select("req_id", F.col("source_node_id").alias("source"), F.col("target_node_id").alias("target"), *[c.alias(n) for n, c in box.items()]),
        "req_id",
    )


def solve(router: Router, ended: DataFrame, goal_directed: bool = False) -> B.Spread:
    """Settle every request of ``ended`` (see ``attach_ends``); ``cost`` may be given, else option and period name it."""
    if "cost" not in ended.columns:
        walk = WALK in router.blocks.costs
        ended = ended.withColumn("cost", F.lit(WALK) if walk else cost_name(F.col("option"), F.col("period")))
    return B.spread(router.blocks, ended.where("source <> target"), goal_directed)


def route_labels(run: B.Spread) -> DataFrame:
    """(req_id, cost_name, source, target, cost_fixed, hops) of every request whose target was reached."""
    return run.requests.join(run.reached(), "req_no").select(
        "req_id", F.col("cost").alias("cost_name"), "source", "target",
        F.shiftright("label", B.HOP_BITS).alias("cost_fixed"), F.col("label").bitwiseAND(F.lit(B.HOP - 1)).alias("hops"),
    )


def _edge_cost(costs: dict[str, B.Cost]) -> Column:
    """Cost of the joined edge in the direction it is travelled, for the request's kind of cost."""
    forward = F.col("node") == F.col("source")
    chosen = None
    for name, cost in costs.items():
        value = F.when(forward, F.col(cost.forward)).otherwise(F.col(cost.reverse))
        here = F.col("cost_name") == name
        chosen = F.when(here, value) if chosen is None else chosen.when(here, value)
    return chosen


def route_rows(router: Router, run: B.Spread, columns: list[str] | None = None) -> DataFrame:
    """(req_id, cost_name, seq, node, edge, cost, agg_cost, ...): a row per node of each route, in order.

    ``edge`` leads on from the node; the last row has edge -1 and cost 0. ``agg_cost``
    is the cost up to the node. ``columns`` of the edge are carried along.
    """
    columns = columns or []
    hops = F.col("label").bitwiseAND(F.lit(B.HOP - 1))
    onward = F.struct(hops.alias("seq"), F.col("prev").alias("node"), F.col("edge").alias("edge"))
    last = F.struct((hops + 1).alias("seq"), F.col("node").alias("node"), F.lit(-1).cast("long").alias("edge"))
    who = run.requests.select("req_no", "req_id", F.col("cost").alias("cost_name"), "goal")
    steps = (
        B.paths(run).join(who, "req_no")
        .select("req_id", "cost_name", F.explode(F.array(F.when(F.col("prev") >= 0, onward), F.when(F.col("node") == F.col("goal"), last))).alias("s"))
        .where("s is not null").select("req_id", "cost_name", "s.*")
    )
    pairs = {c for cost in router.blocks.costs.values() for c in (cost.forward, cost.reverse)}
    edges = router.edges.select(F.col("id").alias("edge"), "source", *sorted(pairs | set(columns)))
    before = Window.partitionBy("req_id", "cost_name").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    cost = F.coalesce(_edge_cost(router.blocks.costs), F.lit(0.0))
    return (
        split_join(materialize(steps, "route-steps"), edges, ["edge"], ["req_id", "cost_name", "seq"], "left")
        .select("req_id", "cost_name", "seq", "node", "edge", cost.alias("step_cost"), *columns)
        .withColumn("agg_cost", F.coalesce(F.sum("step_cost").over(before), F.lit(0.0)))
        .select("req_id", "cost_name", "seq", "node", "edge", F.col("step_cost").alias("cost"), "agg_cost", *columns)
    )


def route_summary(rows: DataFrame, ended: DataFrame) -> DataFrame:
    """(req_id, source, target, time, distance) of vehicle routes; ``rows`` must carry ``length``.

    Costs are rounded to five decimals before they are summed; unreachable targets
    have distance 0.
    """
    # Sums of whole units, so the order of rows cannot matter.
    cost = F.floor(F.col("cost") * 100_000 + 0.5).cast("long")
    length = F.floor(F.col("length") * 1_000_000 + 0.5).cast("long")
    totals = rows.where("edge >= 0").groupBy("req_id").agg(F.sum(cost).alias("c"), F.sum(length).alias("l"))
    seconds = F.floor(F.coalesce("c", F.lit(0)) * 60 / 100_000)
    return ended.join(totals, "req_id", "left").select(
        "req_id", "source", "target",
        F.when(F.col("option") != "distance", hms(seconds)).otherwise("N/A").alias("time"),
        round_to(F.coalesce("l", F.lit(0)) / 1_000_000, 2).alias("distance"),
    )


def walk_summary(rows: DataFrame, ended: DataFrame) -> DataFrame:
    """(req_id, source, target, time, distance) of walks, from the cost accumulated at the last row."""
    totals = rows.groupBy("req_id").agg(F.max_by("agg_cost", "seq").alias("total"))
    total = F.coalesce("total", F.lit(0.0))
    return ended.join(totals, "req_id", "left").select(
        "req_id", "source", "target", hms(total / WALK_METRES_PER_SECOND).alias("time"), round_to(total, 2).alias("distance")
    )


def route_features(rows: DataFrame, walk: bool = False) -> DataFrame:
    """(req_id, seq, feature): one GeoJSON feature per travelled edge; ``rows`` must carry ``geom`` (and ``length``)."""
    if walk:
        properties = {"cost": round_to(F.col("agg_cost") / WALK_METRES_PER_SECOND, 3), "length": round_to(F.col("cost"), 2)}
    else:
        properties = {"cost": round_to(F.col("cost"), 5), "length": F.col("length")}
    shaped = rows.where("geom is not null")
    return shaped.select("req_id", "seq", geojson.feature_json(geojson.line_geometry(F.col("geom")), properties).alias("feature"))


@dataclass
class RouteResult:
    """``rows`` in order of (req_id, seq), ``features`` as GeoJSON text, ``summary`` per request."""

    rows: DataFrame
    features: DataFrame
    summary: DataFrame


def route(router: Router, requests: DataFrame, goal_directed: bool = False, clip: float = CLIP_METRES) -> RouteResult:
    """Answer a batch of requests: (req_id, src_x, src_y, dst_x, dst_y, option, period), or without the last two for walks."""
    walk = WALK in router.blocks.costs
    ended = materialize(attach_ends(router, requests, clip), "ends")
    run = solve(router, ended, goal_directed)
    columns = ["geom"] if walk else ["length", "geom"]
    rows = materialize(route_rows(router, run, columns), "routes")
    summary = walk_summary(rows, ended) if walk else route_summary(rows, ended)
    return RouteResult(rows, route_features(rows, walk), summary)
