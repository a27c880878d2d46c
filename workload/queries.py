"""One query per operator, each with flat, comparable columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions import geometry as G, projection
from roadloom.operators import blocks as B, clip, hull, ids
from roadloom.plans import area, route, vehicle, walk
from roadloom.sources import requests as R, tables
from roadloom.sources.schemas import PERIODS
from roadloom.sources.scratch import materialize, new_folder
from workload.graph import Workload, workload

CLIP_TEST_METRES = 500.0  # small enough to cut something off at every scale

_QUERIES: dict = {}


def query(f):
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict:
    """Every query by name, as a function of the session and the data folder."""
    return {name: (lambda spark, sf_dir, f=f: f(workload(spark, sf_dir))) for name, f in _QUERIES.items()}


def _mm(c: str) -> Column:
    return G.to_mm(F.col(c)).alias(f"{c}_mm")


def _e(value: Column, places: int) -> Column:
    return F.floor(value * float(10**places) + 0.5).cast("long")


# --- tables -------------------------------------------------------------------------------------------------------


@query
def scan_roadlink(w: Workload) -> DataFrame:
    folder = new_folder(w.spark, "inputs")
    w.roadlink.write.parquet(f"{folder}/roadlink.parquet")
    links = tables.load(w.spark, folder, "roadlink")
    return links.select("ogc_fid", "id", "startnode", "endnode", "directionality", "length", F.size("geom").alias("n_vertices"))


@query
def table_roundtrip(w: Workload) -> DataFrame:
    path = new_folder(w.spark, "table")
    elements = w.table("ferryterminal_element")
    tables.save(elements.where("role = 'RoadNode'"), path)
    tables.save(elements.where("role = 'FerryNode'"), path)
    return tables.append(elements.where("role = 'RoadNode'"), path)


@query
def node_table(w: Workload) -> DataFrame:
    return w.nodes


@query
def edge_table_basic(w: Workload) -> DataFrame:
    return vehicle.vehicle_edges(w.roadlink, w.nodes).select(
        "id", "fid", "ref", "routehierarchy", "formofway", "operationalstate", "directionality", "length", "source", "target",
        "cost_distance", "reverse_cost_distance", "x1", "y1", "x2", "y2",
    )


@query
def edge_table_speeds(w: Workload) -> DataFrame:
    costs = [f"{way}cost_time_{p}" for p in PERIODS for way in ("", "reverse_")]
    return vehicle.vehicle_edges(w.roadlink, w.nodes, w.table("average_speeds")).select(
        "id", "fid", "source", "target", *[_e(F.col(c), 9).alias(f"{c}_e9") for c in costs]
    )


@query
def speeds_by_period(w: Workload) -> DataFrame:
    return vehicle.speeds_long(w.edges).select(
        "id", "period", _e(F.col("cost"), 9).alias("cost_e9"), _e(F.col("reverse_cost"), 9).alias("reverse_cost_e9")
    )


@query
def ferryterminal(w: Workload) -> DataFrame:
    """Every element of every terminal, by its place in the list."""
    terminals = vehicle.ferry_terminals(w.table("ferryterminal_element"))
    return terminals.select("id", F.posexplode("element_href").alias("place", "element")).withColumn("place", F.col("place").cast("long"))


@query
def ferry_edges(w: Workload) -> DataFrame:
    ferries = vehicle.ferry_edges(w.table("ferrylink"), w.table("ferryterminal_element"), w.nodes, timed=True)
    return ferries.select(
        "id", "fid", "source", "target", "routehierarchy", "operationalstate", "directionality", F.size("name").alias("n_names"),
        _mm("length"), _e(F.col("cost_distance"), 2).alias("cost_distance_e2"), "cost_time_weekend0719", "x1", "y1", "x2", "y2",
    )


@query
def connectingnode_used(w: Workload) -> DataFrame:
    return walk.connecting_points(w.table("connectingnode"))


@query
def collect_connectingnode(w: Workload) -> DataFrame:
    return walk.collect_connecting_nodes(w.table("connectingnode"))


def _pieces(df: DataFrame, *columns: str) -> DataFrame:
    start, end = G.start_point(F.col("geom")), G.end_point(F.col("geom"))
    return df.select(
        "fid", "n", *columns, G.piece_count(F.col("geom")).cast("long").alias("n_vertices"), G.to_mm(start.x).alias("x1_mm"), G.to_mm(start.y).alias("y1_mm"),
        G.to_mm(end.x).alias("x2_mm"), G.to_mm(end.y).alias("y2_mm"), G.to_mm(G.line_length(F.col("geom"))).alias("length_mm"),
    )


@query
def split_roadlink(w: Workload) -> DataFrame:
    return _pieces(walk.split_road_links(w.roadlink, w.table("connectingnode")))


@query
def non_split_roadlink(w: Workload) -> DataFrame:
    split = walk.split_road_links(w.roadlink, w.table("connectingnode"))
    return walk.unsplit_road_links(w.roadlink, split).select("fid", "n", "type", "routehierarchy", "formofway")


@query
def network_geom(w: Workload) -> DataFrame:
    return _pieces(w.network, "type", "routehierarchy", "formofway")


@query
def node_wkt(w: Workload) -> DataFrame:
    return w.walk_nodes.select("id", G.point_text(F.col("x"), F.col("y")).alias("point"))


@query
def edge_table_pedestrian(w: Workload) -> DataFrame:
    return w.walk_edges.select(
        "id", "type", "routehierarchy", "formofway", "source", "target", _mm("cost"), _mm("reverse_cost"), "x1", "y1", "x2", "y2"
    )


@query
def walkable_edges(w: Workload) -> DataFrame:
    return clip.without_hierarchy(w.walk_edges, clip.WALK_EXCLUDED).select("id", "routehierarchy")


@query
def duplicate_nodes(w: Workload) -> DataFrame:
    """Positions more than one vehicle node shares (grade-separated crossings)."""
    return ids.duplicates(w.nodes, ["x", "y"])


@query
def dense_id(w: Workload) -> DataFrame:
    speeds = w.table("average_speeds").select("roadlinkid")
    return ids.dense_id(speeds, [F.desc("roadlinkid")], offset=1000)


# --- functions ----------------------------------------------------------------------------------------------------


@query
def edge_endpoints(w: Workload) -> DataFrame:
    start, end = G.start_point(F.col("geom")), G.end_point(F.col("geom"))
    return w.roadlink.select("id", start.x.alias("x1"), start.y.alias("y1"), end.x.alias("x2"), end.y.alias("y2"))


@query
def line_length(w: Workload) -> DataFrame:
    return w.roadlink.select("id", G.to_mm(G.line_length(F.col("geom"))).alias("length_mm"))


@query
def to_lonlat(w: Workload) -> DataFrame:
    at = projection.to_lonlat(F.col("x"), F.col("y"))
    return w.nodes.select("id", at.alias("p")).select("id", _e(F.col("p.x"), 7).alias("lon_e7"), _e(F.col("p.y"), 7).alias("lat_e7"))


@query
def to_grid(w: Workload) -> DataFrame:
    """A longitude/latitude per customer, spread over the country."""
    places = w.sql("select c_custkey as point_id, -6 + (c_custkey*37%7000)/1000.0e0 as lon, 50 + (c_custkey*53%8000)/1000.0e0 as lat from customer")
    at = projection.to_grid(F.col("lon"), F.col("lat"))
    return places.select("point_id", at.alias("p")).select("point_id", G.to_mm(F.col("p.x")).alias("x_mm"), G.to_mm(F.col("p.y")).alias("y_mm"))


@query
def parse_requests(w: Workload) -> DataFrame:
    """Request text per supplier to points; a third point changes nothing."""
    text = w.sql(
        """select s_suppkey as req_id,
        concat('-', s_nationkey%4, '.', 1000+s_suppkey%9000, ' 5', s_nationkey%8, '.', 1000+(s_suppkey*7)%9000,
               ',-', s_nationkey%3, '.', 1000+(s_suppkey*3)%9000, ' 5', s_nationkey%7, '.', 1000+(s_suppkey*11)%9000, ',-1.5 51.5') as points
        from supplier"""
    )
    p = R.parse_points(F.col("points"))
    return text.select(
        "req_id", F.size(p).cast("long").alias("n_points"), p[0].lon.alias("lon1"), p[0].lat.alias("lat1"), p[1].lon.alias("lon2"), p[1].lat.alias("lat2")
    )


@query
def rejected_requests(w: Workload) -> DataFrame:
    """Request text per supplier, some of it faulty in one way or another."""
    text = w.sql(
        """select s_suppkey as req_id, concat('-1.', s_suppkey, ' 50.9', case s_suppkey%5 when 0 then '' when 1 then ',-1.2 north' else ',-1.2 51.1' end) as points,
        case s_suppkey%3 when 0 then 'distance' when 1 then 'time' else if(s_suppkey%2=0, 'fastest', null) end as option,
        if(s_suppkey%4=0, 'never', 'weekend0719') as period from supplier"""
    )
    return R.rejected_requests(text)


# --- graph operators ----------------------------------------------------------------------------------------------


@query
def snap_nearest(w: Workload) -> DataFrame:
    return route.snap_ends(w.index, w.requests).select("req_id", "role", "node_id", "d2")


@query
def clip_edges(w: Workload) -> DataFrame:
    ends = w.requests.select("req_id", F.col("src_x").alias("x1"), F.col("src_y").alias("y1"), F.col("dst_x").alias("x2"), F.col("dst_y").alias("y2"))
    return clip.clip(w.edges, ends, CLIP_TEST_METRES)


@query
def arcs_distance(w: Workload) -> DataFrame:
    forward, reverse = clip.cost_columns("distance")
    open_arcs = clip.arcs(w.edges, forward, reverse)
    return open_arcs.select("edge", "u", "v", clip.fixed_cost(F.col("cost"), B.METRE_SCALE).alias("w"))


@query
def arcs_by_period(w: Workload) -> DataFrame:
    each = None
    for p in PERIODS:
        one = clip.arcs(w.edges, *clip.cost_columns("time", p)).select(
            F.lit(p).alias("period"), "edge", "u", "v", clip.fixed_cost(F.col("cost"), B.MINUTE_SCALE).alias("w")
        )
        each = one if each is None else each.unionByName(one)
    return each


def _labels(run: B.Spread, *columns: str) -> DataFrame:
    return route.route_labels(run).select("req_id", *columns, "source", "target", "cost_fixed", "hops")


def _with(requests: DataFrame, option: str) -> DataFrame:
    return requests.withColumn("option", F.lit(option))


def _solve(router: route.Router, requests: DataFrame, goal_directed: bool = False) -> B.Spread:
    return route.solve(router, route.attach_ends(router, requests), goal_directed)


@query
def route_distance(w: Workload) -> DataFrame:
    return _labels(_solve(w.vehicles, _with(w.requests, "distance")))


@query
def route_time(w: Workload) -> DataFrame:
    return _labels(_solve(w.vehicles, _with(w.requests, "time")))


@query
def route_astar(w: Workload) -> DataFrame:
    return _labels(_solve(w.vehicles, w.requests, goal_directed=True), "cost_name")


@query
def route_walk(w: Workload) -> DataFrame:
    return _labels(_solve(w.walkers, w.requests))


@query
def route_reverse(w: Workload) -> DataFrame:
    return _labels(_solve(w.vehicles, _with(R.swap(w.requests), "distance")))


@query
def route_all_periods(w: Workload) -> DataFrame:
    ended = route.attach_ends(w.vehicles, w.requests)
    return _labels(route.solve(w.vehicles, R.every_choice(ended)), "cost_name")


@query
def route_edges(w: Workload) -> DataFrame:
    rows = route.route_rows(w.vehicles, _solve(w.vehicles, w.requests))
    return rows.select(
        "req_id", F.col("seq").cast("long").alias("seq"), "node", "edge", _e(F.col("cost"), 6).alias("cost_e6"), _e(F.col("agg_cost"), 5).alias("agg_cost_e5")
    )


@query
def route_summary(w: Workload) -> DataFrame:
    s = route.route(w.vehicles, w.requests).summary
    return s.select("req_id", "source", "target", "time", _e(F.col("distance"), 2).alias("distance_e2"))


@query
def route_response(w: Workload) -> DataFrame:
    result = route.route(w.vehicles, w.requests)
    answered = tables.responses(result.summary, result.features)
    return answered.select("req_id", "source", "target", "time", _e(F.col("distance"), 2).alias("distance_e2"), F.size("features").cast("long").alias("n_features"))


@query
def walk_summary(w: Workload) -> DataFrame:
    s = route.route(w.walkers, w.requests).summary
    return s.select("req_id", "source", "target", "time", _e(F.col("distance"), 2).alias("distance_e2"))


@query
def geojson_features(w: Workload) -> DataFrame:
    """Every coordinate of every feature."""
    rows = route.route_rows(w.vehicles, _solve(w.vehicles, w.requests), ["length", "geom"])
    features = route.route_features(rows)
    shape = "struct<type:string,properties:struct<cost:double,length:double>,geometry:struct<type:string,coordinates:array<array<double>>>>"
    f = features.select("req_id", F.col("seq").cast("long").alias("seq"), F.from_json("feature", shape).alias("f"))
    each = f.select("*", F.posexplode("f.geometry.coordinates").alias("place", "at"))
    return each.select(
        "req_id", "seq", F.col("f.geometry.type").alias("kind"), F.col("place").cast("long").alias("place"), _e(F.col("f.properties.cost"), 5).alias("cost_e5"),
        _e(F.col("at")[0], 7).alias("lon_e7"), _e(F.col("at")[1], 7).alias("lat_e7"),
    )


def _area_nodes(w: Workload) -> DataFrame:
    return area.area_nodes(area.spread_area(w.areas, area.attach_origin(w.areas, w.origins)))


@query
def service_area_nodes(w: Workload) -> DataFrame:
    return _area_nodes(w).select("req_id", "node", "cost_fixed")


@query
def service_area_edges(w: Workload) -> DataFrame:
    return area.area_edges(_area_nodes(w), w.areas.edges).select("req_id", "node", "edge", "cost_fixed")


@query
def area_summary(w: Workload) -> DataFrame:
    return area.service_area(w.areas, w.origins).summary


@query
def drive_time_bands(w: Workload) -> DataFrame:
    return area.drive_time_bands(w.areas, w.origins)


@query
def hull_convex(w: Workload) -> DataFrame:
    shapes = hull.convex_hull(area.area_points(_area_nodes(w)))
    return shapes.select(
        "req_id", F.size("ring").cast("long").alias("n_points"), G.to_mm(F.col("area")).alias("area_e3"), G.to_mm(F.col("convex_area")).alias("convex_area_e3")
    )


@query
def hull_concave(w: Workload) -> DataFrame:
    """Exact convex area, whether the ring closes and keeps its share of that area, and ring corners that are no reached node."""
    points = materialize(area.area_points(_area_nodes(w)), "area-points")
    shapes = materialize(hull.concave_hull(points), "outlines")
    at = [G.to_mm(F.col(c)).alias(f"{c}_mm") for c in ("x", "y")]
    corners = shapes.select("req_id", F.explode("ring").alias("p")).select("req_id", "p.x", "p.y").select("req_id", *at)
    foreign = corners.join(points.select("req_id", *at).dropDuplicates(), ["req_id", "x_mm", "y_mm"], "left_anti").groupBy("req_id").agg(F.count(F.lit(1)).alias("n"))
    return shapes.join(foreign, "req_id", "left").select(
        "req_id", G.to_mm(F.col("convex_area")).alias("convex_area_e3"), (F.col("ring")[0] == F.element_at("ring", -1)).alias("closed"),
        (F.col("area") / F.col("convex_area")).between(hull.TARGET_SHARE, 1).alias("share_kept"), F.coalesce("n", F.lit(0)).cast("long").alias("n_foreign"),
    )


@query
def service_area(w: Workload) -> DataFrame:
    features = area.service_area(w.areas, w.origins).features
    kind = F.get_json_object("feature", "$.geometry.type").alias("kind")
    return features.select("req_id", kind).groupBy("req_id", "kind").agg(F.count(F.lit(1)).alias("features"))
