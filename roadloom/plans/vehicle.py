"""Vehicle graph: deduplicated nodes, directed edges, optional speeds and ferries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions import costs as C
from roadloom.functions import geometry as G
from roadloom.operators.ids import dense_id
from roadloom.sources.schemas import DISTANCE_COSTS, PERIODS, SPEED_EDGES, TIME_COSTS, VEHICLE_EDGES, VEHICLE_NODES
from roadloom.sources.scratch import materialize
from roadloom.sources.tables import conform

FERRY_ID_OFFSET = 6_000_000  # fixed value: ferry edges are numbered from here on, or from a multiple of it where there are more road edges


def vehicle_nodes(roadlink: DataFrame) -> DataFrame:
    """Distinct (key, point) of both link ends, numbered by key then position.

    Both ends come out of one scan; the dedup combines on the map side.
    """
    ends = F.array(
        F.struct(C.node_key(F.col("startnode"), F.col("startgradeseparation")).alias("node"), G.start_point(F.col("geom")).alias("p")),
        F.struct(C.node_key(F.col("endnode"), F.col("endgradeseparation")).alias("node"), G.end_point(F.col("geom")).alias("p")),
    )
    points = (
        roadlink.select(F.explode(ends).alias("e"))
        .select("e.node", F.col("e.p.x").alias("x"), F.col("e.p.y").alias("y"))
        .dropDuplicates()
    )
    return conform(dense_id(points, ["node", "x", "y"]), VEHICLE_NODES)


def _numbered_ends(roadlink: DataFrame, nodes: DataFrame, speeds: DataFrame | None) -> DataFrame:
    """(edge_id, row, source, target, speeds): narrow, so the joins and the numbering move few bytes."""
    ends = roadlink.select(
        "row", "ogc_fid",
        F.col("id").alias("roadlinkid"),
        C.node_key(F.col("startnode"), F.col("startgradeseparation")).alias("start_key"),
        C.node_key(F.col("endnode"), F.col("endgradeseparation")).alias("end_key"),
    )
    source = nodes.select(F.col("node").alias("start_key"), F.col("id").alias("source"))
    target = nodes.select(F.col("node").alias("end_key"), F.col("id").alias("target"))
    joined = ends.join(source, "start_key").join(target, "end_key").drop("start_key", "end_key")
    if speeds is not None:
        joined = joined.join(speeds, "roadlinkid", "left")
    return dense_id(joined, ["ogc_fid", "source", "target", "roadlinkid", "row"], "edge_id").drop("roadlinkid", "ogc_fid")


def vehicle_edges(roadlink: DataFrame, nodes: DataFrame, speeds: DataFrame | None = None) -> DataFrame:
    """Edge table; with ``speeds`` it gains a forward and a reverse time per period.

    The links with their geometry are written once, with a row number of their own, and shuffled once, to meet
    their numbered ends; so ``ogc_fid`` only orders, and may be repeated or NULL.
    """
    roadlink = materialize(roadlink.withColumn("row", F.monotonically_increasing_id()), "links")
    links = roadlink.select(
        "row",
        F.col("id").alias("fid"),
        F.col("roadname").alias("name"),
        F.col("alternatename").alias("alt_name"),
        F.col("roadclassificationnumber").alias("ref"),
        "roadclassification", "routehierarchy", "formofway", "operationalstate", "directionality", "length",
        C.forward_cost(F.col("directionality"), F.col("length")).alias("cost_distance"),
        C.reverse_cost(F.col("directionality"), F.col("length")).alias("reverse_cost_distance"),
        G.start_point(F.col("geom")).x.alias("x1"), G.start_point(F.col("geom")).y.alias("y1"),
        G.end_point(F.col("geom")).x.alias("x2"), G.end_point(F.col("geom")).y.alias("y2"),
        "geom",
    )
    edges = links.join(_numbered_ends(roadlink, nodes, speeds), "row")
    if speeds is not None:
        direction, length = F.col("directionality"), F.col("length")
        edges = edges.withColumns(
            {f"cost_time_{p}": C.forward_cost(direction, C.travel_minutes(length, F.col(f"{p}a"))) for p in PERIODS}
            | {f"reverse_cost_time_{p}": C.reverse_minutes(direction, length, F.col(f"{p}a"), F.col(f"{p}b")) for p in PERIODS}
        )
    edges = edges.withColumnRenamed("edge_id", "id").withColumns(G.box_columns(F.col("geom")))
    return conform(edges, VEHICLE_EDGES if speeds is None else SPEED_EDGES)


def ferry_terminals(elements: DataFrame) -> DataFrame:
    """One row per terminal that has a road node: all its element identifiers by role, then identifier."""
    return (
        elements.groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("role", "identifier"))).alias("e"), F.max(F.col("role") == "RoadNode").alias("road"))
        .where("road")
        .select("id", F.transform("e", lambda s: s.identifier).alias("element_href"))
    )


def terminal_ends(elements: DataFrame) -> DataFrame:
    """(ferry_node, road_node) of every terminal that has a road node: the first identifier of either role."""
    first = lambda role: F.min(F.when(F.col("role") == role, F.col("identifier")))
    return elements.groupBy("id").agg(first("FerryNode").alias("ferry_node"), first("RoadNode").alias("road_node")).where("road_node is not null").drop("id")


def ferry_edges(
    ferrylink: DataFrame, elements: DataFrame, nodes: DataFrame, timed: bool = False, offset: int = FERRY_ID_OFFSET
) -> DataFrame:
    """Ferry links as edges. A terminal whose road node is unknown gives a NULL end; one whose road node is at two places raises."""
    terminals = terminal_ends(elements).select("ferry_node", C.node_key(F.col("road_node"), F.lit(0)).alias("road_key"))
    ids = nodes.groupBy(F.col("node").alias("road_key")).agg(F.min("id").alias("road_id"), F.count("id").alias("places"))
    twice = F.raise_error(F.concat(F.lit("the road node of terminal element "), F.coalesce("ferry_node", F.lit("NULL")), F.lit(" is at more than one place")))
    terminals = terminals.join(ids, "road_key", "left").select("ferry_node", F.when(F.col("places") > 1, twice.cast("long")).otherwise(F.col("road_id")).alias("road_id"))
    start = terminals.select(F.col("ferry_node").alias("startnode"), F.col("road_id").alias("source"))
    end = terminals.select(F.col("ferry_node").alias("endnode"), F.col("road_id").alias("target"))
    crossings = ferrylink.join(start, "startnode").join(end, "endnode")
    numbered = dense_id(crossings, ["ogc_fid", "source", "target"], "edge_id", offset)

    length = G.line_length(F.col("geom"))
    none = F.array().cast("array<string>")
    edges = numbered.select(
        F.col("edge_id").alias("id"),
        F.col("id").alias("fid"),
        none.alias("name"),
        none.alias("alt_name"),
        F.lit("").alias("ref"),
        F.lit("").alias("roadclassification"),
        F.lit("Ferry Route").alias("routehierarchy"),
        F.lit("").alias("formofway"),
        F.lit("Open").alias("operationalstate"),
        F.lit(C.BOTH_WAYS).alias("directionality"),
        length.alias("length"),
        "source", "target",
        *[C.round_to(length, 2).alias(c) for c in DISTANCE_COSTS],
        *[F.lit(C.FERRY_MINUTES).alias(c) for c in (TIME_COSTS if timed else [])],
        G.start_point(F.col("geom")).x.alias("x1"), G.start_point(F.col("geom")).y.alias("y1"),
        G.end_point(F.col("geom")).x.alias("x2"), G.end_point(F.col("geom")).y.alias("y2"),
        "geom",
        *[c.alias(n) for n, c in G.box_columns(F.col("geom")).items()],
    )
    return conform(edges, SPEED_EDGES if timed else VEHICLE_EDGES)


def ferry_offset(edges: DataFrame) -> int:
    """The least multiple of ``FERRY_ID_OFFSET``, from the first on, that no road edge is numbered past. Reads the ids: hand over a written table."""
    last = edges.agg(F.max("id")).first()[0] or 0
    return FERRY_ID_OFFSET * max(1, -(-last // FERRY_ID_OFFSET))


def add_ferries(edges: DataFrame, ferries: DataFrame, offset: int | None = None) -> DataFrame:
    """Append ferry edges to an edge table of the same shape.

    A road edge numbered past the ferries' ``offset`` (the fixed one if left out) raises, and so does a ferry that is not.
    """
    offset = FERRY_ID_OFFSET if offset is None else offset
    clash = F.raise_error(F.lit(f"more than {offset} road edges: their ids would meet those of ferries")).cast("long")
    early = F.raise_error(F.lit(f"a ferry is numbered before {offset}, among the road edges")).cast("long")
    roads = edges.withColumn("id", F.when(F.col("id") <= offset, F.col("id")).otherwise(clash))
    boats = ferries.withColumn("id", F.when(F.col("id") > offset, F.col("id")).otherwise(early))
    return conform(roads, edges.schema).unionByName(conform(boats, edges.schema))


def speeds_long(edges: DataFrame) -> DataFrame:
    """Time costs as rows (edge, period, cost, reverse_cost) instead of twelve columns."""
    pairs = ", ".join(f"'{p}', cost_time_{p}, reverse_cost_time_{p}" for p in PERIODS)
    return edges.select("id", F.expr(f"stack({len(PERIODS)}, {pairs}) as (period, cost, reverse_cost)"))
