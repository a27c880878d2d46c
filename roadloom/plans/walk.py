"""Pedestrian graph: road links split at connecting nodes, joined with paths and connectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.functions import geometry as G
from roadloom.operators.ids import dense_id
from roadloom.operators.skew import split_join
from roadloom.operators.split import split_lines
from roadloom.sources.schemas import WALK_EDGES, WALK_NODES
from roadloom.sources.scratch import materialize
from roadloom.sources.tables import conform


def connecting_points(connectingnode: DataFrame) -> DataFrame:
    """(fid, x, y): members of the connecting nodes that name a road link."""
    return connectingnode.where("roadlink <> ''").select(F.col("roadlink").alias("fid"), F.explode("geom").alias("p")).select("fid", "p.x", "p.y")


def collect_connecting_nodes(connectingnode: DataFrame) -> DataFrame:
    """(roadlink, x, y): distinct points of each named link, one row per point, so no row holds all points of a link."""
    return connecting_points(connectingnode).dropDuplicates().withColumnRenamed("fid", "roadlink")


def split_road_links(roadlink: DataFrame, connectingnode: DataFrame) -> DataFrame:
    """(fid, n, type, routehierarchy, formofway, geom): pieces of every link some connecting node names."""
    points = connecting_points(connectingnode)
    named = points.select("fid").dropDuplicates()
    links = roadlink.select(F.col("id").alias("fid"), "geom", "routehierarchy", "formofway")
    lines = materialize(links.join(named, "fid", "left_semi"), "named-links")
    pieces = materialize(split_lines(lines.select("fid", "geom"), points), "pieces")
    return split_join(pieces, lines.select("fid", "routehierarchy", "formofway"), ["fid"], ["n"]).select(
        "fid", "n", F.lit("RoadLink").alias("type"), "routehierarchy", "formofway", "geom"
    )


def unsplit_road_links(roadlink: DataFrame, split: DataFrame) -> DataFrame:
    """Links with no row in ``split``, as single pieces."""
    return roadlink.join(split.select(F.col("fid").alias("id")), "id", "left_anti").select(
        F.col("id").alias("fid"), F.lit(1).cast("long").alias("n"), F.lit("RoadLink").alias("type"), "routehierarchy", "formofway", "geom"
    )


def network_geometry(roadlink: DataFrame, split: DataFrame, pathlink: DataFrame, connectinglink: DataFrame) -> DataFrame:
    """All walkable lines: unsplit links, pieces, paths, connectors."""
    blank = F.lit("")
    paths = pathlink.select(
        F.col("id").alias("fid"), F.lit(1).cast("long").alias("n"), F.lit("PathLink").alias("type"),
        blank.alias("routehierarchy"), "formofway", "geom",
    )
    connectors = connectinglink.select(
        F.col("id").alias("fid"), F.lit(1).cast("long").alias("n"), F.lit("ConnectingLink").alias("type"),
        blank.alias("routehierarchy"), blank.alias("formofway"), "geom",
    )
    return unsplit_road_links(roadlink, split).unionByName(split).unionByName(paths).unionByName(connectors)


def _end_key(p) -> list:
    return [G.to_mm(p.x).alias("x_mm"), G.to_mm(p.y).alias("y_mm")]


def walk_nodes(network: DataFrame) -> DataFrame:
    """Distinct end points to the millimetre, numbered in the order of their text form."""
    ends = F.array(*[F.struct(*_end_key(p)) for p in (G.start_point(F.col("geom")), G.end_point(F.col("geom")))])
    points = network.select(F.explode(ends).alias("e")).select("e.x_mm", "e.y_mm").dropDuplicates()
    x, y = F.col("x_mm") / 1000, F.col("y_mm") / 1000
    keyed = points.select(x.alias("x"), y.alias("y"), G.point_text(x, y).alias("p"))
    return conform(dense_id(keyed, ["p"]), WALK_NODES)


def walk_edges(network: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge table with the planar length as the cost of both directions.

    The network is written once with a row number of its own, since it is read twice (ends, then geometry); so
    (fid, type, n) only orders, and may be repeated.
    """
    network = materialize(network.withColumn("row", F.monotonically_increasing_id()), "network")
    key = ["fid", "type", "n"]
    keyed = nodes.select("id", G.to_mm(F.col("x")).alias("x_mm"), G.to_mm(F.col("y")).alias("y_mm"))
    start, end = G.start_point(F.col("geom")), G.end_point(F.col("geom"))
    ends = network.select(
        "row", *key,
        G.to_mm(start.x).alias("sx"), G.to_mm(start.y).alias("sy"), G.to_mm(end.x).alias("tx"), G.to_mm(end.y).alias("ty"),
    )
    ends = ends.join(keyed.toDF("source", "sx", "sy"), ["sx", "sy"]).join(keyed.toDF("target", "tx", "ty"), ["tx", "ty"])
    numbered = dense_id(ends.select("row", *key, "source", "target"), [*key, "source", "target", "row"]).drop(*key)
    length = G.line_length(F.col("geom"))
    edges = network.join(numbered, "row").withColumns(
        {
            "cost": length, "reverse_cost": length,
            "x1": start.x, "y1": start.y, "x2": end.x, "y2": end.y,
            **G.box_columns(F.col("geom")),
        }
    )
    return conform(edges, WALK_EDGES)
