"""Graph builds on hand-written links."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from roadloom.operators.ids import dense_id, duplicates
from roadloom.plans import vehicle, walk
from roadloom.sources import tables
from roadloom.sources.schemas import AVERAGE_SPEEDS, FERRYLINK, FERRYTERMINAL_ELEMENT, INPUTS, PERIODS, ROADLINK


def links(spark, rows):
    """rows: (ogc_fid, direction, length, start, start grade, end, end grade, points)"""
    full = [
        (i, f"L{i}", [f"Road {i}"], [], "A1", None, "Local Road", "Road", "Open", d, float(m), s, sg, e, eg, [(float(x), float(y)) for x, y in g])
        for i, d, m, s, sg, e, eg, g in rows
    ]
    return spark.createDataFrame(full, ROADLINK)


def speeds(spark, rows):
    full = [(link, *[None if v is None else float(v) for _ in PERIODS for v in (a, b)]) for link, a, b in rows]
    return spark.createDataFrame(full, AVERAGE_SPEEDS)


def test_dense_id_counts_over_the_whole_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit(1).alias("same"))
    got = dense_id(df, ["same", "k"], "n", offset=10).orderBy("k").select("n").toPandas()["n"].tolist()
    assert got == list(range(11, 5011))


def test_nodes_keep_grades_and_geometries_apart(spark):
    rl = links(spark, [
        (1, "both directions", 10, "A", 0, "B", 0, [(0, 0), (10, 0)]),
        (2, "both directions", 10, "B", 1, "C", None, [(10, 0), (20, 0)]),
        (3, "both directions", 10, "A", 0, "D", 0, [(0, 5), (20, 5)]),
    ])
    nodes = vehicle.vehicle_nodes(rl).orderBy("id").collect()
    assert [(r.id, r.node, r.x, r.y) for r in nodes] == [
        (1, "A0", 0, 0), (2, "A0", 0, 5), (3, "B0", 10, 0), (4, "B1", 10, 0), (5, "C", 20, 0), (6, "D0", 20, 5),
    ]


def test_one_key_with_two_places_fans_edges_out(spark):
    rl = links(spark, [
        (1, "both directions", 10, "A", 0, "B", 0, [(0, 0), (10, 0)]),
        (3, "both directions", 10, "A", 0, "D", 0, [(0, 5), (20, 5)]),
    ])
    nodes = vehicle.vehicle_nodes(rl)
    edges = vehicle.vehicle_edges(rl, nodes).orderBy("id").collect()
    assert [(e.id, e.fid, e.source, e.target) for e in edges] == [(1, "L1", 1, 3), (2, "L1", 2, 3), (3, "L3", 1, 4), (4, "L3", 2, 4)]
    assert duplicates(nodes, ["node"]).collect()[0].copies == 2


def test_costs_by_direction_and_speed(spark):
    rl = links(spark, [
        (1, "in direction", 1000, "A", 0, "B", 0, [(0, 0), (10, 0)]),
        (2, "in opposite direction", 1000, "B", 0, "C", 0, [(10, 0), (20, 0)]),
        (3, "both directions", 1000, "C", 0, "D", 0, [(20, 0), (30, 0)]),
        (4, "both directions", 1000, "D", 0, "E", 0, [(30, 0), (40, 0)]),
    ])
    sp = speeds(spark, [("L1", 20, 30), ("L2", 20, 30), ("L3", 20, 30), ("L4", None, 0)])
    e = {r.fid: r for r in vehicle.vehicle_edges(rl, vehicle.vehicle_nodes(rl), sp).collect()}
    at = lambda kmh: 1000 / 1000 / kmh * 60
    p = PERIODS[3]
    pair = lambda r: (r[f"cost_time_{p}"], r[f"reverse_cost_time_{p}"])
    assert (e["L1"].cost_distance, e["L1"].reverse_cost_distance) == (1000, -1)
    assert (e["L2"].cost_distance, e["L2"].reverse_cost_distance) == (-1, 1000)
    assert pair(e["L1"]) == pytest.approx((at(20.01), -1))
    assert pair(e["L2"]) == pytest.approx((-1, at(20.01)))
    assert pair(e["L3"]) == pytest.approx((at(20.01), at(30.01)))
    assert pair(e["L4"]) == pytest.approx((at(48), at(0.01)))
    assert (e["L1"].xmin, e["L1"].xmax) == (0, 10)


def test_ferries_take_ends_from_terminals(spark):
    rl = links(spark, [(1, "both directions", 10, "A", 0, "B", 0, [(0, 0), (10, 0)])])
    nodes = vehicle.vehicle_nodes(rl)
    elements = spark.createDataFrame(
        [("T1", "F1", "FerryNode"), ("T1", "A", "RoadNode"), ("T2", "B", "RoadNode"), ("T2", "F2", "FerryNode"),
         ("T3", "F3", "FerryNode"), ("T4", "F4", "FerryNode"), ("T4", "gone", "RoadNode")], FERRYTERMINAL_ELEMENT)
    boats = spark.createDataFrame(
        [(1, "X1", "F1", "F2", [(0.0, 0.0), (3.0, 4.004)]), (2, "X2", "F1", "F3", [(0.0, 0.0), (1.0, 0.0)]), (3, "X3", "F4", "F1", [(0.0, 0.0), (1.0, 0.0)])],
        FERRYLINK)
    got = vehicle.ferry_edges(boats, elements, nodes, timed=True).orderBy("id").collect()
    assert [(r.id, r.fid, r.source, r.target) for r in got] == [(6000001, "X1", 1, 2), (6000002, "X3", None, 1)]
    assert got[0].cost_distance == 5.0 and got[0].cost_time_weekend0719 == 1.0 and got[0].name == [] and got[0].ref == ""
    both = vehicle.add_ferries(vehicle.vehicle_edges(rl, nodes, speeds(spark, [])), vehicle.ferry_edges(boats, elements, nodes, timed=True))
    assert both.count() == 3


def test_walk_graph_joins_pieces_paths_and_connectors(spark):
    rl = links(spark, [
        (1, "in direction", 10, "A", 0, "B", 0, [(0, 0), (10, 0)]),
        (2, "both directions", 10, "B", 0, "C", 0, [(10, 0), (20, 0)]),
    ])
    cn = spark.createDataFrame([("L1", [(4.0, 0.0)]), ("", [(1.0, 0.0)]), (None, [(2.0, 0.0)])], INPUTS["connectingnode"])
    pl = spark.createDataFrame([("P1", "Path", [(4.0, 3.0), (8.0, 6.0)])], INPUTS["pathlink"])
    cl = spark.createDataFrame([("C1", [(4.0, 0.0), (4.0, 3.0)])], INPUTS["connectinglink"])
    split = walk.split_road_links(rl, cn)
    net = walk.network_geometry(rl, split, pl, cl).cache()
    nodes = walk.walk_nodes(net)
    edges = walk.walk_edges(net, nodes).orderBy("id").collect()
    assert [(e.type, round(e.cost, 6), e.reverse_cost == e.cost) for e in edges] == [
        ("ConnectingLink", 3, True), ("RoadLink", 4, True), ("RoadLink", 6, True), ("RoadLink", 10, True), ("PathLink", 5, True)]
    assert nodes.count() == 6
    where = {r.id: (r.x, r.y) for r in nodes.collect()}
    assert all(where[e.source] == (e.x1, e.y1) and where[e.target] == (e.x2, e.y2) for e in edges)


def test_save_replaces_and_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(spark.createDataFrame([(1, "a")], "k long, v string"), path)
    tables.save(spark.createDataFrame([(2, "b")], "k long, v string"), path)
    assert sorted(tables.append(spark.createDataFrame([("c", 3)], "v string, k int"), path).collect()) == [(2, "b"), (3, "c")]


def test_many_connecting_nodes_of_one_link_stay_rows(spark):
    at = F.struct((F.col("id") % 500).cast("double").alias("x"), F.lit(0.0).alias("y"))
    cn = spark.range(1000).select(F.lit("hot").alias("roadlink"), F.array(at).alias("geom"))
    assert sorted(walk.collect_connecting_nodes(cn).collect()) == [("hot", float(i), 0.0) for i in range(500)]


def test_repeated_and_missing_ogc_fid(spark):
    from workload.graph import Workload

    w = Workload(spark, SMALL, rows_per_block=200)
    links = w.roadlink.where("ogc_fid <= 40")
    odd = links.withColumn("ogc_fid", F.when(F.col("ogc_fid") > 5, F.lit(7).cast(links.schema["ogc_fid"].dataType)))
    nodes = vehicle.vehicle_nodes(links)
    plain, got = vehicle.vehicle_edges(links, nodes).collect(), vehicle.vehicle_edges(odd, nodes).collect()
    assert sorted((r.fid, r.source, r.target, r.length) for r in got) == sorted((r.fid, r.source, r.target, r.length) for r in plain)
    assert sorted(r.id for r in got) == list(range(1, len(plain) + 1))


def test_terminals_keep_all_elements_and_ends_go_by_role(spark):
    rows = [("t0", "FerryNode", "Fz"), ("t2", "FerryNode", "F1"), ("t2", "RoadNode", "N1"), ("t5", "FerryNode", "Fa"), ("t5", "FerryNode", "Fb"), ("t5", "RoadNode", "N2"), ("t5", "RoadNode", "N3"), ("t1", "RoadNode", "N4")]
    elements = spark.createDataFrame(rows, "id string, role string, identifier string")
    assert {r.id: r.element_href for r in vehicle.ferry_terminals(elements).collect()} == {"t2": ["F1", "N1"], "t5": ["Fa", "Fb", "N2", "N3"], "t1": ["N4"]}
    assert {(r.ferry_node, r.road_node) for r in vehicle.terminal_ends(elements).collect()} == {("F1", "N1"), ("Fa", "N2"), (None, "N4")}


def test_road_ids_past_the_ferry_offset_raise(spark):
    from pyspark.errors import PySparkException

    edges = spark.createDataFrame([(vehicle.FERRY_ID_OFFSET + 1,)], "id long")
    with pytest.raises(PySparkException, match="road edges"):
        vehicle.add_ferries(edges, edges).collect()


def test_ferries_are_numbered_past_all_road_edges(spark, monkeypatch):
    from workload.graph import Workload

    monkeypatch.setattr(vehicle, "FERRY_ID_OFFSET", 2)
    w = Workload(spark, SMALL)
    w._tables = {
        "roadlink": links(spark, [(i, "both directions", 10, f"N{i}", 0, f"N{i + 1}", 0, [(10 * i, 0), (10 * i + 10, 0)]) for i in range(1, 6)]),
        "average_speeds": speeds(spark, []),
        "ferrylink": spark.createDataFrame([(1, "X1", "F1", "F2", [(0.0, 0.0), (3.0, 4.0)])], FERRYLINK),
        "ferryterminal_element": spark.createDataFrame(
            [("T1", "F1", "FerryNode"), ("T1", "N1", "RoadNode"), ("T2", "F2", "FerryNode"), ("T2", "N3", "RoadNode")], FERRYTERMINAL_ELEMENT),
    }
    got = [(e.id, e.fid) for e in w.edges.orderBy("id").collect()]
    assert got == [(1, "L1"), (2, "L2"), (3, "L3"), (4, "L4"), (5, "L5"), (7, "X1")]


def test_ferry_offset_follows_the_road_edges(spark):
    at = lambda *ids: vehicle.ferry_offset(spark.createDataFrame([(i,) for i in ids], "id long"))
    first = vehicle.FERRY_ID_OFFSET
    assert [at(), at(1), at(1, first), at(first + 1), at(5, 2 * first), at(2 * first + 1)] == [first, first, first, 2 * first, 2 * first, 3 * first]


def test_a_ferry_among_the_road_edges_raises(spark):
    from pyspark.errors import PySparkException

    road, ferry = (spark.createDataFrame([(i,)], "id long") for i in (vehicle.FERRY_ID_OFFSET + 1, vehicle.FERRY_ID_OFFSET + 2))
    with pytest.raises(PySparkException, match="a ferry is numbered"):
        vehicle.add_ferries(road, ferry, 2 * vehicle.FERRY_ID_OFFSET).collect()
