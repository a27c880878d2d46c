"""Block-wise shortest paths against a plain heap search."""

import heapq
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roadloom.operators import blocks as B

HOP = B.HOP
EDGE = "id long, source long, target long, c double, r double, t double, u double, xmin double, ymin double, xmax double, ymax double"


def make_graph(seed, hub=False):
    rng = random.Random(seed)
    side = 12
    nodes = [(i, 100.0 * (i % side) + rng.uniform(0, 30), 100.0 * (i // side) + rng.uniform(0, 30)) for i in range(side * side)]
    edges = []

    def add(a, b):
        c = rng.choice([50.0, 60.0, 100.0, 100.0, 140.5, 0.0])
        r = -1.0 if rng.random() < 0.25 else c
        if r > 0 and rng.random() < 0.2:
            c = -1.0
        (ax, ay), (bx, by) = nodes[a][1:], nodes[b][1:]
        t = None if rng.random() < 0.05 else rng.choice([0.1, 0.2, 0.30001])
        edges.append((len(edges), a, b, c, r, t, 0.25, min(ax, bx), min(ay, by), max(ax, bx), max(ay, by)))

    for i in range(side * side):
        if i % side < side - 1:
            add(i, i + 1)
        if i + side < side * side:
            add(i, i + side)
        if rng.random() < 0.1:
            add(i, rng.randrange(side * side))
        if rng.random() < 0.1:
            add(i, i + 1 if i + 1 < side * side else 0)  # parallel
    if hub:
        for i in range(0, side * side, 2):
            add(70, i)
            add(i, 70)
    nodes.append((side * side, 5000.0, 5000.0))  # no edges
    edges.append((len(edges), 3, None, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0))
    return nodes, edges


COSTS = {"way": B.Cost("c", "r", 1000), "time": B.Cost("t", "u", 1_000_000)}


def graph(spark, nodes, edges, rows):
    return B.block_graph(spark.createDataFrame(nodes, "id long, x double, y double"), spark.createDataFrame(edges, EDGE), COSTS, rows)


def out_arcs(edges, cost, box=None):
    f, r, scale = {"way": (3, 4, 1000), "time": (5, 6, 1_000_000)}[cost]
    out = {}
    for e in edges:
        if e[2] is None or e[1] == e[2]:
            continue
        if box and not (e[9] >= box[0] and e[7] <= box[2] and e[10] >= box[1] and e[8] <= box[3]):
            continue
        for a, b, c in ((e[1], e[2], e[f]), (e[2], e[1], e[r])):
            if c is not None and c >= 0:
                out.setdefault(a, []).append((b, int(c * scale + 0.5) * HOP + 1, e[0]))
    return out


def search(edges, source, cost, box=None, limit=None):
    """Labels and the (smallest edge, node) each is reached by."""
    out = out_arcs(edges, cost, box)
    dist, heap = {}, [(0, source)]
    while heap:
        d, n = heapq.heappop(heap)
        if n in dist or (limit is not None and d // HOP > limit):
            continue
        dist[n] = d
        for m, w, _ in out.get(n, []):
            if m not in dist:
                heapq.heappush(heap, (d + w, m))
    via = {source: (-1, -1)}
    for n in dist:
        for m, w, e in out.get(n, []):
            if dist.get(m) == dist[n] + w:
                via[m] = min(via.get(m, (1 << 60, 0)), (e, n))
    return dist, via


@pytest.mark.parametrize("hub,rows", [(False, 60), (True, 60), (False, 100_000)])
def test_labels_and_parents_equal_heap_search(spark, hub, rows):
    nodes, edges = make_graph(11, hub)
    g = graph(spark, nodes, edges, rows)
    wanted = [(i, s, c, None if i % 3 else 0.8 if c == "time" else 400.0) for i, (s, c) in enumerate([(0, "way"), (5, "time"), (70, "way"), (77, "time"), (143, "way"), (144, "way")])]
    run = B.spread(g, spark.createDataFrame(wanted, "req_id long, source long, cost string, max_cost double"))
    got = {}
    for r in B.labels(run).join(run.requests.select("req_no", "req_id"), "req_no").collect():
        assert (r.req_id, r.node) not in got
        got[r.req_id, r.node] = (r.label, r.edge, r.prev)
    want = {}
    for i, s, c, limit in wanted:
        scale = 1000 if c == "way" else 1_000_000
        dist, via = search(edges, s, c, limit=None if limit is None else int(limit * scale + 0.5))
        want |= {(i, n): (d, *via[n]) for n, d in dist.items()}
    assert got == want
    if rows == 60:
        homes = g.homes.where("v_hi > v_lo").count()
        assert homes == (1 if hub else 0)


@pytest.mark.parametrize("hub", [False, True])
def test_paths_equal_heap_search_with_and_without_bound(spark, hub):
    nodes, edges = make_graph(23, hub)
    g = graph(spark, nodes, edges, 60)
    rng = random.Random(4)
    asked = [(i, rng.randrange(144), rng.randrange(144), rng.choice(["way", "time"])) for i in range(90)]
    boxes = {i: (300.0, 200.0, 900.0, 1000.0) if i % 4 == 0 else None for i, *_ in asked}
    rows = [(i, s, t, c, *(boxes[i] or (None,) * 4)) for i, s, t, c in asked if s != t] + [(500, 0, 144, "way", *(None,) * 4), (501, 999, 3, "way", *(None,) * 4)]
    df = spark.createDataFrame(rows, "req_id long, source long, target long, cost string, lo_x double, lo_y double, hi_x double, hi_y double")
    want = {}
    for i, s, t, c, *_ in rows:
        dist, via = search(edges, s, c, boxes.get(i))
        n = t if t in dist and s < 900 else None
        while n is not None:
            want[i, n] = (dist[n], *via[n])
            n = via[n][1] if via[n][1] >= 0 else None
    assert want
    for goal_directed in (False, True):
        run = B.spread(g, df, goal_directed)
        got = B.paths(run).join(run.requests.select("req_no", "req_id"), "req_no").collect()
        assert len(got) == len(want)
        assert {(r.req_id, r.node): (r.label, r.edge, r.prev) for r in got} == want


def test_blocks_are_bounded_and_cover_every_arc_once(spark):
    nodes, edges = make_graph(5, hub=True)
    g = graph(spark, nodes, edges, 60)
    sizes = [r["count"] for r in g.arcs.groupBy("block").count().collect()]
    assert max(sizes) <= 2 * 60
    both = sum(len(v) for v in out_arcs(edges, "way").values())
    assert g.arcs.where(f"edge >= 0 and w_0 < {B.INF}").count() == both
    assert g.arcs.where("edge < 0").count() == len(nodes)


def test_requests_are_cut_into_full_shards(spark):
    nodes, edges = make_graph(5)
    g = graph(spark, nodes, edges, 60)
    df = spark.range(200).select(F.col("id").alias("req_id"), (F.col("id") % 144).alias("source"), F.lit("way").alias("cost"))
    sizes = sorted(r["count"] for r in B.number_requests(g, df).groupBy("shard").count().collect())
    assert sizes == [8, 64, 64, 64]


def test_a_step_reads_only_the_regions_it_works_in(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCKS_PER_REGION", 2)
    nodes, edges = make_graph(31)
    g = graph(spark, nodes, edges, 60)
    df = spark.createDataFrame([(1, 0, "way", 150.0)], "req_id long, source long, cost string, max_cost double")
    run = B.spread(g, df)
    woken = run.messages().where("step = 0").select("region", "shard", "block").distinct()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan(B._arcs_of(run, woken))
    assert "dynamicpruning" in plan(run.messages().join(woken, ["region", "shard", "block"], "left_semi"))


def test_a_search_keeps_the_weights_it_uses(spark):
    nodes, edges = make_graph(31)
    g = graph(spark, nodes, edges, 60)
    run = B.spread(g, spark.createDataFrame([(1, 0, "way")], "req_id long, source long, cost string"))
    assert "w_0" in run.arcs.columns and "w_1" not in run.arcs.columns
    assert run.steps > 1 and run.sent == run.messages().count()


def test_unwinding_takes_logarithmic_rounds(spark, monkeypatch):
    chains = [(f"a{i}", f"a{i + 1}") for i in range(37)] + [("b0", "b1"), ("x", "a30"), ("y", "x")]
    parents, ends = spark.createDataFrame(chains, "key string, parent string"), spark.createDataFrame([("a5",), ("y",), ("z",)], "key string")
    written = []
    keep = B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, label: written.append(label) or keep(df, label))
    got = {r.key for r in B.unwind(parents, ends).collect()}
    assert got == {f"a{i}" for i in range(5, 38)} | {"x", "y", "z"}
    assert written.count("pointers") <= 7  # a chain of 37 links


def test_paths_of_many_crossings_take_few_jobs(spark, monkeypatch):
    n = 120
    nodes = [(i, 10.0 * i, 0.0) for i in range(n)]
    edges = [(i, i, i + 1, 1.0, 1.0, 1.0, 1.0, 10.0 * i, 0.0, 10.0 * i + 10, 0.0) for i in range(n - 1)]
    g = graph(spark, nodes, edges, 9)
    run = B.spread(g, spark.createDataFrame([(1, 0, n - 1, "way")], "req_id long, source long, target long, cost string"))
    assert g.blocks > 30 and run.steps > 30
    written = []
    keep = B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, label: written.append(label) or keep(df, label))
    rows = sorted((r.label & (HOP - 1), r.node, r.edge) for r in B.paths(run).collect())
    assert rows == [(0, 0, -1)] + [(i, i, i - 1) for i in range(1, n)]
    assert len(written) < 20


def test_too_many_hops_raise():
    label = pd.DataFrame({"req_no": [0], "label": [5 * B.HOP + B.HOP - 3]})
    with pytest.raises(ValueError, match="edges or more"):
        B._open(label, SimpleNamespace(ids=np.arange(3)))


def test_no_requests_and_unknown_origins(spark):
    nodes, edges = make_graph(31)
    g = graph(spark, nodes, edges, 60)
    for rows in ([], [(1, 999, "way", 3)]):
        run = B.spread(g, spark.createDataFrame(rows, "req_id long, source long, cost string, target long"))
        assert run.reached().count() == B.labels(run).count() == B.paths(run).count() == 0


def boxed(i, source, target, cost, limit=None, margin=150.0, nodes=()):
    x, y = nodes[source][1:]
    return i, source, target, cost, limit, x - margin, y - margin, x + margin, y + margin


BOXED = "req_id long, source long, target long, cost string, max_cost double, lo_x double, lo_y double, hi_x double, hi_y double"


def test_boxed_requests_need_no_steps_and_equal_heap_search(spark):
    nodes, edges = make_graph(17, hub=True)
    g = graph(spark, nodes, edges, 60)
    asked = [boxed(i, (i * 29) % 145, None, ("way", "time")[i % 2], (None, 400.0, 0.8)[i % 3], 150.0 + 40 * (i % 7), nodes) for i in range(40)]
    run = B.spread(g, spark.createDataFrame(asked, BOXED))
    want = {}
    for i, s, _, c, limit, *box in asked:
        dist, via = search(edges, s, c, box, None if limit is None else int(limit * COSTS[c].scale + 0.5))
        want |= {(i, n): (d, *via[n], *nodes[n][1:]) for n, d in dist.items()}
    got = B.labels(run).join(run.requests.select("req_no", "req_id"), "req_no").collect()
    assert {(r.req_id, r.node): (r.label, r.edge, r.prev, r.x, r.y) for r in got} == want and len(got) == len(want)
    assert run.sent == 0  # before, boxes were searched block by block


@pytest.mark.parametrize("rows,most", [(1 << 18, 0), (150, 1), (0, 1)])
def test_boxes_with_many_arcs_go_by_steps_with_the_same_paths(spark, monkeypatch, rows, most):
    monkeypatch.setattr(B, "PARTY_ROWS", rows)
    monkeypatch.setattr(B, "PARTY_SLOTS", 1000)
    nodes, edges = make_graph(19)
    far = [(n + 200, x + 60_000.0, y) for n, x, y in nodes[:20]]  # a thin place, kept by the middle limit
    edges += [(e[0] + 1000, e[1] + 200, e[2] + 200, *e[3:7], e[7] + 60_000, e[8], e[9] + 60_000, e[10]) for e in edges if e[2] is not None and e[1] < 20 and e[2] < 20]
    g = graph(spark, nodes + far, edges, 60)
    place = {n: at for n, *at in nodes + far}
    pairs = [((i * 31) % 144, (i * 53 + 7) % 144) for i in range(30)] + [(200 + i, 219 - i) for i in range(9)]
    asked = [(i, s, t, ("way", "time")[i % 2], None, place[s][0] - 400, place[s][1] - 400, place[s][0] + 400, place[s][1] + 400) for i, (s, t) in enumerate(pairs) if s != t]
    want = {}
    for i, s, t, c, _, *box in asked:
        dist, via = search(edges, s, c, box)
        while t in dist:
            want[i, t] = (dist[t], *via[t])
            t = via[t][1]
    for goal_directed in (False, True):
        run = B.spread(g, spark.createDataFrame(asked, BOXED), goal_directed)
        who = run.requests.select("req_no", "req_id")
        got = B.paths(run).join(who, "req_no").collect()
        assert {(r.req_id, r.node): (r.label, r.edge, r.prev) for r in got} == want and len(got) == len(want)
        ends = {r.req_id: r.label for r in run.reached().join(who, "req_no").collect()}
        assert ends == {i: want[i, t][0] for i, _, t, *_ in asked if (i, t) in want}
        assert (run.sent > 0) == bool(most)
        parties = run.requests.where("party is not null").count()
        assert parties == (len(asked) if not most else 9 if rows else 0)


def test_areas_with_few_arcs_share_parties_of_more_than_the_least_size(spark, monkeypatch):
    nodes, edges = make_graph(23)
    g = graph(spark, nodes, edges, 60)
    asked = spark.createDataFrame([boxed(i, i % 144, None, "way", 100.0, 150.0, nodes) for i in range(4000)], BOXED)

    def largest():
        run = B.spread(g, asked)
        assert run.requests.where("party is null").count() == 0
        return run.requests.groupBy("party").count().agg(F.max("count")).first()[0]

    most = 1 + 4000 // (4 * spark.sparkContext.defaultParallelism)
    assert largest() == most > B.PARTY_AREAS  # before, the arcs were repeated for every 64
    monkeypatch.setattr(B, "PARTY_ROWS", 700)  # of which the boxes have about as many in reach
    assert B.PARTY_AREAS <= largest() < most


def test_parties_are_settled_in_all_parts(spark):
    """Parties of few bytes are not merged into one task."""
    nodes, edges = make_graph(29)
    asked = spark.createDataFrame([boxed(i, i, 143 - i, "way", None, 150.0, nodes) for i in range(144)], BOXED)
    run = B.spread(graph(spark, nodes, edges, 60), asked)
    assert run.requests.agg(F.countDistinct("party")).first()[0] > 8
    for found in (B._by_party(run, B._party_goals, B._GOAL), B._by_party(run, B._party_paths, B._PATH)):
        assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
