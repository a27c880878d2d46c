"""Geometry operators against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadloom.functions import geometry as G
from roadloom.operators import clip, hull, snap
from roadloom.operators.split import cut_positions, split_lines

POINT3 = "fid string, x double, y double"
LINES = "fid string, geom array<struct<x:double,y:double>>"


def pieces(df):
    return {(r.fid, r.n): [(p.x, p.y) for p in r.geom] for r in df.collect()}


def test_split_cases(spark):
    lines = spark.createDataFrame([(k, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0)]) for k in ("mid", "vertex", "end", "off", "two")], LINES)
    points = spark.createDataFrame(
        [("mid", 4.0, 0.0), ("vertex", 10.0, 0.0), ("end", 10.0, 10.0), ("end", 0.0, 0.0), ("off", 5.0, 1.0),
         ("two", 10.0, 5.0), ("two", 5.0, 0.0), ("two", 5.0, 0.0), ("other", 1.0, 0.0)], POINT3)
    assert pieces(split_lines(lines, points)) == {
        ("mid", 1): [(0, 0), (4, 0)], ("mid", 2): [(4, 0), (10, 0), (10, 10)],
        ("vertex", 1): [(0, 0), (10, 0)], ("vertex", 2): [(10, 0), (10, 10)],
        ("end", 1): [(0, 0), (10, 0), (10, 10)], ("off", 1): [(0, 0), (10, 0), (10, 10)],
        ("two", 1): [(0, 0), (5, 0)], ("two", 2): [(5, 0), (10, 0), (10, 5)], ("two", 3): [(10, 5), (10, 10)],
    }


def test_split_one_line_with_very_many_cuts(spark):
    lines = spark.createDataFrame([("hot", [(0.0, 0.0), (4096.0, 0.0), (4096.0, 4096.0)]), ("cold", [(0.0, 0.0), (1.0, 1.0)])], LINES)
    cuts = spark.range(1, 4000).select(F.lit("hot").alias("fid"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"))
    got = split_lines(lines, cuts).withColumn("length", G.line_length(F.col("geom")))
    assert got.where("fid = 'hot'").count() == 4000
    assert got.where("fid = 'hot'").agg(F.sum("length"), F.max("n")).first() == (8192.0, 4000)
    assert got.where("fid = 'hot' and n < 4000 and length <> 1").count() == 0


def test_cuts_are_found_on_long_slanted_segments(spark):
    rng = random.Random(5)
    lines, points = [], []
    for k in range(60):
        a, b = (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)), (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000))
        lines.append((f"s{k}", [a, b]))
        for _ in range(8):
            t = rng.random()
            points.append((f"s{k}", a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
    for k, (dx, dy) in enumerate([(0.0, 640.0), (640.0, 0.0), (640.0, 640.0)]):
        lines.append((f"g{k}", [(64.0, 64.0), (64.0 + dx, 64.0 + dy)]))
        points += [(f"g{k}", 64.0 + dx * t / 10, 64.0 + dy * t / 10) for t in range(11)]
    found = cut_positions(spark.createDataFrame(lines, LINES), spark.createDataFrame(points, POINT3))
    counts = {r.fid: r["count"] for r in found.groupBy("fid").count().collect()}
    assert all(counts[f"s{k}"] == 8 for k in range(60))
    assert [counts[f"g{k}"] for k in range(3)] == [9, 9, 9]


def brute_nearest(points, nodes):
    return {k: min(((x - px) ** 2 + (y - py) ** 2, i) for i, x, y in nodes) for k, px, py in points}


@pytest.mark.parametrize("seed", [1, 2])
def test_snap_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    nodes = [(i, rng.uniform(0, 50_000), rng.uniform(0, 50_000)) for i in range(300)]
    nodes += [(300 + i, 20_000 + rng.gauss(0, 3), 20_000 + rng.gauss(0, 3)) for i in range(400)]  # dense
    nodes += [(700 + i, 123.0, 456.0) for i in range(350)]  # a third in one place
    points = [(i, rng.uniform(-9_000, 60_000), rng.uniform(-9_000, 60_000)) for i in range(80)]
    points += [(80 + i, 20_000 + rng.gauss(0, 4), 20_000 + rng.gauss(0, 4)) for i in range(80)] + [(200, 123.0, 456.0)]
    index = snap.node_index(spark.createDataFrame(nodes, "id long, x double, y double"))
    assert index.depth > 2
    got = snap.snap(spark.createDataFrame(points, "k long, px double, py double"), index, ["k"]).collect()
    assert {r.k: (r.d2, r.node_id) for r in got} == brute_nearest(points, nodes)


def test_snap_tie_takes_smallest_id_and_single_node(spark):
    nodes = spark.createDataFrame([(9, 0.0, 0.0), (4, 2.0, 0.0), (5, 2.0, 0.0)], "id long, x double, y double")
    points = spark.createDataFrame([(1, 1.0, 0.0)], "k long, px double, py double")
    assert snap.snap(points, snap.node_index(nodes), ["k"]).first().node_id == 4
    assert snap.snap(points, snap.node_index(nodes.where("id = 9")), ["k"]).first().node_id == 9


def test_clip_equals_brute_force(spark):
    rng = random.Random(3)
    box = lambda s: (lambda x, y: (x, y, x + rng.uniform(0, s), y + rng.uniform(0, s)))(rng.uniform(-5e3, 5e3), rng.uniform(-5e3, 5e3))
    edges = [(i, *box(3000 if i % 9 == 0 else 100)) for i in range(200)]
    reqs = [(i, *[rng.uniform(-5e3, 5e3) for _ in range(4)]) for i in range(30)]
    want = {
        (r[0], e[0]) for r in reqs for e in edges
        if e[3] >= min(r[1], r[3]) - 300 and e[1] <= max(r[1], r[3]) + 300 and e[4] >= min(r[2], r[4]) - 300 and e[2] <= max(r[2], r[4]) + 300
    }
    got = clip.clip(
        spark.createDataFrame(edges, "id long, xmin double, ymin double, xmax double, ymax double"),
        spark.createDataFrame(reqs, "req_id long, x1 double, y1 double, x2 double, y2 double"), 300,
    ).collect()
    assert len(got) == len(want) and {(r.req_id, r.edge) for r in got} == want


def inside(ring, p):
    """Whether p is in or on the closed ring."""
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        cross = (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
        if abs(cross) < 1e-6 and min(ax, bx) <= p[0] <= max(ax, bx) and min(ay, by) <= p[1] <= max(ay, by):
            return True
        if (ay > p[1]) != (by > p[1]) and p[0] < (bx - ax) * (p[1] - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def simple(ring):
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    sides = list(zip(ring, ring[1:]))
    for i, (a, b) in enumerate(sides):
        for c, d in sides[i + 1 :]:
            if cross(a, b, c) * cross(a, b, d) < 0 and cross(c, d, a) * cross(c, d, b) < 0:
                return False
    return len(set(ring[:-1])) == len(ring) - 1


def shapes(seed):
    rng = random.Random(seed)
    crescent = []
    for _ in range(900):
        t, r = rng.uniform(0, 1.6 * math.pi), rng.uniform(4000, 6000)
        crescent.append((round(r * math.cos(t), 3), round(r * math.sin(t), 3)))
    blob = [(round(rng.gauss(0, 2000), 3), round(rng.gauss(0, 2000), 3)) for _ in range(900)]
    grid = [(float(200 * i), float(200 * j)) for i in range(25) for j in range(25) if not (8 < i < 16 and j > 5)]
    return {"crescent": crescent, "blob": blob, "grid": grid}


def test_hull_properties(spark):
    sets = shapes(7)
    rows = [(k, x, y) for k, ps in sets.items() for x, y in ps] + [("line", float(i), float(i)) for i in range(5)] + [("pair", 0.0, 0.0), ("pair", 1.0, 0.0)]
    points = spark.createDataFrame(rows, "req_id string, x double, y double")
    convex = {r.req_id: r for r in hull.convex_hull(points).collect()}
    concave = {r.req_id: r for r in hull.concave_hull(points).collect()}
    again = {r.req_id: r for r in hull.concave_hull(points.repartition(7, "x")).collect()}
    assert set(convex) == set(concave) == set(sets)
    for k, ps in sets.items():
        ring = [(p.x, p.y) for p in concave[k].ring]
        assert ring[0] == ring[-1] and simple(ring)
        assert all(inside(ring, p) for p in ps)
        assert set(ring) <= set(ps)
        assert 0.85 * convex[k].area <= concave[k].area <= convex[k].area == concave[k].convex_area
        assert again[k] == concave[k]
    assert concave["crescent"].area < 0.9 * convex["crescent"].area
    assert concave["grid"].area < 0.95 * convex["grid"].area


def test_hull_corners_of_a_square():
    import numpy as np

    p = np.array([(x, y) for x in range(5) for y in range(5)], dtype=np.int64)
    assert hull.hull_corners(p).tolist() == [[0, 0], [4, 0], [4, 4], [0, 4]]


def test_corners_of_many_groups_at_once():
    import numpy as np

    r = np.random.default_rng(5)
    x = np.arange(400)
    shapes = [r.integers(0, side, (n, 2)) for n in (1, 2, 3, 40, 300) for side in (2, 9, 1 << 29)]
    shapes += [np.array([(3, 3)] * 4), np.stack([x, 2 * x], 1), np.stack([x, x * x], 1), np.vstack([np.stack([x, x * x], 1), [[400, -1]]])]
    p, who = np.vstack(shapes), np.repeat(np.arange(len(shapes)), [len(s) for s in shapes])
    order = r.permutation(len(p))
    rows = hull.corner_rows(who[order], p[order])
    for k, shape in enumerate(shapes):
        assert p[order][rows[who[order][rows] == k]].tolist() == hull.hull_corners(shape).tolist()


def test_squares_are_reduced_without_a_loop_over_them(monkeypatch):
    """Twenty thousand squares of a point or two each take one pass."""
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(hull, "hull_corners", None)
    monkeypatch.setattr(hull, "_chain", None)
    at = np.array([(x, y) for x in range(200) for y in range(200)], dtype=np.int64) * 200_000
    batch = pd.DataFrame({"req_id": np.arange(len(at)) % 7, "x_mm": at[:, 0], "y_mm": at[:, 1]})
    (fine,) = hull._reduce(hull.SQUARE_BITS)([batch])
    assert len(fine) == len(at)
    (wide,) = hull._reduce(hull.WIDEST_BITS)([batch])
    assert 4 * 7 <= len(wide) < 10 * 7


def test_outline_of_few_corners_equals_that_by_squares(monkeypatch):
    import numpy as np

    r = np.random.default_rng(9)
    for n in (5, 60, 700):
        p = r.integers(0, 6_000_000, (n, 2))
        squares = [hull.hull_corners(g) for g in hull._groups(p, p[:, 0] >> hull.SQUARE_BITS, p[:, 1] >> hull.SQUARE_BITS)]
        few = hull.dig(squares, 0.6)
        with monkeypatch.context() as m:
            m.setattr(hull, "FEW_CORNERS", 0)
            assert few.tolist() == hull.dig(squares, 0.6).tolist()


def test_outline_time_is_linear():
    """A hundred thousand reached nodes of one request take seconds, and four times the nodes not much more than four times as long."""
    import time

    import numpy as np

    def run(n):
        p = np.array([(x, y) for x in range(-n, n) for y in range(-n, n) if abs(x) + abs(y) < n], dtype=np.int64) * 150_000
        squares = [hull.hull_corners(g) for g in hull._groups(p, p[:, 0] >> hull.SQUARE_BITS, p[:, 1] >> hull.SQUARE_BITS)]
        start = time.perf_counter()
        ring = hull.dig(squares, 0.85)
        full = hull._double_area(hull.hull_corners(p))
        assert 0.85 * full <= hull._double_area(ring) < full
        return len(p), time.perf_counter() - start

    (few, short), (many, long) = run(112), run(225)
    assert few < 26_000 and many > 100_000 and long < 40 and long < 12 * short


def test_outline_in_larger_squares_than_one(spark):
    """Corners of the convex form survive both widths of squares, and points of one square alone suffice."""
    rows = [("far", x * 1e4, y * 1e4) for x in range(-7, 8) for y in range(-7, 8)] + [("near", x * 1.0, y * 1.0) for x in range(9) for y in range(9)]
    got = {r.req_id: r for r in hull.convex_hull(spark.createDataFrame(rows, "req_id string, x double, y double")).collect()}
    assert {(p.x, p.y) for p in got["far"].ring} == {(x, y) for x in (-7e4, 7e4) for y in (-7e4, 7e4)} and got["far"].area == 1.4e5**2
    assert {(p.x, p.y) for p in got["near"].ring} == {(0, 0), (8, 0), (8, 8), (0, 8)} and got["near"].area == 64


def test_curve_visits_neighbours_in_turn(spark):
    grid = spark.range(1024).select((F.col("id") % 32).alias("i"), F.floor(F.col("id") / 32).alias("j"))
    step = G.CURVE_METRES
    rows = grid.select("i", "j", G.curve_key(F.col("i") * step, F.col("j") * step).alias("k")).orderBy("k").collect()
    assert [b.k - a.k for a, b in zip(rows, rows[1:])] == [1] * 1023
    assert all(abs(a.i - b.i) + abs(a.j - b.j) == 1 for a, b in zip(rows, rows[1:]))


def test_written_joins_are_not_broadcast_by_the_size_of_files(spark, tmp_path, monkeypatch):
    """80,000 rows of one long run each: some KB in files, 10 MB in memory."""
    from pyspark.sql import DataFrameWriter
    from roadloom.sources import scratch

    path = str(tmp_path / "runs")
    spark.range(80_000, numPartitions=1).select("id", F.repeat(F.lit("x"), 100).alias("v")).write.parquet(path)
    runs = spark.read.parquet(path)
    joined = runs.join(spark.range(1_000_000).withColumnRenamed("id", "key"), F.col("id") == F.col("key"))
    plans, write = [], DataFrameWriter.parquet
    plan = lambda: joined.select("*")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (plans.append(plan()), write(self, *a, **k))[1])
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1m")
    try:
        before = {k: spark.conf.getAll.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
        assert scratch.materialize(joined, "joined").count() == 80_000
        assert {k: spark.conf.getAll.get(k) for k in before} == before
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0] and "BroadcastHashJoin" in plan()
