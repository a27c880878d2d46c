"""Nearest graph node of many points.

Node positions are kept in a pyramid of grid squares, eight by eight children
per square. Points walk down it, each keeping only the squares that can still
hold its nearest node, so the work per point is a handful of rows per level
wherever the nodes are dense or sparse. Only equi-joins are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.operators.skew import split_join
from roadloom.sources.scratch import materialize

FANOUT_BITS = 3  # a square has 2^3 by 2^3 children
LEAF_NODES = 64  # deepen the pyramid until no leaf square holds more positions
SMALL_LEVEL = 2  # has at most 64^2 squares and may be broadcast


@dataclass
class NodeIndex:
    """Distinct node positions with their leaf square, and the boxes of the occupied leaf squares."""

    leaves: DataFrame  # ix, iy, x, y, id
    boxes: DataFrame  # ix, iy, bx0, by0, bx1, by1
    depth: int
    top: list  # occupied squares of level 1 with their boxes, at most 64

    def level(self, d: int) -> DataFrame:
        """Occupied squares of level ``d`` (0 is the root) with tight boxes."""
        up = FANOUT_BITS * (self.depth - d)
        if up == 0:
            return self.boxes
        return self.boxes.groupBy(F.shiftright("ix", up).alias("ix"), F.shiftright("iy", up).alias("iy")).agg(
            F.min("bx0").alias("bx0"), F.min("by0").alias("by0"), F.max("bx1").alias("bx1"), F.max("by1").alias("by1")
        )


def node_index(nodes: DataFrame) -> NodeIndex:
    """Build the pyramid over ``nodes(id, x, y)``. Nodes sharing a position are met by their smallest id."""
    positions = materialize(nodes.groupBy("x", "y").agg(F.min("id").alias("id")), "positions")
    e = positions.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y"), F.count(F.lit(1))).first()
    if e[4] == 0:
        raise ValueError("no nodes to snap to")
    x0, y0, side = e[0], e[1], max(e[2] - e[0], e[3] - e[1], 1e-3)
    depth = max(1, math.ceil(math.log(max(e[4] / 16, 1), 4**FANOUT_BITS)))

    def squares(d: int) -> DataFrame:
        n = 1 << (FANOUT_BITS * d)
        at = lambda v, low: F.least(F.floor((F.col(v) - low) / side * n), F.lit(n - 1)).cast("long")
        return positions.select(at("x", x0).alias("ix"), at("y", y0).alias("iy"), "x", "y", "id")

    while squares(depth).groupBy("ix", "iy").count().agg(F.max("count")).first()[0] > LEAF_NODES:
        depth += 1
        if FANOUT_BITS * depth > 60:
            raise ValueError("positions are too close together for squares numbered in 64 bits")
    leaves = squares(depth)
    boxes = leaves.groupBy("ix", "iy").agg(
        F.min("x").alias("bx0"), F.min("y").alias("by0"), F.max("x").alias("bx1"), F.max("y").alias("by1")
    )
    index = NodeIndex(leaves, materialize(boxes, "squares"), depth, [])
    index.top = sorted(tuple(r) for r in index.level(1).select("ix", "iy", "bx0", "by0", "bx1", "by1").collect())
    return index


def _least(box, p) -> Column:
    """Squared distance to the nearest point of a box."""
    dx = F.greatest(box["bx0"] - p["px"], F.lit(0.0), p["px"] - box["bx1"])
    dy = F.greatest(box["by0"] - p["py"], F.lit(0.0), p["py"] - box["by1"])
    return dx * dx + dy * dy


def _most(box, p) -> Column:
    """Squared distance to the farthest point of a box."""
    dx = F.greatest(F.abs(box["bx0"] - p["px"]), F.abs(p["px"] - box["bx1"]))
    dy = F.greatest(F.abs(box["by0"] - p["py"]), F.abs(p["py"] - box["by1"]))
    return dx * dx + dy * dy


def _down(near: DataFrame, children: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Points with the children of their squares. Below the small levels a square that holds very many points is split."""
    if level <= SMALL_LEVEL:
        return near.join(F.broadcast(children), (F.col("ix") == F.col("pix")) & (F.col("iy") == F.col("piy")))
    return split_join(materialize(near, "near"), children.withColumnsRenamed({"pix": "ix", "piy": "iy"}), ["ix", "iy"], keys)


def snap(points: DataFrame, index: NodeIndex, keys: list[str]) -> DataFrame:
    """``points(keys..., px, py)`` → keys, node_id, d2: least squared distance, then smallest id.

    A square holds some node no farther than its box's far side, so squares
    nearer than the least such distance are the only ones worth opening.
    """
    names = ["ix", "iy", "bx0", "by0", "bx1", "by1"]
    here = {c: F.col(c) for c in ["px", "py", *names]}
    top = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in index.top])
    bound = F.array_min(F.transform(top, lambda b: _most(b, here)))
    near = (
        points.select(*keys, "px", "py", bound.alias("bound"))
        .select(*keys, "px", "py", F.explode(F.filter(top, lambda b: _least(b, here) <= F.col("bound"))).alias("s"))
        .select(*keys, "px", "py", "s.ix", "s.iy")
    )
    own = Window.partitionBy(*keys)
    for d in range(2, index.depth + 1):
        children = index.level(d).withColumns(
            {"pix": F.shiftright("ix", FANOUT_BITS), "piy": F.shiftright("iy", FANOUT_BITS)}
        ).withColumnsRenamed({"ix": "cx", "iy": "cy"})
        near = (
            _down(near, children, keys, d)
            .select(*keys, "px", "py", F.col("cx").alias("ix"), F.col("cy").alias("iy"), _least(here, here).alias("least"), _most(here, here).alias("most"))
            .withColumn("bound", F.min("most").over(own))
            .where("least <= bound")
            .select(*keys, "px", "py", "ix", "iy")
        )
    dx, dy = F.col("x") - F.col("px"), F.col("y") - F.col("py")
    return (
        split_join(materialize(near, "near"), index.leaves, ["ix", "iy"], keys)
        .groupBy(*keys)
        .agg(F.min(F.struct((dx * dx + dy * dy).alias("d2"), F.col("id").alias("node_id"))).alias("best"))
        .select(*keys, "best.node_id", "best.d2")
    )
