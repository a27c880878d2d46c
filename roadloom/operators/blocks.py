"""Batch shortest paths over a graph cut into bounded blocks.

The arcs are numbered along a space-filling curve and cut into blocks of a
fixed number of rows, so no block grows with the data however dense a place
is. A node with more arcs than a block holds spans several blocks and is only
ever reached by messages. Requests are numbered the same way and cut into
shards of a fixed size. One step works on the (shard, block) groups that got new
messages: the arcs of their blocks are joined to them, labels settle inside the
block, and labels that cross to another block are written as messages. Only messages
are kept between steps; labels inside a block are always recomputed from them, so a
lost task costs one block. Arcs and messages are stored by region, so a step reads
those of the regions it works in.

Most requests are asked within a box. Those whose box holds a bounded number of arcs need no steps: requests with boxes of
about one size in one place form a party, the arcs that meet the party's box are joined to it through squares of that size,
and the party is settled in one group, each request within its own box. Only the others go block by block.

Paths are unwound from the messages: one pass over the groups finds, for every
message, the message it goes back to; pointer doubling marks those on a path to a
goal; one more pass expands all their blocks at once. The number of jobs grows with
the logarithm of the blocks a path crosses.

A label is ``cost * 2^20 + hops`` with the cost in whole units, so sums are exact
and ties go to fewer hops. Among equal labels the smallest edge id wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roadloom.functions.geometry import curve_key, overlaps
from roadloom.operators.clip import fixed_cost
from roadloom.operators.ids import dense_id
from roadloom.sources.scratch import materialize, new_folder, shuffle_partitions

HOP_BITS = 20
HOP = 1 << HOP_BITS
INF = 1 << 61
FAR = 1e15  # metres; stands for "no box"
ROWS_PER_BLOCK = 65_536
REQUESTS_PER_SHARD = 64
BLOCKS_PER_REGION = 256  # arcs and messages are stored by region, so a step reads only the regions it works in
PARTY_ROWS = 1 << 18  # arcs joined to a party at most; requests with more of them in reach go block by block
PARTY_REQUESTS = 1024  # at most; they share the arcs joined to the party
PARTY_AREAS = 64  # where all labels are wanted and not one goal's: at most with the most arcs, more with fewer
PARTY_SLOTS = 1 << 22  # labels held at once while a party settles
LEAST_LEVEL, MOST_LEVEL = 13, 22  # boxes of 8 to 4,194 km go by parties, counted by powers of two
BOUND_SHRINK = 1 - 1e-6  # keeps the straight-line bound below the true cost despite rounding

METRE_SCALE = 1_000  # millimetres
MINUTE_SCALE = 1_000_000

_ARC = "region long, block long, edge long, u long, v long, v_lo long, v_hi long, x double, y double, xmin double, ymin double, xmax double, ymax double"
_MESSAGE = "shard long, block long, req_no long, node long, label long, edge long, prev long, prev_block long, goal boolean"
_TREE = "req_no long, node long, label long, edge long, prev long, x double, y double"
_PATH = "req_no long, node long, label long, edge long, prev long"
_ENTRY = "req_no long, block long, node long, entry long"


@dataclass
class Cost:
    """A pair of edge columns and the number of whole units in one unit of cost."""

    forward: str
    reverse: str
    scale: int


@dataclass
class BlockGraph:
    arcs: DataFrame  # _ARC, the place vx, vy of v, and one weight column w_<i> per cost
    homes: DataFrame  # node, v_lo, v_hi, x, y
    costs: dict[str, Cost]
    rate: dict[str, float]  # least cost units per straight metre of any arc
    blocks: int

    def index(self, cost: str) -> int:
        return list(self.costs).index(cost)


def _region(block: Column) -> Column:
    return F.floor(block / BLOCKS_PER_REGION).cast("long")


def block_graph(nodes: DataFrame, edges: DataFrame, costs: dict[str, Cost], rows_per_block: int = ROWS_PER_BLOCK) -> BlockGraph:
    """Expand edges to weighted arcs and assign them to blocks.

    Build once per graph; every request batch reuses it. Each node also gets one
    row without an edge, so nodes with no way out have a home block too.
    """
    names = list(costs)
    weights = [f"w_{i}" for i in range(len(names))]

    def weight(column: str, scale: int) -> Column:
        return F.coalesce(fixed_cost(F.col(column), scale) * HOP + 1, F.lit(INF))

    box = ["xmin", "ymin", "xmax", "ymax"]
    there = [weight(costs[n].forward, costs[n].scale).alias(w) for n, w in zip(names, weights)]
    back = [weight(costs[n].reverse, costs[n].scale).alias(w) for n, w in zip(names, weights)]
    ends = F.array(
        F.struct(F.col("source").alias("u"), F.col("target").alias("v"), *there),
        F.struct(F.col("target").alias("u"), F.col("source").alias("v"), *back),
    )
    opened = (
        edges.where("source is not null and target is not null and source <> target")
        .select(F.col("id").alias("edge"), *box, F.explode(ends).alias("a"))
        .select("edge", *box, "a.*")
        .where(F.least(*weights, F.lit(INF)) < INF)
    )
    anchors = nodes.select(
        F.lit(-1).cast("long").alias("edge"), *[F.lit(0.0).alias(b) for b in box], F.col("id").alias("u"), F.col("id").alias("v"),
        *[F.lit(INF).alias(w) for w in weights],
    )
    at = nodes.select(F.col("id").alias("u"), "x", "y", curve_key(F.col("x"), F.col("y")).alias("key"))
    rows = opened.unionByName(anchors).join(at, "u")
    numbered = dense_id(rows, ["key", "u", "edge", "v"], "no", offset=-1).drop("key")

    first, last = F.floor(F.min("no") / rows_per_block), F.floor(F.max("no") / rows_per_block)
    wide = F.max("no") - F.min("no") >= rows_per_block
    homes = materialize(
        numbered.groupBy(F.col("u").alias("node"))
        .agg(first.cast("long").alias("v_lo"), F.when(wide, last).otherwise(first).cast("long").alias("v_hi"), F.first("x").alias("x"), F.first("y").alias("y")),
        "homes",
    )
    u_home = homes.select(F.col("node").alias("u"), F.col("v_lo").alias("u_lo"), F.col("v_hi").alias("u_hi"))
    v_home = homes.select(F.col("node").alias("v"), "v_lo", "v_hi", F.col("x").alias("vx"), F.col("y").alias("vy"))
    block = F.when(F.col("u_lo") == F.col("u_hi"), F.col("u_lo")).otherwise(F.floor(F.col("no") / rows_per_block)).cast("long")
    dx, dy = F.col("x") - F.col("vx"), F.col("y") - F.col("vy")
    chord = F.sqrt(dx * dx + dy * dy)
    placed = materialize(
        numbered.join(u_home, "u").join(v_home, "v")
        .select(_region(block).alias("region"), block.alias("block"), "edge", "u", "v", "v_lo", "v_hi", "x", "y", "vx", "vy", *box, *weights, chord.alias("chord"))
        .repartition("block"),
        "arcs", ["region"],
    )
    rates = placed.agg(
        *[F.min(F.when((F.col("chord") > 0) & (F.col(w) < INF), F.shiftright(w, HOP_BITS) / F.col("chord"))).alias(w) for w in weights],
        F.max("block").alias("last"),
    ).first()
    return BlockGraph(
        placed.drop("chord"), homes, dict(costs), {n: (rates[w] or 0.0) * BOUND_SHRINK for n, w in zip(names, weights)},
        1 + (rates["last"] or 0),
    )


# --- inside one block ---------------------------------------------------------------------------------------------


class _Arcs:
    """Arcs of one block as arrays, the same for all requests."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["v", "edge", "u"])
        self.number = int(rows["arc_block"].iat[0])
        self.ids, at = np.unique(rows["u"].to_numpy(), return_index=True)
        self.x, self.y = rows["x"].to_numpy()[at], rows["y"].to_numpy()[at]
        anchor = rows["edge"].to_numpy() < 0
        self.owned = np.isin(self.ids, rows["u"].to_numpy()[anchor])
        rows = rows[~anchor]
        inside = (rows["v_lo"].to_numpy() == self.number) & (rows["v_hi"].to_numpy() == self.number)
        self.inner = rows[inside]
        self.outer = rows[~inside]
        self._link()

    def _link(self) -> None:
        inner = self.inner
        self.edge, self.u_id = inner["edge"].to_numpy(), inner["u"].to_numpy()
        self.u, self.v = self.at(inner["u"]), self.at(inner["v"])
        self.table = np.stack([inner[c].to_numpy() for c in inner.columns if c.startswith("w_")])
        self.xmin, self.ymin, self.xmax, self.ymax = (inner[c].to_numpy() for c in ("xmin", "ymin", "xmax", "ymax"))
        # Arcs by the node they leave and, as they are sorted, by the node they enter.
        self.leaving = np.argsort(self.u, kind="stable")
        self.leave_from = np.searchsorted(self.u[self.leaving], np.arange(len(self.ids) + 1))
        self.enter_from = np.searchsorted(self.v, np.arange(len(self.ids) + 1))

    def at(self, nodes) -> np.ndarray:
        return np.searchsorted(self.ids, np.asarray(nodes))


class _Around(_Arcs):
    """The arcs that meet a party's box; every node is inner and owned."""

    def __init__(self, rows: pd.DataFrame, requests: pd.DataFrame):
        self.number, self.inner = -1, rows.sort_values(["v", "edge", "u"])
        nodes = np.concatenate([rows["u"], rows["v"], requests["source"]]).astype(np.int64)
        self.ids, at = np.unique(nodes, return_index=True)
        self.x = np.concatenate([rows["x"], rows["vx"], requests["sx"]])[at]
        self.y = np.concatenate([rows["y"], rows["vy"], requests["sy"]])[at]
        self.owned = np.ones(len(self.ids), bool)
        self._link()


class _Block:
    """One block with the requests that have labels in it.

    Labels are kept flat, one per (node, request): ``slot = node * requests + request``.
    """

    def __init__(self, arcs: _Arcs, requests: pd.DataFrame):
        for name, value in vars(arcs).items():
            setattr(self, name, value)
        self.at = arcs.at
        self.reqs, self.width = requests, len(requests)
        self.cost_ix, self.bound = requests["cost_ix"].to_numpy(), requests["bound"].to_numpy()
        self.lo_x, self.lo_y, self.hi_x, self.hi_y = (requests[c].to_numpy() for c in ("lo_x", "lo_y", "hi_x", "hi_y"))
        self.always = (  # arcs open to every request
            (self.xmax >= self.lo_x.max()) & (self.xmin <= self.hi_x.min()) & (self.ymax >= self.lo_y.max()) & (self.ymin <= self.hi_y.min())
        )
        self.place = np.empty(len(self.ids) * self.width, dtype=np.int64)
        self.rest = self._remaining().ravel()
        goal = np.minimum(self.at(requests["goal"]), len(self.ids) - 1)
        self.goal_req = np.flatnonzero((self.ids[goal] == requests["goal"].to_numpy()) & self.owned[goal])
        self.goal_slot = goal[self.goal_req] * self.width + self.goal_req

    def slots(self, labels: pd.DataFrame) -> np.ndarray:
        return self.at(labels["node"]) * self.width + labels["req"].to_numpy()

    def _remaining(self) -> np.ndarray:
        """Least label still to come from each node to each request's goal (zero unless goal-directed)."""
        r = self.reqs
        if not r["rate"].any():
            return np.zeros((len(self.ids), self.width), dtype=np.int64)
        far = np.hypot(self.x[:, None] - r["goal_x"].to_numpy()[None, :], self.y[:, None] - r["goal_y"].to_numpy()[None, :])
        return np.floor(far * r["rate"].to_numpy()[None, :]).astype(np.int64) * HOP

    def weights(self, arcs: pd.DataFrame) -> np.ndarray:
        """Weight of each arc for each request; arcs outside a request's box are closed to it."""
        r = self.reqs
        table = np.stack([arcs[c].to_numpy() for c in arcs.columns if c.startswith("w_")], axis=1)
        meets = (
            (arcs["xmax"].to_numpy()[:, None] >= r["lo_x"].to_numpy()) & (arcs["xmin"].to_numpy()[:, None] <= r["hi_x"].to_numpy())
            & (arcs["ymax"].to_numpy()[:, None] >= r["lo_y"].to_numpy()) & (arcs["ymin"].to_numpy()[:, None] <= r["hi_y"].to_numpy())
        )
        return np.where(meets, table[:, r["cost_ix"].to_numpy()], INF)

    def weight(self, arc: np.ndarray, req: np.ndarray) -> np.ndarray:
        """Weight of each inner arc for the request beside it."""
        w = self.table[self.cost_ix[req], arc]
        some = np.flatnonzero(~self.always[arc])
        a, r = arc[some], req[some]
        meets = (self.xmax[a] >= self.lo_x[r]) & (self.xmin[a] <= self.hi_x[r]) & (self.ymax[a] >= self.lo_y[r]) & (self.ymin[a] <= self.hi_y[r])
        w[some[~meets]] = INF
        return w

    def blank(self) -> np.ndarray:
        return np.full(len(self.ids) * self.width, INF, dtype=np.int64)

    @staticmethod
    def _runs(first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges first..past one after another, and which range each element came from."""
        size = past - first
        which = np.repeat(np.arange(len(size)), size)
        return np.arange(len(which)) - np.repeat(np.cumsum(size) - size - first, size), which

    def settle(self, dist: np.ndarray, slot: np.ndarray, label: np.ndarray) -> None:
        """Lower ``dist`` by the given labels and relax inner arcs from what changed until nothing does.

        Nothing is kept that cannot beat the request's bound, or its goal's label where the goal lies in this block.
        """
        req = slot % self.width
        while True:
            fits = (label < dist[slot]) & (label + self.rest[slot] <= self.bounds(dist)[req])
            slot, label = slot[fits], label[fits]
            if not len(slot):
                return
            np.minimum.at(dist, slot, label)
            nth = np.arange(len(slot))
            self.place[slot] = nth
            live = slot[self.place[slot] == nth]  # each slot once
            node, req = np.divmod(live, self.width)
            run, which = self._runs(self.leave_from[node], self.leave_from[node + 1])
            arc, req = self.leaving[run], req[which]
            label = dist[live][which] + self.weight(arc, req)
            slot = self.v[arc] * self.width + req

    def bounds(self, dist: np.ndarray) -> np.ndarray:
        """Largest label of use to each request."""
        bound = self.bound.copy()
        bound[self.goal_req] = np.minimum(bound[self.goal_req], dist[self.goal_slot])
        return bound

    def parents(self, dist: np.ndarray, slot: np.ndarray, entry: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edge, previous node, block it came from) of settled slots: of the tied arcs, inner or by message, the smallest edge id.

        The block is -1 where the previous node lies inside this one.
        """
        edge = np.full(len(slot), INF, dtype=np.int64)
        prev, came = np.full(len(slot), -1, dtype=np.int64), np.full(len(slot), -1, dtype=np.int64)
        node, req = np.divmod(slot, self.width)
        arc, which = self._runs(self.enter_from[node], self.enter_from[node + 1])
        tied = dist[self.u[arc] * self.width + req[which]] + self.weight(arc, req[which]) == dist[slot][which]
        arc, which = arc[tied], which[tied]
        first = np.flatnonzero(np.diff(which, prepend=-1))  # arcs into a node are in edge order
        which = which[first]
        edge[which], prev[which] = self.edge[arc[first]], self.u_id[arc[first]]
        if not len(entry):
            return edge, prev, came

        sent = self.slots(entry)
        order = np.argsort(sent)
        k = np.minimum(np.searchsorted(sent[order], slot), len(sent) - 1)
        e, p, c, label = (entry[n].to_numpy()[order][k] for n in ("edge", "prev", "prev_block", "label"))
        wins = (sent[order][k] == slot) & (label == dist[slot]) & ((e < edge) | ((e == edge) & (p < prev)))
        return np.where(wins, e, edge), np.where(wins, p, prev), np.where(wins, c, came)


_REQUEST = ["req_no", "cost_ix", "bound", "rate", "goal", "goal_x", "goal_y", "lo_x", "lo_y", "hi_x", "hi_y"]


def _open(inbox: pd.DataFrame, arcs: _Arcs) -> tuple[_Block, pd.DataFrame]:
    if int((inbox["label"].to_numpy() & (HOP - 1)).max()) + len(arcs.ids) >= HOP:
        raise ValueError(f"a path may have {HOP} edges or more, which labels cannot count")
    requests = inbox.drop_duplicates("req_no")[_REQUEST].sort_values("req_no")
    inbox = inbox.assign(req=np.searchsorted(requests["req_no"].to_numpy(), inbox["req_no"].to_numpy()))
    return _Block(arcs, requests), inbox


def _empty(schema: str) -> pd.DataFrame:
    return pd.DataFrame({part.split()[0]: [] for part in schema.split(", ")})


def _advance(inbox: pd.DataFrame, arcs: _Arcs) -> pd.DataFrame:
    """One group of one step: settle all messages, report what the new ones improved."""
    block, inbox = _open(inbox, arcs)
    slot, dist = block.slots(inbox), block.blank()
    block.settle(dist, slot, inbox["old"].to_numpy())
    old = dist.copy()
    block.settle(dist, slot, inbox["label"].to_numpy())
    bound = block.bounds(dist)
    improved, dist = (dist < old).reshape(-1, block.width), dist.reshape(-1, block.width)
    shard, reqs = int(inbox["shard"].iat[0]), block.reqs["req_no"].to_numpy()
    parts = []

    outer = block.outer
    if len(outer):
        u = block.at(outer["u"])
        some = improved[u].any(axis=1)
        outer, u = outer[some], u[some]
        label = dist[u] + block.weights(outer)
        a, r = np.nonzero(improved[u] & (label <= bound))
        out = pd.DataFrame({
            "shard": shard, "req_no": reqs[r], "node": outer["v"].to_numpy()[a], "label": label[a, r],
            "edge": outer["edge"].to_numpy()[a], "prev": outer["u"].to_numpy()[a], "prev_block": block.number, "goal": False,
            "lo": outer["v_lo"].to_numpy()[a], "hi": outer["v_hi"].to_numpy()[a],
        })
        out = out.sort_values(["req_no", "node", "label", "edge", "prev"]).drop_duplicates(["req_no", "node"])
        copies = (out["hi"] - out["lo"] + 1).to_numpy()
        out = out.loc[out.index.repeat(copies)]
        nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        parts.append(out.assign(block=out["lo"].to_numpy() + nth))

    better = improved.ravel()[block.goal_slot]
    hit = block.goal_slot[better]
    parts.append(pd.DataFrame({
        "shard": shard, "block": block.number, "req_no": reqs[block.goal_req[better]], "node": block.ids[hit // block.width],
        "label": dist.ravel()[hit], "edge": -1, "prev": -1, "prev_block": -1, "goal": True,
    }))
    return pd.concat(parts)[[c.split()[0] for c in _MESSAGE.split(", ")]]


def _finish(inbox: pd.DataFrame, arcs: _Arcs) -> pd.DataFrame:
    """All labels of the nodes this block owns, with the arc each was reached by."""
    block, inbox = _open(inbox, arcs)
    dist = block.blank()
    block.settle(dist, block.slots(inbox), inbox["label"].to_numpy())
    slot = np.flatnonzero((dist < INF) & np.repeat(block.owned, block.width))
    edge, prev, _ = block.parents(dist, slot, inbox)
    node, req = np.divmod(slot, block.width)
    return pd.DataFrame({
        "req_no": block.reqs["req_no"].to_numpy()[req], "node": block.ids[node], "label": dist[slot], "edge": edge, "prev": prev,
        "x": block.x[node], "y": block.y[node],
    })


def _tokens(inbox: pd.DataFrame, arcs: _Arcs) -> tuple[_Block, np.ndarray, pd.DataFrame, np.ndarray]:
    """The block, its settled labels, the messages into it, and the slots of the nodes asked about."""
    block, inbox = _open(inbox, arcs)
    entry, tokens = inbox[~inbox["token"]], inbox[inbox["token"]]
    dist = block.blank()
    block.settle(dist, block.slots(entry), entry["label"].to_numpy())
    asked = np.unique(block.slots(tokens))
    return block, dist, entry, asked[dist[asked] < INF]  # others lie beyond the bound, on no path to the goal


def _entries(inbox: pd.DataFrame, arcs: _Arcs) -> pd.DataFrame:
    """For each node asked about, the node where the path to it entered the block."""
    block, dist, entry, asked = _tokens(inbox, arcs)
    reqs, slot, start, parts = block.reqs["req_no"].to_numpy(), asked, asked, [_empty(_ENTRY)]
    while len(slot):
        _, prev, came = block.parents(dist, slot, entry)
        node, req = np.divmod(slot, block.width)
        done = (came >= 0) | (prev < 0)
        parts.append(pd.DataFrame({
            "req_no": reqs[req[done]], "block": block.number, "node": block.ids[start[done] // block.width], "entry": block.ids[node[done]],
        }))
        slot, start = block.at(prev[~done]) * block.width + req[~done], start[~done]
    return pd.concat(parts)


def _walk_back(inbox: pd.DataFrame, arcs: _Arcs) -> pd.DataFrame:
    """The path from each node asked about back to where it entered the block."""
    block, dist, entry, slot = _tokens(inbox, arcs)
    reqs, parts = block.reqs["req_no"].to_numpy(), [_empty(_PATH)]
    while len(slot):
        edge, prev, came = block.parents(dist, slot, entry)
        node, req = np.divmod(slot, block.width)
        parts.append(pd.DataFrame({"req_no": reqs[req], "node": block.ids[node], "label": dist[slot], "edge": edge, "prev": prev}))
        stays = (came < 0) & (prev >= 0)
        slot = block.at(prev[stays]) * block.width + req[stays]
    return pd.concat(parts)


# --- one party of requests -----------------------------------------------------------------------------------------

_GOAL = "req_no long, label long"


def _settled(requests: pd.DataFrame, arcs: pd.DataFrame):
    """The party's requests, some at a time, with their settled labels."""
    around = _Around(arcs, requests)
    some = max(1, PARTY_SLOTS // len(around.ids))
    for first in range(0, len(requests), some):
        part = requests.iloc[first : first + some]
        block = _Block(around, part)
        dist = block.blank()
        start = block.at(part["source"]) * block.width + np.arange(block.width)
        block.settle(dist, start, np.zeros(block.width, dtype=np.int64))
        yield block, dist


def _reached_by(block: _Block, dist: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge, prev, _ = block.parents(dist, slot, ())
    return np.where(prev < 0, -1, edge), prev


def _party_goals(block: _Block, dist: np.ndarray) -> pd.DataFrame:
    label = dist[block.goal_slot]
    return pd.DataFrame({"req_no": block.reqs["req_no"].to_numpy()[block.goal_req], "label": label})[label < INF]


def _party_labels(block: _Block, dist: np.ndarray) -> pd.DataFrame:
    slot = np.flatnonzero(dist < INF)
    edge, prev = _reached_by(block, dist, slot)
    node, req = np.divmod(slot, block.width)
    return pd.DataFrame({
        "req_no": block.reqs["req_no"].to_numpy()[req], "node": block.ids[node], "label": dist[slot], "edge": edge, "prev": prev,
        "x": block.x[node], "y": block.y[node],
    })


def _party_paths(block: _Block, dist: np.ndarray) -> pd.DataFrame:
    reqs, parts = block.reqs["req_no"].to_numpy(), [_empty(_PATH)]
    slot = block.goal_slot[dist[block.goal_slot] < INF]
    while len(slot):
        edge, prev = _reached_by(block, dist, slot)
        node, req = np.divmod(slot, block.width)
        parts.append(pd.DataFrame({"req_no": reqs[req], "node": block.ids[node], "label": dist[slot], "edge": edge, "prev": prev}))
        stays = prev >= 0
        slot = block.at(prev[stays]) * block.width + req[stays]
    return pd.concat(parts)


def _squares(df: DataFrame, side: Column) -> DataFrame:
    """Each row once per square its box lo_x..hi_y covers."""
    at = lambda c: F.floor(F.col(c) / side).cast("long")
    return df.withColumn("gx", F.explode(F.sequence(at("lo_x"), at("hi_x")))).withColumn("gy", F.explode(F.sequence(at("lo_y"), at("hi_y"))))


def _in_squares(arcs: DataFrame, parties: DataFrame, side: Column) -> DataFrame:
    """Arcs once per level and square they cover, within the extent of the parties of that level."""
    low, high = [f"lo_{c}" for c in "xy"], [f"hi_{c}" for c in "xy"]
    extents = parties.groupBy("level").agg(*[F.min(c).alias(c) for c in low], *[F.max(c).alias(c) for c in high])
    clamped = {f"lo_{c}": F.greatest(f"lo_{c}", f"{c}min") for c in "xy"} | {f"hi_{c}": F.least(f"hi_{c}", f"{c}max") for c in "xy"}
    return _squares(arcs.join(F.broadcast(extents), overlaps()).withColumns(clamped), side).drop(*low, *high)


def _parties(held: DataFrame, boxed: DataFrame, size: int, most: int) -> DataFrame:
    """(level, cx, cy, nth, first, share): runs of ``size`` numbers, from ``first`` on, that form parties of ``share`` requests.

    Left out are runs with over ``PARTY_ROWS`` arcs in reach. Requests times arcs of a party are at most ``most``.
    """
    by, side = ["level", "cx", "cy", "nth"], F.pow(F.lit(2.0), F.col("level") - 1)
    runs = materialize(
        boxed.withColumn("nth", F.floor(F.col("req_no") / size)).groupBy(*by).agg(
            F.min("req_no").alias("first"), *[F.min(c).alias(c) for c in ("lo_x", "lo_y")], *[F.max(c).alias(c) for c in ("hi_x", "hi_y")]
        ), "parties",
    )
    reach = _squares(runs, side).join(held, ["level", "gx", "gy"]).groupBy("first").agg(F.sum("held").alias("held"))
    arcs = F.greatest(F.coalesce("held", F.lit(0)), F.lit(1))
    share = F.least(F.lit(size), F.greatest(F.lit(1), F.floor(F.lit(most) / arcs))).cast("long")
    return runs.join(reach, "first", "left").where(arcs <= PARTY_ROWS).select(*by, "first", share.alias("share"))


def with_parties(arcs: DataFrame, numbered: DataFrame, sizes: list[int], most: int) -> DataFrame:
    """``numbered`` with a ``party`` of at most ``sizes[0]`` requests, NULL where over ``PARTY_ROWS`` arcs may meet its box.

    Where that holds for a run of ``sizes[0]`` requests the next size is tried. Arcs are counted by squares of half the boxes' size, so a
    party's count is that of at most 25 squares.
    """
    by, side = ["level", "cx", "cy", "nth"], F.pow(F.lit(2.0), F.col("level") - 1)
    boxed = numbered.where(F.col("level") <= MOST_LEVEL)
    held = _in_squares(arcs.select("xmin", "ymin", "xmax", "ymax"), boxed, side).groupBy("level", "gx", "gy").agg(F.count(F.lit(1)).alias("held"))
    held = materialize(held, "held")
    for size in sizes:
        found = _parties(held, boxed, size, most)
        start = F.col("first") + F.floor((F.col("req_no") - F.col("first")) / F.col("share")) * F.col("share")
        joined = numbered.withColumn("nth", F.floor(F.col("req_no") / size)).join(found, by, "left")
        party = F.coalesce("party", start) if "party" in numbered.columns else start
        numbered = joined.withColumn("party", party.cast("long")).drop("nth", "first", "share")
    return materialize(numbered, "requests")


def _by_party(spread: Spread, work, schema: str) -> DataFrame:
    """Run ``work`` on every party's requests, settled on the arcs that meet the party's box."""
    side = F.pow(F.lit(2.0), F.col("level") - 1)
    members = spread.requests.where("party is not null")
    edges = ["lo_x", "lo_y", "hi_x", "hi_y"]
    boxes = members.groupBy("party", "level").agg(*[F.min(c).alias(c) for c in edges[:2]], *[F.max(c).alias(c) for c in edges[2:]])
    arcs = spread.near_arcs
    first = (F.floor(F.greatest("lo_x", "xmin") / side) == F.col("gx")) & (F.floor(F.greatest("lo_y", "ymin") / side) == F.col("gy"))
    met = (
        _in_squares(arcs, boxes, side).join(_squares(boxes, side), ["level", "gx", "gy"])
        .where(overlaps() & first)  # once, in the square of the lower corner of their common box
        .select(F.col("party").alias("arc_party"), *arcs.columns)
    )
    asked = members.select("party", F.col("max_label").alias("bound"), "source", "sx", "sy", *[c for c in _REQUEST if c != "bound"])

    def run(requests: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_empty(schema)] + ([work(block, dist) for block, dist in _settled(requests, arcs)] if len(requests) else []))

    # Settling takes long for few bytes, so the parties keep their number of parts, which would be merged by size.
    parts = shuffle_partitions(asked.sparkSession)
    return asked.repartition(parts, "party").groupBy("party").cogroup(met.repartition(parts, "arc_party").groupBy("arc_party")).applyInPandas(run, schema)


# --- steps over all blocks ----------------------------------------------------------------------------------------


@dataclass
class Spread:
    """Settled messages of one batch of requests."""

    arcs: DataFrame  # with the weights of the costs in use only
    near_arcs: DataFrame  # those open in a cost in use, without their blocks
    requests: DataFrame  # numbered, with their bounds in label units and their party
    folder: str  # messages by step, goals apart, by region
    steps: int = 0
    sent: int = 0  # messages

    def messages(self) -> DataFrame:
        return self._read().where("not goal")

    def _read(self) -> DataFrame:
        spark = self.requests.sparkSession
        return spark.read.schema(f"{_MESSAGE}, region long, step int").option("basePath", self.folder).parquet(self.folder)

    def write(self, messages: DataFrame) -> int:
        """Store the messages of the next step; how many they are."""
        count = Observation()
        stored = messages.withColumn("region", _region(F.col("block"))).hint("rebalance", "region", "shard", "block").observe(
            count, F.count_if(~F.col("goal")).alias("sent")
        )  # observed last: an empty plan below would be dropped together with its figures
        stored.write.partitionBy("goal", "region").parquet(f"{self.folder}/step={self.steps}")
        sent = count.get["sent"]
        self.steps, self.sent = self.steps + 1, self.sent + sent
        return sent

    def reached(self) -> DataFrame:
        """(req_no, label): best label at each request's goal."""
        near = _by_party(self, _party_goals, _GOAL)
        return near.union(self.reached_by_steps()) if self.sent else near

    def reached_by_steps(self) -> DataFrame:
        return self._read().where("goal").groupBy("req_no").agg(F.min("label").alias("label"))

    def terms(self) -> DataFrame:
        """What a block must know of each request; the bound tightens once the goal has been reached."""
        best = self.reached_by_steps().withColumnRenamed("label", "best")
        bound = F.least("max_label", F.coalesce("best", F.lit(INF - 1)))
        return self.requests.join(best, "req_no", "left").select(
            "req_no", "cost_ix", bound.alias("bound"), "rate", "goal", "goal_x", "goal_y", "lo_x", "lo_y", "hi_x", "hi_y"
        )


def _by_group(spread: Spread, inbox: DataFrame, groups: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` on every (shard, block) of ``groups`` with its inbox rows and that block's arcs."""

    def run(inbox: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
        return _empty(schema) if inbox.empty or arcs.empty else work(inbox, _Arcs(arcs))

    left = inbox.join(spread.terms(), "req_no")
    right = _arcs_of(spread, groups)
    return left.groupBy("shard", "block").cogroup(right.groupBy("arc_shard", "arc_block")).applyInPandas(run, schema)


def _arcs_of(spread: Spread, groups: DataFrame) -> DataFrame:
    """The arcs of every group's block; the columns are renamed, as cogroup needs distinct keys."""
    wanted = groups.select(_region(F.col("block")).alias("region"), "block", F.col("shard").alias("arc_shard")).distinct()
    return spread.arcs.join(wanted, ["region", "block"]).drop("region").withColumnRenamed("block", "arc_block")


def _inbox(messages: DataFrame, step: int | None = None) -> DataFrame:
    """Best message per (group, request, node); ``old`` is the best label from before ``step``."""
    before = F.min(F.when(F.col("step") < step, F.col("label"))) if step is not None else F.lit(None)
    return (
        messages.groupBy("shard", "block", "req_no", "node")
        .agg(F.min(F.struct("label", "edge", "prev", "prev_block")).alias("m"), F.coalesce(before, F.lit(INF)).alias("old"))
        .select("shard", "block", "req_no", "node", "m.*", "old")
    )


def number_requests(graph: BlockGraph, requests: DataFrame, goal_directed: bool = False) -> DataFrame:
    """Number requests along the curve through their origins, those with boxes of one size and place together, and cut them into shards.

    ``requests``: req_id, source, cost; optional target, max_cost, lo_x..hi_y.
    Every origin that is a graph node takes part; others give no rows.
    """
    spark = requests.sparkSession
    kinds = spark.createDataFrame(
        [(n, i, c.scale, graph.rate[n] if goal_directed else 0.0) for i, (n, c) in enumerate(graph.costs.items())],
        "cost string, cost_ix int, scale long, rate double",
    )
    optional = {"target": "long", "max_cost": "double", "lo_x": "double", "lo_y": "double", "hi_x": "double", "hi_y": "double"}
    full = requests.withColumns({c: F.lit(None).cast(t) for c, t in optional.items() if c not in requests.columns})
    origins = graph.homes.select(F.col("node").alias("source"), F.col("v_lo").alias("from_lo"), F.col("v_hi").alias("from_hi"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    goals = graph.homes.select(F.col("node").alias("target"), F.col("v_lo").alias("goal_block"), F.col("x").alias("goal_x"), F.col("y").alias("goal_y"))
    widest = F.greatest(F.col("hi_x") - F.col("lo_x"), F.col("hi_y") - F.col("lo_y"), F.lit(2.0**LEAST_LEVEL))
    cell = lambda c: F.floor((F.col(f"lo_{c}") + F.col(f"hi_{c}")) / F.pow(F.lit(2.0), F.col("level") + 1)).cast("long")
    limit = F.when(F.col("max_cost").isNotNull(), (F.floor(F.col("max_cost") * F.col("scale") + 0.5) + 1) * HOP - 1)
    ready = (
        full.join(F.broadcast(kinds), "cost").join(origins, "source").join(goals, "target", "left")
        .select(
            "req_id", "source", "target", "cost", "cost_ix", "scale", "rate", "from_lo", "from_hi", "goal_block",
            F.coalesce("target", F.lit(-1)).cast("long").alias("goal"),
            F.coalesce("goal_x", F.lit(0.0)).alias("goal_x"), F.coalesce("goal_y", F.lit(0.0)).alias("goal_y"),
            F.when(F.col("goal_block").isNull(), F.lit(0.0)).otherwise(F.col("rate")).alias("goal_rate"),
            F.coalesce(limit, F.lit(INF - 1)).cast("long").alias("max_label"),
            F.coalesce("lo_x", F.lit(-FAR)).alias("lo_x"), F.coalesce("lo_y", F.lit(-FAR)).alias("lo_y"),
            F.coalesce("hi_x", F.lit(FAR)).alias("hi_x"), F.coalesce("hi_y", F.lit(FAR)).alias("hi_y"),
            "sx", "sy", curve_key(F.col("sx"), F.col("sy")).alias("key"),
        )
        .withColumn("level", F.ceil(F.log2(widest)).cast("int")).withColumn("cx", cell("x")).withColumn("cy", cell("y"))
        .drop("rate").withColumnRenamed("goal_rate", "rate")
    )
    numbered = dense_id(ready, ["level", "cx", "cy", "key", "source", "req_id", "target", "cost"], "req_no", offset=-1).drop("key")
    return materialize(numbered.withColumn("shard", F.floor(F.col("req_no") / REQUESTS_PER_SHARD).cast("long")), "requests")


def spread(graph: BlockGraph, requests: DataFrame, goal_directed: bool = False) -> Spread:
    """Settle shortest labels from every request's origin, up to its bound, box and goal."""
    spark = requests.sparkSession
    numbered = number_requests(graph, requests, goal_directed)
    kinds, n, goals = numbered.agg(F.collect_set("cost_ix"), F.count(F.lit(1)), F.count_if(F.col("goal") >= 0)).first()  # at most one element per cost
    used = sorted(kinds) or [0]
    place = F.create_map(*[F.lit(v) for i, u in enumerate(used) for v in (u, i)])
    numbered = numbered.withColumn("cost_ix", place[F.col("cost_ix")])
    unused = [f"w_{i}" for i in range(len(graph.costs)) if i not in used]
    arcs = graph.arcs.drop(*unused)
    near_arcs = arcs.where(F.least(*[f"w_{i}" for i in used], F.lit(INF)) < INF).drop("region", "block", "v_lo", "v_hi")
    most = 1 + n // (4 * spark.sparkContext.defaultParallelism)
    sizes = [PARTY_REQUESTS] if goals == n else [PARTY_REQUESTS, PARTY_AREAS]  # labels of areas are all held at once
    parties = with_parties(near_arcs, numbered, list(dict.fromkeys(min(s, most) for s in sizes)), sizes[-1] * PARTY_ROWS)
    run = Spread(arcs.drop("vx", "vy"), near_arcs, parties, new_folder(spark, "messages"))
    none = F.lit(-1).cast("long")
    sent = run.write(run.requests.where("party is null").select(
        "shard", F.explode(F.sequence("from_lo", "from_hi")).alias("block"), "req_no", F.col("source").alias("node"),
        F.lit(0).cast("long").alias("label"), none.alias("edge"), none.alias("prev"), none.alias("prev_block"), F.lit(False).alias("goal"),
    ))
    while sent:
        messages, step = run.messages(), run.steps - 1
        woken = messages.where(F.col("step") == step).select("region", "shard", "block").distinct()
        inbox = _inbox(messages.join(woken, ["region", "shard", "block"], "left_semi"), step)
        sent = run.write(_by_group(run, inbox, woken, _advance, _MESSAGE))
    return run


def labels(run: Spread) -> DataFrame:
    """(req_no, node, label, edge, prev, x, y) of every reached node; the origin has edge and prev -1."""
    near = _by_party(run, _party_labels, _TREE)
    if not run.sent:
        return near
    messages = run.messages()
    return near.union(_by_group(run, _inbox(messages), messages.select("shard", "block"), _finish, _TREE))


def _asked(run: Spread, best: DataFrame, tokens: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` on the groups of ``tokens`` (shard, block, req_no, node), with the best messages of those requests there."""
    key = ["shard", "block", "req_no"]
    entries = best.join(tokens.select(key).distinct(), key, "left_semi").drop("old").withColumn("token", F.lit(False))
    none = F.lit(-1).cast("long")
    marks = tokens.distinct().select(
        *key, "node", F.lit(INF).alias("label"), none.alias("edge"), none.alias("prev"), none.alias("prev_block"), F.lit(True).alias("token")
    )
    return _by_group(run, entries.unionByName(marks), tokens.select("shard", "block"), work, schema)


def unwind(parents: DataFrame, ends: DataFrame) -> DataFrame:
    """Keys reached from ``ends`` (key) by following ``parents`` (key, parent) any number of times, ends included.

    Pointer doubling: each round joins the pointers to themselves, so they reach twice as far, and adds what they reach from
    the keys marked so far. Rounds are logarithmic in the longest chain.
    """
    marked, hops = materialize(ends.select("key").distinct(), "marked"), materialize(parents, "pointers")
    rounds = 0
    while not hops.isEmpty():
        if (rounds := rounds + 1) > HOP_BITS:
            raise ValueError("pointers run in a circle")
        reached = marked.join(hops, "key").select(F.col("parent").alias("key"))
        marked = materialize(marked.union(reached).distinct(), "marked")
        far = hops.select(F.col("key").alias("parent"), F.col("parent").alias("far"))
        hops = materialize(hops.join(far, "parent").select("key", F.col("far").alias("parent")), "pointers")
    return marked


def paths(run: Spread) -> DataFrame:
    """(req_no, node, label, edge, prev) of the nodes on the path to each reached goal."""
    near = _by_party(run, _party_paths, _PATH)
    return near.union(_paths_by_steps(run)) if run.sent else near


def _paths_by_steps(run: Spread) -> DataFrame:
    goal = run.requests.join(run.reached_by_steps(), "req_no").select("shard", F.col("goal_block").alias("block"), "req_no", F.col("goal").alias("node"))
    goal = materialize(goal, "goals")
    best = materialize(_inbox(run.messages().join(goal.select("req_no"), "req_no", "left_semi")), "best")
    sent = best.where("prev_block >= 0")
    sources = sent.select("shard", F.col("prev_block").alias("block"), "req_no", F.col("prev").alias("node"))
    entered = materialize(_asked(run, best, sources.union(goal), _entries, _ENTRY), "entered")
    key = F.struct("req_no", "block", "node").alias("key")
    before = entered.select("req_no", F.col("block").alias("prev_block"), F.col("node").alias("prev"), "entry")
    parents = sent.join(before, ["req_no", "prev_block", "prev"]).select(
        key, F.struct("req_no", F.col("prev_block").alias("block"), F.col("entry").alias("node")).alias("parent")
    )
    ends = goal.join(entered, ["req_no", "block", "node"]).select(F.struct("req_no", "block", F.col("entry").alias("node")).alias("key"))
    on_path = unwind(parents, ends).select("key.*")
    crossed = sent.join(on_path, ["req_no", "block", "node"]).select("shard", F.col("prev_block").alias("block"), "req_no", F.col("prev").alias("node"))
    return _asked(run, best, materialize(crossed.union(goal), "tokens"), _walk_back, _PATH)
