"""Every registered query against its SQL counterpart, with blocks small enough that routes cross them."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from roadloom.plans import area, route
from workload import oracle, queries
from workload.graph import Workload

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def small(spark):
    return Workload(spark, SMALL, rows_per_block=200)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    text = lambda v: "NULL" if pd.isna(v) else repr(float(v)) if not isinstance(v, str) else v
    return sorted("|".join(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


def test_every_query_has_sql():
    assert set(queries._QUERIES) == set(oracle.all_oracles())


@pytest.mark.parametrize("name", sorted(oracle.all_oracles()))
def test_query_equals_sql(small, duck, name):
    got = queries._QUERIES[name](small).toPandas()
    want = duck.execute(oracle.all_oracles()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and rows(got) == rows(want)


def test_several_blocks_are_in_play(small):
    assert small.vehicles.blocks.arcs.select("block").distinct().count() >= 4


def test_goal_directed_equals_plain(small):
    ended = route.attach_ends(small.vehicles, small.requests)
    plain = route.route_labels(route.solve(small.vehicles, ended)).toPandas()
    directed = route.route_labels(route.solve(small.vehicles, ended, goal_directed=True)).toPandas()
    assert rows(plain) == rows(directed)


def test_route_result_is_consistent(small):
    result = route.route(small.vehicles, small.requests)
    r = result.rows.toPandas().sort_values(["req_id", "seq"])
    assert (r.groupby("req_id")["seq"].apply(list).map(lambda s: s == list(range(1, len(s) + 1)))).all()
    last = r.groupby("req_id").tail(1)
    assert (last["edge"] == -1).all() and (last["cost"] == 0).all()
    total = r.groupby("req_id")["cost"].sum().to_numpy()
    assert abs(total - last["agg_cost"].to_numpy()).max() < 1e-6
    assert result.features.count() == len(r) - len(last)


def test_service_area_outlines_cover_their_nodes(small):
    result = area.service_area(small.areas, small.origins)
    kinds = {r.req_id: r.kind for r in result.features.select("req_id", F.get_json_object("feature", "$.geometry.type").alias("kind")).distinct().collect()}
    options = {r.req_id: r.option for r in result.summary.collect()}
    assert {options[k] for k, v in kinds.items() if v == "Polygon"} == {"alphashape"}
    assert {options[k] for k, v in kinds.items() if v == "LineString"} == {"drivingdistance"}


def test_unknown_area_option_raises(small):
    with pytest.raises(ValueError, match="option must be"):
        area.service_area(small.areas, small.origins.withColumn("option", F.lit("circle")))


def test_snapping_builds_no_edges(spark):
    w = Workload(spark, SMALL, rows_per_block=200)
    assert queries._QUERIES["snap_nearest"](w).count() > 0
    assert not {"edges", "vehicles"} & set(vars(w))
