"""Hot keys are dealt to several tasks; tables are replaced whole; keys are checked."""

import pytest
from pyspark.sql import functions as F

from roadloom.operators import ids, skew
from roadloom.plans import walk
from roadloom.sources import requests as R
from roadloom.sources import tables


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.range(4000)
    key = F.when(F.col("id") % 10 != 0, 7).when(F.col("id") % 100 == 0, None).otherwise(F.col("id") % 90)
    big = rows.select(key.alias("k"), F.lit("x").alias("part"), F.col("id").alias("row"))
    small = spark.createDataFrame([(7, "a"), (7, "b"), (10, "c"), (None, "n"), (999, "z")], "k long, parts string")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("part_rows", [100, 10**9])
def test_split_join_is_a_join(sides, how, part_rows):
    big, small = sides
    got, want = skew.split_join(big, small, ["k"], ["row"], how, part_rows), big.join(small, "k", how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_ninety_per_cent_on_one_key_is_many_tasks(spark, sides):
    big, small = sides
    heavy = {r.k: r.parts for r in skew.heavy_keys(big, ["k"], 100).collect()}
    assert heavy == {7: 36}
    assert skew.heavy_keys(big, ["k"], 10, most=1).count() == 1
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        tasks = skew.split_join(big, small, ["k"], ["row"], "inner", 100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in zip(("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"), before, strict=True):
            spark.conf.set(k, v)
    assert max(r["count"] for r in tasks) < 0.3 * sum(r["count"] for r in tasks)


def test_a_line_with_most_cuts_is_split_right(spark, monkeypatch):
    monkeypatch.setattr(skew.split_join, "__defaults__", ("inner", 20, 1 << 14))
    line = [{"x": float(x), "y": 0.0} for x in (0, 100, 200)]
    links = spark.createDataFrame([("L1", line, "A", "f"), ("L2", [{"x": 0.0, "y": 9.0}, {"x": 5.0, "y": 9.0}], "A", "f")], "id string, geom array<struct<x:double,y:double>>, routehierarchy string, formofway string")
    cuts = spark.createDataFrame([("L1", [{"x": 0.5 * k, "y": 0.0}]) for k in range(1, 400)] + [("L2", [{"x": 2.0, "y": 9.0}])], "roadlink string, geom array<struct<x:double,y:double>>")
    pieces = walk.split_road_links(links, cuts).groupBy("fid").agg(F.count("*").alias("n"), F.max("n").alias("last")).collect()
    assert {r.fid: (r.n, r["last"]) for r in pieces} == {"L1": (400, 400), "L2": (2, 2)}


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no table"):
        tables.current(spark, path)
    tables.save(spark.createDataFrame([(1, "a")], "k long, v string"), path)
    broken = spark.range(9, numPartitions=3).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("k"), F.lit("b").alias("v"))
    with pytest.raises(Exception, match="lost"):
        tables.save(broken, path)
    with pytest.raises(ValueError, match="unique"):
        tables.save(spark.createDataFrame([(2, "a"), (2, "b")], "k long, v string"), path, key=["k"])
    assert [tuple(r) for r in tables.current(spark, path).collect()] == [(1, "a")]
    assert tables.append(spark.createDataFrame([("z", 5)], "v string, k int"), path).count() == 2
    assert [tuple(r) for r in tables.save(spark.createDataFrame([(3, "c")], "k long, v string"), path, key=["k"]).collect()] == [(3, "c")]
    assert [tuple(r) for r in tables.current(spark, path).collect()] == [(3, "c")]


def test_repeated_requests_raise(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "req_id long, v string")
    with pytest.raises(Exception, match="req_id is repeated: 1"):
        ids.unique(asked, ["req_id"], "req_id").select("v").collect()
    assert ids.unique(asked.where("v <> 'c'"), ["req_id"], "req_id").count() == 2


def test_bad_area_requests_are_listed_and_the_others_answered(spark):
    at = "-1.4,50.9"
    rows = [(1, at, None, None, None), (2, "x", None, None, None), (3, at, "circle", None, None), (4, at, None, "ten", None), (5, at, None, "-1", None),
            (6, at, None, "5", "never"), (7, at, "drivingdistance", " 7.5 ", "weekend0719"), (8, None, None, None, None), (9, at, None, "NaN", None)]
    asked = spark.createDataFrame(rows, "req_id long, point string, option string, cost string, period string")
    assert sorted((r.req_id, r.minutes) for r in R.area_requests(asked).collect()) == [(1, 10.0), (7, 7.5)]
    reasons = {r.req_id: r.reason.split()[-1] for r in R.rejected_area_requests(asked).collect()}
    assert reasons == {2: "latitude", 3: "option", 4: "minutes", 5: "minutes", 6: "period", 8: "latitude", 9: "minutes"}
    assert R.area_requests(asked.drop("cost", "option")).count() == 6
