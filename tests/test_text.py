"""Projection, durations, request text and GeoJSON."""

import json

import pytest
from pyspark.sql import functions as F

from roadloom.functions import costs, geojson, geometry as G, projection
from roadloom.sources import requests as R, scratch, tables


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_worked_example_of_the_public_guide(spark):
    # 52°39'27.2531"N 1°43'4.5177"E on the national datum is 651409.903, 313177.270
    lat, lon = 52 + 39 / 60 + 27.2531 / 3600, 1 + 43 / 60 + 4.5177 / 3600
    p = F.array(F.struct(F.radians(F.lit(lon)).alias("lam"), F.radians(F.lit(lat)).alias("phi")))
    r = one(spark, projection._chain(p, projection._project())[0].alias("g")).g
    assert (round(r.x, 3), round(r.y, 3)) == (651409.903, 313177.270)


def test_demo_point_and_round_trip(spark):
    r = one(spark, projection.to_grid(F.lit(-3.5299), F.lit(50.7224)).alias("g")).g
    assert (round(r.x, 3), round(r.y, 3)) == (292103.909, 92536.125)
    back = one(spark, projection.to_lonlat(F.lit(r.x), F.lit(r.y)).alias("p")).p
    assert back.x == pytest.approx(-3.5299, abs=1e-7) and back.y == pytest.approx(50.7224, abs=1e-7)


def test_durations_wrap_after_a_day(spark):
    r = one(spark, *[costs.hms(F.lit(s)).alias(f"s{i}") for i, s in enumerate([0.0, 59.99, 3661.5, 86399.0, 90061.0])])
    assert list(r) == ["00:00:00", "00:00:59", "01:01:01", "23:59:59", "01:01:01"]


def test_rounding_and_keys(spark):
    r = one(spark, costs.round_to(F.lit(2.675), 2), costs.node_key(F.lit("N1"), F.lit(None)), G.piece(F.array(F.lit(1)), 2), G.point_text(F.lit(1.5), F.lit(2.0)))
    assert list(r) == [2.68, "N1", None, "POINT(1.500 2.000)"]


def test_request_text(spark):
    df = spark.createDataFrame([(1, "-1.471 50.939,-1.475 50.945,0 0")], "req_id long, points string")
    r = R.route_requests(df).first()
    assert r.option == "distance" and 437000 < r.src_x < 438000 and 115000 < r.dst_y < 117000
    a = spark.createDataFrame([(1, "-3.5299,50.7224", None, None, None)], "req_id long, point string, option string, cost string, period string")
    r = R.area_requests(a).first()
    assert (r.option, r.minutes, r.period, round(r.x, 3)) == ("alphashape", 10.0, "nighttime0004everyday", 292103.909)


@pytest.mark.parametrize("option,period", [("quickest", None), ("time", None), ("time", "noon")])
def test_unknown_choices_raise(spark, option, period):
    df = spark.createDataFrame([(option, period)], "option string, period string")
    with pytest.raises(Exception, match="must be one of"):
        df.select(R.cost_name(F.col("option"), F.col("period"))).collect()


def test_features_are_valid_geojson(spark):
    line = F.array(F.struct(F.lit(292103.909).alias("x"), F.lit(92536.125).alias("y")), F.struct(F.lit(292203.0).alias("x"), F.lit(92536.0).alias("y")))
    f = json.loads(one(spark, geojson.feature_json(geojson.line_geometry(line), {"cost": F.lit(1.5), "length": F.lit(100.0)})).asDict().popitem()[1])
    assert f["type"] == "Feature" and f["properties"] == {"cost": 1.5, "length": 100.0} and f["geometry"]["type"] == "LineString"
    assert f["geometry"]["coordinates"][0] == pytest.approx([-3.5299, 50.7224], abs=1e-7)
    assert all(len(str(v).split(".")[1]) <= 7 for p in f["geometry"]["coordinates"] for v in p)
    bare = json.loads(one(spark, geojson.feature_json(geojson.polygon_geometry(line), {})).asDict().popitem()[1])
    assert bare["properties"] == {} and bare["geometry"]["type"] == "Polygon"


def test_features_are_written_request_by_request(spark, tmp_path):
    df = spark.createDataFrame([(r, s, f"{r}-{s}") for s in (2, 1, 3) for r in (1, 2)], "req_id long, seq long, feature string")
    tables.write_features(df, str(tmp_path / "f"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "f")).collect()]
    assert [x for x in lines if x[0] == "1"] == ["1-1", "1-2", "1-3"] and len(lines) == 6


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:1"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())
    Session.conf = {"spark.checkpoint.dir": "s3a://shared/tmp/"}
    assert scratch.new_folder(Session(), "x").startswith("s3a://shared/tmp/x-")


def test_bad_requests_are_listed_and_the_others_answered(spark):
    rows = [(1, "-1.4 50.9,-1.3 50.8", None, None), (2, "-1.4 50.9", None, None), (3, "-1.4 x,-1.3 50.8", None, None), (4, None, None, None),
            (5, "-1.4 50.9,-1.3 50.8", "fastest", None), (6, "-1.4 50.9,-1.3 50.8", "time", "never"), (7, "-1.4 50.9,-1.3 50.8", "time", "weekend0719")]
    asked = spark.createDataFrame(rows, "req_id long, points string, option string, period string")
    assert sorted(r.req_id for r in R.route_requests(asked).collect()) == [1, 7]
    assert {r.req_id: r.reason.split()[-1] for r in R.rejected_requests(asked).collect()} == {2: "latitude", 3: "latitude", 4: "latitude", 5: "option", 6: "period"}


def test_responses_keep_their_request(spark, tmp_path):
    import json

    summary = spark.createDataFrame([(1, "0:1", None), (2, None, 3.5)], "req_id long, time string, distance double")
    features = spark.createDataFrame([(1, 2, '{"k":"b"}'), (1, 1, '{"k":"a}"}')], "req_id long, seq int, feature string")
    answered = tables.responses(summary, features)
    assert {r.req_id: r.features for r in answered.collect()} == {1: ['{"k":"a}"}', '{"k":"b"}'], 2: []}
    tables.write_responses(answered, str(tmp_path / "r"))
    got = {r["req_id"]: r for r in map(json.loads, (x.value for x in spark.read.text(str(tmp_path / "r")).collect()))}
    assert got[1]["features"] == [{"k": "a}"}, {"k": "b"}] and got[1]["time"] == "0:1" and got[1]["distance"] is None
    assert got[2]["features"] == [] and got[2]["distance"] == 3.5
