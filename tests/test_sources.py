"""Source formats: GeoJSON shapes, weather documents, CSV projection."""

import json
import tempfile

import pytest

from ashgrid.contract import ContractError
from ashgrid.operators import geo as G
from ashgrid.sources import files as SF
from ashgrid.sources import weather as WS

SQ = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
HOLE = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]
SQ2 = [[20.0, 0.0], [30.0, 0.0], [30.0, 10.0], [20.0, 10.0], [20.0, 0.0]]


def _write(spark, obj) -> str:
    path = tempfile.mkdtemp(prefix="ashgrid-test-geojson-") + "/m"
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.text(path)
    return path


def _kept(spark, path):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 25.0, 5.0), (4, 15.0, 5.0)],
                                "gid long, lon double, lat double")
    edges = G.polygon_edges(SF.polygon_rings(spark, path))
    return {r.gid for r in G.clip_to_polygons(pts, edges).collect()}


def test_geojson_feature_collection_with_multipolygon_and_point(spark):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQ, HOLE], [SQ2]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [15.0, 5.0]}},
    ]}
    assert _kept(spark, _write(spark, fc)) == {2, 3}


def test_geojson_single_feature_and_bare_geometry(spark):
    feat = {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [SQ, HOLE]}}
    assert _kept(spark, _write(spark, feat)) == {2}
    bare = {"type": "Polygon", "coordinates": [SQ2]}
    assert _kept(spark, _write(spark, bare)) == {3}


def test_weather_document_object_or_list(spark):
    obj = {"latitude": 50.0, "longitude": -120.0,
           "daily": {"time": ["2024-07-01", "2024-07-02"], "temperature_2m_max": [20.0, 21.0]},
           "hourly": {"time": ["2024-07-01T00:00"], "snow_depth": [0.0]}}
    raw = spark.createDataFrame([(json.dumps(obj), "a"), (json.dumps([obj, obj]), "b")], "value string, source_file string")
    rows = WS.parse_documents(raw).collect()
    assert sorted((r.source_file, r.pos) for r in rows) == [("a", 0), ("b", 0), ("b", 1)]
    daily = WS.daily_rows(WS.parse_documents(raw), ["source_file", "pos"]).collect()
    assert len(daily) == 6 and {r.temperature_2m_max for r in daily} == {20.0, 21.0}


def test_projected_csv_and_points_csv(spark):
    path = tempfile.mkdtemp(prefix="ashgrid-test-csv-") + "/c"
    df = spark.createDataFrame([(1, 50.0, None, "x"), (2, 51.0, -120.0, "y")], "id int, la double, lo double, t string")
    df.write.option("header", True).csv(path)
    p = SF.projected_csv(spark, path, ["t", "id", "t", "missing"])
    assert p.columns == ["t", "id"]
    typed = SF.read_csv(spark, path, "id int, la double, lo double, t string")
    assert [r.id for r in SF.points_csv(typed, "la", "lo").collect()] == [2]
    with pytest.raises(ContractError):
        SF.points_csv(typed, "lat", "lon")


def test_hourly_service_time_format_and_missing_variables(spark):
    from ashgrid.operators import weather as W

    obj = {"latitude": 50.0, "longitude": -120.0, "daily": {"time": ["2024-07-01"], "temperature_2m_max": [20.0]},
           "hourly": {"time": ["2024-07-01T00:00", "2024-07-01T13:00", "2024-07-02T01:00"],
                      "snow_depth": [0.0, 1.0, 2.0], "shortwave_radiation": [5.0, 700.0, 3.0]}}
    raw = spark.createDataFrame([(json.dumps(obj), "a")], "value string, source_file string")
    h = WS.hourly_rows(WS.parse_documents(raw), ["source_file"]).withColumnRenamed("source_file", "loc")
    out = {str(r.day): r for r in W.hourly_to_daily(h).collect()}
    assert out["2024-07-01"].mean_snow_depth == 0.5 and out["2024-07-01"].max_solar_radiation == 700.0
    assert out["2024-07-01"].mean_low_cloud_cover is None and out["2024-07-02"].max_solar_radiation == 3.0
