"""Publishing, latest/pinned slices, raster round trip, static cache rules."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ashgrid.operators import cache as CA
from ashgrid.operators import filters as FL
from ashgrid.operators import raster as RA
from ashgrid.sinks import publish as P


def test_geojson_document_is_valid_and_omits_absent_why(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 7, 1), 50.0, -120.0, 3, 0.012, 300.15, 4.26), (dt.date(2024, 7, 1), 51.0, -121.0, 5, None, None, None)],
        "date date, lat double, lon double, prediction int, precip_14day_sum double, max_temp double, max_wind_speed double")
    doc = P.geojson_document(P.geojson_features(df)).collect()[0].document
    g = json.loads(doc)
    assert g["type"] == "FeatureCollection" and g["date"] == "2024-07-01"
    props = sorted((f["properties"] for f in g["features"]), key=lambda p: p["risk"])
    assert props[0] == {"risk": 3, "label": "High", "rain14_mm": 12.0, "maxtemp_c": 27.0, "wind_ms": 4.3}
    assert props[1] == {"risk": 5, "label": "Extreme"}
    assert g["features"][0]["geometry"]["type"] == "Point"


def test_matrix_holes_and_order(spark):
    df = spark.createDataFrame([(50.0, -120.0, 1), (51.0, -119.0, 2)], "lat double, lon double, prediction int")
    m = P.matrix(df, [-120.0, -119.0]).collect()
    assert [r.lat for r in m] == [51.0, 50.0]
    assert list(m[0])[1:] == [None, 2] and list(m[1])[1:] == [1, None]


def test_trend_direction(spark):
    places = spark.createDataFrame([("x", 50.0, -120.0), ("lonely", 10.0, 10.0)], "name string, la double, lo double")
    pred = spark.createDataFrame(
        [(dt.date(2024, 1, d), 50.1, -120.1, r) for d, r in ((1, 5), (3, 2), (6, 3), (9, 4))],
        "d date, la double, lo double, risk int")
    out = P.trend(places, pred, F.lit("2024-01-06").cast("date")).collect()
    # six calendar days ending Jan 6 are Jan 1..6: days 1, 3 and 6 have data; day 9 is outside
    # a far place has its nearest cell too: it was accepted or not before
    assert sorted(r.name for r in out) == ["lonely", "x"]
    assert all((r.n_days, r.first_risk, r.last_risk) == (3, 5, 3) for r in out)
    assert out[0].direction == "falling" and out[0].n_days == 3


def test_latest_pinned_and_all_null_dates(spark):
    rows = [("EVI", dt.date(2024, 1, 1), 1.0), ("EVI", dt.date(2024, 1, 2), 2.0), ("NDVI", None, 3.0)]
    df = spark.createDataFrame(rows, "layer string, date date, value double")
    latest = {(r.layer, r.value) for r in FL.latest_or_pinned(df, "date", per=["layer"]).collect()}
    assert latest == {("EVI", 2.0), ("NDVI", 3.0)}
    assert FL.latest_or_pinned(df, "date", pinned="2023-01-01").count() == 0
    assert FL.latest_or_pinned(df.drop("date"), "date").count() == 3


def test_flatten_then_sample_at_centres_is_identity(spark):
    vals = [float(i) for i in range(12)]
    tiles = spark.createDataFrame(
        [(1, 3, 4, 0.5, 0.0, -120.0, 0.0, -0.25, 55.0, None, -999.0, vals)],
        "tile long, rows int, cols int, a double, b double, c double, d double, e double, f double, epsg int, "
        "nodata double, values array<double>")
    px = RA.raster_to_long(tiles)
    pts = px.select((F.col("row") * 10 + F.col("col")).alias("k"), "lat", "lon", F.col("value").alias("expect"))
    s = RA.sample_points(tiles, pts, "lat", "lon", "k")
    j = s.join(pts, "k").collect()
    assert len(j) == 12 and all(r.value == r.expect for r in j)


def test_raster_masks_and_decimate(spark):
    vals = [1.0, -999.0, float("nan"), float("inf"), 5.0, 6.0, 7.0, 8.0, 9.0]
    tiles = spark.createDataFrame(
        [(1, 3, 3, 1.0, 0.0, 0.0, 0.0, -1.0, 3.0, 4326, -999.0, vals)],
        "tile long, rows int, cols int, a double, b double, c double, d double, e double, f double, epsg int, "
        "nodata double, values array<double>")
    assert sorted(r.value for r in RA.raster_to_long(tiles).collect()) == [1.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    assert sorted(r.value for r in RA.raster_to_long(tiles, decimate=2).collect()) == [1.0, 7.0, 9.0]


def test_wide_cache_null_vs_zero(spark):
    grid = spark.createDataFrame([(1, 50.0, -120.0)], "gid long, lat double, lon double")
    nearest = spark.createDataFrame([(1, "EVI", 0.3)], "gid long, layer string, value double")
    # NDVI's layer exists but has no pixel here -> null; the others have no layer -> 0.0
    out = CA.wide_cache(grid, nearest, ["EVI", "NDVI"]).collect()[0]
    assert out.EVI == 0.3 and out.NDVI is None and out.elevation == 0.0


def test_static_cache_from_stations_fills_with_median(spark):
    from ashgrid.plans import static_cache

    hist = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 50.0, -120.0, 1.0), ("a", dt.date(2024, 1, 2), 50.0, -120.0, 3.0),
         ("b", dt.date(2024, 1, 1), 55.0, -125.0, None), ("c", dt.date(2024, 1, 1), 58.0, -130.0, 10.0)],
        "station_code string, date date, lat double, lon double, EVI double")
    grid = spark.createDataFrame([(1, 50.1, -120.1), (2, 55.1, -125.1)], "gid long, lat double, lon double")
    out = {r.gid: r for r in static_cache.from_stations(grid, hist).collect()}
    assert out[1].EVI == 2.0  # station a: median of 1 and 3
    assert out[2].EVI == 6.0  # station b has no EVI: median over stations (2, 10)
    assert out[1].NDVI == 0.0  # no such input column


def test_sampling_inverts_a_sheared_affine(spark):
    # x = 0.5*col + 0.1*row - 120, y = 0.05*col - 0.25*row + 55: not north-up
    vals = [float(i) for i in range(12)]
    tiles = spark.createDataFrame(
        [(1, 3, 4, 0.5, 0.1, -120.0, 0.05, -0.25, 55.0, 4326, -999.0, vals)],
        "tile long, rows int, cols int, a double, b double, c double, d double, e double, f double, epsg int, "
        "nodata double, values array<double>")
    px = RA.raster_to_long(tiles)
    pts = px.select((F.col("row") * 10 + F.col("col")).alias("k"), "lat", "lon", F.col("value").alias("expect"))
    got = RA.sample_points(tiles, pts, "lat", "lon", "k").join(pts, "k").collect()
    assert len(got) == 12 and all(r.value == r.expect for r in got)


def test_sampled_points_are_dealt_over_tasks(spark):
    """Points are few bytes, but a row for every tile over them."""
    tiles = spark.createDataFrame([(1, 2, 2, 1.0, 0.0, 0.0, 0.0, -1.0, 2.0, 4326, -1.0, [1.0, 2.0, 3.0, 4.0])],
                                  "tile long, rows int, cols int, a double, b double, c double, d double, e double, f double, epsg int, nodata double, `values` array<double>")
    pts = spark.range(200).selectExpr("id AS k", "id % 20 / 10 + 0.05 AS lat", "id % 10 / 5 + 0.05 AS lon").coalesce(1)
    out = RA.sample_points(tiles, pts, "lat", "lon", "k")
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 200
