"""Projections against independent numbers, and the raster-to-table job."""

import json
import math

import pytest
from pyspark.sql import functions as F

from ashgrid.contract import ContractError
from ashgrid.functions import projection as PJ
from ashgrid.plans import raster_table as RT
from ashgrid.sources import files

TILE = ("path string, rows int, cols int, a double, b double, c double, d double, e double, f double, "
        "epsg int, nodata double, values array<double>")


def _xy(spark, rows, forward):
    df = spark.createDataFrame([(e, float(u), float(v)) for e, u, v in rows], "epsg int, u double, v double")
    a, b = (PJ.from_lonlat if forward else PJ.to_lonlat)(F.col("epsg"), F.col("u"), F.col("v"))
    return [(r.a, r.b) for r in df.select(a.alias("a"), b.alias("b")).collect()]


def _meridian_arc(lat, steps=20_000):
    """Length of the meridian from the equator, by Simpson's rule."""
    a, f = PJ.WGS84
    e2 = f * (2 - f)
    h = math.radians(lat) / steps

    def m(p):
        return a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5

    return h / 3 * sum(m(i * h) * (1 if i in (0, steps) else 4 if i % 2 else 2) for i in range(steps + 1))


def test_known_places(spark):
    (x, y), (mx, my), (ax, ay) = _xy(spark, [(32617, -79.387139, 43.642567), (3857, 180.0, 85.0511287798066), (3005, -126.0, 45.0)], True)
    assert abs(x - 630084) < 1.5 and abs(y - 4833438) < 1.5  # a tower whose grid place is published to the metre
    assert abs(mx - 20037508.342789244) < 1e-6 and abs(my - 20037508.342789244) < 1e-3
    assert abs(ax - 1_000_000) < 1e-6 and abs(ay) < 1e-6


def test_utm_northing_is_the_meridian_arc(spark):
    lats = [0.0, 10.0, 48.5, 60.0, 83.0]
    got = _xy(spark, [(32610, -123.0, x) for x in lats] + [(32710, -123.0, -x) for x in lats], True)
    for (x, y), lat in zip(got[:5], lats):
        assert abs(x - 500_000) < 1e-6 and abs(y - 0.9996 * _meridian_arc(lat)) < 1e-3
    for (x, y), lat in zip(got[5:], lats):
        assert abs(y - (10_000_000 - 0.9996 * _meridian_arc(lat))) < 1e-3


def test_utm_is_conformal_and_albers_keeps_areas(spark):
    a, f = PJ.WGS84
    e2, h = f * (2 - f), 1e-5
    for epsg, lon, lat in [(32610, -121.3, 52.2), (32710, -125.1, -37.0), (3005, -121.3, 52.2), (3005, -133.0, 59.1)]:
        p, e, n = _xy(spark, [(epsg, lon, lat), (epsg, lon + h, lat), (epsg, lon, lat + h)], True)
        s = math.sin(math.radians(lat))
        east = math.radians(h) * a * math.cos(math.radians(lat)) / math.sqrt(1 - e2 * s * s)
        north = math.radians(h) * a * (1 - e2) / (1 - e2 * s * s) ** 1.5
        ex, ey, nx, ny = ((e[0] - p[0]) / east, (e[1] - p[1]) / east, (n[0] - p[0]) / north, (n[1] - p[1]) / north)
        if epsg == 3005:
            assert abs(ex * ny - ey * nx - 1) < 1e-5
        else:
            assert abs(ex - ny) < 1e-5 and abs(ey + nx) < 1e-5


def test_round_trips_and_unsupported(spark):
    rows = [(e, lon, lat) for e, mid in ((32601, -177), (32610, -123), (32660, 177), (32733, 15), (3857, 10), (3005, -126), (4326, 0), (None, 5))
            for lon in (mid - 2.9, mid, mid + 2.9) for lat in (-59.5, -1.0, 0.0, 33.3, 60.0) if e != 3005 or lat > 40]
    there = _xy(spark, rows, True)
    back = _xy(spark, [(r[0], *t) for r, t in zip(rows, there)], False)
    for r, b in zip(rows, back):
        assert abs(r[1] - b[0]) < 1e-8 and abs(r[2] - b[1]) < 1e-8, (r, b)
    assert _xy(spark, [(2154, 1.0, 2.0), (32600, 1.0, 2.0), (32661, 1.0, 2.0)], False) == [(None, None)] * 3


def _tiles(spark, rows):
    return spark.createDataFrame(rows, TILE)


LONLAT = (0.5, 0.0, -120.0, 0.0, -0.5, 50.0)
UTM = (1000.0, 0.0, 600_000.0, 0.0, -1000.0, 5_500_000.0)
FOUR = [1.0, 2.0, 3.0, 4.0]


def _mixed(spark):
    return _tiles(spark, [
        ("x/P__250m_NDVI_doy2024060_aid0001.tif", 2, 2, *LONLAT, 4326, -9.0, [1.0, -9.0, float("nan"), 4.0]),
        ("x/P__250m_NDVI_doy2024061_aid0001.tif", 2, 2, *LONLAT, None, None, FOUR),
        ("x/grid_SM_20240301.tif", 2, 2, *UTM, 32610, None, FOUR),
        ("x/dem.tif", 1, 1, *LONLAT, 4326, None, [float("inf")]),
        ("x/short_SM_20240301.tif", 2, 2, *LONLAT, 4326, None, [1.0]),
        ("x/far_SM_20240301.tif", 2, 2, *LONLAT, 2154, None, FOUR),
        ("x/flat_SM_20240301.tif", 2, 2, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 4326, None, FOUR),
        (None, 2, 2, *LONLAT, 4326, None, FOUR),
    ])


def test_listing_maps_names_and_keeps_going(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"SM": "root_wetness", "unused": "z", "empty": ""}, indent=2))
    m = files.layer_map(spark, str(tmp_path / "map.json"))
    assert sorted((r.k, r.v) for r in m.collect()) == [("SM", "root_wetness"), ("unused", "z")]
    out = RT.run(spark, _mixed(spark), str(tmp_path / "out"), layer_map=m)
    rows = sorted((r.layer, r.date, round(r.lat, 4), round(r.lon, 4), r.value) for r in out.collect())
    assert [r for r in rows if r[0] == "NDVI"] == [
        ("NDVI", "2024-02-29", 49.25, -119.25, 4.0), ("NDVI", "2024-02-29", 49.75, -119.75, 1.0),
        ("NDVI", "2024-03-01", 49.25, -119.75, 3.0), ("NDVI", "2024-03-01", 49.25, -119.25, 4.0),
        ("NDVI", "2024-03-01", 49.75, -119.75, 1.0), ("NDVI", "2024-03-01", 49.75, -119.25, 2.0)]
    wet = [r for r in rows if r[0] == "root_wetness"]
    assert sorted(r[4] for r in wet) == FOUR and all(49.6 < r[2] < 49.7 and -121.7 < r[3] < -121.5 for r in wet)
    assert {r[0] for r in rows} == {"NDVI", "root_wetness"}  # the infinite pixel is no row
    bad = {(r.path, r.reject_reason) for r in spark.read.parquet(str(tmp_path / "out" / "rejects")).collect()}
    assert bad == {("x/short_SM_20240301.tif", "unreadable"), ("x/far_SM_20240301.tif", "unsupported crs"),
                   ("x/flat_SM_20240301.tif", "unreadable"), (None, "no file name")}
    one = RT.layer_table(spark, str(tmp_path / "out"), "root_wetness")
    assert one.columns == ["lat", "lon", "root_wetness", "date"] and one.count() == 4


def test_listing_override_and_decimation(spark):
    long = RT.tables(_mixed(spark), date="2025-01-02", decimate=2).long.collect()
    assert {r.date for r in long} == {"2025-01-02"} and sorted(r.value for r in long) == [1.0, 1.0, 1.0]


def test_samples_of_pixel_centres_give_the_pixels(spark):
    tiles = _mixed(spark)
    centres = RT.tables(tiles).long.filter("layer = 'SM'").select("lat", "lon", F.col("value").alias("truth")).collect()
    pts = spark.createDataFrame([(r.lat, r.lon, r.truth) for r in centres], "lat double, lon double, truth double")
    long = RT.tables(tiles, points=pts).long.filter("layer = 'SM'")
    got = {(r.lat, r.lon): r.value for r in long.collect()}
    assert got == {(r.lat, r.lon): r.truth for r in centres}


def test_samples_keep_repeats_nulls_and_uncovered_points(spark):
    pts = spark.createDataFrame([(49.75, -119.25, "a"), (49.75, -119.25, "b"), (10.0, 10.0, "far"), (None, 3.0, "null"), (float("nan"), 3.0, "nan")],
                                "LATITUDE double, LONGITUDE double, value string")
    got = RT.tables(_mixed(spark), points=pts, lat="LATITUDE", lon="LONGITUDE")
    assert sorted((r.layer, r.date, r.value) for r in got.long.collect() if r.value is not None) == [("NDVI", "2024-03-01", 2.0)] * 2
    assert sorted((r.layer, r.date) for r in got.long.collect() if r.value is None) == [("NDVI", "2024-02-29")] * 2  # nodata there
    assert sorted(r.value for r in got.uncovered.collect()) == ["far", "nan", "null"]
    with pytest.raises(ContractError):
        RT.tables(_mixed(spark), points=pts)


def test_samples_equal_brute_force_over_systems(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for i in range(40):
        size = rnd.choice([2, 3])
        vals = [float(rnd.randint(0, 99)) for _ in range(size * size)]
        if i % 2:
            rows.append((f"t{i}_L_20240101.tif", size, size, 0.3, 0.0, -122 + rnd.random(), 0.0, -0.2, 50 + rnd.random(), 4326, None, vals))
        else:
            rows.append((f"t{i}_L_20240101.tif", size, size, 20_000.0, 500.0, 520_000 + 100_000 * rnd.random(), -300.0, -15_000.0,
                         5_500_000 + 100_000 * rnd.random(), 32610, None, vals))
    pts = [(49 + 2.5 * rnd.random(), -123 + 2.5 * rnd.random()) for _ in range(150)]
    utm = _xy(spark, [(32610, lo, la) for la, lo in pts], True)
    want = []
    for (la, lo), (ux, uy) in zip(pts, utm):
        for path, r, q, a, b, c, d, e, f, epsg, _, vals in rows:
            x, y = (ux, uy) if epsg == 32610 else (lo, la)
            det = a * e - b * d
            i, j = math.floor((a * (y - f) - d * (x - c)) / det), math.floor((e * (x - c) - b * (y - f)) / det)
            if 0 <= i < r and 0 <= j < q:
                want.append((la, lo, vals[i * q + j]))
    got = RT.tables(_tiles(spark, rows), points=spark.createDataFrame(pts, "lat double, lon double")).long
    assert sorted((r.lat, r.lon, r.value) for r in got.collect()) == sorted(want) and len(want) > 100


def test_empty_and_all_bad(spark, tmp_path):
    for k, tiles in enumerate([_tiles(spark, []), _mixed(spark).filter("path IS NULL")]):
        out = RT.run(spark, tiles, str(tmp_path / f"o{k}"))
        assert out.count() == 0 and out.columns == ["layer", "date", "lat", "lon", "value"]
        pts = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
        got = RT.tables(tiles, points=pts)
        assert got.long.count() == 0 and got.uncovered.count() == 1
