"""Raster tile and static-cache queries (RAS-*, FLT-3/4/8/9, AGG-2..5, GEO-13,
PRJ-11, PRJ-13, PRJ-14, SET-1, SNK-4, SRC-6)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from .. import fixtures as FX
from ..functions import projection as PJ
from ..functions import scalar as S
from ..operators import cache as CA
from ..operators import filters as FL
from ..operators import geo as G
from ..operators import raster as RA
from ..sources import files
from .registry import register
from .spatial import _grid_sql, hav_sql

# ---------------------------------------------------------------- file names

_STEM = "regexp_replace(regexp_replace(path, '^.*/', ''), '[.][^.]*$', '')"
_DOY = "'_doy([0-9]{4})([0-9]{3})'"
_YMD = "'([0-9]{4})[-_]?([0-9]{2})[-_]?([0-9]{2})'"
_NAMES_SQL = FX.with_views("tile_names") + f"""
, s AS (SELECT pk, {_STEM} AS s FROM tile_names),
p AS (SELECT pk, s,
        regexp_matches(s, {_DOY}) AS has_doy, regexp_matches(s, {_YMD}) AS has_ymd,
        regexp_replace(rtrim(regexp_extract(s, '^(.*?)_doy[0-9]{{7}}', 1), '_'), '_aid[0-9]+$', '') AS before_doy,
        rtrim(regexp_extract(s, '^(.*?)[0-9]{{4}}[-_]?[0-9]{{2}}[-_]?[0-9]{{2}}', 1), '_-') AS before_ymd,
        CAST(CAST(make_date(TRY_CAST(regexp_extract(s, {_DOY}, 1) AS INTEGER), 1, 1)
             + TRY_CAST(regexp_extract(s, {_DOY}, 2) AS INTEGER) - 1 AS DATE) AS VARCHAR) AS doy_date,
        regexp_extract(s, {_YMD}, 1) || '-' || regexp_extract(s, {_YMD}, 2) || '-' || regexp_extract(s, {_YMD}, 3) AS ymd_date
      FROM s),
r AS (SELECT pk, CASE WHEN has_doy THEN before_doy WHEN has_ymd THEN (CASE WHEN before_ymd = '' THEN s ELSE before_ymd END)
                      ELSE s END AS raw_layer,
             CASE WHEN has_doy THEN doy_date WHEN has_ymd THEN ymd_date END AS date FROM p),
c1 AS (SELECT *, CASE WHEN contains(raw_layer, '__') THEN string_split(raw_layer, '__')[-1] ELSE raw_layer END AS t1 FROM r),
c2 AS (SELECT *, CASE WHEN contains(t1, '_') THEN string_split(t1, '_')[-1] ELSE t1 END AS t2 FROM c1),
named AS (SELECT pk, raw_layer, CASE WHEN t2 = '' THEN raw_layer ELSE t2 END AS layer, date FROM c2)
"""


def _named(spark, sf_dir) -> DataFrame:
    t = FX.tile_names(spark, sf_dir)
    return t.select("pk", *[e.alias(n) for n, e in RA.parse_layer_and_date("path").items()])


@register("parse_layer_date", _NAMES_SQL + "SELECT pk, layer, date FROM named")
def parse_layer_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS-1: layer and (unvalidated) date from tile file names."""
    return _named(spark, sf_dir).select("pk", "layer", "date")


@register("clean_layer", _NAMES_SQL + "SELECT pk, raw_layer, layer FROM named")
def clean_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir).select("pk", "raw_layer", "layer")


@register("date_override", _NAMES_SQL + "SELECT pk, coalesce('2024-06-01', date) AS date FROM named")
def date_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _named(spark, sf_dir)
    return n.select("pk", RA.date_override(F.col("date"), "2024-06-01").alias("date"))


@register("string_regex", _NAMES_SQL + """
, x AS (SELECT pk, path, regexp_replace(path, '^.*/', '') AS base FROM tile_names)
SELECT x.pk, x.base, regexp_replace(x.base, '[.][^.]*$', '') AS stem, named.layer,
       coalesce(nullif(named.date, ''), 'none') AS date_or_none FROM x JOIN named USING (pk)""")
def string_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-16: basename, stem, regex layer/date, default-if-empty."""
    t = FX.tile_names(spark, sf_dir)
    parsed = RA.parse_layer_and_date("path")
    return t.select(
        "pk", F.substring_index("path", "/", -1).alias("base"), RA.stem("path").alias("stem"),
        parsed["layer"].alias("layer"), F.coalesce(F.nullif(parsed["date"], F.lit("")), F.lit("none")).alias("date_or_none"),
    )


# layer map (SRC-6): FIXED VALUES of the fixture mapping
LAYER_MAP = {"ECONOMY": "EVI", "PROMO": "NDVI", "max": "surface_temp_max"}


@register("layer_map", _NAMES_SQL + """
, m AS (SELECT * FROM (VALUES ('ECONOMY', 'EVI'), ('PROMO', 'NDVI'), ('max', 'surface_temp_max')) t(k, v))
SELECT pk, coalesce(m.v, named.layer) AS layer FROM named LEFT JOIN m ON named.layer = m.k""")
def layer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: names mapped by a JSON file; unmapped ones pass."""
    n = _named(spark, sf_dir)
    m = _layer_map(spark)
    return n.join(m, n.layer == m.k, "left").select("pk", F.coalesce("v", "layer").alias("layer"))


def _layer_map(spark) -> DataFrame:
    """The map as a file of the shared folder, read as a job reads it."""
    from ..session import scratch_path

    path = scratch_path(spark, "layer-map")
    spark.range(1).select(F.lit(json.dumps(LAYER_MAP, indent=1)).alias("value")).write.text(path)
    return files.layer_map(spark, path)


# ---------------------------------------------------------------- tiles

_GOOD = "(len(\"values\") = rows * cols AND (epsg IS NULL OR epsg = 4326))"
_PIX_BODY = f"""
, px AS (SELECT t.tile, t.nodata, CAST(i // cols AS INTEGER) AS row, CAST(i % cols AS INTEGER) AS col,
                t.d * (i % cols + 0.5) + t.e * (i // cols + 0.5) + t.f AS lat,
                t.a * (i % cols + 0.5) + t.b * (i // cols + 0.5) + t.c AS lon,
                t."values"[i + 1] AS value, t.tile % 2 AS lay, t.tile % 3 AS dd
         FROM tiles t, range(len(t."values")) r(i) WHERE {_GOOD}),
valid AS (SELECT * FROM px WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) <> 'inf'::DOUBLE
                              AND (nodata IS NULL OR value <> nodata))
"""


_PIX_SQL = FX.with_views("tiles") + _PIX_BODY


def _good_tiles(spark, sf_dir) -> DataFrame:
    good, _ = RA.split_tiles(FX.tiles(spark, sf_dir))
    return good


@register("raster_to_long", _PIX_SQL + """
SELECT tile, row, col, round(lat, 8) AS lat, round(lon, 8) AS lon, value FROM valid""", headline=True)
def raster_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = RA.raster_to_long(_good_tiles(spark, sf_dir))
    return px.select("tile", "row", "col", S.round8("lat").alias("lat"), S.round8("lon").alias("lon"), "value")


@register("decimate", _PIX_SQL + """
SELECT tile, row, col, value FROM valid WHERE row % 3 = 0 AND col % 3 = 0""")
def decimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RA.raster_to_long(_good_tiles(spark, sf_dir), decimate=3).select("tile", "row", "col", "value")


@register("pixel_center", _PIX_SQL + "SELECT tile, row, col, round(lat, 8) AS lat, round(lon, 8) AS lon FROM px")
def pixel_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = RA.raster_to_long(_good_tiles(spark, sf_dir), drop_invalid=False)
    return px.select("tile", "row", "col", S.round8("lat").alias("lat"), S.round8("lon").alias("lon"))


@register("nodata_to_null", _PIX_SQL + """
SELECT tile, row, col, CASE WHEN value = nodata THEN NULL ELSE value END AS value FROM px""")
def nodata_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _good_tiles(spark, sf_dir)
    px = RA.raster_to_long(good, keep=["tile", "nodata"], drop_invalid=False)
    return px.select("tile", "row", "col", S.nodata_to_null("value", "nodata").alias("value"))


@register("sample_points", FX.with_views("tiles", "points") + f"""
, g AS (SELECT * FROM tiles WHERE {_GOOD}),
j AS (SELECT p.k, g.tile, CAST(floor((g.a * (p.la - g.f) - g.d * (p.lo - g.c)) / (g.a * g.e - g.b * g.d)) AS INTEGER) AS row,
             CAST(floor((g.e * (p.lo - g.c) - g.b * (p.la - g.f)) / (g.a * g.e - g.b * g.d)) AS INTEGER) AS col,
             g.cols, g.rows, g."values", g.nodata FROM points p, g),
s AS (SELECT k, tile, row, col, "values"[row * cols + col + 1] AS raw, nodata FROM j
      WHERE row >= 0 AND row < rows AND col >= 0 AND col < cols)
SELECT p.k, s.tile, s.row, s.col,
       CASE WHEN raw IS NULL OR isnan(raw) OR abs(raw) = 'inf'::DOUBLE OR raw = nodata THEN NULL ELSE raw END AS value
FROM points p LEFT JOIN s ON p.k = s.k""")
def sample_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS-7: every point once per covering tile; points no tile covers keep a
    row with null tile and value."""
    pts = FX.points(spark, sf_dir)
    s = RA.sample_points(_good_tiles(spark, sf_dir), pts, "la", "lo", "k")
    return pts.select("k").join(s, "k", "left").select("k", "tile", "row", "col", "value")


@register("crs_identity", FX.with_views("tiles") + """
SELECT tile, epsg IS NULL OR epsg = 4326 AS accepted FROM tiles""")
def crs_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.tiles(spark, sf_dir).select("tile", RA.crs_is_lonlat().alias("accepted"))


@register("skip_bad_tile", FX.with_views("tiles") + """
SELECT tile, CASE WHEN NOT (len("values") = rows * cols) THEN 'unreadable' ELSE 'unsupported crs' END AS reject_reason
FROM tiles WHERE NOT (len("values") = rows * cols AND (epsg IS NULL OR epsg = 4326))""")
def skip_bad_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS-9: bad tiles go to a rejects table; the good ones go on."""
    _, rejects = RA.split_tiles(FX.tiles(spark, sf_dir))
    return rejects.select("tile", "reject_reason")


@register("inf_to_null", FX.with_views("ratings") + """
SELECT id, CASE WHEN x IS NULL OR isnan(x) OR abs(x) = 'inf'::DOUBLE THEN NULL ELSE x END AS x FROM (
  SELECT id, CASE id % 13 WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN '-inf'::DOUBLE WHEN 2 THEN 'nan'::DOUBLE
                          ELSE CAST(p AS DOUBLE) END AS x FROM ratings)""")
def inf_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-8: +-Inf (and NaN) become null at ingest."""
    r = FX.ratings(spark, sf_dir)
    x = (F.when(F.col("id") % 13 == 0, F.lit(float("inf"))).when(F.col("id") % 13 == 1, F.lit(float("-inf")))
         .when(F.col("id") % 13 == 2, F.lit(float("nan"))).otherwise(F.col("p").cast("double")))
    return FL.inf_nan_to_null(r.select("id", x.alias("x")), ["x"])


# ---------------------------------------------------------------- pixels -> cache


def _pixels(spark, sf_dir) -> DataFrame:
    """Pixel long table: layer EVI for even tiles, NDVI for odd ones; date from the tile id."""
    px = RA.raster_to_long(_good_tiles(spark, sf_dir))
    return px.select(
        (F.col("tile") * 100 + F.col("row") * 8 + F.col("col")).alias("pid"),
        F.when(F.col("tile") % 2 == 0, "EVI").otherwise("NDVI").alias("layer"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("tile") % 3).cast("int")).alias("date"),
        "lat", "lon", "value", "tile", "row", "col",
    )


_PIXELS_BODY = _PIX_BODY + """
, pixels AS (SELECT tile * 100 + row * 8 + col AS pid, CASE WHEN tile % 2 = 0 THEN 'EVI' ELSE 'NDVI' END AS layer,
                    CAST(DATE '2024-01-01' + CAST(tile % 3 AS INTEGER) AS DATE) AS date, lat, lon, value, tile, row, col FROM valid),
latest AS (SELECT * FROM pixels WHERE date = (SELECT max(date) FROM pixels p2 WHERE p2.layer = pixels.layer))
"""
_PIXELS_SQL = FX.with_views("tiles") + _PIXELS_BODY


@register("latest_or_pinned", _PIXELS_SQL + "SELECT tile, row, col, layer, date FROM latest")
def latest_or_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4 per layer: the newest date's pixels of each layer."""
    return CA.pixels_latest(_pixels(spark, sf_dir)).select("tile", "row", "col", "layer", "date")


_NN_WIDE_BODY = f"""
, nn AS (SELECT gid, layer, value FROM (
    SELECT grid.gid, l.layer, l.value,
           row_number() OVER (PARTITION BY grid.gid, l.layer ORDER BY {hav_sql('grid.lat', 'grid.lon', 'l.lat', 'l.lon')}, l.pid) AS rn
    FROM grid, latest l) WHERE rn = 1),
wide AS (SELECT grid.gid, grid.lat, grid.lon, max(nn.value) FILTER (WHERE nn.layer = 'EVI') AS EVI,
                max(nn.value) FILTER (WHERE nn.layer = 'NDVI') AS NDVI
         FROM grid LEFT JOIN nn ON grid.gid = nn.gid GROUP BY grid.gid, grid.lat, grid.lon)
"""
_WIDE_SQL = _grid_sql(0.5, "tiles") + _PIXELS_BODY + _NN_WIDE_BODY


def _wide(spark, sf_dir) -> DataFrame:
    from ..plans import static_cache

    grid = G.build_grid(G.bbox_of(FX.points(spark, sf_dir), "la", "lo"), 0.5)
    present = ["EVI", "NDVI"]  # the layers of the input (fixture: tile parity)
    return static_cache.from_pixels(grid, _pixels(spark, sf_dir), present)


@register("wide_cache", _WIDE_SQL + """
SELECT gid, EVI, NDVI, CAST(0.0 AS DOUBLE) AS rootzone_wetness_mean FROM wide""", headline=True)
def wide_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-14 (+GEO-4 per layer, FLT-4, PRJ-6): static cache in contract order;
    a feature without input layer is 0.0."""
    return _wide(spark, sf_dir).select("gid", "EVI", "NDVI", "rootzone_wetness_mean")


@register("add_missing_zero", _WIDE_SQL + """
SELECT gid, CAST(0.0 AS DOUBLE) AS surface_temp_max, CAST(0.0 AS DOUBLE) AS evapotranspiration_max FROM wide""")
def add_missing_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6: absent feature columns become 0.0."""
    grid = G.build_grid(G.bbox_of(FX.points(spark, sf_dir), "la", "lo"), 0.5)
    return C.add_missing_zero(grid.select("gid"), ["surface_temp_max", "evapotranspiration_max"])


_ELEV_SQL = """
, elev AS (SELECT round(b.lat_min + round((la - b.lat_min) / 0.5) * 0.5, 4) AS lat,
                  round(b.lon_min + round((lo - b.lon_min) / 0.5) * 0.5, 4) AS lon, max(v) AS elevation
           FROM sites, b GROUP BY 1, 2)
"""


@register("default_elevation", _grid_sql(0.5, "tiles", "sites") + _PIXELS_BODY + _NN_WIDE_BODY + _ELEV_SQL + """
SELECT w.gid, coalesce(e.elevation, 0.0) AS elevation FROM wide w LEFT JOIN elev e ON w.lat = e.lat AND w.lon = e.lon""")
def default_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-11: elevations from a supplied table on the coordinate key, else 0.0."""
    cache = _wide(spark, sf_dir).drop("elevation")
    box = G.bbox_of(FX.points(spark, sf_dir), "la", "lo")
    lat0, lon0 = box.select("lat_min").scalar(), box.select("lon_min").scalar()
    elev = FX.sites(spark, sf_dir).select(
        S.round4(lat0 + F.round((F.col("la") - lat0) / 0.5) * 0.5).alias("lat"),
        S.round4(lon0 + F.round((F.col("lo") - lon0) / 0.5) * 0.5).alias("lon"), "v",
    ).groupBy("lat", "lon").agg(F.max("v").alias("elevation"))
    return CA.default_elevation(cache, elev).select("gid", "elevation")


@register("value_layer_rename", _PIXELS_SQL + """
SELECT tile, row, col, max(value) FILTER (WHERE layer = 'EVI') AS EVI, max(value) FILTER (WHERE layer = 'NDVI') AS NDVI
FROM pixels GROUP BY tile, row, col""")
def value_layer_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-13: long (value, layer) -> wide (one column per layer) by pivot."""
    px = _pixels(spark, sf_dir)
    return px.groupBy("tile", "row", "col").pivot("layer", ["EVI", "NDVI"]).agg(F.first("value"))


def _layer_frames(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    px = _pixels(spark, sf_dir)
    evi = px.filter(F.col("layer") == "EVI").select("pid", "lat", "lon", F.col("value").alias("EVI"), "date")
    ndvi = px.filter(F.col("layer") == "NDVI").select("pid", "lat", "lon", F.col("value").alias("NDVI"))
    return evi, ndvi


@register("union_frames", _PIXELS_SQL + """
SELECT pid, lat, lon, value AS EVI, CAST(NULL AS DOUBLE) AS NDVI, date FROM pixels WHERE layer = 'EVI'
UNION ALL SELECT pid, lat, lon, NULL, value, NULL FROM pixels WHERE layer = 'NDVI'""")
def union_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-1: frames matched by name; absent columns are null (bag union)."""
    evi, ndvi = _layer_frames(spark, sf_dir)
    u = evi.unionByName(ndvi, allowMissingColumns=True)
    return u.select("pid", S.round8("lat").alias("lat"), S.round8("lon").alias("lon"), "EVI", "NDVI", "date")


@register("combined_sink", _PIXELS_SQL + """
SELECT pid, lat, lon, value, date, layer FROM pixels""")
def combined_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: per-layer frames -> one long (lat, lon, value, date, layer) table,
    written as parquet partitioned by layer and read back."""
    from ..session import scratch_path

    evi, ndvi = _layer_frames(spark, sf_dir)
    ndvi = ndvi.join(_pixels(spark, sf_dir).select("pid", "date"), "pid")
    longs = [evi.withColumnRenamed("EVI", "value").withColumn("layer", F.lit("EVI")),
             ndvi.withColumnRenamed("NDVI", "value").withColumn("layer", F.lit("NDVI"))]
    u = longs[0].unionByName(longs[1], allowMissingColumns=True)
    path = scratch_path(spark, "combined")
    u.write.mode("overwrite").partitionBy("layer").parquet(path)
    back = spark.read.parquet(path)
    return back.select("pid", S.round8("lat").alias("lat"), S.round8("lon").alias("lon"), "value", "date", "layer")


# ---------------------------------------------------------------- station history

_FEATS = ["evi", "ndvi", "temp"]


def _history(spark, sf_dir) -> DataFrame:
    """Station history with coordinates from the points and gaps in them."""
    sd = FX.station_day(spark, sf_dir)
    pts = FX.points(spark, sf_dir)
    j = sd.join(pts, sd.st == pts.k)
    return j.select(
        F.col("st").alias("station_code"), F.col("d").alias("date"), "evi", "ndvi", "temp",
        F.when(F.dayofmonth("d") % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("la")).alias("lat"),
        F.when(F.dayofmonth("d") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("lo") + F.dayofmonth("d") / 100).alias("lon"),
    )


_HIST_SQL = FX.with_views("station_day", "points") + """
, hist AS (SELECT st AS station_code, d AS date, evi, ndvi, temp,
                  CASE WHEN dayofmonth(d) % 4 = 0 THEN NULL ELSE la END AS lat,
                  CASE WHEN dayofmonth(d) % 5 = 0 THEN NULL ELSE lo + dayofmonth(d) / 100 END AS lon
           FROM station_day JOIN points ON st = k)
"""


@register("station_median", _HIST_SQL + """
SELECT station_code, round(median(evi), 8) AS evi, round(median(ndvi), 8) AS ndvi, round(median(temp), 8) AS temp
FROM hist WHERE date <= DATE '2024-01-20' GROUP BY station_code""")
def station_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 (+FLT-3): exact median of each station's non-null history up to a day."""
    s = CA.station_summary(_history(spark, sf_dir), _FEATS, upto="2024-01-20")
    return s.select("station_code", *[S.round8(f).alias(f) for f in _FEATS])


@register("last_non_null", _HIST_SQL + """
SELECT station_code, arg_max(lat, date) FILTER (WHERE lat IS NOT NULL) AS lat,
       arg_max(lon, date) FILTER (WHERE lon IS NOT NULL) AS lon FROM hist GROUP BY station_code""")
def last_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3: last non-null coordinate in date order (null dates last)."""
    s = CA.station_summary(_history(spark, sf_dir), [])
    return s.select("station_code", "lat", "lon")


@register("upto_date", FX.with_views("station_day_long") + """
SELECT st, d, id FROM station_day_long WHERE d <= DATE '1998-06-30'""")
def upto_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.upto_date(FX.station_day_long(spark, sf_dir), "d", "1998-06-30").select("st", "d", "id")


@register("group_fallback", _HIST_SQL + """
SELECT lat, lon, round(median(temp), 8) AS temp FROM hist WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY lat, lon""")
def group_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-4: without a station id the history is grouped by (lat, lon)."""
    h = _history(spark, sf_dir).drop("station_code")
    s = CA.station_summary(h, ["temp"], key=None)
    return s.select("lat", "lon", S.round8("temp").alias("temp"))


@register("global_median", FX.with_views("sites") + """
SELECT round(coalesce(median(v), 0.0), 8) AS med_v,
       coalesce(median(CASE WHEN v < 0 AND v > 0 THEN v END), 0.0) AS med_none FROM sites""")
def global_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-5: median over all stations, nulls skipped, 0.0 when all null."""
    s = FX.sites(spark, sf_dir).withColumn("none", F.lit(None).cast("double"))
    return spark.range(1).select(S.round8(CA.global_median(s, "v")).alias("med_v"), CA.global_median(s, "none").alias("med_none"))


@register("station_pixel_merge", FX.with_views("tiles", "station_day", "points") + _PIXELS_BODY + f"""
, locs AS (SELECT DISTINCT layer, lat, lon FROM pixels),
locs_k AS (SELECT *, row_number() OVER (ORDER BY layer, lat, lon) AS lk FROM locs),
st AS (SELECT DISTINCT st, la, lo FROM station_day JOIN points ON st = k),
snap AS (SELECT st, layer, lat, lon FROM (
   SELECT st.st, l.layer, l.lat, l.lon,
          row_number() OVER (PARTITION BY st.st, l.layer ORDER BY {hav_sql('st.la', 'st.lo', 'l.lat', 'l.lon')}, l.lat, l.lon) AS rn
   FROM st, locs_k l) WHERE rn = 1),
vals AS (SELECT layer, lat, lon, date, max(value) AS value FROM pixels GROUP BY 1, 2, 3, 4)
SELECT sd.st, sd.d, s.layer, v.value FROM station_day sd JOIN snap s ON sd.st = s.st
JOIN vals v ON v.layer = s.layer AND v.lat = s.lat AND v.lon = s.lon AND v.date = sd.d""")
def station_pixel_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-13: per layer, each station snaps to its nearest pixel location and
    takes that pixel's value of the same day (pixels of one location and date
    are reduced to their max first)."""
    px = _pixels(spark, sf_dir)
    locs = px.select("layer", "lat", "lon").distinct().withColumn(
        "lk", F.struct("lat", "lon"))  # ties on distance go to the smaller (lat, lon)
    sd = FX.station_day(spark, sf_dir)
    st = sd.select("st").distinct().join(FX.points(spark, sf_dir), F.col("st") == F.col("k")).select("st", "la", "lo")
    q = st.select("st", "la", "lo", F.explode(F.array(F.lit("EVI"), F.lit("NDVI"))).alias("layer"))
    nn = G.nearest_by_pyramid(q, locs, "st", "lk", "la", "lo", "lat", "lon", group=["layer"])
    snap = nn.select("st", "layer", F.col("nn_key.lat").alias("lat"), F.col("nn_key.lon").alias("lon"))
    # only the snapped pixel locations matter: a (small) semi-join first, then the per-day reduction
    vals = px.join(snap.select("layer", "lat", "lon").distinct(), ["layer", "lat", "lon"], "left_semi") \
        .groupBy("layer", "lat", "lon", "date").agg(F.max("value").alias("value"))
    j = sd.select("st", "d").join(snap, "st").join(
        vals, (vals.layer == snap.layer) & (vals.lat == snap.lat) & (vals.lon == snap.lon) & (vals.date == F.col("d")))
    return j.select("st", "d", snap.layer, "value")


# ---------------------------------------------------------------- raster-to-table job

# The fixture tiles as a job meets them: a file name each, and the UTM ones with an affine in metres.
_FILES_SQL = """
, files AS (SELECT CASE tile % 4 WHEN 0 THEN 'in/MOD13Q1.061__250m_16_days_PROMO_doy2024' || lpad(CAST(tile % 366 + 1 AS VARCHAR), 3, '0') || '_aid0001.tif'
                                 WHEN 1 THEN 'in/station__ECONOMY_2023-07-' || lpad(CAST(tile % 28 + 1 AS VARCHAR), 2, '0') || '.tif'
                                 WHEN 2 THEN 'in/dem.tif' END AS path,
                   CASE tile % 4 WHEN 0 THEN 'NDVI' WHEN 1 THEN 'EVI' WHEN 2 THEN 'dem' END AS layer,
                   CASE tile % 4 WHEN 0 THEN CAST(CAST(DATE '2024-01-01' + CAST(tile % 366 AS INTEGER) AS DATE) AS VARCHAR)
                                 WHEN 1 THEN '2023-07-' || lpad(CAST(tile % 28 + 1 AS VARCHAR), 2, '0') END AS date,
                   tile, rows, cols, epsg, nodata, "values", b, d,
                   CASE WHEN epsg = 32610 THEN 5000.0::DOUBLE ELSE a END AS a, CASE WHEN epsg = 32610 THEN -5000.0::DOUBLE ELSE e END AS e,
                   CASE WHEN epsg = 32610 THEN 300000.0::DOUBLE + 8000 * (tile % 50) ELSE c END AS c,
                   CASE WHEN epsg = 32610 THEN 6650000.0::DOUBLE - 40000 * (tile % 23) ELSE f END AS f FROM tiles),
good AS (SELECT * FROM files WHERE len("values") = rows * cols AND path IS NOT NULL)"""


def _krueger(terms: tuple, outer: str, inner: str) -> str:
    return " + ".join(f"({t!r}::DOUBLE) * {outer.format(j=2 * j)}" + (f" * {inner.format(j=2 * j)}" if inner else "") for j, t in enumerate(terms, 1))


_UTM = f"({PJ.UTM_SCALE * PJ.RECTIFYING!r}::DOUBLE)"


def _cosh(x: str) -> str:
    return f"((exp({x}) + exp(-({x}))) / 2)"


def _sinh(x: str) -> str:
    return f"((exp({x}) - exp(-({x}))) / 2)"


_UTM_INVERSE_SQL = f"""
, u1 AS (SELECT *, y / {_UTM} AS xi, (x - 500000.0) / {_UTM} AS eta FROM centres),
u2 AS (SELECT *, xi - ({_krueger(PJ.BETA, 'sin({j} * xi)', _cosh('{j} * eta'))}) AS xi1,
                 eta - ({_krueger(PJ.BETA, 'cos({j} * xi)', _sinh('{j} * eta'))}) AS eta1 FROM u1),
u3 AS (SELECT *, asin(sin(xi1) / {_cosh('eta1')}) AS chi FROM u2),
placed AS (SELECT * EXCLUDE (xi, eta, xi1, eta1, chi),
                  CASE WHEN epsg = 32610 THEN degrees(radians(-123.0) + atan2({_sinh('eta1')}, cos(xi1))) ELSE x END AS lon,
                  CASE WHEN epsg = 32610 THEN degrees(chi + {_krueger(PJ.DELTA, 'sin({j} * chi)', '')}) ELSE y END AS lat FROM u3)"""


def _tile_files(spark, sf_dir) -> DataFrame:
    t = FX.tiles(spark, sf_dir)
    n = F.col("tile")
    utm = F.col("epsg") == 32610
    path = (F.when(n % 4 == 0, F.concat(F.lit("in/MOD13Q1.061__250m_16_days_PROMO_doy2024"), F.lpad((n % 366 + 1).cast("string"), 3, "0"), F.lit("_aid0001.tif")))
            .when(n % 4 == 1, F.concat(F.lit("in/station__ECONOMY_2023-07-"), F.lpad((n % 28 + 1).cast("string"), 2, "0"), F.lit(".tif")))
            .when(n % 4 == 2, "in/dem.tif"))
    return t.withColumns({
        "path": path, "a": F.when(utm, 5000.0).otherwise(F.col("a")), "e": F.when(utm, -5000.0).otherwise(F.col("e")),
        "c": F.when(utm, 300000.0 + 8000 * (n % 50)).otherwise(F.col("c")),
        "f": F.when(utm, 6650000.0 - 40000 * (n % 23)).otherwise(F.col("f")),
    })


@register("raster_table", FX.with_views("tiles") + _FILES_SQL + """
, centres AS (SELECT layer, date, epsg, "values"[i + 1] AS value, nodata,
                     a * (i % cols + 0.5) + b * (i // cols + 0.5) + c AS x, d * (i % cols + 0.5) + e * (i // cols + 0.5) + f AS y
              FROM good, range(len("values")) r(i) WHERE (i // cols) % 2 = 0 AND (i % cols) % 2 = 0)""" + _UTM_INVERSE_SQL + """
SELECT layer, date, round(lat, 6) AS lat, round(lon, 6) AS lon, value FROM placed
WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) <> 'inf'::DOUBLE AND (nodata IS NULL OR value <> nodata)""")
def raster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster-to-table job, listing: names and dates from files, layer map,
    every second pixel by row and column, UTM tiles in longitude and latitude,
    written by layer and read back as the combined table."""
    from ..plans import raster_table as job
    from ..session import scratch_path

    out = job.run(spark, _tile_files(spark, sf_dir), scratch_path(spark, "raster-table"), layer_map=_layer_map(spark), decimate=2)
    return out.select("layer", "date", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "value")


_UTM_FORWARD_SQL = f"""
, f1 AS (SELECT *, sin(radians(la)) AS s, radians(lo) - radians(-123.0) AS dl FROM points),
f2 AS (SELECT *, atanh(s) - {2 * PJ.N3**0.5 / (1 + PJ.N3)!r}::DOUBLE * atanh({2 * PJ.N3**0.5 / (1 + PJ.N3)!r}::DOUBLE * s) AS psi FROM f1),
f3 AS (SELECT *, {_sinh('psi')} AS t FROM f2),
f4 AS (SELECT *, atan2(t, cos(dl)) AS xi1, atanh(sin(dl) / sqrt(1 + t * t)) AS eta1 FROM f3),
utm AS (SELECT k, la, lo, 500000.0 + {_UTM} * (eta1 + {_krueger(PJ.ALPHA, 'cos({j} * xi1)', _sinh('{j} * eta1'))}) AS ux,
               {_UTM} * (xi1 + {_krueger(PJ.ALPHA, 'sin({j} * xi1)', _cosh('{j} * eta1'))}) AS uy FROM f4)"""


@register("raster_samples", FX.with_views("tiles", "points") + _FILES_SQL + _UTM_FORWARD_SQL + """
, met AS (SELECT k, la, lo, CASE WHEN epsg = 32610 THEN ux ELSE lo END AS x, CASE WHEN epsg = 32610 THEN uy ELSE la END AS y, good.* FROM utm, good),
j AS (SELECT *, floor((a * (y - f) - d * (x - c)) / (a * e - b * d)) AS r, floor((e * (x - c) - b * (y - f)) / (a * e - b * d)) AS q FROM met),
hit AS (SELECT k, la, lo, layer, date, "values"[CAST(r * cols + q + 1 AS BIGINT)] AS raw, nodata FROM j WHERE r >= 0 AND r < rows AND q >= 0 AND q < cols)
SELECT layer, date, la AS lat, lo AS lon,
       CASE WHEN raw IS NULL OR isnan(raw) OR abs(raw) = 'inf'::DOUBLE OR raw = nodata THEN NULL ELSE raw END AS value FROM hit""")
def raster_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster-to-table job, sampling: every point in every tile that covers it,
    in the tile's own system."""
    from ..plans import raster_table as job

    pts = FX.points(spark, sf_dir)
    return job.tables(_tile_files(spark, sf_dir), layer_map=_layer_map(spark), points=pts, lat="la", lon="lo").long
