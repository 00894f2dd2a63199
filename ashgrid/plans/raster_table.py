"""Raster-to-table job: decoded tiles -> long tables per layer and date.

The layer and date of a tile come from its file name (RAS-1/2), names are
mapped by a JSON file (SRC-6), the date may be overridden (RAS-3).  Unreadable
tiles and tiles in a reference system that ``functions.projection`` does not
know go to the rejects, the others go on (RAS-8/9).  Then either every valid
pixel is listed (RAS-4..6) or the tiles are sampled at given points (RAS-7), in
the tile's own system; coordinates in the result are longitude and latitude.

Both modes are one plan without actions.  Listing shuffles nothing; sampling
joins boxes of tiles with cells of points and then fetches pixels by tile.  The
result is written once, partitioned by layer: a layer's folder is the table of
that layer (SNK-3), the whole folder is the combined table (SNK-4).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import require_columns
from ..functions import projection as PJ
from ..operators import raster as RA

METRES = 100_000.0  # projected coordinates are counted in units of this, so that a cell is about a degree in all systems


class Tables(NamedTuple):
    long: DataFrame  # layer, date, lat, lon, value
    rejects: DataFrame  # the tiles' columns but the pixels, reject_reason
    uncovered: DataFrame | None  # points mode: points (and null ones) without a tile


def tagged(tiles: DataFrame, layer_map: DataFrame | None = None, date: str | None = None) -> DataFrame:
    """Tiles with __layer and __date from ``path``.  ``layer_map`` (k, v) renames
    layers, others keep their name; of several names for a key the smallest is
    taken.  It is as small as the list of layers; Spark decides on its join."""
    names = RA.parse_layer_and_date("path")
    t = tiles.withColumns({"__layer": names["layer"], "__date": RA.date_override(names["date"], date)})
    if layer_map is None:
        return t
    m = layer_map.groupBy(F.col("k").alias("__k")).agg(F.min("v").alias("__v"))
    return t.join(m, t["__layer"] == m["__k"], "left").withColumn("__layer", F.coalesce("__v", "__layer")).drop("__k", "__v")


def split(tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): as ``raster.split_tiles`` with all supported systems."""
    singular = F.coalesce(F.col("a") * F.col("e") - F.col("b") * F.col("d") == 0, F.lit(True))
    reason = (F.when(~RA.tile_is_valid() | singular, "unreadable").when(F.col("path").isNull() | (RA.stem("path") == ""), "no file name")
              .when(~PJ.supported(F.col("epsg")), "unsupported crs"))
    t = tiles.withColumn("reject_reason", reason)
    return t.filter("reject_reason IS NULL").drop("reject_reason"), t.filter("reject_reason IS NOT NULL").drop("values")


def pixels(good: DataFrame, decimate: int = 1) -> DataFrame:
    """Valid pixels of tagged tiles; centres in longitude and latitude."""
    px = RA.raster_to_long(good, decimate=decimate, keep=["__layer", "__date", "epsg"])
    lon, lat = PJ.to_lonlat(F.col("epsg"), F.col("lon"), F.col("lat"))
    return px.select(F.col("__layer").alias("layer"), F.col("__date").alias("date"), lat.alias("lat"), lon.alias("lon"), "value")


def samples(good: DataFrame, points: DataFrame, lat: str, lon: str) -> tuple[DataFrame, DataFrame]:
    """(long, uncovered): each point in each tile that covers it, null where the
    pixel has no value.  Points without coordinates are uncovered.  Points at the
    same place are one place for the join and several rows in the result."""
    unit = F.when(PJ.is_lonlat(F.col("epsg")), 1.0).otherwise(METRES)
    scaled = good.select("values", "rows", "cols", "nodata", "__layer", "__date", F.coalesce("epsg", F.lit(4326)).cast("int").alias("epsg"),
                         F.col("path").alias("tile"), *[(F.col(c) / unit).alias(c) for c in "abcdef"])
    places = points.groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).agg(F.count(F.lit(1)).alias("__n"))
    places = places.filter("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    # one row of at most 123 codes
    systems = scaled.agg(F.collect_set("epsg").alias("s")).scalar()
    at = places.withColumn("epsg", F.explode(systems))
    x, y = PJ.from_lonlat(F.col("epsg"), F.col("lon"), F.col("lat"))
    # a place that a system cannot show has no number there, or one far outside of it
    at = at.withColumns({"__x0": x / unit, "__y0": y / unit}).filter("abs(__x0) < 1e6 AND abs(__y0) < 1e6")
    at = at.withColumn("__p", F.struct("lat", "lon", "__n"))
    got = RA.sample_points(scaled, at, "__y0", "__x0", "__p", by=["epsg"], keep=["__layer", "__date"])
    rows = got.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__p.__n"))))
    long = rows.select(F.col("__layer").alias("layer"), F.col("__date").alias("date"), F.col("__p.lat").alias("lat"),
                       F.col("__p.lon").alias("lon"), "value")
    hit = long.select(F.col("lat").alias("__hlat"), F.col("lon").alias("__hlon")).distinct()
    left = points.join(hit, (points[lat].cast("double") == F.col("__hlat")) & (points[lon].cast("double") == F.col("__hlon")), "left_anti")
    return long, left


def tables(tiles: DataFrame, layer_map: DataFrame | None = None, date: str | None = None, decimate: int = 1,
           points: DataFrame | None = None, lat: str = "lat", lon: str = "lon") -> Tables:
    """tiles: path, rows, cols, a..f (affine), epsg, nodata, values.  An empty or
    all-bad table gives empty results; a repeated tile is listed again."""
    good, rejects = split(tiles)
    good = tagged(good, layer_map, date)
    if points is None:
        return Tables(pixels(good, decimate), rejects, None)
    require_columns(points, [lat, lon])
    long, uncovered = samples(good, points, lat, lon)
    return Tables(long, rejects, uncovered)


def run(spark: SparkSession, tiles: DataFrame, out_dir: str, fmt: str = "csv", **options) -> DataFrame:
    """Write ``tables`` under ``out_dir`` (layers, rejects, uncovered) and return
    the combined table as written.  Layers are folders; a rerun replaces them."""
    got = tables(tiles, **options)
    got.long.write.mode("overwrite").partitionBy("layer").option("header", True).format(fmt).save(f"{out_dir}/layers")
    got.rejects.write.mode("overwrite").parquet(f"{out_dir}/rejects")
    if got.uncovered is not None:
        got.uncovered.write.mode("overwrite").parquet(f"{out_dir}/uncovered")
    return combined(spark, out_dir, fmt)


SCHEMA = "date string, lat double, lon double, value double, layer string"


def combined(spark: SparkSession, out_dir: str, fmt: str = "csv") -> DataFrame:
    """SNK-4: all layers of a written job; empty where it wrote no row."""
    try:
        return spark.read.schema(SCHEMA).option("header", True).format(fmt).load(f"{out_dir}/layers").select(
            "layer", "date", "lat", "lon", "value")
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], SCHEMA).select("layer", "date", "lat", "lon", "value")


def layer_table(spark: SparkSession, out_dir: str, layer: str, fmt: str = "csv") -> DataFrame:
    """SNK-3: lat, lon, the layer's value under its own name, date; only that
    layer's folder is read."""
    return combined(spark, out_dir, fmt).filter(F.col("layer") == layer).select(
        "lat", "lon", F.col("value").alias(layer), "date")
