"""Static (satellite) cache jobs.

* ``from_tiles``: decoded tiles -> good tiles (rejects apart) -> pixels with
  layer and date -> latest slice per layer -> nearest pixel per grid point and
  layer (one nearest join for all layers) -> one column per feature, missing
  elevation from a supplied table, else 0.0.
* ``from_stations``: station history -> per-station medians and last
  coordinates -> nearest station per grid point -> nulls from the
  all-station median.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..operators import cache as CA
from ..operators import raster as RA


def pixels_from_tiles(tiles: DataFrame, layer: Column, date: Column, decimate: int = 1) -> tuple[DataFrame, DataFrame]:
    """(pixels, rejects): pixels have pid, layer, date, lat, lon, value."""
    good, rejects = RA.split_tiles(tiles)
    tagged = good.withColumns({"__layer": layer, "__date": date})
    px = RA.raster_to_long(tagged, decimate=decimate, keep=["tile", "__layer", "__date"])
    px = px.select(
        F.xxhash64("tile", "row", "col").alias("pid"), F.col("__layer").alias("layer"), F.col("__date").alias("date"),
        "lat", "lon", "value", "tile", "row", "col",
    )
    return px, rejects


def from_pixels(grid: DataFrame, pixels: DataFrame, layers: Sequence[str], pinned: str | None = None,
                elevations: DataFrame | None = None, key: str = "gid") -> DataFrame:
    """Wide cache on the grid in contract order.  ``layers`` are the layers
    the input has (the file set); features without a layer are 0.0."""
    latest = CA.pixels_latest(pixels, "date", pinned)
    nn = CA.nearest_per_layer(grid, latest, layers, key)
    wide = CA.wide_cache(grid, nn, list(layers), key)
    if elevations is not None and "elevation" not in layers:
        wide = CA.default_elevation(wide.drop("elevation"), elevations)
    return wide


def from_stations(grid: DataFrame, history: DataFrame, features: Sequence[str] = C.SATELLITE_FEATURES,
                  upto: str | None = None, key: str = "gid") -> DataFrame:
    present = [f for f in features if f in history.columns]
    stations = CA.station_summary(history, present, upto=upto)
    seeded = CA.seed_from_stations(grid, stations, present, key)
    return C.add_missing_zero(seeded, list(features)).select(key, "lat", "lon", *features)
