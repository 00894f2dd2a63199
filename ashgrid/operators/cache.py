"""Static (satellite) feature cache bound to a grid (FLT-3, FLT-4, AGG-2..5,
GEO-4..6, PRJ-6, PRJ-11, PRJ-14).

Two builds, both one Spark job each:
* from pixels: latest slice per layer -> exact nearest pixel per (grid point,
  layer), all layers in one nearest join (the layer is part of the key) ->
  pivot to one column per feature;
* from station history: per-station medians and last coordinates -> nearest
  station per grid point -> null filled from the all-station median.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from . import filters as FL
from . import geo as G
from . import quantiles as Q


def pixels_latest(pixels: DataFrame, date: str = "date", pinned: str | None = None) -> DataFrame:
    """FLT-4 per layer, then null pixels are dropped (GEO-4): a layer whose newest
    slice is all null has no pixels, it does not fall back to an older date."""
    return FL.latest_or_pinned(pixels, date, pinned, per=["layer"]).na.drop(subset=["lat", "lon", "value"])


def nearest_per_layer(grid: DataFrame, pixels: DataFrame, layers: Sequence[str], key: str = "gid",
                      pixel_key: str = "pid") -> DataFrame:
    """GEO-4 for every layer in one job: grid rows are repeated per layer (a
    fixed, small list) and the layer joins the cell key."""
    q = grid.select(key, "lat", "lon", F.explode(F.array(*[F.lit(x) for x in layers])).alias("layer"))
    return G.nearest_join(q, pixels, key, pixel_key, "lat", "lon", "lat", "lon", payload=["value"], group=["layer"])


def wide_cache(grid: DataFrame, nearest: DataFrame, present: Sequence[str], key: str = "gid",
               features: Sequence[str] = C.SATELLITE_FEATURES) -> DataFrame:
    """PRJ-14 + PRJ-6: one column per feature in contract order.  A feature
    whose layer exists but has no pixel near (or in the slice) is null; a
    feature with no input layer at all is 0.0."""
    wide = nearest.groupBy(key).pivot("layer", list(present)).agg(F.first("value"))
    out = grid.select(key, "lat", "lon").join(wide, key, "left")
    cols = []
    for f in features:
        cols.append(F.col(f) if f in present else F.lit(0.0).alias(f))
    return out.select(key, "lat", "lon", *cols)


def default_elevation(cache: DataFrame, elevations: DataFrame, keys: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """PRJ-11: elevation missing from the cache -> supplied elevations, else 0.0."""
    if "elevation" in cache.columns:
        base = cache
        e = elevations.select(*keys, F.col("elevation").alias("__e"))
        return base.join(e, list(keys), "left").withColumn(
            "elevation", F.coalesce("elevation", "__e", F.lit(0.0))
        ).drop("__e")
    return cache.join(elevations.select(*keys, "elevation"), list(keys), "left").withColumn(
        "elevation", F.coalesce("elevation", F.lit(0.0))
    )


# AGG-2 / AGG-3 / AGG-4
def station_summary(history: DataFrame, features: Sequence[str], key: str | None = "station_code",
                    date: str = "date", lat: str = "lat", lon: str = "lon", upto: str | None = None) -> DataFrame:
    """Per station: median of each feature's non-null history (null when all
    null) and the last non-null lat/lon in date order (null dates last).
    Without a station key the rows are grouped by (lat, lon).  Null keys are
    dropped.  Medians are exact (``median``); a station's history is one
    station's days, a bounded group."""
    h = FL.upto_date(history, date, upto)
    order = F.struct(F.col(date).isNull(), F.col(date))
    if key is not None and key in h.columns:
        h = h.filter(F.col(key).isNotNull())
        aggs = [
            F.max_by(F.when(F.col(lat).isNotNull(), F.col(lat)), F.when(F.col(lat).isNotNull(), order)).alias(lat),
            F.max_by(F.when(F.col(lon).isNotNull(), F.col(lon)), F.when(F.col(lon).isNotNull(), order)).alias(lon),
        ]
        return h.groupBy(key).agg(*aggs, *[F.median(f).alias(f) for f in features])
    h = h.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return h.groupBy(lat, lon).agg(*[F.median(f).alias(f) for f in features])


# AGG-5
def global_median(df: DataFrame, c: str) -> Column:
    """Exact median over all rows (nulls skipped), 0.0 when all are null, as a
    scalar subquery; selected by bucket counts, no task holds the column."""
    return F.coalesce(Q.median(df, c).scalar(), F.lit(0.0))


def seed_from_stations(grid: DataFrame, stations: DataFrame, features: Sequence[str], key: str = "gid",
                       station_key: str = "station_code") -> DataFrame:
    """GEO-6: nearest station regardless of nulls, then each null feature
    takes the all-station median (else 0.0)."""
    nn = G.nearest_by_pyramid(grid, stations.na.drop(subset=["lat", "lon"]), key, station_key, "lat", "lon", "lat", "lon",
                        payload=list(features))
    fills = {f: F.coalesce(F.col(f), global_median(stations, f)) for f in features}
    return grid.select(key, "lat", "lon").join(nn.withColumns(fills).drop("dist_km"), key, "left")
