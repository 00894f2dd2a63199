"""Raster tile tables -> pixels (RAS-*).

A decoded tile is one row: affine (a, b, c, d, e, f), rows, cols, epsg,
nodata and the band as a row-major ``values`` array.  Flattening is a
``posexplode`` inside the task that holds the tile (no shuffle); decimation
filters on the generated row/col right after the explode.  Sampling a point
inverts the affine to (row, col) and reads the array element directly, after
an equi-join on the tile's coarse cells (never points x tiles).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: file-name patterns of the tile naming scheme.
DOY_PATTERN = "_doy([0-9]{4})([0-9]{3})"
YMD_PATTERN = "([0-9]{4})[-_]?([0-9]{2})[-_]?([0-9]{2})"
AID_TAIL = "_aid[0-9]+$"


def stem(path) -> Column:
    """File name without directory and last extension."""
    base = F.substring_index(F.col(path) if isinstance(path, str) else path, "/", -1)
    return F.regexp_replace(base, "(?<=.)[.][^.]*$", "")


# RAS-2
def clean_layer(layer: Column) -> Column:
    """Last piece after '__', then last piece after '_'; the whole key if empty."""
    t1 = F.when(layer.contains("__"), F.substring_index(layer, "__", -1)).otherwise(layer)
    t2 = F.when(t1.contains("_"), F.substring_index(t1, "_", -1)).otherwise(t1)
    return F.when(t2 == "", layer).otherwise(t2)


# RAS-1
def parse_layer_and_date(path) -> dict[str, Column]:
    """layer (cleaned), raw_layer and date (ISO text, not validated) from a
    file name; ``date_parsed`` is the validated date (null when invalid)."""
    s = stem(path)
    has_doy = F.regexp_extract(s, DOY_PATTERN, 0) != ""
    has_ymd = F.regexp_extract(s, YMD_PATTERN, 0) != ""
    year = F.regexp_extract(s, DOY_PATTERN, 1).try_cast("int")  # "" when absent: null, never an error
    doy = F.regexp_extract(s, DOY_PATTERN, 2).try_cast("int")
    doy_date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1).cast("string")
    ymd_date = F.concat_ws(
        "-", F.regexp_extract(s, YMD_PATTERN, 1), F.regexp_extract(s, YMD_PATTERN, 2), F.regexp_extract(s, YMD_PATTERN, 3)
    )
    before_doy = F.regexp_replace(F.rtrim(F.substring(s, F.lit(1), F.regexp_instr(s, F.lit(DOY_PATTERN)) - 1), F.lit("_")), AID_TAIL, "")
    ymd_at = F.regexp_instr(s, F.lit(YMD_PATTERN))
    before_ymd = F.rtrim(F.substring(s, F.lit(1), ymd_at - 1), F.lit("_-"))
    raw = F.when(has_doy, before_doy).when(has_ymd, F.when(before_ymd == "", s).otherwise(before_ymd)).otherwise(s)
    date = F.when(has_doy, doy_date).when(has_ymd, ymd_date)
    return {
        "raw_layer": raw,
        "layer": clean_layer(raw),
        "date": date,
        "date_parsed": F.to_date(F.try_to_timestamp(date, F.lit("yyyy-MM-dd"))),
    }


# RAS-3
def date_override(date: Column, override: str | None) -> Column:
    return date if override is None else F.coalesce(F.lit(override), date)


# RAS-9
def tile_is_valid(rows="rows", cols="cols") -> Column:
    affine = [F.col(c).isNotNull() for c in ("a", "b", "c", "d", "e", "f")]
    ok = (F.size("values") == F.col(rows) * F.col(cols)) & (F.col(rows) > 0) & (F.col(cols) > 0)
    for a in affine:
        ok = ok & a
    return F.coalesce(ok, F.lit(False))


# RAS-8
def crs_is_lonlat(epsg="epsg") -> Column:
    return F.col(epsg).isNull() | (F.col(epsg) == 4326)


def split_tiles(tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good tiles and a rejects table with a reason (the run goes on)."""
    reason = F.when(~tile_is_valid(), "unreadable").when(~crs_is_lonlat(), "unsupported crs")
    tagged = tiles.withColumn("reject_reason", reason)
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"), tagged.filter(
        F.col("reject_reason").isNotNull()
    )


# RAS-6
def pixel_center(row: Column, col: Column) -> tuple[Column, Column]:
    x = F.col("a") * (col + 0.5) + F.col("b") * (row + 0.5) + F.col("c")
    y = F.col("d") * (col + 0.5) + F.col("e") * (row + 0.5) + F.col("f")
    return x, y


# RAS-4 / RAS-5
def raster_to_long(tiles: DataFrame, decimate: int = 1, keep: list[str] = ("tile",), drop_invalid: bool = True) -> DataFrame:
    """One row per pixel of the band: keep columns, row, col, lat, lon, value.
    Masked (== nodata), NaN and +-Inf pixels are dropped (full-raster mode)."""
    extra = [c for c in ("a", "b", "c", "d", "e", "f", "cols", "nodata") if c not in keep]
    px = tiles.select(*keep, *extra, F.posexplode("values").alias("pos", "value"))
    px = px.withColumns({"row": (F.col("pos") / F.col("cols")).cast("int"), "col": (F.col("pos") % F.col("cols")).cast("int")})
    if decimate > 1:
        px = px.filter((F.col("row") % decimate == 0) & (F.col("col") % decimate == 0))
    x, y = pixel_center(F.col("row"), F.col("col"))
    out = px.select(*keep, "row", "col", y.alias("lat"), x.alias("lon"), "value", *([] if "nodata" in keep else ["nodata"]))
    if drop_invalid:
        v = F.col("value")
        out = out.filter(
            v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
            & (F.col("nodata").isNull() | (v != F.col("nodata")))
        )
    return out if "nodata" in keep else out.drop("nodata")


# RAS-7
def sample_points(tiles: DataFrame, points: DataFrame, lat: str = "lat", lon: str = "lon",
                  key: str = "k", cell: float = 1.0, by: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Value of the pixel containing each point, per tile covering it; nodata,
    NaN and +-Inf become null but the rows are kept.

    Late materialisation: only the tiles' boxes (everything but the pixels) are
    keyed by the coarse cells that they touch and meet the points of these
    cells, an equi-join followed by an exact bounds test.  The hits, each a
    point and a position in a tile, then fetch their pixels by tile, so an array
    of pixels is shuffled at most once, and not at all where the hits are small
    enough to be broadcast.  A tile listed twice is sampled twice.  A point meets
    only tiles equal to it in the columns ``by`` (a reference system, say);
    ``keep`` names further columns of the tiles for the result."""
    meta = [x for x in tiles.columns if x != "values"]
    named = F.struct(*[F.col(f"`{x}`") for x in meta])
    a, b, c, d, e, f = (F.col(f"__t.{n}") for n in "abcdef")
    cols, rows = F.col("__t.cols"), F.col("__t.rows")
    xs = [c, c + a * cols, c + b * rows, c + a * cols + b * rows]
    ys = [f, f + d * cols, f + e * rows, f + d * cols + e * rows]

    def cells(v: list[Column]):
        return F.sequence(F.floor(F.least(*v) / cell).cast("bigint"), F.floor(F.greatest(*v) / cell).cast("bigint"))

    boxes = (tiles.select(named.alias("__t")).distinct().withColumn("__ci", F.explode(cells(ys)))
             .withColumn("__cj", F.explode(cells(xs))).withColumns({n: F.col(f"__t.{n}") for n in by}))
    # a few bytes a point, but a row for every tile over it: adaptive execution would put millions of points into one task
    pk = points.select(
        F.col(key), *by, F.col(lat).alias("__y"), F.col(lon).alias("__x"),
        F.floor(F.col(lat) / cell).cast("bigint").alias("__ci"), F.floor(F.col(lon) / cell).cast("bigint").alias("__cj"),
    ).repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, "__y", "__x")
    det = a * e - b * d
    colf = (e * (F.col("__x") - c) - b * (F.col("__y") - f)) / det
    rowf = (a * (F.col("__y") - f) - d * (F.col("__x") - c)) / det
    hits = (pk.join(boxes, [*by, "__ci", "__cj"]).withColumns({"row": F.floor(rowf).cast("int"), "col": F.floor(colf).cast("int")})
            .filter((F.col("row") >= 0) & (F.col("row") < rows) & (F.col("col") >= 0) & (F.col("col") < cols))
            .select(key, "__t", "row", "col"))
    pixels = tiles.select(named.alias("__o"), "values")
    j = hits.join(pixels, F.col("__t").eqNullSafe(F.col("__o")))
    raw = F.try_element_at("values", (F.col("row") * cols + F.col("col") + 1).cast("int"))
    v = F.when(
        raw.isNull() | F.isnan(raw) | (F.abs(raw) == F.lit(float("inf"))) | (raw == F.col("__t.nodata")),
        F.lit(None).cast("double"),
    ).otherwise(raw)
    return j.select(key, F.col("__t.tile").alias("tile"), "row", "col", v.alias("value"), *[F.col(f"__t.{n}").alias(n) for n in keep])
