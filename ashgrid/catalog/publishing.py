"""Sources, sinks, map lookups, filters and projections (SRC-*, SNK-*, WIN-7,
JOIN-7, FN-1/2/9..13/18/19, FLT-1/2/6/7/10/11, PRJ-1..10/16, ORD-3..6, AGG-7)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from .. import fixtures as FX
from ..functions import scalar as S
from ..operators import filters as FL
from ..operators import geo as G
from ..operators import timeseries as TS
from ..session import scratch_path
from ..sinks import publish as P
from ..sources import files as SF
from .registry import register
from .spatial import _CLIP_POINTS_SQL

SD = FX.with_views("station_day")
PR = FX.with_views("predictions")


def _pred(spark, sf_dir) -> DataFrame:
    return FX.predictions(spark, sf_dir)


# ---------------------------------------------------------------- sources


@register("read_csv", SD + "SELECT st, d, precip, evi FROM station_day")
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: a header CSV landed by Spark, read back with an explicit schema."""
    path = scratch_path(spark, "csv")
    P.write_csv(FX.station_day(spark, sf_dir).select("st", "d", "precip", "evi"), path)
    return SF.typed_csv(spark, path, "d date, st bigint, evi double, precip double")[0].select("st", "d", "precip", "evi")


@register("projected_csv", SD + "SELECT st, ndvi FROM station_day")
def projected_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: only the wanted columns present in the header, de-duplicated."""
    path = scratch_path(spark, "csv")
    P.write_csv(FX.station_day(spark, sf_dir), path)
    return SF.projected_csv(spark, path, ["st", "ndvi", "st", "not_there"], {"st": "bigint", "ndvi": "double"})


@register("points_csv", FX.with_views("sites") + "SELECT sk, la, lo FROM sites WHERE la IS NOT NULL AND lo IS NOT NULL")
def points_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7: caller-named lat/lon columns; null coordinates dropped."""
    path = scratch_path(spark, "points")
    P.write_csv(FX.sites(spark, sf_dir).select("sk", "la", "lo"), path)
    df = SF.read_csv(spark, path, "sk bigint, la double, lo double")
    return SF.points_csv(df, "la", "lo").select("sk", "la", "lo")


@register("grid_file", FX.with_views("points") + """
SELECT DISTINCT floor(la * 10) / 10 AS lat, floor(lo * 10) / 10 AS lon FROM points""")
def grid_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-8: a pre-clipped grid file replaces the generated grid (lat, lon only)."""
    path = scratch_path(spark, "grid")
    g = FX.points(spark, sf_dir).select(F.lit("7").alias("extra"), (F.floor(F.col("lo") * 10) / 10).alias("lon"),
                                        (F.floor(F.col("la") * 10) / 10).alias("lat")).distinct()
    P.write_csv(g, path)
    return SF.grid_file(spark, path)


@register("file_collect")
def file_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: recursive listing of landed files matching a glob, sorted, unique
    (rows check: file names come from the writer)."""
    root = scratch_path(spark, "tiles")
    names = FX.tile_names(spark, sf_dir).select(
        F.when(F.col("path").endswith(".tiff"), "tiff").otherwise("tif").alias("ext"), F.col("pk").cast("string").alias("pk"))
    names.write.mode("overwrite").partitionBy("ext").text(root)
    return SF.file_collect(spark, root, ["*.txt"])


@register("polygon_geojson", _CLIP_POINTS_SQL)
def polygon_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: mask read from a GeoJSON FeatureCollection, then used to clip the points."""
    path = scratch_path(spark, "mask")
    spark.createDataFrame([(json.dumps(FX.MASK_GEOJSON),)], "value string").coalesce(1).write.text(path)
    edges = G.polygon_edges(SF.polygon_rings(spark, path))
    return G.clip_to_polygons(FX.points(spark, sf_dir), edges, x="lo", y="la", key="k").select("k", "la", "lo")


# ---------------------------------------------------------------- sinks


@register("write_csv", PR + "SELECT d, la, lo, risk FROM predictions")
def write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: predictions to header CSV and back."""
    path = scratch_path(spark, "pred-csv")
    P.write_csv(_pred(spark, sf_dir), path)
    return SF.read_csv(spark, path, "d date, la double, lo double, risk int")


@register("append_checkpoint", SD + """
SELECT st, precip, d AS target_date, CAST(0 AS INTEGER) AS step FROM station_day""")
def append_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2: three chunks appended under the same (target_date, step) keys, one
    of them replayed; the replay replaces itself only."""
    path = scratch_path(spark, "ckpt")
    sd = FX.station_day(spark, sf_dir).select("st", "precip", F.col("d").alias("target_date"),
                                               F.lit(0).alias("step"))
    for chunk in (0, 1, 2, 1):  # 1 is replayed
        P.append_checkpoint(sd.filter(F.col("st") % 3 == chunk), path, chunk)
    return spark.read.parquet(path).select("st", "precip", "target_date", "step")


@register("per_layer_sink", FX.with_views("tiles") + """
SELECT CASE WHEN tile % 2 = 0 THEN 'EVI' ELSE 'NDVI' END AS layer, count(*) AS n_tiles FROM tiles GROUP BY 1""")
def per_layer_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: one output directory per layer."""
    path = scratch_path(spark, "layers")
    t = FX.tiles(spark, sf_dir).select("tile", F.when(F.col("tile") % 2 == 0, "EVI").otherwise("NDVI").alias("layer"))
    P.per_layer_sink(t, path)
    return spark.read.parquet(path).groupBy("layer").agg(F.count(F.lit(1)).alias("n_tiles"))


_WHY = """
, f AS (SELECT d, la, lo, CAST((st + dayofmonth(d)) % 5 + 1 AS INTEGER) AS risk, temp / 10 + 273.15 AS max_temp,
               precip * 0.001 AS precip_14day_sum, we AS max_wind_speed
        FROM station_day JOIN points ON st = k)"""
_WHY_SQL = FX.with_views("station_day", "points") + _WHY


def _why_frame(spark, sf_dir) -> DataFrame:
    sd = FX.station_day(spark, sf_dir)
    pts = FX.points(spark, sf_dir)
    return sd.join(pts, sd.st == pts.k).select(
        "d", "la", "lo", ((F.col("st") + F.dayofmonth("d")) % 5 + 1).cast("int").alias("risk"),
        (F.col("temp") / 10 + 273.15).alias("max_temp"), (F.col("precip") * 0.001).alias("precip_14day_sum"),
        F.col("we").alias("max_wind_speed"),
    )


@register("geojson_sink", _WHY_SQL + """
SELECT d AS date, lo, la, risk,
  ['Low', 'Moderate', 'High', 'Very High', 'Extreme'][risk] AS label,
  CAST(printf('%.1f', precip_14day_sum * 1000) AS DOUBLE) AS rain14_mm, CAST(printf('%.1f', max_temp - 273.15) AS DOUBLE) AS maxtemp_c,
  CAST(printf('%.1f', max_wind_speed) AS DOUBLE) AS wind_ms
FROM f""")
def geojson_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5 (+FN-9, JOIN-7): newline-delimited GeoJSON features partitioned by
    date, read back and parsed."""
    path = scratch_path(spark, "geojson")
    feats = P.geojson_features(_why_frame(spark, sf_dir).withColumnRenamed("d", "date"), "la", "lo", "risk")
    P.write_geojson_lines(feats, path)
    schema = ("type string, geometry struct<type string, coordinates array<double>>, properties struct<risk int, "
              "label string, rain14_mm double, maxtemp_c double, wind_ms double>")
    back = spark.read.schema(schema).json(path)
    return back.select(
        F.col("date"), F.col("geometry.coordinates")[0].alias("lo"), F.col("geometry.coordinates")[1].alias("la"),
        "properties.risk", "properties.label", "properties.rain14_mm", "properties.maxtemp_c", "properties.wind_ms",
    )


@register("explain_values", _WHY_SQL + """
SELECT d, la, lo, CAST(printf('%.1f', precip_14day_sum * 1000) AS DOUBLE) AS rain14_mm, CAST(printf('%.1f', max_temp - 273.15) AS DOUBLE) AS maxtemp_c,
       CAST(printf('%.1f', max_wind_speed) AS DOUBLE) AS wind_ms FROM f""")
def explain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-9: friendly units, one decimal."""
    f = _why_frame(spark, sf_dir)
    ex = S.explain_values("precip_14day_sum", "max_temp", "max_wind_speed")
    return f.select("d", "la", "lo", *[e.alias(n) for n, e in ex.items()])


_CLASS_SQL = _WHY_SQL + """
, e AS (SELECT d, la, lo, CAST(printf('%.1f', precip_14day_sum * 1000) AS DOUBLE) AS rain14_mm, CAST(printf('%.1f', max_temp - 273.15) AS DOUBLE) AS maxtemp_c FROM f)
"""


@register("dryness_class", _CLASS_SQL + """
SELECT d, la, lo, CASE WHEN rain14_mm < 5 THEN 'very dry' WHEN rain14_mm < 20 THEN 'fairly dry' ELSE 'some recent rain' END AS dryness FROM e""")
def dryness_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _why_frame(spark, sf_dir)
    ex = S.explain_values("precip_14day_sum", "max_temp", "max_wind_speed")
    return f.select("d", "la", "lo", S.dryness_class(ex["rain14_mm"]).alias("dryness"))


@register("heat_class", _CLASS_SQL + """
SELECT d, la, lo, CASE WHEN maxtemp_c >= 28 THEN 'hot' WHEN maxtemp_c >= 18 THEN 'mild' ELSE 'cool' END AS heat FROM e""")
def heat_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _why_frame(spark, sf_dir)
    ex = S.explain_values("precip_14day_sum", "max_temp", "max_wind_speed")
    return f.select("d", "la", "lo", S.heat_class(ex["maxtemp_c"]).alias("heat"))


@register("popup_fields", PR + """
SELECT d, la, lo, coalesce(nullif(CASE WHEN risk = 5 THEN 0 ELSE risk END, 0), 1) AS popup_risk,
       ['Low', 'Moderate', 'High', 'Very High', 'Extreme'][coalesce(nullif(CASE WHEN risk = 5 THEN 0 ELSE risk END, 0), 1)]
         || ' (' || coalesce(nullif(CASE WHEN risk = 5 THEN 0 ELSE risk END, 0), 1) || '/5)' AS popup_text,
       printf('%.2f, %.2f', la, lo) AS popup_coords,
       CASE WHEN risk = 5 THEN NULL ELSE la END IS NOT NULL AS has_why FROM predictions""")
def popup_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-19: risk defaults to 1 when missing or 0; the 'why' block only when
    the rain value is present (risk 5 cells carry neither here)."""
    p = _pred(spark, sf_dir).select(
        "d", "la", "lo", F.when(F.col("risk") == 5, F.lit(0)).otherwise(F.col("risk")).alias("risk"),
        F.when(F.col("risk") == 5, F.lit(None).cast("double")).otherwise(F.col("la")).alias("rain14_mm"),
    )
    return P.popup_fields(p).select("d", "la", "lo", "popup_risk", "popup_text", "popup_coords", "has_why")


@register("label_lookup", PR + """
SELECT d, la, lo, ['Low', 'Moderate', 'High', 'Very High', 'Extreme'][risk] AS label,
       ['#0001fe', '#00e001', '#ffff00', '#e29f01', '#fe0000'][risk] AS colour FROM predictions""")
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-7: risk 1..5 -> label and colour (array lookup, no join)."""
    p = _pred(spark, sf_dir)
    return p.select("d", "la", "lo", S.risk_label("risk").alias("label"), S.risk_colour("risk").alias("colour"))


@register("level_filter", PR + "SELECT d, la, lo, risk FROM predictions WHERE risk IN (4, 5)")
def level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.level_filter(_pred(spark, sf_dir), [4, 5])


@register("place_label", FX.with_views("places") + """
SELECT name, name || ', ' || admin1 AS label, printf('%.2f, %.2f', la, lo) AS coords FROM places""")
def place_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-18: 'name, admin1' and 2-dp coordinates."""
    pl = FX.places(spark, sf_dir)
    return pl.select("name", S.place_label("name", "admin1").alias("label"),
                     F.format_string("%.2f, %.2f", "la", "lo").alias("coords"))


_ANCHOR_SQL = FX.with_views("predictions", "places") + """
, a AS (SELECT max(d) AS anchor FROM predictions),
w AS (SELECT p.* FROM predictions p, a WHERE p.d BETWEEN a.anchor - 5 AND a.anchor),
c AS (SELECT pl.name, w.d, w.risk,
             row_number() OVER (PARTITION BY pl.name, w.d ORDER BY pow(pl.la - w.la, 2) + pow(pl.lo - w.lo, 2), w.la, w.lo) AS rn
      FROM places pl, w),
n AS (SELECT name, d, risk FROM c WHERE rn = 1)
"""


@register("trend_window", _ANCHOR_SQL + """
SELECT name, count(*) AS n_days, arg_min(risk, d) AS first_risk, arg_max(risk, d) AS last_risk,
       CASE WHEN arg_max(risk, d) > arg_min(risk, d) THEN 'rising' WHEN arg_max(risk, d) < arg_min(risk, d) THEN 'falling'
            ELSE 'steady' END AS direction
FROM n GROUP BY name HAVING count(*) >= 2""")
def trend_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-7: six-day risk trend of the nearest cell for each place."""
    pred = _pred(spark, sf_dir)
    anchor = pred.select(F.max("d")).scalar()
    return P.trend(FX.places(spark, sf_dir), pred, anchor)


@register("latest_row", SD + """
SELECT st, max(d) AS last_day, arg_max(precip, d) AS last_precip FROM station_day GROUP BY st""")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-5: last date and last row per station."""
    sd = FX.station_day(spark, sf_dir)
    return sd.groupBy("st").agg(F.max("d").alias("last_day"), F.max_by("precip", "d").alias("last_precip"))


@register("dated_and_latest", PR + "SELECT d, la, lo, risk FROM predictions WHERE d = (SELECT max(d) FROM predictions)")
def dated_and_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6: dated partitions, then the newest date replaces ``latest``."""
    dated, latest = scratch_path(spark, "dated"), scratch_path(spark, "latest")
    P.write_dated_and_latest(_pred(spark, sf_dir), dated, latest, "d")
    return P.read_latest(spark, latest).select("d", "la", "lo", "risk")


_MATRIX_SQL = PR + """
, day AS (SELECT * FROM predictions WHERE d = (SELECT max(d) FROM predictions)),
lats AS (SELECT DISTINCT la FROM day), lons AS (SELECT DISTINCT lo FROM day),
cells AS (SELECT lats.la, lons.lo, day.risk FROM lats CROSS JOIN lons LEFT JOIN day ON day.la = lats.la AND day.lo = lons.lo)
SELECT la AS lat, list(risk ORDER BY lo) AS cells FROM cells GROUP BY la"""


def _newest_day(spark, sf_dir) -> DataFrame:
    pred = _pred(spark, sf_dir)
    day = pred.filter(F.col("d") == pred.select(F.max("d")).scalar())
    return day.withColumnRenamed("la", "lat").withColumnRenamed("lo", "lon")


@register("matrix_output", _MATRIX_SQL)
def matrix_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: lat x lon matrix of the newest day's predictions, holes null."""
    return P.matrix_rows(_newest_day(spark, sf_dir), value="risk")


@register("matrix_order", _MATRIX_SQL.replace("SELECT la AS lat, list(risk ORDER BY lo) AS cells FROM cells GROUP BY la", """
SELECT la AS lat, row_number() OVER (ORDER BY la DESC) AS row_idx FROM (SELECT DISTINCT la FROM cells)"""))
def matrix_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-6: matrix rows in descending latitude (row index of each lat)."""
    m = _newest_day(spark, sf_dir).select("lat").distinct()
    from pyspark.sql import Window

    return m.select("lat", F.row_number().over(Window.orderBy(F.col("lat").desc())).alias("row_idx"))


def _features_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-9: without a model the job writes the feature frame and stops; the
    written features are read back."""
    from .serving import weather_feature_map

    path = scratch_path(spark, "features")
    weather_feature_map(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _register_features_only() -> None:
    from .registry import ORACLE_SQL

    register("features_only", ORACLE_SQL["weather_feature_map"])(_features_only)


# ---------------------------------------------------------------- filters / projections


@register("exclude_keys", FX.with_views("station_day_long") + """
SELECT st, d, id FROM station_day_long WHERE st IS NOT NULL AND CAST(st AS VARCHAR) NOT IN ('964', '1239')""")
def exclude_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1 on customer keys (964 and 1239 exist in the orders)."""
    return FL.exclude_keys(FX.station_day_long(spark, sf_dir), "st").select("st", "d", "id")


@register("date_range_and_exclude", FX.with_views("station_day_long") + """
SELECT st, d, id FROM station_day_long WHERE d BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND d <> DATE '1998-08-12'""")
def date_range_and_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = FX.station_day_long(spark, sf_dir)
    return FL.date_range_and_exclude(df, "d", "1996-01-01", "2000-12-31", "1998-08-12").select("st", "d", "id")


@register("dropna_all", SD + """
SELECT * FROM station_day WHERE st IS NOT NULL AND d IS NOT NULL AND precip IS NOT NULL AND temp IS NOT NULL
  AND evi IS NOT NULL AND ndvi IS NOT NULL AND we IS NOT NULL AND wn IS NOT NULL""")
def dropna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6: any null in any column drops the row."""
    return FL.dropna_all(FX.station_day(spark, sf_dir))


@register("dropna_subset", SD + "SELECT st, d, evi FROM station_day WHERE evi IS NOT NULL")
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.dropna_subset(FX.station_day(spark, sf_dir), ["evi"]).select("st", "d", "evi")


@register("label_present", FX.with_views("ratings") + """
, cls AS (SELECT * FROM (VALUES (1), (2), (3), (4), (5), (6)) t(cls))
SELECT cls.cls, count(r.y) AS n FROM cls LEFT JOIN ratings r ON r.y = cls.cls GROUP BY cls.cls""")
def label_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-11: per-class rows, with 0 shown for listed classes without rows."""
    r = FX.ratings(spark, sf_dir)
    classes = spark.range(1, 7).select(F.col("id").cast("int").alias("cls"))
    counts = r.groupBy(F.col("y").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    return classes.join(counts, "cls", "left").select("cls", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@register("rename_alias", SD + "SELECT st, d, temp AS elevation FROM station_day")
def rename_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: ELEVATION_M becomes elevation when elevation is absent."""
    df = FX.station_day(spark, sf_dir).select("st", "d", F.col("temp").alias("ELEVATION_M"))
    return C.rename_alias(df, "elevation", "ELEVATION_M")


@register("resolve_column", SD + "SELECT st, d AS date, precip FROM station_day")
def resolve_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-2: first candidate name present (DATE_TIME is absent, DATE is used)."""
    df = FX.station_day(spark, sf_dir).select("st", F.col("d").alias("DATE"), "precip")
    c = C.resolve_column(df, C.ALIASES["date"])
    return df.select("st", F.col(c).alias("date"), "precip")


@register("value_column", SD + "SELECT st AS lat, d AS date, precip AS value FROM station_day")
def value_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-3: the feature-named column, else the first non-coordinate column."""
    df = FX.station_day(spark, sf_dir).select(F.col("st").alias("lat"), F.col("d").alias("date"), F.col("precip").alias("p"),
                                              F.col("temp").alias("t"))
    v = C.value_column(df, "NDVI")
    return df.select("lat", "date", F.col(v).alias("value"))


@register("require_columns", SD + "SELECT st, d FROM station_day")
def require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4: passes when the columns exist (the failing case is a unit test)."""
    df = C.require_columns(FX.station_day(spark, sf_dir), ["st", "d", "precip"])
    return df.select("st", "d")


@register("drop_columns", SD + "SELECT st, d, precip, temp, evi, ndvi FROM station_day")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5: drop listed columns; absent ones are ignored."""
    return FX.station_day(spark, sf_dir).drop("we", "wn", "station_name")


@register("fill_zero", SD + "SELECT st, d, coalesce(evi, 0.0) AS evi, coalesce(ndvi, 0.0) AS ndvi FROM station_day")
def fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-9: nulls become 0.0 just before scoring."""
    return FX.station_day(spark, sf_dir).select("st", "d", "evi", "ndvi").na.fill(0.0)


@register("wind_magnitude", SD + "SELECT st, d, round(sqrt(we * we + wn * wn), 8) AS wind FROM station_day")
def wind_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.station_day(spark, sf_dir).select("st", "d", S.round8(S.wind_magnitude("we", "wn")).alias("wind"))


@register("season_sin_cos", SD + """
SELECT st, d, dayofyear(d) AS doy, round(sin(2 * pi() * dayofyear(d) / 365), 8) AS sin_doy,
       round(cos(2 * pi() * dayofyear(d) / 365), 8) AS cos_doy FROM station_day""")
def season_sin_cos(spark: SparkSession, sf_dir: str) -> DataFrame:
    sd = FX.station_day(spark, sf_dir)
    return sd.select("st", "d", S.day_of_year("d").alias("doy"), S.round8(S.season_sin("d")).alias("sin_doy"),
                     S.round8(S.season_cos("d")).alias("cos_doy"))


@register("round4", FX.with_views("points") + "SELECT k, round(la * 1.000123, 4) AS la4, round(lo / 3, 4) AS lo4 FROM points")
def round4(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = FX.points(spark, sf_dir)
    return p.select("k", S.round4(F.col("la") * 1.000123).alias("la4"), S.round4(F.col("lo") / 3).alias("lo4"))


@register("parse_date_strict_coerce", FX.with_views("hourly") + """
SELECT seq, CAST(try_strptime(txt, '%Y-%m-%d') AS DATE) AS coerced FROM (
  SELECT seq, CASE WHEN seq % 10 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d') END AS txt FROM hourly)""")
def parse_date_strict_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-13: a strict parse fails on bad text; the coercing parse gives null."""
    h = FX.hourly(spark, sf_dir).select(
        "seq", F.when(F.col("seq") % 10 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("txt"))
    return h.select("seq", S.parse_date_coerce("txt").alias("coerced"))


@register("distinct", PR + "SELECT DISTINCT la, lo FROM predictions")
def distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-7: unique coordinates."""
    return _pred(spark, sf_dir).select("la", "lo").distinct()


# importance-like table: spread of each station feature (drives ORD-3, ORD-4, WIN-8)
_SPREAD_SQL = SD + """
, u AS (SELECT 'precip' AS feature, precip AS v FROM station_day UNION ALL SELECT 'temp', temp FROM station_day
        UNION ALL SELECT 'evi', evi FROM station_day UNION ALL SELECT 'ndvi', ndvi FROM station_day
        UNION ALL SELECT 'we', we FROM station_day UNION ALL SELECT 'wn', wn FROM station_day),
imp AS (SELECT feature, round(var_pop(v), 6) AS importance FROM u GROUP BY feature)
"""


def _spread(spark, sf_dir) -> DataFrame:
    sd = FX.station_day(spark, sf_dir)
    feats = ["precip", "temp", "evi", "ndvi", "we", "wn"]
    long = sd.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in feats])).alias("x"))
    return long.groupBy("x.feature").agg(F.round(F.var_pop("x.v"), 6).alias("importance"))


@register("top_k", _SPREAD_SQL + "SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 3")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-3: the k largest by importance (TakeOrderedAndProject)."""
    return _spread(spark, sf_dir).orderBy(F.col("importance").desc(), "feature").limit(3)


@register("arg_extreme", _SPREAD_SQL + """
SELECT arg_max(feature, importance) AS most, max(importance) AS most_value,
       arg_min(feature, importance) AS least, min(importance) AS least_value FROM imp""")
def arg_extreme(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD-4: most and least important with their values."""
    s = _spread(spark, sf_dir)
    return s.agg(F.max_by("feature", "importance").alias("most"), F.max("importance").alias("most_value"),
                 F.min_by("feature", "importance").alias("least"), F.min("importance").alias("least_value"))


@register("importance_rank", _SPREAD_SQL + """
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM imp""")
def importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-8: 1-based rank by descending importance (one row per feature)."""
    return TS.importance_rank(_spread(spark, sf_dir))
