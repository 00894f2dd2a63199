"""Weather serving queries (SRC-4, AGG-1, AGG-6, AGG-8, JOIN-1..6, FN-3..6,
FN-14, PRJ-12, PRJ-15, SET-2, SET-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from .. import fixtures as FX
from ..functions import scalar as S
from ..operators import geo as G
from ..operators import weather as W
from ..session import scratch_path
from ..sources import weather as WS
from .registry import register
from .spatial import _clip_sql, _edges, _grid_sql

TARGET = "2024-01-15"
EARLY = "2024-01-02"  # before some locations have any row

# fixture columns -> service variables (daily from station_day, hourly from events)
_DAILY_MAP = {
    "temperature_2m_max": "temp / 10", "temperature_2m_mean": "evi / 10", "precipitation_sum": "precip",
    "snowfall_sum": "ndvi", "wind_speed_10m_max": "we", "wind_speed_10m_mean": "wn",
    "dew_point_2m_mean": "precip / 100", "cloud_cover_mean": "ndvi", "et0_fao_evapotranspiration": "NULL",
}
_HOURLY_MAP = {"snow_depth": "a", "cloud_cover_low": "b", "soil_moisture_3_to_9cm": "a / 1000",
               "shortwave_radiation": "a"}


def _daily(spark, sf_dir) -> DataFrame:
    sd = FX.station_day(spark, sf_dir)
    return sd.select(F.col("st").alias("loc"), F.col("d").alias("day"),
                     *[(F.expr(e).cast("double") if e != "NULL" else F.lit(None).cast("double")).alias(n)
                       for n, e in _DAILY_MAP.items()])


def _hourly(spark, sf_dir) -> DataFrame:
    h = FX.hourly(spark, sf_dir)
    return h.select("loc", F.col("ts").alias("time"), "seq", *[F.expr(e).alias(n) for n, e in _HOURLY_MAP.items()])


def _daily_sql() -> str:
    items = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _DAILY_MAP.items())
    return f"daily AS (SELECT st AS loc, d AS day, {items} FROM station_day)"


def _hourly_sql() -> str:
    items = ", ".join(f"{e} AS {n}" for n, e in _HOURLY_MAP.items())
    return f"hr AS (SELECT loc, ts AS time, seq, {items} FROM hourly)"


SV = FX.with_views("station_day", "hourly", "points") + ", " + _daily_sql() + ", " + _hourly_sql() + "\n"


def _locs(spark, sf_dir) -> DataFrame:
    """Requested locations: the stations, 40 per request chunk."""
    st = FX.station_day(spark, sf_dir).select(F.col("st").alias("loc")).distinct()
    pts = FX.points(spark, sf_dir)
    return st.join(pts, st.loc == pts.k).select(
        "loc", (F.col("loc").cast("bigint") / 40).cast("bigint").cast("string").alias("chunk"),
        (F.col("loc") % 40).cast("int").alias("pos"), F.col("la").alias("latitude"), F.col("lo").alias("longitude"),
    )


def _landed(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "weather-landing")
    WS.write_payloads(_locs(spark, sf_dir), _daily(spark, sf_dir), _hourly(spark, sf_dir), "loc", path)
    return WS.read_payloads(spark, path)


@register("weather_json", SV + """
SELECT p.la AS latitude, p.lo AS longitude, d.day, d.temperature_2m_max, d.precipitation_sum, d.wind_speed_10m_mean
FROM daily d JOIN points p ON d.loc = p.k""")
def weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads landed as JSON (arrays of location objects), read back and
    flattened with inline(arrays_zip)."""
    rows = WS.daily_rows(_landed(spark, sf_dir))
    return rows.select("latitude", "longitude", "day", "temperature_2m_max", "precipitation_sum", "wind_speed_10m_mean")


@register("positional_zip", SV + """
SELECT p.k AS loc, CAST(p.k // 40 AS VARCHAR) AS chunk, CAST(p.k % 40 AS INTEGER) AS pos, count(*) AS n_days
FROM daily d JOIN points p ON d.loc = p.k GROUP BY p.k""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-5: the i-th response of a chunk belongs to the i-th request."""
    resp = _landed(spark, sf_dir)
    z = W.positional_zip(_locs(spark, sf_dir).select("loc", "chunk", "pos"), resp)
    return z.select("loc", "chunk", "pos", F.size("daily.time").cast("bigint").alias("n_days"))


@register("hourly_to_daily", SV + """
SELECT loc, CAST(time AS DATE) AS day, round(avg(snow_depth), 8) AS mean_snow_depth,
       round(avg(cloud_cover_low), 8) AS mean_low_cloud_cover, round(avg(soil_moisture_3_to_9cm), 8) AS mean_soil_water,
       max(shortwave_radiation) AS max_solar_radiation
FROM hr GROUP BY 1, 2""")
def hourly_to_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = W.hourly_to_daily(_hourly(spark, sf_dir))
    return out.select("loc", "day", *[S.round8(c).alias(c) for c in
                                      ("mean_snow_depth", "mean_low_cloud_cover", "mean_soil_water")],
                      "max_solar_radiation")


@register("floor_day", FX.with_views("hourly") + "SELECT seq, CAST(ts AS DATE) AS day FROM hourly")
def floor_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.hourly(spark, sf_dir).select("seq", S.floor_day("ts").alias("day"))


@register("trailing_sum_mean", SV + f"""
, r AS (SELECT loc, snowfall_sum AS x, row_number() OVER (PARTITION BY loc ORDER BY day DESC) AS rn
        FROM daily WHERE day <= DATE '{EARLY}')
SELECT k.loc, round(coalesce(sum(x) FILTER (WHERE rn <= 7), 0.0), 8) AS s7,
       round(coalesce(sum(x) FILTER (WHERE rn <= 14), 0.0), 8) AS s14,
       CASE WHEN count(rn) = 0 THEN 0.0 ELSE round(avg(x) FILTER (WHERE rn <= 7), 8) END AS m7,
       CASE WHEN count(rn) = 0 THEN 0.0 ELSE round(avg(x) FILTER (WHERE rn <= 14), 8) END AS m14
FROM (SELECT DISTINCT loc FROM daily) k LEFT JOIN r ON r.loc = k.loc GROUP BY k.loc""")
def trailing_sum_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6: last 7/14 rows up to an early day; all-null sum = 0.0, mean = null;
    locations that begin later keep 0.0."""
    d = _daily(spark, sf_dir)
    out = W.TS.trailing(d.withColumnRenamed("snowfall_sum", "x"), "loc", "day",
                        {"s7": ("x", 7, "sum"), "s14": ("x", 14, "sum"), "m7": ("x", 7, "mean"),
                         "m14": ("x", 14, "mean")}, upto=F.lit(EARLY).cast("date"))
    return out.select("loc", *[S.round8(c).alias(c) for c in ("s7", "s14", "m7", "m14")])


_RESOLVE_SQL = f"""
, res AS (SELECT loc, coalesce(max(day) FILTER (WHERE day = DATE '{TARGET}'), max(day)) AS resolved_day
          FROM daily GROUP BY loc),
hd AS (SELECT loc, CAST(time AS DATE) AS day, avg(snow_depth) AS mean_snow_depth,
              avg(cloud_cover_low) AS mean_low_cloud_cover, avg(soil_moisture_3_to_9cm) AS mean_soil_water,
              max(shortwave_radiation) AS max_solar_radiation FROM hr GROUP BY 1, 2),
row AS (SELECT d.*, res.resolved_day,
          CASE WHEN hd.loc IS NULL THEN 0.0 ELSE hd.mean_snow_depth END AS mean_snow_depth,
          CASE WHEN hd.loc IS NULL THEN 0.0 ELSE hd.mean_low_cloud_cover END AS mean_low_cloud_cover,
          CASE WHEN hd.loc IS NULL THEN 0.0 ELSE hd.mean_soil_water END AS mean_soil_water,
          CASE WHEN hd.loc IS NULL THEN 0.0 ELSE hd.max_solar_radiation END AS max_solar_radiation
        FROM daily d JOIN res ON d.loc = res.loc AND d.day = res.resolved_day
        LEFT JOIN hd ON hd.loc = d.loc AND hd.day = res.resolved_day)
"""


# some locations without hourly rows, to show their 0.0
_SV_GAPS = SV.replace("FROM hourly)", "FROM hourly WHERE loc % 10 <> 0)")


@register("target_or_latest", _SV_GAPS + _RESOLVE_SQL + """
SELECT loc, resolved_day, temperature_2m_max, precipitation_sum, round(mean_low_cloud_cover, 8) AS mean_low_cloud_cover
FROM row""")
def target_or_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-6: target day else latest; hourly aggregates of that day else 0.0."""
    d, h = _daily(spark, sf_dir), _hourly(spark, sf_dir).filter(F.col("loc") % 10 != 0)
    hd = W.hourly_to_daily(h)
    out = W.target_or_latest(d, hd, F.lit(TARGET).cast("date"))
    return out.select("loc", "resolved_day", "temperature_2m_max", "precipitation_sum",
                      S.round8("mean_low_cloud_cover").alias("mean_low_cloud_cover"))


_FEAT_SQL = {
    "max_temp": "temperature_2m_max + 273.15", "mean_temp": "temperature_2m_mean + 273.15",
    "precipitation_sum": "precipitation_sum * 0.001", "sum_snowfall": "snowfall_sum * 0.001",
    "sum_snowmelt": "0.0", "average_wind_speed": "wind_speed_10m_mean", "max_wind_speed": "wind_speed_10m_max",
    "mean_dewpoint": "dew_point_2m_mean + 273.15", "mean_total_cloud_cover": "cloud_cover_mean * 0.01",
    "mean_evaporation": "-7e-5", "mean_snow_depth": "mean_snow_depth * 0.1",
    "mean_low_cloud_cover": "mean_low_cloud_cover * 0.01", "mean_soil_water": "0.0",
    "max_solar_radiation": "max_solar_radiation * 3600.0",
}


@register("weather_feature_map", SV + _RESOLVE_SQL + """
, hist AS (SELECT d.loc, d.day, d.precipitation_sum * 0.001 AS pm, d.temperature_2m_mean + 273.15 AS tk,
                  row_number() OVER (PARTITION BY d.loc ORDER BY d.day DESC) AS rn
           FROM daily d JOIN res ON d.loc = res.loc WHERE d.day <= res.resolved_day),
tr AS (SELECT loc,
   coalesce(sum(pm) FILTER (WHERE rn <= 7), 0.0) AS precip_7day_sum, coalesce(sum(pm) FILTER (WHERE rn <= 14), 0.0) AS precip_14day_sum,
   avg(pm) FILTER (WHERE rn <= 7) AS precip_7day_mean, avg(pm) FILTER (WHERE rn <= 14) AS precip_14day_mean,
   coalesce(sum(tk) FILTER (WHERE rn <= 7), 0.0) AS temp_7day_sum, coalesce(sum(tk) FILTER (WHERE rn <= 14), 0.0) AS temp_14day_sum,
   avg(tk) FILTER (WHERE rn <= 7) AS temp_7day_mean, avg(tk) FILTER (WHERE rn <= 14) AS temp_14day_mean
   FROM hist GROUP BY loc)
SELECT row.loc, row.resolved_day, """ + ", ".join(
    f"round(CAST({e} AS DOUBLE), 8) AS {n}" for n, e in _FEAT_SQL.items()) + ", " + ", ".join(
    f"round(tr.{n}, 8) AS {n}" for n in W.SERVING_TRAILING) + """
FROM row JOIN tr ON row.loc = tr.loc""", headline=True)
def weather_feature_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-15 (+FN-3, PRJ-12, AGG-1, AGG-6, JOIN-6): one model-unit feature row
    per location for the target day."""
    out = W.location_features(_daily(spark, sf_dir), _hourly(spark, sf_dir), F.lit(TARGET).cast("date"))
    return out.select("loc", "resolved_day", *[S.round8(n).alias(n) for n in W.WEATHER_FEATURES])


@register("unit_convert", SV + """
SELECT loc, day, round(temperature_2m_max + 273.15, 8) AS max_temp, round(precipitation_sum * 0.001, 8) AS precip_m,
       round(cloud_cover_mean * 0.01, 8) AS cloud_frac, round(snowfall_sum * 0.001, 8) AS snow_m_we,
       round(precipitation_sum * 0.1, 8) AS snow_depth_we, round(temperature_2m_max * 3600.0, 8) AS solar_jm2
FROM daily""")
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _daily(spark, sf_dir)
    return d.select(
        "loc", "day", S.round8(S.c_to_k("temperature_2m_max")).alias("max_temp"),
        S.round8(S.mm_to_m("precipitation_sum")).alias("precip_m"),
        S.round8(S.pct_to_frac("cloud_cover_mean")).alias("cloud_frac"),
        S.round8(S.snow_cm_to_m_we("snowfall_sum")).alias("snow_m_we"),
        S.round8(S.snow_depth_to_we("precipitation_sum")).alias("snow_depth_we"),
        S.round8(S.wm2_to_jm2("temperature_2m_max")).alias("solar_jm2"),
    )


@register("constant_features", SV + """
SELECT DISTINCT loc, CAST(0.0 AS DOUBLE) AS sum_snowmelt, CAST(-7e-5 AS DOUBLE) AS mean_evaporation,
       CAST(0.0 AS DOUBLE) AS mean_soil_water FROM daily""")
def constant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    locs = _daily(spark, sf_dir).select("loc").distinct()
    return locs.select("loc", F.lit(C.SUM_SNOWMELT_CONST).alias("sum_snowmelt"),
                       F.lit(C.EVAP_CONST).alias("mean_evaporation"), F.lit(C.SOIL_WATER_CONST).alias("mean_soil_water"))


_TK, _TDK = "(temp / 10 + 273.15)", "(precip / 100 + 273.15)"


def _humid_sql(expr: str, alias: str) -> str:
    es = f"(0.6108 * exp(17.27 * ({_TK} - 273.15) / (({_TK} - 273.15) + 237.3)))"
    ea = f"(0.6108 * exp(17.27 * ({_TDK} - 273.15) / (({_TDK} - 273.15) + 237.3)))"
    e = expr.replace("ES", es).replace("EA", ea)
    return FX.with_views("station_day") + f"SELECT st, d, round({e}, 8) AS {alias} FROM station_day"


def _humid(spark, sf_dir, fn, alias) -> DataFrame:
    sd = FX.station_day(spark, sf_dir).select("st", "d", (F.col("temp") / 10 + 273.15).alias("tk"),
                                              (F.col("precip") / 100 + 273.15).alias("tdk"))
    return sd.select("st", "d", S.round8(fn("tk", "tdk")).alias(alias))


@register("vpd", _humid_sql("CASE WHEN ES - EA < 0 THEN 0.0 ELSE ES - EA END", "vpd"))
def vpd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _humid(spark, sf_dir, S.vpd, "vpd")


@register("relative_humidity", _humid_sql(
    "CASE WHEN EA / ES * 100 < 0 THEN 0.0 WHEN EA / ES * 100 > 100 THEN 100.0 ELSE EA / ES * 100 END", "rh"))
def relative_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _humid(spark, sf_dir, S.relative_humidity, "rh")


@register("dewpoint_spread", _humid_sql(f"{_TK} - {_TDK}", "spread"))
def dewpoint_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _humid(spark, sf_dir, S.dewpoint_spread, "spread")


@register("dedupe_keep_last", FX.with_views("hourly") + """
SELECT loc, seq, a FROM (SELECT *, row_number() OVER (PARTITION BY loc ORDER BY seq DESC) AS rn FROM hourly) WHERE rn = 1""")
def dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.dedupe_keep_last(FX.hourly(spark, sf_dir), ["loc"], "seq").select("loc", "seq", "a")


# ---- grid alignment and cache bookkeeping ----------------------------------

def _snapped(spark, sf_dir, step: float = 0.5) -> DataFrame:
    """Weather rows keyed by the grid point each customer point snaps to."""
    p = FX.points(spark, sf_dir)
    box = G.bbox_of(p, "la", "lo")
    lat0, lon0 = box.select("lat_min").scalar(), box.select("lon_min").scalar()
    return p.select(
        F.col("k").alias("seq"),
        S.round4(lat0 + F.round((F.col("la") - lat0) / step) * step).alias("lat"),
        S.round4(lon0 + F.round((F.col("lo") - lon0) / step) * step).alias("lon"),
        (F.col("k") % 97).cast("double").alias("value"),
    )


_SNAP_SQL = """
, snapped AS (SELECT k AS seq, round(b.lat_min + round((la - b.lat_min) / 0.5) * 0.5, 4) AS lat,
                     round(b.lon_min + round((lo - b.lon_min) / 0.5) * 0.5, 4) AS lon,
                     CAST(k % 97 AS DOUBLE) AS value FROM points, b)
"""


@register("align_left", _grid_sql(0.5) + _SNAP_SQL + """
, w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY seq DESC) AS rn FROM snapped) WHERE rn = 1)
SELECT grid.gid, grid.lat, grid.lon, w.value FROM grid LEFT JOIN w ON round(grid.lat, 4) = w.lat AND round(grid.lon, 4) = w.lon""")
def align_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-1: grid LEFT JOIN keep-last weather on rounded coordinates."""
    grid = G.build_grid(G.bbox_of(FX.points(spark, sf_dir), "la", "lo"), 0.5)
    w = W.dedupe_keep_last(_snapped(spark, sf_dir), ["lat", "lon"], "seq")
    g = grid.withColumns({"klat": S.round4("lat"), "klon": S.round4("lon")})
    j = g.join(w.withColumnsRenamed({"lat": "klat", "lon": "klon"}), ["klat", "klon"], "left")
    return j.select("gid", "lat", "lon", "value")


@register("assemble_left", _grid_sql(0.5, "sites") + _SNAP_SQL + """
, w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY seq DESC) AS rn FROM snapped) WHERE rn = 1),
st AS (SELECT round(b.lat_min + round((la - b.lat_min) / 0.5) * 0.5, 4) AS lat,
              round(b.lon_min + round((lo - b.lon_min) / 0.5) * 0.5, 4) AS lon, max(v) AS elevation
       FROM sites, b GROUP BY 1, 2)
SELECT w.lat, w.lon, w.value, st.elevation FROM w LEFT JOIN st ON w.lat = st.lat AND w.lon = st.lon""")
def assemble_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-2: weather LEFT JOIN static features on the coordinate key."""
    w = W.dedupe_keep_last(_snapped(spark, sf_dir), ["lat", "lon"], "seq")
    p = FX.points(spark, sf_dir)
    box = G.bbox_of(p, "la", "lo")
    lat0, lon0 = box.select("lat_min").scalar(), box.select("lon_min").scalar()
    s = FX.sites(spark, sf_dir).select(
        S.round4(lat0 + F.round((F.col("la") - lat0) / 0.5) * 0.5).alias("lat"),
        S.round4(lon0 + F.round((F.col("lo") - lon0) / 0.5) * 0.5).alias("lon"), "v",
    ).groupBy("lat", "lon").agg(F.max("v").alias("elevation"))
    return w.join(s, ["lat", "lon"], "left").select("lat", "lon", "value", "elevation")


def _clipped_grid(spark, sf_dir) -> DataFrame:
    grid = G.build_grid(G.bbox_of(FX.points(spark, sf_dir), "la", "lo"), 0.5)
    return G.clip_to_polygons(grid, _edges(spark), x="lon", y="lat", key="gid")


_CLIPPED = _grid_sql(0.5, "edges") + _clip_sql("grid", "gid", "lon", "lat") + """
, cg AS (SELECT * FROM grid WHERE gid IN (SELECT key FROM kept))""" + _SNAP_SQL


@register("semi_in_grid", _CLIPPED + """
SELECT seq, lat, lon FROM snapped s WHERE EXISTS (SELECT 1 FROM cg WHERE cg.lat = s.lat AND cg.lon = s.lon)""")
def semi_in_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-3: cached rows kept only when their key is in the current grid."""
    return _snapped(spark, sf_dir).join(_clipped_grid(spark, sf_dir), ["lat", "lon"], "left_semi").select("seq", "lat", "lon")


@register("anti_remaining", _CLIPPED + """
SELECT gid, lat, lon FROM cg WHERE NOT EXISTS (SELECT 1 FROM snapped s WHERE cg.lat = s.lat AND cg.lon = s.lon)""")
def anti_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-4: grid points not fetched yet."""
    return _clipped_grid(spark, sf_dir).join(_snapped(spark, sf_dir), ["lat", "lon"], "left_anti").select("gid", "lat", "lon")


@register("key_difference___intersection", _CLIPPED + """
SELECT (SELECT count(*) FROM cg WHERE NOT EXISTS (SELECT 1 FROM snapped s WHERE cg.lat = s.lat AND cg.lon = s.lon)) AS n_todo,
       (SELECT count(*) FROM cg WHERE EXISTS (SELECT 1 FROM snapped s WHERE cg.lat = s.lat AND cg.lon = s.lon)) AS n_done""")
def key_difference_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-3: keys still to do and keys already done, as one row."""
    g, s = _clipped_grid(spark, sf_dir), _snapped(spark, sf_dir)
    todo = g.join(s, ["lat", "lon"], "left_anti").agg(F.count(F.lit(1)).alias("n_todo"))
    done = g.join(s, ["lat", "lon"], "left_semi").agg(F.count(F.lit(1)).alias("n_done"))
    return todo.select("n_todo", done.select("n_done").scalar().alias("n_done"))


@register("union_cached_new", _grid_sql(0.5) + _SNAP_SQL + """
, u AS (SELECT seq, lat, lon, value FROM snapped WHERE seq < 750
        UNION ALL SELECT seq + 100000, lat, lon, value + 1000 FROM snapped WHERE seq >= 500)
SELECT lat, lon, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY seq DESC) AS rn FROM u) WHERE rn = 1""")
def union_cached_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-2: resumed rows + new rows, then keep-last per key."""
    s = _snapped(spark, sf_dir)
    cached = s.filter(F.col("seq") < 750)
    new = s.filter(F.col("seq") >= 500).select((F.col("seq") + 100000).alias("seq"), "lat", "lon",
                                               (F.col("value") + 1000).alias("value"))
    u = cached.unionByName(new)
    return W.dedupe_keep_last(u, ["lat", "lon"], "seq").select("lat", "lon", "seq", "value")
