"""Time-series queries: training features, rolling windows, interpolation, fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as FX
from ..functions import scalar as S
from ..operators import filters as FL
from ..operators import timeseries as TS
from ..plans import training
from .registry import register
from .sqltext import interp_cols, interp_value, r8, rolling

# fixture columns -> training schema
_TRAIN_NAMES = {"st": "station_code", "d": "date", "evi": "EVI", "ndvi": "NDVI",
                "temp": "mean_temp", "precip": "precipitation_sum"}


def _station_day_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    sd = FX.station_day(spark, sf_dir)
    return sd.select(*[F.col(a).alias(b) for a, b in _TRAIN_NAMES.items()], "we", "wn")


_FEATURE_OUT = ["EVI", "NDVI", "average_wind_speed", "sin_doy", "cos_doy",
                "precip_7day_sum", "precip_14day_sum", "precip_7day_mean", "precip_14day_mean",
                "temp_7day_sum", "temp_14day_sum", "temp_7day_mean", "temp_14day_mean"]


def _station_features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = training.clean(_station_day_train(spark, sf_dir))
    df = training.derive(df, winds={"average_wind_speed": ("we", "wn")})
    df = FL.dropna_all(df)
    return df.select(
        F.col("station_code").alias("st"), F.col("date").alias("d"),
        *[S.round8(c).alias(c) for c in _FEATURE_OUT],
    )


_SF_SQL = FX.with_views("station_day") + f"""
, f AS (
  SELECT * FROM station_day
  WHERE st IS NOT NULL AND CAST(st AS VARCHAR) NOT IN ('964', '1239')
    AND d BETWEEN DATE '2015-04-01' AND DATE '2025-07-15' AND d <> DATE '2024-08-12'),
r AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY d) AS rn FROM f),
i AS (SELECT *, {interp_cols('evi', 'st', 'd')}, {interp_cols('ndvi', 'st', 'd')} FROM r),
g AS (
  SELECT st, d,
         {interp_value('evi')} AS evi_f, {interp_value('ndvi')} AS ndvi_f,
         sqrt(we * we + wn * wn) AS wind,
         sin(2 * pi() * dayofyear(d) / 365) AS sin_doy, cos(2 * pi() * dayofyear(d) / 365) AS cos_doy,
         {rolling('sum', 'precip', 7, 'st', 'd')} AS p7s, {rolling('sum', 'precip', 14, 'st', 'd')} AS p14s,
         {rolling('avg', 'precip', 7, 'st', 'd')} AS p7m, {rolling('avg', 'precip', 14, 'st', 'd')} AS p14m,
         {rolling('sum', 'temp', 7, 'st', 'd')} AS t7s, {rolling('sum', 'temp', 14, 'st', 'd')} AS t14s,
         {rolling('avg', 'temp', 7, 'st', 'd')} AS t7m, {rolling('avg', 'temp', 14, 'st', 'd')} AS t14m,
         precip, temp
  FROM i)
SELECT st, d, {r8('evi_f', 'EVI')}, {r8('ndvi_f', 'NDVI')}, {r8('wind', 'average_wind_speed')},
       {r8('sin_doy', 'sin_doy')}, {r8('cos_doy', 'cos_doy')},
       {r8('p7s', 'precip_7day_sum')}, {r8('p14s', 'precip_14day_sum')},
       {r8('p7m', 'precip_7day_mean')}, {r8('p14m', 'precip_14day_mean')},
       {r8('t7s', 'temp_7day_sum')}, {r8('t14s', 'temp_14day_sum')},
       {r8('t7m', 'temp_7day_mean')}, {r8('t14m', 'temp_14day_mean')}
FROM g
WHERE evi_f IS NOT NULL AND ndvi_f IS NOT NULL AND wind IS NOT NULL AND p7s IS NOT NULL
  AND p14s IS NOT NULL AND p7m IS NOT NULL AND p14m IS NOT NULL AND t7s IS NOT NULL
  AND t14s IS NOT NULL AND t7m IS NOT NULL AND t14m IS NOT NULL AND precip IS NOT NULL AND temp IS NOT NULL
"""


@register("station_features", _SF_SQL, headline=True)
def station_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training feature query end to end (FLT-1, FLT-2, WIN-4..6, FN-1, FN-2, WIN-1, WIN-2, FLT-6)."""
    return _station_features_df(spark, sf_dir)


# ---- WIN-1 / WIN-2 / WIN-3: rolling windows by rows ------------------------

def _rolling_query(n_list, how_list, src: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        if src == "long":
            df = FX.station_day_long(spark, sf_dir)
            order = ["d", "id"]
        else:
            df = FX.station_day(spark, sf_dir)
            order = ["d"]
        specs = {f"{how}_{n}": ("precip", n, how) for n in n_list for how in how_list}
        # customer-keyed history: one key could hold a large share of the rows, so it runs in blocks
        out = TS.add_rolling(df, "st", order, specs, block_rows=1_000_000 if src == "long" else None)
        keys = ["st", "d"] + (["id"] if src == "long" else [])
        return out.select(*keys, *[S.round8(c).alias(c) for c in specs])

    return q


def _rolling_sql(n_list, how_list, src: str) -> str:
    view = "station_day_long" if src == "long" else "station_day"
    order = "d, id" if src == "long" else "d"
    keys = "st, d" + (", id" if src == "long" else "")
    agg = {"sum": "sum", "mean": "avg"}
    items = ", ".join(
        r8(rolling(agg[how], "precip", n, "st", order), f"{how}_{n}") for n in n_list for how in how_list
    )
    return FX.with_views(view) + f"SELECT {keys}, {items} FROM {view}"


for _name, _n, _how, _src in [
    ("rolling_sum_7_14", (7, 14), ("sum",), "day"),
    ("rolling_mean_7_14", (7, 14), ("mean",), "day"),
    ("rolling_sum_30_60", (30, 60), ("sum",), "long"),
]:
    register(_name, _rolling_sql(_n, _how, _src), headline=_name == "rolling_sum_30_60")(
        _rolling_query(_n, _how, _src)
    )


# ---- WIN-4 / WIN-5 / WIN-6 -------------------------------------------------

_INTERP_SQL = FX.with_views("station_day") + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY st ORDER BY d) AS rn FROM station_day),
i AS (SELECT *, {interp_cols('evi', 'st', 'd')} FROM r)
SELECT st, d, {r8(interp_value('evi', fill_edges=False), 'evi_interp')} FROM i
"""


@register("interpolate_linear", _INTERP_SQL)
def interpolate_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interior gaps only (edges left null)."""
    df = FX.station_day(spark, sf_dir)
    out = TS.interpolate(df, "st", ["d"], ["evi"], fill_edges=False)
    return out.select("st", "d", S.round8("evi").alias("evi_interp"))


_FILL_SQL = FX.with_views("station_day") + """
SELECT st, d,
  last_value(ndvi IGNORE NULLS) OVER (PARTITION BY st ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ndvi_ffill,
  first_value(ndvi IGNORE NULLS) OVER (PARTITION BY st ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ndvi_bfill
FROM station_day
"""


def _fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = FX.station_day(spark, sf_dir)
    w = TS.spec("st", "d")
    return df.select("st", "d", TS.ffill("ndvi", w).alias("ndvi_ffill"), TS.bfill("ndvi", w).alias("ndvi_bfill"))


@register("ffill", FX.with_views("station_day") + """
SELECT st, d, last_value(ndvi IGNORE NULLS) OVER (PARTITION BY st ORDER BY d
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ndvi_ffill FROM station_day""")
def ffill_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fills(spark, sf_dir).drop("ndvi_bfill")


@register("bfill", FX.with_views("station_day") + """
SELECT st, d, first_value(ndvi IGNORE NULLS) OVER (PARTITION BY st ORDER BY d
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ndvi_bfill FROM station_day""")
def bfill_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fills(spark, sf_dir).drop("ndvi_ffill")


# ---- ORD-1 / ORD-2: ordering ------------------------------------------------

@register("sort_station_date", FX.with_views("station_day") + """
SELECT st, d, row_number() OVER (PARTITION BY st ORDER BY d) AS pos FROM station_day""")
def sort_station_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each row in its station's date order (the order every window uses)."""
    df = FX.station_day(spark, sf_dir)
    return df.select("st", "d", F.row_number().over(TS.spec("st", "d")).alias("pos"))


@register("sort_time", FX.with_views("hourly") + """
SELECT loc, ts, row_number() OVER (PARTITION BY loc ORDER BY b ASC NULLS LAST, seq) AS pos FROM hourly""")
def sort_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows ranked by value with nulls last, per location (a total order)."""
    df = FX.hourly(spark, sf_dir)
    w = TS.spec("loc", []).orderBy(F.col("b").asc_nulls_last(), "seq")
    return df.select("loc", "ts", F.row_number().over(w).alias("pos"))


# ---- many groups, null groups and null keys ---------------------------------

_GROUPED_SQL = """
WITH g AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 100 = 7 THEN NULL ELSE o_custkey % 100 END AS grp,
                  CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS DOUBLE) AS x FROM orders)
"""


def _grouped_orders(spark, sf_dir) -> DataFrame:
    grp = F.col("o_custkey") % 100
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.when(grp != 7, grp).alias("grp"), F.col("o_orderdate").cast("date").alias("d"),
        F.col("o_custkey").cast("double").alias("x"))


@register("latest_many_groups", _GROUPED_SQL + """
, m AS (SELECT grp, max(d) AS newest FROM g GROUP BY grp)
SELECT id, g.grp FROM g JOIN m ON g.grp IS NOT DISTINCT FROM m.grp AND g.d = m.newest""")
def latest_many_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4 over a hundred groups, one of them null."""
    return FL.latest_or_pinned(_grouped_orders(spark, sf_dir), "d", per=["grp"]).select("id", "grp")


@register("rolling_null_key", _GROUPED_SQL + f"""
SELECT id, grp, {rolling('sum', 'x', 5, 'grp', 'id')} AS sum_5, round({rolling('avg', 'x', 9, 'grp', 'id')}, 8) AS mean_9 FROM g""")
def rolling_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-3 in small blocks; the rows of the null key are a history too."""
    out = TS.add_rolling(_grouped_orders(spark, sf_dir), "grp", "id", {"sum_5": ("x", 5, "sum"), "mean_9": ("x", 9, "mean")}, block_rows=64)
    return out.select("id", "grp", "sum_5", S.round8("mean_9").alias("mean_9"))
