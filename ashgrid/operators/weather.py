"""Weather serving features (AGG-1, AGG-6, JOIN-5, JOIN-6, FN-3, PRJ-12, PRJ-15).

Inputs are long tables, one row per (location, day) and per (location, hour),
as produced by ``sources.weather.read_payloads`` from landed JSON.  Every
operator groups by location, so the work is one shuffle on the location key
and no location's history ever leaves its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import scalar as S
from . import timeseries as TS


# AGG-1
def hourly_to_daily(hourly: DataFrame, loc: str = "loc", time: str = "time") -> DataFrame:
    """Calendar-day aggregates of the hourly-only variables (nulls skipped)."""
    return hourly.groupBy(loc, S.floor_day(time).alias("day")).agg(
        F.avg("snow_depth").alias("mean_snow_depth"),
        F.avg("cloud_cover_low").alias("mean_low_cloud_cover"),
        F.avg("soil_moisture_3_to_9cm").alias("mean_soil_water"),
        F.max("shortwave_radiation").alias("max_solar_radiation"),
    )


# JOIN-6
def resolve_day(daily: DataFrame, target: Column, loc: str = "loc", day: str = "day") -> DataFrame:
    """Per location: the target day when present, else its latest day (which
    may be a forecast day)."""
    return daily.groupBy(loc).agg(
        F.coalesce(F.max(F.when(F.col(day) == target, F.col(day))), F.max(day)).alias("resolved_day")
    )


def target_or_latest(daily: DataFrame, hourly_daily: DataFrame, target: Column, loc: str = "loc",
                     day: str = "day", hourly_cols: list[str] | None = None, default: float = 0.0,
                     resolved: DataFrame | None = None) -> DataFrame:
    """The resolved day's daily row plus the hourly aggregates of that same
    day; a day without hourly rows gets ``default`` (a null aggregate stays null)."""
    res = resolved if resolved is not None else resolve_day(daily, target, loc, day)
    d = daily.join(res, [loc]).filter(F.col(day) == F.col("resolved_day")).drop(day)
    hcols = hourly_cols or [c for c in hourly_daily.columns if c not in (loc, day)]
    h = hourly_daily.select(F.col(loc), F.col(day).alias("resolved_day"), F.lit(True).alias("__h"), *hcols)
    out = d.join(h, [loc, "resolved_day"], "left")
    return out.withColumns(
        {c: F.when(F.col("__h").isNull(), F.lit(default)).otherwise(F.col(c)) for c in hcols}
    ).drop("__h")


SERVING_TRAILING = {
    "precip_7day_sum": ("__precip_m", 7, "sum"),
    "precip_14day_sum": ("__precip_m", 14, "sum"),
    "precip_7day_mean": ("__precip_m", 7, "mean"),
    "precip_14day_mean": ("__precip_m", 14, "mean"),
    "temp_7day_sum": ("__temp_k", 7, "sum"),
    "temp_14day_sum": ("__temp_k", 14, "sum"),
    "temp_7day_mean": ("__temp_k", 7, "mean"),
    "temp_14day_mean": ("__temp_k", 14, "mean"),
}


def serving_trailing(daily: DataFrame, resolved: DataFrame, loc: str = "loc", day: str = "day") -> DataFrame:
    """AGG-6 on the serving path: units converted before aggregating, windows
    end at each location's resolved day."""
    hist = daily.join(resolved, [loc]).filter(F.col(day) <= F.col("resolved_day")).select(
        loc, day,
        S.mm_to_m("precipitation_sum").alias("__precip_m"),
        S.c_to_k("temperature_2m_mean").alias("__temp_k"),
    )
    return TS.trailing(hist, loc, day, SERVING_TRAILING)


# FN-3 + PRJ-12 + PRJ-15
def weather_feature_map(row: DataFrame) -> dict[str, Column]:
    """Service names and units -> model names and units (one row per location)."""
    return {
        "max_temp": S.c_to_k("temperature_2m_max"),
        "mean_temp": S.c_to_k("temperature_2m_mean"),
        "precipitation_sum": S.mm_to_m("precipitation_sum"),
        "sum_snowfall": S.snow_cm_to_m_we("snowfall_sum"),
        "sum_snowmelt": F.lit(C.SUM_SNOWMELT_CONST),
        "average_wind_speed": F.col("wind_speed_10m_mean"),
        "max_wind_speed": F.col("wind_speed_10m_max"),
        "mean_dewpoint": S.c_to_k("dew_point_2m_mean"),
        "mean_total_cloud_cover": S.pct_to_frac("cloud_cover_mean"),
        "mean_evaporation": F.lit(C.EVAP_CONST),
        "mean_snow_depth": S.snow_depth_to_we("mean_snow_depth"),
        "mean_low_cloud_cover": S.pct_to_frac("mean_low_cloud_cover"),
        "mean_soil_water": F.lit(C.SOIL_WATER_CONST),
        "max_solar_radiation": S.wm2_to_jm2("max_solar_radiation"),
    }


WEATHER_FEATURES = [
    "max_temp", "mean_temp", "precipitation_sum", "sum_snowfall", "sum_snowmelt", "average_wind_speed",
    "max_wind_speed", "mean_dewpoint", "mean_total_cloud_cover", "mean_evaporation", "mean_snow_depth",
    "mean_low_cloud_cover", "mean_soil_water", "max_solar_radiation", *SERVING_TRAILING,
]


def location_features(daily: DataFrame, hourly: DataFrame, target: Column, loc: str = "loc",
                      day: str = "day", time: str = "time") -> DataFrame:
    """One feature row per location for the target day (the whole per-location
    weather step of the daily job): resolve day, attach hourly aggregates,
    convert units, trailing windows."""
    hd = hourly_to_daily(hourly, loc, time).withColumnRenamed("day", day)
    res = resolve_day(daily, target, loc, day)  # one per location, used twice
    row = target_or_latest(daily, hd, target, loc, day, resolved=res)
    trail = serving_trailing(daily, res, loc, day)
    feats = row.select(loc, "resolved_day", *[e.alias(n) for n, e in weather_feature_map(row).items()])
    return feats.join(trail, [loc], "left").withColumns(
        {n: F.coalesce(F.col(n), F.lit(0.0)) for n in SERVING_TRAILING if n.endswith("sum")}
    )


# AGG-8
def dedupe_keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the one with the highest ingest sequence."""
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


# JOIN-5
def positional_zip(requests: DataFrame, responses: DataFrame, chunk: str = "chunk", pos: str = "pos") -> DataFrame:
    """i-th requested point <-> i-th response of the same chunk; the requested
    coordinates are the identity.  A chunk whose counts differ raises when the
    result is computed (nothing runs here); ``streaming.ledger.zip_chunks`` puts
    such answers into a table of rejects instead."""
    asked = requests.groupBy(chunk).agg(F.count(F.lit(1)).alias("__n"))
    given = responses.groupBy(chunk).agg(F.count(F.lit(1)).alias("__m"))
    said = F.concat(F.lit("response count differs from request count in chunk "), F.col(chunk).cast("string"))
    equal = asked.join(given, chunk, "full").filter(
        F.when(F.col("__n").eqNullSafe(F.col("__m")), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
    return requests.join(responses, [chunk, pos]).join(equal.select(chunk), chunk)
