"""Column expressions (all JVM-side, codegen friendly; no Python UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round8(c) -> Column:
    """Oracle hygiene: doubles compared at 8 decimals."""
    return F.round(col(c), 8)


# FN-1
def wind_magnitude(east, north) -> Column:
    return F.hypot(col(east), col(north))


# FN-2
def day_of_year(d) -> Column:
    return F.dayofyear(col(d))


def season_sin(d) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.dayofyear(col(d)) / 365)


def season_cos(d) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.dayofyear(col(d)) / 365)


# FN-3 unit conversions (weather service -> training units) and inverses (FN-9)
def c_to_k(c) -> Column:
    return col(c) + F.lit(C.C_TO_K)


def k_to_c(c) -> Column:
    return col(c) - F.lit(C.C_TO_K)


def mm_to_m(c) -> Column:
    return col(c) * F.lit(C.MM_TO_M)


def m_to_mm(c) -> Column:
    return col(c) * F.lit(1000.0)


def pct_to_frac(c) -> Column:
    return col(c) * F.lit(C.PCT_TO_FRAC)


def wm2_to_jm2(c) -> Column:
    return col(c) * F.lit(C.WM2_TO_JM2)


def snow_cm_to_m_we(c) -> Column:
    return col(c) * F.lit(C.SNOW_CM_TO_M_WE)


def snow_depth_to_we(c) -> Column:
    return col(c) * F.lit(C.SNOWDEPTH_TO_WE)


def _sat_vp(t_c: Column) -> Column:
    return F.lit(0.6108) * F.exp(F.lit(17.27) * t_c / (t_c + F.lit(237.3)))


def _clip(x: Column, lo: float | None, hi: float | None) -> Column:
    """pandas ``clip``: null stays null (``greatest``/``least`` would skip it)."""
    y = x
    if lo is not None:
        y = F.when(y < lo, F.lit(lo)).otherwise(y)
    if hi is not None:
        y = F.when(y > hi, F.lit(hi)).otherwise(y)
    return y


# FN-4
def vpd(max_temp_k, dewpoint_k) -> Column:
    es = _sat_vp(col(max_temp_k) - F.lit(C.C_TO_K))
    ea = _sat_vp(col(dewpoint_k) - F.lit(C.C_TO_K))
    return _clip(es - ea, 0.0, None)


# FN-5
def relative_humidity(max_temp_k, dewpoint_k) -> Column:
    es = _sat_vp(col(max_temp_k) - F.lit(C.C_TO_K))
    ea = _sat_vp(col(dewpoint_k) - F.lit(C.C_TO_K))
    return _clip(ea / es * 100, 0.0, 100.0)


# FN-6
def dewpoint_spread(max_temp, dewpoint) -> Column:
    return col(max_temp) - col(dewpoint)


# FN-7
def haversine_km(lat1, lon1, lat2, lon2, radius: float = C.EARTH_RADIUS_KM) -> Column:
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dp = p2 - p1
    dl = F.radians(col(lon2)) - F.radians(col(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def planar_d2(lat1, lon1, lat2, lon2) -> Column:
    """Squared planar distance in degrees (map lookups)."""
    return F.pow(col(lat1) - col(lat2), 2) + F.pow(col(lon1) - col(lon2), 2)


# FN-8
def clip_round_rating(x, lo: int = 1, hi: int = 5) -> Column:
    """Half-even round, clip to [lo, hi], int."""
    r = F.rint(col(x))
    return F.least(F.greatest(r, F.lit(float(lo))), F.lit(float(hi))).cast("int")


def round1(x) -> Column:
    """One decimal of the exact binary value, ties to even (0.25 -> 0.2, 0.35 -> 0.3)."""
    return F.regexp_replace(F.format_number(col(x), 1), ",", "").cast("double")


# FN-9
def explain_values(precip_14day_sum, max_temp, max_wind_speed) -> dict[str, Column]:
    return {
        "rain14_mm": round1(m_to_mm(precip_14day_sum)),
        "maxtemp_c": round1(k_to_c(max_temp)),
        "wind_ms": round1(max_wind_speed),
    }


# FN-10
def dryness_class(rain14_mm) -> Column:
    r = col(rain14_mm)
    return F.when(r < 5, "very dry").when(r < 20, "fairly dry").otherwise("some recent rain")


# FN-11
def heat_class(maxtemp_c) -> Column:
    t = col(maxtemp_c)
    return F.when(t >= 28, "hot").when(t >= 18, "mild").otherwise("cool")


# FN-12
def round4(c) -> Column:
    return F.round(col(c), 4)


# FN-13
def parse_date_strict(c, fmt: str | None = None) -> Column:
    return F.to_date(col(c), fmt) if fmt else F.to_date(col(c))


def parse_date_coerce(c) -> Column:
    return F.to_date(F.try_to_timestamp(col(c)))


# FN-14
def floor_day(ts) -> Column:
    return col(ts).cast("date")


# FN-15
def int_label(c) -> Column:
    return col(c).cast("int")


# FN-17
def abs_error(y, p) -> Column:
    return F.abs(col(y) - col(p))


def signed_error(y, p) -> Column:
    return col(p) - col(y)


# FN-18
def place_label(name, admin1) -> Column:
    return F.concat_ws(", ", col(name), col(admin1))


def risk_label(risk) -> Column:
    """JOIN-7: 1..5 -> label (null outside the range)."""
    return F.try_element_at(F.array(*[F.lit(x) for x in C.RISK_LABELS]), col(risk).cast("int"))


def risk_colour(risk) -> Column:
    return F.try_element_at(F.array(*[F.lit(x) for x in C.RISK_COLOURS]), col(risk).cast("int"))


# FN-19
def popup_risk(risk) -> Column:
    return F.coalesce(F.nullif(col(risk), F.lit(0)), F.lit(1))


# FLT-8
def inf_to_null(c) -> Column:
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


# FLT-9
def nodata_to_null(c, nodata) -> Column:
    return F.when(col(c) == col(nodata), F.lit(None).cast("double")).otherwise(col(c))


# GEO-8
def in_box(lat, lon, box: dict) -> Column:
    return col(lat).between(box["lat_min"], box["lat_max"]) & col(lon).between(box["lon_min"], box["lon_max"])


def in_low_confidence_zone(lat, lon) -> Column:
    return in_box(lat, lon, C.LOW_CONFIDENCE_ZONE)


# GEO-9
def region_band(lat, lon) -> Column:
    la, lo = col(lat), col(lon)
    return (
        F.when((la <= 50) & (lo <= -122.5), "coast/SW")
        .when(la >= 54, "north")
        .otherwise("interior")
    )


# GEO-12
def coord_key(lat, lon) -> Column:
    """bigint key of a coordinate pair rounded to 4 dp (float-safe matching)."""
    return F.struct(round4(lat).alias("lat"), round4(lon).alias("lon"))
