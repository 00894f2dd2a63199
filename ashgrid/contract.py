"""Column contracts and fixed values.

Everything in the block marked FIXED VALUES must stay equal to the values the
scoring model was trained with; they are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the trained model's contract)
# ---------------------------------------------------------------------------

# The 37 model features, in the order the model expects them.
FEATURE_ORDER = [
    "lat", "lon", "elevation", "EVI", "NDVI", "max_temp", "mean_temp",
    "precipitation_sum", "mean_snow_depth", "sum_snowfall", "sum_snowmelt",
    "rootzone_wetness_mean", "rootzone_wetness_max", "surface_temp_mean",
    "surface_temp_max", "surface_wetness_mean", "surface_wetness_max",
    "evapotranspiration_mean", "evapotranspiration_max", "max_solar_radiation",
    "mean_dewpoint", "mean_evaporation", "mean_low_cloud_cover", "mean_soil_water",
    "mean_total_cloud_cover", "average_wind_speed", "max_wind_speed",
    "sin_doy", "cos_doy", "precip_7day_sum", "precip_14day_sum",
    "precip_7day_mean", "precip_14day_mean", "temp_7day_sum", "temp_14day_sum",
    "temp_7day_mean", "temp_14day_mean",
]

# Features that come from the static (satellite) cache.
SATELLITE_FEATURES = [
    "elevation", "EVI", "NDVI", "rootzone_wetness_mean", "rootzone_wetness_max",
    "surface_temp_mean", "surface_temp_max", "surface_wetness_mean",
    "surface_wetness_max", "evapotranspiration_mean", "evapotranspiration_max",
]

# Optional feature groups.
DROUGHT_FEATURES = ["precip_30day_sum", "precip_60day_sum"]
HUMIDITY_FEATURES = ["vpd", "relative_humidity", "temp_dewpoint_spread"]

# Raw training columns that must be present.
REQUIRED_RAW = [
    "station_code", "date", "DANGER_RATING", "mean_temp", "precipitation_sum",
    "mean_wind_east", "mean_wind_north", "max_wind_east", "max_wind_north",
    "EVI", "NDVI",
]

# Weather payload variables.
DAILY_VARS = [
    "temperature_2m_max", "temperature_2m_mean", "precipitation_sum",
    "snowfall_sum", "wind_speed_10m_max", "wind_speed_10m_mean",
    "dew_point_2m_mean", "cloud_cover_mean", "et0_fao_evapotranspiration",
]
HOURLY_VARS = ["snow_depth", "cloud_cover_low", "soil_moisture_3_to_9cm", "shortwave_radiation"]

# Stations excluded from training, compared as strings.
EXCLUDED_STATIONS = ["964", "1239"]
# Training date range (inclusive) and the one excluded day.
TRAIN_START = "2015-04-01"
TRAIN_END = "2025-07-15"
EXCLUDED_DAY = "2024-08-12"

# Default bounding box of the scoring grid.
DEFAULT_BBOX = {"lat_min": 48.3, "lat_max": 60.0, "lon_min": -139.0, "lon_max": -114.0}
# Low-confidence zone of the map (inclusive box).
LOW_CONFIDENCE_ZONE = {"lat_min": 48.3, "lat_max": 49.6, "lon_min": -125.6, "lon_max": -121.7}

# Unit conversions from the weather service to the training units.
C_TO_K = 273.15
MM_TO_M = 0.001
PCT_TO_FRAC = 0.01
WM2_TO_JM2 = 3600.0
SNOW_CM_TO_M_WE = 0.001
SNOWDEPTH_TO_WE = 0.1
# Constant features with no live source.
SUM_SNOWMELT_CONST = 0.0
EVAP_CONST = -7e-5
SOIL_WATER_CONST = 0.0

# Risk levels 1..5: labels and colours.
RISK_LABELS = ["Low", "Moderate", "High", "Very High", "Extreme"]
RISK_COLOURS = ["#0001fe", "#00e001", "#ffff00", "#e29f01", "#fe0000"]

# Column aliases of the raw inputs.
ALIASES = {
    "station_code": ["STATION_CODE", "station_code"],
    "date": ["DATE_TIME", "date", "DATE"],
    "lat": ["lat", "LATITUDE", "Latitude"],
    "lon": ["lon", "LONGITUDE", "Longitude"],
    "elevation": ["elevation", "ELEVATION_M"],
}

# Mean earth radius in km for haversine distances.
EARTH_RADIUS_KM = 6371.0088

# ---------------------------------------------------------------------------
# contract checks (driver-side schema checks; no data is read)
# ---------------------------------------------------------------------------


class ContractError(ValueError):
    pass


def require_columns(df: DataFrame, cols: list[str], what: str = "input") -> DataFrame:
    """PRJ-4: fail listing the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}; present: {df.columns}")
    return df


def resolve_column(df: DataFrame, candidates: list[str]) -> str | None:
    """PRJ-2: first candidate name present in the frame, else None."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def rename_alias(df: DataFrame, target: str, alias: str) -> DataFrame:
    """PRJ-1: ``alias`` becomes ``target`` when ``target`` is absent."""
    if target not in df.columns and alias in df.columns:
        return df.withColumnRenamed(alias, target)
    return df


def value_column(df: DataFrame, feature: str, coords=("lat", "lon", "date")) -> str:
    """PRJ-3: the column named after the feature, else the first column that is
    not a coordinate or date, else an error."""
    if feature in df.columns:
        return feature
    for c in df.columns:
        if c not in coords:
            return c
    raise ContractError(f"no value column for {feature} in {df.columns}")


def add_missing_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-6: absent columns become 0.0."""
    absent = {c: F.lit(0.0) for c in cols if c not in df.columns}
    return df.withColumns(absent) if absent else df


def select_contract(df: DataFrame, order: list[str] = FEATURE_ORDER, keep: list[str] = ()) -> DataFrame:
    """PRJ-7: project exactly the contract columns, in order (plus ``keep``)."""
    return df.select(*keep, *order)


def assert_contract(columns: list[str], expected: list[str] = FEATURE_ORDER) -> None:
    """PRJ-8: ordered column list must equal the model's."""
    if list(columns) != list(expected):
        raise ContractError(f"feature order mismatch: {list(columns)} != {list(expected)}")


def feature_groups(drought: bool = False, humidity: bool = False) -> list[str]:
    """PRJ-10: base features without the drought group, plus the chosen groups."""
    base = [c for c in FEATURE_ORDER if c not in DROUGHT_FEATURES]
    return base + (DROUGHT_FEATURES if drought else []) + (HUMIDITY_FEATURES if humidity else [])
