"""Serving-path semantics: units before windows, requested-date season,
contract assembly; training dropna over every column."""

import datetime as dt
import math

from pyspark.sql import functions as F

from ashgrid import contract as C
from ashgrid.operators import weather as W
from ashgrid.plans import daily, training


def _daily(spark, rows):
    return spark.createDataFrame(rows, ", ".join(["loc int", "day date"] + [f"{v} double" for v in C.DAILY_VARS]))


def test_units_converted_before_trailing_windows(spark):
    rows = []
    for i in range(3):
        vals = {v: 1.0 for v in C.DAILY_VARS}
        vals.update(precipitation_sum=10.0 * (i + 1), temperature_2m_mean=float(i))
        rows.append((1, dt.date(2024, 7, 1) + dt.timedelta(days=i), *[vals[v] for v in C.DAILY_VARS]))
    d = _daily(spark, rows)
    h = spark.createDataFrame([], "loc int, time timestamp_ntz, " + ", ".join(f"{v} double" for v in C.HOURLY_VARS))
    r = W.location_features(d, h, F.lit("2024-07-03").cast("date")).collect()[0]
    assert math.isclose(r.precip_7day_sum, 0.06) and math.isclose(r.precip_7day_mean, 0.02)
    assert math.isclose(r.temp_7day_mean, 1.0 + 273.15)
    assert r.mean_snow_depth == 0.0 and r.max_solar_radiation == 0.0  # no hourly rows: defaults


def test_assemble_contract_and_requested_date_season(spark):
    grid = spark.createDataFrame([(1, 50.0, -120.0), (2, 51.0, -121.0)], "gid long, lat double, lon double")
    weather = spark.createDataFrame([(7, dt.date(2024, 7, 3), 50.0, -120.0, 300.0)],
                                    "loc long, resolved_day date, lat double, lon double, max_temp double")
    static = spark.createDataFrame([(50.0, -120.0, 0.4, 800.0)], "lat double, lon double, EVI double, elevation double")
    out = {r.gid: r for r in daily.assemble(grid, weather, static, "2024-07-01").collect()}
    assert list(out[1].asDict())[1:] == C.FEATURE_ORDER
    assert out[1].max_temp == 300.0 and out[2].max_temp == 0.0  # no weather row: 0.0 before scoring
    assert out[2].EVI == 0.4 and out[2].elevation == 800.0  # nearest static row
    doy = dt.date(2024, 7, 1).timetuple().tm_yday
    assert math.isclose(out[1].sin_doy, math.sin(2 * math.pi * doy / 365))


def test_unused_null_column_drops_training_row(spark):
    derived = {"average_wind_speed", "max_wind_speed", "sin_doy", "cos_doy",
               "precip_7day_sum", "precip_14day_sum", "precip_7day_mean", "precip_14day_mean",
               "temp_7day_sum", "temp_14day_sum", "temp_7day_mean", "temp_14day_mean"}
    raw = [c for c in C.FEATURE_ORDER if c not in derived] + ["mean_wind_east", "mean_wind_north",
                                                               "max_wind_east", "max_wind_north"]
    schema = ", ".join(["station_code string", "date string", "DANGER_RATING double", "unused double"]
                       + [f"{c} double" for c in raw])
    rows = [("1", f"2024-01-0{i + 1}", 2.0, None if i == 1 else 0.0, *([1.0] * len(raw))) for i in range(3)]
    out = training.training_features(spark.createDataFrame(rows, schema))
    assert out.count() == 2
