"""Row windows, interpolation and fills against plain-Python references."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from ashgrid.operators import timeseries as TS
from ashgrid.plans import training


def _frame(spark, rows):
    return spark.createDataFrame(rows, "st string, d date, v double")


def _days(n, start=dt.date(2024, 1, 1), skip=()):
    out, d = [], start
    while len(out) < n:
        if d not in skip:
            out.append(d)
        d += dt.timedelta(days=1)
    return out


def _interp_ref(vals):
    """pandas' linear interpolate().ffill().bfill() by position, in plain Python."""
    known = [i for i, v in enumerate(vals) if v is not None]
    if not known:
        return list(vals)
    out = list(vals)
    for i, v in enumerate(vals):
        if v is not None:
            continue
        lo = max((k for k in known if k < i), default=None)
        hi = min((k for k in known if k > i), default=None)
        if lo is not None and hi is not None:
            out[i] = vals[lo] + (vals[hi] - vals[lo]) * (i - lo) / (hi - lo)
        elif lo is not None:
            out[i] = vals[lo]
        else:
            out[i] = vals[hi]
    return out


def test_interpolate_leading_trailing_all_null(spark):
    days = _days(6)
    rows = [("a", d, v) for d, v in zip(days, [None, 2.0, None, None, 8.0, None])]
    rows += [("b", d, None) for d in days]
    out = TS.interpolate(_frame(spark, rows), "st", "d", ["v"]).orderBy("st", "d").collect()
    a = [r.v for r in out if r.st == "a"]
    assert a == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]
    assert all(r.v is None for r in out if r.st == "b")


def test_interpolate_ignores_dates(spark):
    # missing calendar days do not change the straight line: rows are equally spaced
    days = _days(3, skip={dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)})
    rows = [("a", d, v) for d, v in zip(days, [0.0, None, 9.0])]
    out = TS.interpolate(_frame(spark, rows), "st", "d", ["v"]).orderBy("d").collect()
    assert [r.v for r in out] == [0.0, 4.5, 9.0]


def test_interpolate_random_matches_reference(spark):
    rnd = random.Random(7)
    rows = []
    for st in "abcd":
        for d in _days(40):
            rows.append((st, d, None if rnd.random() < 0.4 else round(rnd.uniform(0, 10), 2)))
    out = TS.interpolate(_frame(spark, rows), "st", "d", ["v"]).collect()
    got = {(r.st, r.d): r.v for r in out}
    for st in "abcd":
        vals = [v for s, d, v in rows if s == st]
        ref = _interp_ref(vals)
        for (s, d, _), e in zip([r for r in rows if r[0] == st], ref):
            g = got[(s, d)]
            assert (g is None and e is None) or math.isclose(g, e, rel_tol=1e-12, abs_tol=1e-12)


def test_causal_interpolation_only_carries_forward(spark):
    days = _days(4)
    rows = [("a", d, v) for d, v in zip(days, [None, 1.0, None, 5.0])]
    out = TS.interpolate(_frame(spark, rows), "st", "d", ["v"], causal=True).orderBy("d").collect()
    assert [r.v for r in out] == [None, 1.0, 1.0, 5.0]


def test_rolling_is_by_rows_and_skips_nulls(spark):
    days = _days(5, skip={dt.date(2024, 1, 3)})
    rows = [("a", d, v) for d, v in zip(days, [1.0, None, 3.0, 4.0, 5.0])]
    df = TS.add_rolling(_frame(spark, rows), "st", "d", {"s3": ("v", 3, "sum"), "m3": ("v", 3, "mean")})
    out = df.orderBy("d").collect()
    assert [r.s3 for r in out] == [1.0, 1.0, 4.0, 7.0, 12.0]
    assert [r.m3 for r in out] == [1.0, 1.0, 2.0, 3.5, 4.0]


def test_rolling_all_null_window_is_null_but_trailing_sum_is_zero(spark):
    days = _days(3)
    rows = [("a", d, None) for d in days]
    df = _frame(spark, rows)
    roll = TS.add_rolling(df, "st", "d", {"s7": ("v", 7, "sum"), "m7": ("v", 7, "mean")}).collect()
    assert all(r.s7 is None and r.m7 is None for r in roll)
    tr = TS.trailing(df, "st", "d", {"s7": ("v", 7, "sum"), "m7": ("v", 7, "mean")}).collect()[0]
    assert tr.s7 == 0.0 and tr.m7 is None


def test_filters_before_windows_keep_row_semantics(spark):
    # the excluded day is removed before the windows, so the window widens
    days = [dt.date(2024, 8, 10), dt.date(2024, 8, 11), dt.date(2024, 8, 12), dt.date(2024, 8, 13)]
    rows = [("1", d, float(i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "station_code string, date date, precipitation_sum double")
    cleaned = training.clean(df)
    assert cleaned.count() == 3
    out = TS.add_rolling(cleaned, "station_code", "date", {"s2": ("precipitation_sum", 2, "sum")}).orderBy("date").collect()
    assert [r.s2 for r in out] == [0.0, 1.0, 4.0]


def test_excluded_and_null_keys(spark):
    rows = [("964", dt.date(2020, 1, 1), 1.0), ("1239", dt.date(2020, 1, 1), 1.0), (None, dt.date(2020, 1, 1), 1.0),
            ("5", dt.date(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "station_code string, date date, v double")
    assert [r.station_code for r in training.clean(df).collect()] == ["5"]


def test_importance_rank_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "feature string, importance double")
    out = TS.importance_rank(df).orderBy("rank").collect()
    assert [r.feature for r in out] == ["c", "a", "b"]


def test_integer_station_keys_excluded_numerically(spark):
    rows = [(964, dt.date(2020, 1, 1), 1.0), (1239, dt.date(2020, 1, 1), 1.0), (None, dt.date(2020, 1, 1), 1.0),
            (5, dt.date(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "station_code bigint, date date, v double")
    assert [r.station_code for r in training.clean(df).collect()] == [5]


def test_training_features_contract(spark):
    from ashgrid import contract as C

    derived = {"average_wind_speed", "max_wind_speed", "sin_doy", "cos_doy"} | set(TS.TRAINING_ROLLING)
    raw_cols = [c for c in C.FEATURE_ORDER if c not in derived]
    extra = ["mean_wind_east", "mean_wind_north", "max_wind_east", "max_wind_north"]
    schema = ", ".join(["station_code string", "date string", "DANGER_RATING double", "station_name string"]
                       + [f"{c} double" for c in raw_cols + extra if c != "elevation"] + ["ELEVATION_M double"])
    rows = []
    for st in ("1", "2"):
        for i, d in enumerate(_days(10)):
            vals = [float(i + 1)] * len([c for c in raw_cols + extra if c != "elevation"])
            rows.append((st, d.isoformat(), float(1 + i % 5), "name", *vals, 100.0))
    df = spark.createDataFrame(rows, schema)
    # one missing required value in an unused column still drops its row (dropna over all columns)
    df = df.withColumn("station_name", F.when((F.col("station_code") == "2") & (F.col("date") == "2024-01-03"), None)
                       .otherwise(F.col("station_name")))
    out = training.training_features(df)
    assert out.columns == C.FEATURE_ORDER + ["DANGER_RATING"]
    assert out.count() == 20  # station_name is dropped before dropna, so no row is lost
    assert dict(out.dtypes)["DANGER_RATING"] == "int"
