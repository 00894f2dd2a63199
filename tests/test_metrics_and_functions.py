"""Ordinal metrics, rounding, contracts, raster names, weather edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ashgrid import contract as C
from ashgrid.functions import scalar as S
from ashgrid.operators import metrics as M
from ashgrid.operators import raster as RA
from ashgrid.operators import splits as SP
from ashgrid.operators import weather as W


def _kappa_ref(y, p):
    labels = sorted(set(y) | set(p))
    pos = {lab: i for i, lab in enumerate(labels)}
    k, n = len(labels), len(y)
    o = [[0] * k for _ in range(k)]
    for a, b in zip(y, p):
        o[pos[a]][pos[b]] += 1
    ry = [sum(r) for r in o]
    cp = [sum(o[i][j] for i in range(k)) for j in range(k)]
    num = sum((i - j) ** 2 * o[i][j] for i in range(k) for j in range(k))
    den = sum((i - j) ** 2 * ry[i] * cp[j] / n for i in range(k) for j in range(k))
    return None if den == 0 else 1 - num / den


@pytest.mark.parametrize("y,p", [
    ([1, 2, 3, 4, 5, 5, 2], [1, 3, 3, 5, 4, 5, 1]),
    ([1, 1, 5, 5, 2], [2, 1, 5, 4, 2]),  # classes 3 and 4 partly absent: positions, not labels
    ([3, 3, 3], [3, 3, 3]),  # constant: undefined
])
def test_quadratic_kappa_matches_matrix_form(spark, y, p):
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    got = M.quadratic_kappa(df).collect()[0].qwk
    ref = _kappa_ref(y, p)
    assert (got is None and ref is None) or abs(got - ref) < 1e-12


def test_ordinal_report(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (3, 2), (5, 5)], "y int, p int")
    r = M.ordinal_report(df).collect()[0]
    assert r.n == 4 and r.exact == 0.5 and r.within_one == 0.75 and r.bias == 0.25


def test_half_even_rating_round_and_clip(spark):
    df = spark.createDataFrame([(2.5,), (0.4,), (5.6,), (3.5,)], "x double")
    assert [r.v for r in df.select(S.clip_round_rating("x").alias("v")).collect()] == [2, 1, 5, 4]


def test_stratified_split_exact_counts(spark):
    rows = [(i, 1 + i % 3) for i in range(1000)] + [(2000 + i, 9) for i in range(7)]
    df = spark.createDataFrame(rows, "id long, y int")
    out = SP.stratified_split(df, "y", "id", 0.2)
    counts = {(r.y, r.split): r["count"] for r in out.groupBy("y", "split").count().collect()}
    for y in (1, 2, 3):
        n = sum(1 for _, c in rows if c == y)
        assert counts[(y, "test")] == int(n * 0.2 + 0.5)
    assert counts[(9, "test")] == 1
    # deterministic
    a = {r.id for r in out.filter("split = 'test'").collect()}
    b = {r.id for r in SP.stratified_split(df, "y", "id", 0.2).filter("split = 'test'").collect()}
    assert a == b


def test_empty_split_side_raises(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date")
    with pytest.raises(ValueError):
        SP.require_both_sides(SP.temporal_split_tag(df, "d", "2019-01-01"))


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "y int")
    w = {r.y: r.w for r in M.balanced_weights(df, "y").collect()}
    assert w == {1: 4 / (2 * 3), 2: 4 / (2 * 1)}


def test_contract_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(C.ContractError):
        C.require_columns(df, ["a", "b"])
    with pytest.raises(C.ContractError):
        C.assert_contract(["lat", "lon"])
    assert C.add_missing_zero(df, ["z"]).collect()[0].z == 0.0


def test_inf_nan_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.5,)], "x double")
    assert [r.x for r in df.select(S.inf_to_null("x").alias("x")).collect()] == [None, None, None, 1.5]


@pytest.mark.parametrize("path,layer,date", [
    ("MOD13Q1.061__250m_16_days_NDVI_doy2023145_aid0001.tif", "NDVI", "2023-05-25"),
    ("x/SPL4__surface_temp_max_2023-05-12.tif", "max", "2023-05-12"),
    ("a/b/EVI_20220131.tiff", "EVI", "2022-01-31"),
    ("elevation.tif", "elevation", None),
    ("20220131.tif", "20220131", "2022-01-31"),
    ("rootzone_wetness_aid0007_doy2021001.tif", "wetness", "2021-01-01"),
])
def test_parse_layer_and_date(spark, path, layer, date):
    df = spark.createDataFrame([(path,)], "path string")
    e = RA.parse_layer_and_date("path")
    r = df.select(e["layer"].alias("layer"), e["date"].alias("date")).collect()[0]
    assert (r.layer, r.date) == (layer, date)


def test_unvalidated_date_kept_as_text(spark):
    df = spark.createDataFrame([("LST_20221345.tif",)], "path string")
    e = RA.parse_layer_and_date("path")
    r = df.select(e["date"].alias("date"), e["date_parsed"].alias("p")).collect()[0]
    assert r.date == "2022-13-45" and r.p is None


def test_target_day_missing_falls_back_to_latest_incl_forecast(spark):
    daily = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 1.0), (1, dt.date(2024, 1, 3), 3.0), (2, dt.date(2024, 1, 2), 2.0)],
        "loc int, day date, x double")
    hd = spark.createDataFrame([(2, dt.date(2024, 1, 2), None)], "loc int, day date, h double")
    out = {r.loc: r for r in W.target_or_latest(daily, hd, F.lit("2024-01-02").cast("date")).collect()}
    assert out[1].resolved_day == dt.date(2024, 1, 3) and out[1].h == 0.0  # no hourly rows -> default
    assert out[2].resolved_day == dt.date(2024, 1, 2) and out[2].h is None  # null aggregate stays null


def test_positional_zip_count_mismatch(spark):
    req = spark.createDataFrame([("c", 0), ("c", 1)], "chunk string, pos int")
    resp = spark.createDataFrame([("c", 0)], "chunk string, pos int")
    zipped = W.positional_zip(req, resp)  # nothing runs yet
    with pytest.raises(Exception, match="response count differs"):
        zipped.collect()


def test_dedupe_keep_last(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1, "a"), (1.0, 2.0, 5, "b"), (3.0, 4.0, 2, "c")], "lat double, lon double, seq int, v string")
    out = {(r.lat, r.lon): r.v for r in W.dedupe_keep_last(df, ["lat", "lon"], "seq").collect()}
    assert out == {(1.0, 2.0): "b", (3.0, 4.0): "c"}


def test_strict_parse_raises_coerce_gives_null(spark):
    df = spark.createDataFrame([("2024-07-01",), ("not a date",)], "t string")
    assert [r.d for r in df.select(S.parse_date_coerce("t").alias("d")).collect()] == [dt.date(2024, 7, 1), None]
    with pytest.raises(Exception):
        df.select(S.parse_date_strict("t", "yyyy-MM-dd").alias("d")).collect()


def test_majority_ties_go_to_smallest_label(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (5,)], "y int")
    assert M.majority_class(df).collect()[0].majority == 1


def test_zone_box_inclusive_and_region_first_match(spark):
    df = spark.createDataFrame([(48.3, -125.6), (49.6, -121.7), (49.61, -122.0), (50.0, -122.5), (54.0, -130.0),
                                (53.9, -120.0)], "la double, lo double")
    r = df.select(S.in_low_confidence_zone("la", "lo").alias("z"), S.region_band("la", "lo").alias("b")).collect()
    assert [x.z for x in r] == [True, True, False, False, False, False]
    assert [x.b for x in r] == ["coast/SW", "interior", "interior", "coast/SW", "north", "interior"]


def test_humidity_clips_but_keeps_nulls(spark):
    df = spark.createDataFrame([(300.0, 290.0), (290.0, 300.0), (None, 290.0)], "t double, td double")
    r = df.select(S.vpd("t", "td").alias("vpd"), S.relative_humidity("t", "td").alias("rh")).collect()
    assert r[0].vpd > 0 and 0 < r[0].rh < 100
    assert r[1].vpd == 0.0 and r[1].rh == 100.0  # dewpoint above temperature: clipped
    assert r[2].vpd is None and r[2].rh is None
