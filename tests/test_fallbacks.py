"""Fallback paths the fixtures do not reach: many groups in the latest
slice (join instead of literal predicates)."""

import datetime as dt

from ashgrid.operators import filters as FL


def test_latest_per_group_join_path(spark):
    rows = [(f"L{g}", dt.date(2024, 1, 1) + dt.timedelta(days=d), float(g * 10 + d))
            for g in range(70) for d in range(g % 3 + 1)]
    rows.append(("nulls", None, 1.0))
    df = spark.createDataFrame(rows, "layer string, date date, value double")
    got = {(r.layer, r.value) for r in FL.latest_or_pinned(df, "date", per=["layer"]).collect()}
    want = {(f"L{g}", float(g * 10 + g % 3)) for g in range(70)} | {("nulls", 1.0)}
    assert got == want
