"""The daily scoring job end to end on sf0.001: every grid point gets one
rating in 1..5 and every output is written."""

import glob
import json

import __spark_entry__ as E

from .conftest import SF0001


def test_daily_scoring_outputs(spark):
    latest = E.queries()["daily_scoring"](spark, SF0001)
    rows = latest.collect()
    assert len(rows) > 0
    assert len({(r.lat, r.lon) for r in rows}) == len(rows)
    assert all(1 <= r.prediction <= 5 for r in rows)
    out = latest.inputFiles()[0].split("/dated/")[0].replace("file:", "")
    assert glob.glob(f"{out}/csv/date=*/part-*.csv")
    assert glob.glob(f"{out}/geojson/date=*/part-*")
    lines = [x for p in glob.glob(f"{out}/geojson/date=*/part-*") for x in open(p).read().splitlines() if x]
    assert len(lines) == len(rows) and all(json.loads(x)["type"] == "Feature" for x in lines)
    assert not glob.glob(f"{out}/geojson_doc/*")  # the single document is opt-in
