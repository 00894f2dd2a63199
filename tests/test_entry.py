"""Driver contract: entry, registry completeness, a sample of oracle checks."""

import os

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["st", "d"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 130


def _duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", ["station_features", "quadratic_kappa", "clip_rings", "nearest_pixel_join",
                                  "weather_feature_map", "raster_to_long", "trend_window", "stratified_split"])
def test_oracle_sample(spark, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sdf.columns
    srows = sorted(tuple(r) for r in sdf.collect())
    cur = _duck().execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    order = [dcols.index(c) for c in cols]
    drows = sorted(tuple(r[i] for i in order) for r in cur.fetchall())
    assert len(srows) == len(drows)
    assert srows == drows
