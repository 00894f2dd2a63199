"""Exact medians by bucket counts, ranks without a global window, mergeable sketches."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashgrid.operators import drift
from ashgrid.operators import quantiles as Q
from ashgrid.operators.hotkeys import ranked


def _values(kind, rng):
    return {
        "normal": [rng.gauss(0, 1) for _ in range(20_001)], "even": [rng.lognormvariate(0, 3) for _ in range(10_000)],
        "ties": [float(rng.choice([1, 2, 2, 2, 3])) for _ in range(5_000)], "two": [1.0, 5.0], "one": [7.5], "same": [3.0] * 4_000,
        "half": [0.0] * 3_000 + [1.0] * 3_000, "few": [float(i) for i in range(11)],
        "sorted": [i / 7 for i in range(30_000)], "far": [-1e308] * 500 + [1e-300, 2e-300] + [1e308] * 500,
    }[kind]


@pytest.mark.parametrize("kind", ["normal", "even", "ties", "two", "one", "same", "half", "few", "sorted", "far"])
def test_median_equals_sorting(spark, kind):
    v = _values(kind, random.Random(kind))
    df = spark.createDataFrame([(x,) for x in v] + [(None,)] * 3, "x double").repartition(7)
    assert Q.median(df, "x").head()["m"] == statistics.median(v)


def test_median_of_nothing(spark):
    assert Q.median(spark.createDataFrame([(None,), (None,)], "x double"), "x").head()["m"] is None
    assert Q.median(spark.createDataFrame([], "x double"), "x").head()["m"] is None


def test_no_task_gets_the_column(spark):
    """What reaches the last window is a sliver of the distinct values."""
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.random(),) for _ in range(200_000)], "x double")
    c = df.select(F.col("x").alias("v"))
    first = c.agg(Q._cuts(F.col("v")).alias("cuts")).select(Q._around(F.col("cuts"), F.lit(0.5), -1), Q._around(F.col("cuts"), F.lit(0.5), 1)).head()
    assert 0 < c.filter(F.col("v").between(first[0], first[1])).count() < 200_000 * 0.005


def test_ranks_equal_a_global_window(spark):
    rng = random.Random(3)
    keys = rng.sample(range(10 ** 6), 5_000)
    got = ranked(spark.createDataFrame([(k,) for k in keys], "k long").repartition(5), "k", "rank").collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["rank"])] == sorted(keys)
    assert sorted(r["rank"] for r in got) == list(range(5_000))
    few = ranked(spark.createDataFrame([(2,), (None,), (2,), (1,)], "k long"), "k", "rank").collect()
    assert sorted(r["rank"] for r in few) == [0, 1, 2, 3] and [r["rank"] for r in few if r["k"] is None] == [0]


def test_sketches_merge_over_days(spark, tmp_path):
    rng = np.random.default_rng(4)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    a, b = rng.lognormal(0, 1, (12, 3_000)), rng.normal(50, 5, (12, 3_000))
    rows = [(d, float(x), float(y) if j % 10 else None) for i, d in enumerate(days) for j, (x, y) in enumerate(zip(a[i], b[i]))]
    rows.append((None, float("nan"), 1.0))
    df = spark.createDataFrame(rows, "day date, a double, b double").repartition(6)
    path = str(tmp_path / "sketches")
    drift.sketches(df, ["a", "b"], "day").filter("day < '2024-01-07'").write.parquet(path)
    drift.sketches(df, ["a", "b"], "day").filter("day >= '2024-01-07'").write.mode("append").parquet(path)  # later days
    stored = spark.read.parquet(path)
    got = {r["feature"]: r for r in drift.described(stored, "t").collect()}
    for name, values in (("a", np.sort(a.ravel())), ("b", np.sort([r[2] for r in rows if r[2] is not None and r[0] is not None]))):
        r = got[name]
        assert r["t_n"] == len(values) and r["t_min"] == values[0] and r["t_max"] == values[-1]
        assert r["t_mean"] == pytest.approx(values.mean()) and r["t_std"] == pytest.approx(values.std(ddof=1))
        for q, at in drift.QUANTILES.items():
            assert abs(np.searchsorted(values, r[f"t_{q}"]) / len(values) - at) < 2 * drift.rank_error()
    # a window of days is a filter of the stored rows
    some = drift.described(stored.filter("day <= '2024-01-03'"), "t").filter("feature = 'a'").head()
    assert some["t_n"] == 9_000


def test_profile_flags_units(spark):
    train = drift.sketches(spark.createDataFrame([(float(i), 1.0) for i in range(1, 100)], "p double, q double"), ["p", "q"])
    serve = drift.sketches(spark.createDataFrame([(i / 1000, 1.1, None) for i in range(1, 100)], "p double, q double, r double"), ["p", "q", "r"])
    got = {r["feature"]: r["unit_flag"] for r in drift.profile(train, serve).collect()}
    assert got == {"p": True, "q": False, "r": None}
