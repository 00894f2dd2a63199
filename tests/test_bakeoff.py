"""Bake-off and sweep on a small learnable table."""

import random

import pytest
from pyspark.sql import functions as F

from ashgrid.operators import models as ML
from ashgrid.plans import bakeoff as BO


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.random()
        y = min(5, max(1, round(3 + 1.2 * a - 0.5 * b + rng.gauss(0, 0.3))))
        rows.append((a, b, c, y, i % 3 == 0))
    df = spark.createDataFrame(rows, "a double, b double, c double, DANGER_RATING int, held boolean")
    return BO.prepare(df.filter("NOT held"), df.filter("held"), ["a", "b", "c"])


def test_bakeoff_reports_every_model(spark, data):
    table, by_class = BO.bakeoff(data, BO.models(depth=8, trees=20, balanced_trees=30), threads=3)
    got = {r["model"]: r for r in table.collect()}
    assert set(got) == {"majority", "linear", "ridge", "forest_regressor", "forest", "balanced_forest"}
    assert all(r["n"] == 300 for r in got.values())
    for name in ("linear", "ridge", "forest_regressor"):
        assert got[name]["rmse"] ** 2 == pytest.approx(got[name]["mse"]) and got[name]["mae"] < 0.8
        assert got[name]["exact"] > got["majority"]["exact"] + 0.15 and got[name]["rounded_mae"] is not None
    assert got["forest"]["mse"] is None and got["forest"]["qwk"] > 0.6
    assert got["balanced_forest"]["total_nodes"] > got["forest"]["total_nodes"] > 0
    assert got["ridge"]["mse"] == pytest.approx(got["linear"]["mse"], rel=0.01)
    classes = {(r["model"], r["cls"]) for r in by_class.collect()}
    assert len(classes) == 30


def test_linear_and_ridge_equal_the_normal_equations(spark, data):
    import numpy as np

    rows = data.train.select("scores", "__y").collect()
    x, y = np.array([r["scores"].toArray() for r in rows]), np.array([r["__y"] for r in rows])
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0), 1)
    for model, alpha in ((BO.models()["linear"].fit(data.train), 0.0), (BO.ridge(data.train, 1.0).fit(data.train), 1.0)):
        w = np.linalg.solve(x.T @ x + alpha * np.eye(3), x.T @ (y - y.mean()))
        assert np.allclose(model.coefficients.toArray(), w, rtol=1e-4) and model.intercept == pytest.approx(y.mean())


def test_sweep_varies_all_sizes(spark, data):
    got = {(r["trees"], r["max_depth"], r["min_leaf"]): r for r in BO.sweep(data, (5, 10), (3, 8), (1, 40), threads=4).collect()}
    assert len(got) == 8
    assert got[10, 8, 1]["total_nodes"] > got[5, 8, 1]["total_nodes"] > got[5, 3, 1]["total_nodes"]
    assert got[10, 8, 1]["total_nodes"] > got[10, 8, 40]["total_nodes"]


def test_side_by_side_passes_errors_on(spark):
    with pytest.raises(ZeroDivisionError):
        BO.side_by_side([lambda: 1, lambda: 1 // 0], spark)
    assert BO.side_by_side([lambda i=i: spark.range(i).agg(F.sum("id")).head()[0] for i in (3, 4)], spark) == [3, 6]


def _learnable(spark, rows):
    a, b = F.col("id") % 97, F.col("id") * 31 % 89
    df = spark.range(rows).select(a.cast("double").alias("a"), b.cast("double").alias("b"), (a * 5 / 97 + 1).cast("int").alias("DANGER_RATING"), F.lit(1.0).alias("w"))
    return df.coalesce(1)


def test_forest_rows_are_dealt_over_the_cores(spark):
    """A table of one part trains in several; a small one stays as it is."""
    parts = lambda df: df.select(F.spark_partition_id()).distinct().count()
    assert parts(ML.spread(_learnable(spark, 60_000))) == min(spark.sparkContext.defaultParallelism, 4)
    assert parts(ML.spread(_learnable(spark, 2_000))) == 1
    assert ML.spread(_learnable(spark, 0)).count() == 0


def test_forests_keep_the_nodes_of_their_rows_and_stay_the_same(spark):
    df = _learnable(spark, 1500)
    pipe = ML.rf_classifier(["a", "b"], 5, 12, 2)
    learners = [pipe.getStages()[-1], ML.rf_regressor(["a", "b"]).getStages()[-1], BO.forest(5, 12, 2, True), BO.models()["forest_regressor"]]
    assert all(x.getCacheNodeIds() for x in learners)
    kept = ML.fit(pipe, df)
    pipe.getStages()[-1].setCacheNodeIds(False)
    plain = pipe.fit(df.withColumn("__y", F.col("DANGER_RATING").cast("double") - 1))
    assert kept.stages[-1].toDebugString.split("\n")[1:] == plain.stages[-1].toDebugString.split("\n")[1:]
