"""Queries that fit a forest compute the training table once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ashgrid.catalog import learning


@pytest.mark.parametrize("query", ["rf_classifier", "model_load"])
def test_forest_reads_a_written_table(spark, monkeypatch, query):
    schema = "st long, d date, " + ", ".join(f"{c} double" for c in learning.ML_FEATURES) + f", {learning.LABEL} int"
    rows = [(s, dt.date(2024, 1, 11) + dt.timedelta(k), *[float((s * k + j) % 7) for j in range(13)], (s + k) % 3 + 1)
            for s in range(20) for k in range(20)]
    made = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(learning, "_labelled", lambda spark, sf_dir: made)
    scored = getattr(learning, query)(spark, "unused")
    assert scored.inputFiles() and all("/labelled-" in f for f in scored.inputFiles())
    expected = made.filter(F.col("d") >= learning.CUT) if query == "rf_classifier" else made
    assert sorted((r["st"], r["d"]) for r in scored.collect()) == sorted((r["st"], r["d"]) for r in expected.collect())
