"""Pipelines with a forest grown a tree in a task: MLlib models, saved and loaded."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from ashgrid.operators import forest as FR
from ashgrid.operators import metrics as M
from ashgrid.operators import models as ML

from .test_forest import _small_blocks, table  # noqa: F401


def test_a_large_fit_is_grown_and_is_an_mllib_model(spark, table, monkeypatch):
    train, test = M.balanced_weights(table.filter("NOT held"), "DANGER_RATING"), table.filter("held")
    pipe = ML.rf_classifier(["a", "b", "c", "e"], 30, 12, 4)
    plain = ML.fit(pipe, train)
    _small_blocks(monkeypatch)
    fits = []
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df, f=RandomForestClassifier._fit: fits.append(df.count()) or f(self, df))
    grown = ML.fit(pipe, train)
    assert fits == [10]  # MLlib has two rows of each class
    a, b = plain.stages[-1], grown.stages[-1]
    assert (b.getNumTrees, b.numClasses, b.numFeatures, b.getMaxDepth()) == (30, 5, 4, 12) and max(t.depth for t in b.trees) <= 12
    assert b.totalNumNodes == pytest.approx(a.totalNumNodes, rel=0.1)
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray(), atol=0.1)
    exact = [ML.evaluate(ML.score(m, test)).first()["exact"] for m in (plain, grown)]
    assert exact[1] == pytest.approx(exact[0], abs=0.03)
    assert b.toDebugString.split("\n")[1:] == ML.fit(pipe, train).stages[-1].toDebugString.split("\n")[1:]


def test_a_saved_fit_has_the_same_size_as_the_loaded_model(spark, table, monkeypatch, tmp_path):
    pipe, train = ML.rf_classifier(["a", "b"], 6, 9, 1), M.balanced_weights(table, "DANGER_RATING")
    for least in (FR.LEAST_ROWS, 1):
        monkeypatch.setattr(FR, "LEAST_ROWS", least)
        size = ML.fit_to(f"{tmp_path}/{least}", pipe, train)
        assert size == ML.model_size(PipelineModel.load(f"{tmp_path}/{least}")) and size["trees"] == 6


def test_regression_forest_is_grown(spark, table, monkeypatch):
    pipe, test = ML.rf_regressor(["a", "b", "c"], 20), table.filter("held").withColumn("y", F.col("DANGER_RATING") - 1)
    plain = ML.fit(pipe, table)
    _small_blocks(monkeypatch)
    grown = ML.fit(pipe, table)
    a, b = (m.transform(test).agg(M.rmse("y", "prediction")).first()[0] for m in (plain, grown))
    assert b == pytest.approx(a, rel=0.05) and grown.stages[-1].getNumTrees == 20


def test_null_features_are_an_error_as_in_mllib(spark, table, monkeypatch):
    _small_blocks(monkeypatch)
    train = M.balanced_weights(table.withColumn("a", F.expr("CASE WHEN c < 0.5 THEN a END")), "DANGER_RATING")
    with pytest.raises(Exception, match="null or NaN"):
        ML.fit(ML.rf_classifier(["a", "b"], 3, 4, 1), train)
