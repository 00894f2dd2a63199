"""Model fitting, scoring and comparison with Spark MLlib (ML-*).

Training data stays distributed: VectorAssembler and the tree/linear learners
run as Spark jobs; metrics are the one-pass aggregates of ``metrics``.  The
only values brought to the driver are model metadata (importances, node
counts), whose size is the number of features.  Forests keep the node of every
row and tree (``cacheNodeIds``): a level costs one look instead of a walk from
the root, and the trees are the same.  Forests over many rows are grown by
``forest``, a tree in a task, and read back as MLlib models.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.scalar import clip_round_rating
from ..session import scratch_path
from . import forest as FR
from . import metrics as M

LABEL = "DANGER_RATING"


# ML-1
def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _label(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("__y", (F.col(label).cast("double") - 1.0))


# ML-4 / ML-5
def rf_classifier(features: Sequence[str], trees: int = 100, depth: int = 25, min_leaf: int = 50,
                  weight: str | None = "w", seed: int = 42, max_bins: int = 64) -> Pipeline:
    """Class-balanced random forest on the ordinal label (label - 1 as index).
    MLlib caps depth at 30 and bins features (``max_bins``)."""
    rf = RandomForestClassifier(
        featuresCol="features", labelCol="__y", numTrees=trees, maxDepth=min(depth, 30),
        minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", maxBins=max_bins, seed=seed, cacheNodeIds=True,
        **({"weightCol": weight} if weight else {}),
    )
    return Pipeline(stages=[assembler(features), rf])


# ML-6
def rf_regressor(features: Sequence[str], trees: int = 100, seed: int = 42) -> Pipeline:
    rf = RandomForestRegressor(featuresCol="features", labelCol="__y", numTrees=trees, seed=seed, cacheNodeIds=True)
    return Pipeline(stages=[assembler(features), rf])


# ML-9
def standardize(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """z-scores with the population standard deviation: one global aggregate
    (a single row of moments, of ``fit_on`` if given: the training side) whose
    values enter the plan as literals."""
    mom = (df if fit_on is None else fit_on).agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
    exprs = {}
    for c in features:
        m, s = mom[f"m_{c}"], mom[f"s_{c}"]
        exprs[c] = F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(exprs)


# ML-7
def linear_regression(features: Sequence[str]) -> Pipeline:
    lr = LinearRegression(featuresCol="features", labelCol="__y", regParam=0.0, solver="normal")
    return Pipeline(stages=[assembler(features), lr])


# ML-8
def ridge(features: Sequence[str], train: DataFrame, alpha: float = 1.0) -> Pipeline:
    """Ridge with sum-of-squares loss + alpha * ||w||^2 on standardized
    features: Spark's objective is scaled by 1/(2n) and by the label's
    standard deviation, so regParam = alpha * std_pop(y) / n."""
    st = train.agg(F.stddev_pop("__y").alias("s"), F.count(F.lit(1)).alias("n")).first()
    reg = alpha * (st["s"] or 1.0) / max(st["n"], 1)
    lr = LinearRegression(featuresCol="features", labelCol="__y", regParam=reg, elasticNetParam=0.0,
                          standardization=False, solver="normal")
    return Pipeline(stages=[assembler(features), lr])


#: a training part has at least so many rows where cores are idle, and at most so many
LEAST_ROWS, MOST_ROWS = 1 << 14, 1 << 19


def spread(train: DataFrame) -> DataFrame:
    """Training rows in parts enough for the cores and none too large, where they lie
    in fewer (a table of a few files would train on a few cores)."""
    r = train.groupBy(F.spark_partition_id().alias("part")).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("part").alias("parts")).first()
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, math.ceil(r["n"] / LEAST_ROWS)), math.ceil(r["n"] / MOST_ROWS))
    return train.repartition(parts) if parts > r["parts"] else train


def _forest_rows(pipe: Pipeline, df: DataFrame) -> DataFrame:
    """A forest reads its rows several times (classes, counts, split points, bags), so
    their plan runs once and writes them to the shared folder."""
    learner = pipe.getStages()[-1]
    used = [*pipe.getStages()[0].getInputCols(), "__y", *([learner.getWeightCol()] if learner.isSet("weightCol") else [])]
    path = scratch_path(df.sparkSession, "forest-rows")
    df.select(*dict.fromkeys(used)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _grown(pipe: Pipeline, rows: DataFrame, path: str) -> bool:
    """Write the pipeline with its forest to ``path``, in MLlib's format, where ``forest``
    can grow it.  MLlib fits and saves the same pipeline on two rows of each label and
    weight; the nodes of that forest are replaced."""
    spark, (asm, learner) = rows.sparkSession, pipe.getStages()
    columns = asm.getInputCols()
    how = FR.plan(learner, rows, len(columns), learner.getMaxBins())
    if how is None:
        return False
    rows = rows.withColumn("__w", F.col(learner.getWeightCol()).cast("double") if learner.isSet("weightCol") else F.lit(1.0))
    cuts = FR.thresholds(rows, columns, how.bins)
    folder = FR.packed(spark, FR.pack(rows, columns, cuts, how.pairs))
    few = spark.createDataFrame([(y, w, float(i)) for y, w in how.pairs for i in (0, 1)], "__y double, w double, x double")
    few = few.select("__y", *([F.col("w").alias(learner.getWeightCol())] if learner.isSet("weightCol") else []), *[F.col("x").alias(c) for c in columns])
    shell = pipe.fit(few)
    shell.write().overwrite().save(path)
    FR.node_rows(spark, folder, how, cuts).write.mode("overwrite").parquet(f"{path}/stages/1_{shell.stages[-1].uid}/data")
    return True


def fit(pipe: Pipeline, train: DataFrame, label: str = LABEL) -> PipelineModel:
    df = _label(train, label)
    if not isinstance(pipe.getStages()[-1], (RandomForestClassifier, RandomForestRegressor)):
        return pipe.fit(df)
    rows, path = _forest_rows(pipe, df), scratch_path(df.sparkSession, "forest")
    return PipelineModel.load(path) if _grown(pipe, rows, path) else pipe.fit(spread(rows))


def fit_to(path: str, pipe: Pipeline, train: DataFrame, label: str = LABEL) -> dict[str, int]:
    """Fit a forest and save it; its size (``model_size``).  A large forest goes from the
    tasks to the folder and is not loaded here."""
    rows = _forest_rows(pipe, _label(train, label))
    if _grown(pipe, rows, path):
        nodes = rows.sparkSession.read.parquet(f"{path}/stages/*/data").count()
        return {"trees": pipe.getStages()[-1].getNumTrees(), "total_nodes": nodes}
    model = pipe.fit(spread(rows))
    model.write().overwrite().save(path)
    return model_size(model)


# ML-13
def score(model: PipelineModel, df: DataFrame, out: str = "prediction_level") -> DataFrame:
    """Predict, back to 1..5, half-even round and clip (classifiers return the
    class index, regressors a real value; both go through the same rule)."""
    return model.transform(df).withColumn(out, clip_round_rating(F.col("prediction") + 1.0)).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def evaluate(scored: DataFrame, label: str = LABEL, pred: str = "prediction_level", group: Sequence[str] = ()) -> DataFrame:
    return M.ordinal_report(scored, label, pred, group)


# ML-14 / WIN-8
def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """Importances of the fitted forest as a (feature, importance, rank) table."""
    asm, rf = model.stages[0], model.stages[-1]
    vals = rf.featureImportances.toArray().tolist()
    rows = list(zip(asm.getInputCols(), [float(v) for v in vals]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    from .timeseries import importance_rank

    return importance_rank(df)


# ML-15
def model_size(model: PipelineModel) -> dict[str, int]:
    rf = model.stages[-1]
    return {"trees": len(rf.trees), "total_nodes": int(rf.totalNumNodes)}


# PRJ-8
def assert_model_contract(model: PipelineModel, expected: Sequence[str]) -> None:
    C.assert_contract(model.stages[0].getInputCols(), list(expected))


def vector_size(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn("n_features", F.size(vector_to_array(col)))
