"""Model bake-off and size sweep (ML-11, ML-17): many fits over one table.

The training side is prepared once: every feature is binned at the same
quantile cuts, the bin numbers and z-scores are assembled into two vectors, and
the result is written to the shared folder.  All fits read that table; trees
split bins, as they would after binning by themselves, linear models get the
z-scores.  Fits are independent jobs and run side by side from a few threads of
the driver, which only starts them; Spark shares its executors between them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import QuantileDiscretizer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.scalar import clip_round_rating
from ..operators import forest as FR
from ..operators import metrics as M
from ..operators import models as ML
from ..session import scratch_path

BINS = 64
TREES = 100  # trees of each forest but the balanced one
BALANCED_TREES = 300


@dataclass
class Prepared:
    """Both sides with ``bins`` and ``scores`` vectors, the label ``y`` (1..5), its
    index ``__y`` and balanced weights ``w``."""
    train: DataFrame
    test: DataFrame
    features: list[str]


def prepare(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = ML.LABEL, bins: int = BINS) -> Prepared:
    features = list(features)
    spark = train.sparkSession

    def once(df: DataFrame, name: str) -> DataFrame:  # both sides are read several times below
        path = scratch_path(spark, f"bakeoff-rows-{name}")
        df.select(*features, label).write.parquet(path)
        return spark.read.parquet(path)

    train, test = once(train, "train"), once(test, "test")
    cut = QuantileDiscretizer(numBuckets=bins, inputCols=features, outputCols=[f"__b_{c}" for c in features], handleInvalid="keep").fit(train)
    weights = M.balanced_weights(train, label).groupBy(label).agg(F.first("w").alias("w"))

    zs = [f"__z_{c}" for c in features]

    def wide(df: DataFrame) -> DataFrame:
        return df.withColumns({z: F.col(c).cast("double") for z, c in zip(zs, features)})

    def write(df: DataFrame, name: str) -> DataFrame:
        both = ML.standardize(cut.transform(wide(df)), zs, fit_on=wide(train))
        for names, out in (([f"__b_{c}" for c in features], "bins"), (zs, "scores")):
            both = VectorAssembler(inputCols=names, outputCol=out).transform(both)
        path = scratch_path(spark, f"bakeoff-{name}")
        (both.join(F.broadcast(weights), label, "left")  # one row per class
         .select(F.col(label).cast("int").alias("y"), (F.col(label).cast("double") - 1).alias("__y"), "w", "bins", "scores").write.parquet(path))
        return spark.read.parquet(path)

    return Prepared(ML.spread(write(train, "train")), write(test, "test"), features)


def forest(trees: int, depth: int, min_leaf: int, weighted: bool, seed: int = 42) -> RandomForestClassifier:
    rf = RandomForestClassifier(featuresCol="bins", labelCol="__y", numTrees=trees, maxDepth=min(depth, 30), minInstancesPerNode=min_leaf,
                                featureSubsetStrategy="sqrt", maxBins=BINS + 2, seed=seed, cacheNodeIds=True)
    return rf.setWeightCol("w") if weighted else rf


def models(depth: int = 30, trees: int = TREES, balanced_trees: int = BALANCED_TREES) -> dict:
    """The five models compared: two linear ones on z-scores, a regression forest,
    a classification forest and a larger one, both with balanced weights."""
    return {
        "linear": LinearRegression(featuresCol="scores", labelCol="__y", solver="normal"),
        "ridge": "ridge",
        "forest_regressor": RandomForestRegressor(featuresCol="bins", labelCol="__y", numTrees=trees, maxDepth=min(depth, 30),
                                                  featureSubsetStrategy="all", maxBins=BINS + 2, seed=42, cacheNodeIds=True),
        "forest": forest(trees, depth, 1, True),
        "balanced_forest": forest(balanced_trees, depth, 1, True),
    }


def ridge(train: DataFrame, alpha: float = 1.0) -> LinearRegression:
    return ML.ridge([], train, alpha).getStages()[-1].setFeaturesCol("scores")


def side_by_side(jobs: Sequence[Callable[[], object]], spark, threads: int = 4) -> list:
    """Results in order; a failed job raises."""
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def _fit_and_score(name: str, estimator, data: Prepared) -> tuple[str, DataFrame, float, int | None]:
    """(name, scored test rows, seconds of the fit, nodes); a forest over many rows scores the
    test side in the tasks that grow it, and its seconds are those of both."""
    spark = data.test.sparkSession
    path = scratch_path(spark, f"bakeoff-scored-{name}")
    began = time.time()
    how = FR.plan(estimator, data.train, len(data.features), BINS + 1) if isinstance(estimator, (RandomForestClassifier, RandomForestRegressor)) else None
    if how:
        weight = F.col(estimator.getWeightCol()) if estimator.isSet("weightCol") else F.lit(1.0)
        folder = FR.packed(spark, FR.pack(data.train.withColumn("__w", weight), "bins", None, how.pairs), FR.pack(data.test, "bins", None, label="y"))
        FR.score_rows(spark, folder, how).select("y", (F.col("raw") + 1).alias("raw"), "nodes").withColumn("p", clip_round_rating("raw")).write.parquet(path)
        seconds, found = time.time() - began, spark.read.parquet(path)
        nodes = found.filter("nodes IS NOT NULL").first()["nodes"]
        return name, found.filter("nodes IS NULL").select("y", "raw", "p"), seconds, nodes
    model = estimator.fit(data.train)
    seconds = time.time() - began
    scored = model.transform(data.test).select("y", (F.col("prediction") + 1).alias("raw")).withColumn("p", clip_round_rating("raw"))
    nodes = int(model.totalNumNodes) if hasattr(model, "totalNumNodes") else None
    scored.write.parquet(path)  # several measures read it, the trees are walked once
    return name, spark.read.parquet(path), seconds, nodes


def _measured(scored: DataFrame, regression: bool) -> DataFrame:
    """One row: error metrics before and after rounding, and the ordinal ones."""
    errors = scored.agg(M.mse("y", "raw").alias("mse"), M.rmse("y", "raw").alias("rmse"), M.mae("y", "raw").alias("mae"),
                        M.rmse("y", "p").alias("rounded_rmse"), M.mae("y", "p").alias("rounded_mae"))
    if not regression:  # a class has no distance of its own
        errors = errors.withColumns({c: F.lit(None).cast("double") for c in errors.columns})
    return M.ordinal_report(scored.select("y", "p")).crossJoin(F.broadcast(errors))  # one row each


def bakeoff(data: Prepared, compared: dict | None = None, threads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(metrics, by_class): one row per model, and its accuracy by official class.
    A majority guess comes first, as the score to beat."""
    spark = data.train.sparkSession
    compared = dict(models() if compared is None else compared)
    if "ridge" in compared:
        compared["ridge"] = ridge(data.train)
    guess = M.majority_class(data.train, "y").select("majority").scalar()
    found = [("majority", data.test.select("y", guess.cast("double").alias("raw"), guess.cast("int").alias("p")), 0.0, None)]
    found += side_by_side([lambda n=n, e=e: _fit_and_score(n, e, data) for n, e in compared.items()], spark, threads)
    table = by_class = None
    for name, scored, seconds, nodes in found:
        row = _measured(scored, name in ("linear", "ridge", "forest_regressor")).select(
            F.lit(name).alias("model"), "*", F.lit(seconds).alias("seconds"), F.lit(nodes).cast("long").alias("total_nodes"))
        each = M.per_class_accuracy(scored, data.test.select("y")).select(F.lit(name).alias("model"), "cls", "accuracy")
        table = row if table is None else table.unionByName(row)
        by_class = each if by_class is None else by_class.unionByName(each)
    return table, by_class


def sweep(data: Prepared, trees: Sequence[int] = (50, 100), depths: Sequence[int] = (10, 25), leaves: Sequence[int] = (1, 50),
          threads: int = 4) -> DataFrame:
    """One row per (trees, max_depth, min_leaf): nodes, accuracy, kappa."""
    grid = [(t, d, leaf) for t in trees for d in depths for leaf in leaves]
    fitted = side_by_side([lambda g=g: _fit_and_score("forest", forest(*g, True), data) for g in grid], data.train.sparkSession, threads)
    out = None
    for (t, d, leaf), (_, scored, _, nodes) in zip(grid, fitted):
        row = M.ordinal_report(scored.select("y", "p")).select(
            F.lit(t).alias("trees"), F.lit(d).alias("max_depth"), F.lit(leaf).alias("min_leaf"), F.lit(nodes).cast("long").alias("total_nodes"),
            "exact", "within_one", "qwk")
        out = row if out is None else out.unionByName(row)
    return out
