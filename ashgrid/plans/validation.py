"""Temporal validation job: train on days before the cutoff, test on the
rest, report how the model disagrees with the official rating.

The feature table comes from ``training.training_features(keep_date=True)``
(note: its interpolation/backfill reads across the cutoff unless ``causal``
was chosen there).  The report is one long table:
(section, key, n, exact, within_one, qwk, bias, mean_pred, pct_high_plus) for
overall, per region band and per official class (the bias with its direction),
plus the confusion matrix as row percentages with its counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import models as ML
from ..operators import splits as SP


def fit_and_score(df: DataFrame, features: Sequence[str], label: str, date: str, cutoff: str,
                  trees: int = 100, depth: int = 30, min_leaf: int = 10, squared_weights: bool = False) -> DataFrame:
    tagged = SP.temporal_split_tag(df, date, cutoff)
    SP.require_both_sides(tagged)
    train = M.balanced_weights(tagged.filter("split = 'train'"), label, squared=squared_weights)
    model = ML.fit(ML.rf_classifier(features, trees, depth, min_leaf), train)
    return ML.score(model, tagged.filter("split = 'test'"))


SUMMARY = {"exact": "double", "within_one": "double", "qwk": "double", "bias": "double", "mean_pred": "double",
           "pct_high_plus": "double", "direction": "string"}


def _section(name: str, key: Column, rows: DataFrame) -> DataFrame:
    """One section of the summary: what it does not have is null."""
    have = rows.withColumn("direction", M.bias_word(F.col("bias"))) if "bias" in rows.columns else rows
    return have.select(F.lit(name).alias("section"), key.cast("string").alias("key"), F.col("n").cast("bigint").alias("n"),
                       *[F.col(c) if c in have.columns else F.lit(None).cast(t).alias(c) for c, t in SUMMARY.items()])


def report(scored: DataFrame, label: str, pred: str = "prediction_level", lat: str = "lat", lon: str = "lon") -> dict[str, DataFrame]:
    """summary and confusion of the scored rows; both are sums over few groups.
    The parts read ``scored`` one by one: a fitted model's rows are best written
    first (``write_report`` does)."""
    s = scored.select(F.col(label).alias("y"), F.col(pred).alias("p"), F.col(lat).alias("la"), F.col(lon).alias("lo"))
    parts = [_section("overall", F.lit("all"), M.ordinal_report(s)),
             _section("region", F.col("region"), M.bias_by_region(s)),
             _section("official", F.col("official"), M.by_class_mean_pred(s))]
    return {"summary": reduce(DataFrame.unionByName, parts), "confusion": M.confusion_row_pct(s)}


def write_report(scored: DataFrame, out_dir: str, label: str, pred: str = "prediction_level", lat: str = "lat",
                 lon: str = "lon") -> dict[str, DataFrame]:
    """Score once: the four columns that the report needs are written, summary and
    confusion are made from that table and written beside it."""
    spark = scored.sparkSession
    scored.select(*{c: None for c in (label, pred, lat, lon)}).write.mode("overwrite").parquet(f"{out_dir}/scored")
    parts = report(spark.read.parquet(f"{out_dir}/scored"), label, pred, lat, lon)
    for name, part in parts.items():
        part.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return {name: spark.read.parquet(f"{out_dir}/{name}") for name in parts}
