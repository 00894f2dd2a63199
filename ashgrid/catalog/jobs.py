"""End-to-end jobs as queries: the daily scoring run and the temporal
validation report (rows checks; their operators are oracle-checked one by one)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from .. import fixtures as FX
from ..operators import geo as G
from ..operators.hotkeys import ranked
from ..operators import metrics as M
from ..operators import models as ML
from ..plans import daily
from ..session import scratch_path
from ..sources import weather as WS
from .learning import CUT, LABEL, _labelled
from .rasters import _wide
from .serving import TARGET, _daily, _hourly
from .registry import register


def _requests(spark, sf_dir) -> DataFrame:
    grid = G.build_grid(G.bbox_of(FX.points(spark, sf_dir), "la", "lo"), 0.5)
    return grid.select(
        F.col("gid").alias("loc"), (F.col("gid") / 40).cast("bigint").cast("string").alias("chunk"),
        (F.col("gid") % 40).cast("int").alias("pos"), "lat", "lon",
    ), grid


def _grid_weather(spark, sf_dir, requests):
    """Each grid point's payload carries the history of one station; all
    stations are dealt out in turn (by rank, modulo their count)."""
    daily = _daily(spark, sf_dir).withColumnRenamed("loc", "st")
    stations = ranked(daily.select("st").distinct(), "st", "rank")
    n = F.greatest(F.lit(1), daily.select("st").distinct().agg(F.count(F.lit(1))).scalar())
    st = requests.select("loc", (F.col("loc") % n).alias("rank")).join(stations, "rank").drop("rank")
    d = daily.join(st, "st").drop("st")
    h = _hourly(spark, sf_dir).withColumnRenamed("loc", "st").join(st, "st").drop("st")
    return d, h


@register("daily_scoring")
def daily_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job end to end: payloads for every grid point -> weather
    features -> grid alignment -> nearest static attach -> 37-feature
    contract -> saved forest -> CSV / GeoJSON / dated + latest."""
    root = scratch_path(spark, "daily")
    requests, grid = _requests(spark, sf_dir)
    d, h = _grid_weather(spark, sf_dir, requests)
    WS.write_payloads(requests.withColumnsRenamed({"lat": "latitude", "lon": "longitude"}), d, h, "loc", f"{root}/landing")
    static = _wide(spark, sf_dir).drop("gid")
    train = C.add_missing_zero(_labelled(spark, sf_dir), C.FEATURE_ORDER)
    model = ML.fit(ML.rf_classifier(C.FEATURE_ORDER, 100, 25, 50), M.balanced_weights(train, LABEL))
    model.write().overwrite().save(f"{root}/model")
    return daily.run(spark, f"{root}/landing", requests, grid, static, f"{root}/model", TARGET, f"{root}/out")


@register("temporal_validation")
def temporal_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temporal holdout report: exact / within-one / kappa / bias overall, by
    region and by official class, as one long table."""
    from ..plans import validation
    from .learning import ML_FEATURES, _labelled_rows

    df = _labelled_rows(spark, sf_dir).join(FX.points(spark, sf_dir).select(F.col("k").alias("st"), "la", "lo"), "st")
    scored = validation.fit_and_score(df, ML_FEATURES, LABEL, "d", CUT, trees=100, depth=25, min_leaf=50)
    return validation.write_report(scored, scratch_path(spark, "validation"), LABEL, lat="la", lon="lo")["summary"]
