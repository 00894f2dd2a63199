"""Daily scoring job: landed weather payloads + static cache + model -> risk
per grid point, published as CSV, GeoJSON lines and dated/latest tables.

Payloads are parsed where they are read and judged per request chunk; the
weather features of finished chunks are committed, so that a run that stopped
goes on with the others.  Grid alignment and the static attach are joins on the
grid key, the model is applied row by row by ``PipelineModel.transform``; only
commits and sinks trigger jobs.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import scalar as S
from ..operators import cache as CA
from ..operators import geo as G
from ..operators import models as ML
from ..operators import weather as W
from ..sinks import publish as P
from ..sources import weather as WS
from ..streaming import ledger as LG


def weather_for_grid(spark: SparkSession, payload_path: str, requests: DataFrame, target_date: str, store: str,
                     commits: int = 1, whole_file: bool = False, stop_after: int | None = None) -> DataFrame:
    """requests: loc, chunk, pos, lat, lon (the grid points as requested).
    Returns one row per requested location with the weather features, keyed
    by the *requested* coordinates (JOIN-5) rounded to 4 dp (GEO-12).

    Chunks that the target date has finished under ``store`` are not computed
    again (INC-1); refused documents go to its rejects.  Raises when a chunk is
    still open afterwards: what is finished is kept for the next run."""
    raw = spark.read.text(payload_path, wholetext=whole_file).select("value", F.col("_metadata.file_path").alias("source_file"))
    chunks = requests.select("loc", "chunk")
    target = F.lit(target_date).cast("date")

    def compute(answers: DataFrame) -> DataFrame:
        feats = W.location_features(WS.daily_rows(answers, ["loc"]), WS.hourly_rows(answers, ["loc"]), target)
        return feats.join(chunks, "loc")

    rows = LG.run_chunks(spark, raw, requests.select("chunk", "pos", "loc"), compute, store, target_date, commits, stop_after)
    left = LG.missing(spark, requests, store, target_date).orderBy("chunk").limit(5).collect()
    if left or rows is None:
        raise RuntimeError(f"chunks without a usable answer for {target_date}: "
                           + ", ".join(f"{r['chunk']} ({r['reason'] or 'no document'})" for r in left)
                           + f"; finished ones are kept under {store}")
    return rows.drop("chunk").join(requests.select("loc", S.round4("lat").alias("lat"), S.round4("lon").alias("lon")), "loc")


def assemble(grid: DataFrame, weather: DataFrame, static: DataFrame, target_date: str,
             key: str = "gid", elevations: DataFrame | None = None) -> DataFrame:
    """JOIN-1 + GEO-5 + JOIN-2 + FN-2 + PRJ-6/7/9/11: the 37-feature frame per
    grid point, in contract order, nulls -> 0.0 (lat, lon and key kept).
    ``elevations`` (lat, lon, elevation) fills grid points that the static
    table has no elevation for, as does a static table without that column."""
    g = grid.select(key, S.round4("lat").alias("lat"), S.round4("lon").alias("lon"))
    w = W.dedupe_keep_last(weather, ["lat", "lon"], "loc").drop("loc", "resolved_day")
    aligned = g.join(w, ["lat", "lon"], "left")
    sat = [c for c in C.SATELLITE_FEATURES if c in static.columns]
    st = static.select(F.struct("lat", "lon").alias("__sid"), "lat", "lon", *sat)
    nn = G.nearest_join(g, st, key, "__sid", payload=sat).drop("nn_key", "dist_km")
    t = F.lit(target_date).cast("date")
    full = aligned.join(nn, key, "left").withColumns({"sin_doy": S.season_sin(t), "cos_doy": S.season_cos(t)})
    if elevations is not None:
        supplied = elevations.groupBy(S.round4("lat").alias("lat"), S.round4("lon").alias("lon")).agg(F.min("elevation").alias("elevation"))
        full = CA.default_elevation(full, supplied)
    full = C.add_missing_zero(full, C.FEATURE_ORDER)
    return C.select_contract(full, C.FEATURE_ORDER, keep=[key]).na.fill(0.0)


def score_grid(features: DataFrame, model_path: str, key: str = "gid") -> DataFrame:
    """ML-13 with the PRJ-8 contract check against the saved model."""
    model = PipelineModel.load(model_path)
    ML.assert_model_contract(model, C.FEATURE_ORDER)
    return ML.score(model, features).select(key, "lat", "lon", F.col("prediction_level").alias("prediction"),
                                            "precip_14day_sum", "max_temp", "max_wind_speed")


def publish(pred: DataFrame, out_dir: str, target_date: str, document: bool = False) -> None:
    """The scored grid is written once (a table that also cuts the lineage);
    SNK-1 CSV, SNK-5 GeoJSON (one feature per line, and the day's single
    FeatureCollection) and SNK-6 dated + latest are derived from that table,
    so the upstream plan runs once."""
    spark = pred.sparkSession
    base = f"{out_dir}/scored/date={target_date}"
    pred.write.mode("overwrite").parquet(base)
    dated = spark.read.parquet(base).withColumn("date", F.lit(target_date).cast("date"))
    P.write_csv(dated.select("date", "lat", "lon", "prediction"), f"{out_dir}/csv/date={target_date}")
    feats = P.geojson_features(dated)
    P.write_geojson_lines(feats, f"{out_dir}/geojson")
    if document:  # the day's FeatureCollection as one text: for grids whose map fits in memory
        P.geojson_document(feats).select("document").write.mode("overwrite").text(f"{out_dir}/geojson_doc/date={target_date}")
    P.write_dated_and_latest(dated.select("date", "lat", "lon", "prediction"), f"{out_dir}/dated", f"{out_dir}/latest")


def run(spark: SparkSession, payload_path: str, requests: DataFrame, grid: DataFrame, static: DataFrame,
        model_path: str | None, target_date: str, out_dir: str, document: bool = False,
        elevations: DataFrame | None = None, commits: int = 1) -> DataFrame:
    """The whole day, resumable by request chunk.  Without a model the feature
    frame is written instead (SNK-9)."""
    weather = weather_for_grid(spark, payload_path, requests, target_date, f"{out_dir}/weather", commits)
    feats = assemble(grid, weather, static, target_date, elevations=elevations)
    if model_path is None:
        feats.write.mode("overwrite").parquet(f"{out_dir}/features/date={target_date}")
        return spark.read.parquet(f"{out_dir}/features/date={target_date}")
    pred = score_grid(feats, model_path)
    publish(pred, out_dir, target_date, document)
    return spark.read.parquet(f"{out_dir}/dated").filter(F.col("date") == F.lit(target_date).cast("date"))
