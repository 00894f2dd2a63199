"""Outputs of the daily job (SNK-1..7, SNK-9) and map lookups (WIN-7, JOIN-7,
FN-9..11, FN-19).

Writers are plain DataFrame writers: partitioned by date, dynamic partition
overwrite for idempotent re-runs, and newline-delimited GeoJSON features as
the scalable form (one feature per line, written by every task in parallel).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import geo as G


# SNK-1
def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


# SNK-2
def append_checkpoint(df: DataFrame, path: str, chunk: int | str, keys: Sequence[str] = ("target_date", "step")) -> None:
    """Append a finished chunk under its (target_date, step) key and its own
    chunk id: many chunks share a key, and a replayed chunk replaces only
    itself (dynamic partition overwrite)."""
    (df.withColumn("chunk", F.lit(str(chunk))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys, "chunk").parquet(path))


# SNK-3
def per_layer_sink(df: DataFrame, path: str, layer: str = "layer") -> None:
    df.write.mode("overwrite").partitionBy(layer).parquet(path)


# SNK-5
def geojson_features(pred: DataFrame, lat: str = "lat", lon: str = "lon", risk: str = "prediction",
                     why: bool = True) -> DataFrame:
    """One GeoJSON Feature (JSON text) per cell: Point [lon, lat], risk, label
    and the optional 'why' values; absent values are omitted from the JSON."""
    props = [F.col(risk).cast("int").alias("risk"), S.risk_label(risk).alias("label")]
    if why and {"precip_14day_sum", "max_temp", "max_wind_speed"} <= set(pred.columns):
        ex = S.explain_values("precip_14day_sum", "max_temp", "max_wind_speed")
        props += [ex[k].alias(k) for k in ("rain14_mm", "maxtemp_c", "wind_ms")]
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates")).alias("geometry"),
        F.struct(*props).alias("properties"),
    )
    keep = [c for c in ("date",) if c in pred.columns]
    return pred.select(*keep, F.to_json(feat).alias("feature"))


def geojson_document(features: DataFrame, date: str = "date") -> DataFrame:
    """One FeatureCollection document per date (for a single grid-day map).
    A grid-day has a bounded number of cells, so the per-date collect is
    bounded by the grid size."""
    return features.groupBy(date).agg(
        F.concat(
            F.lit('{"type":"FeatureCollection","date":"'), F.col(date).cast("string"), F.lit('","features":['),
            F.array_join(F.collect_list("feature"), ","), F.lit("]}"),
        ).alias("document")
    )


def write_geojson_lines(features: DataFrame, path: str, date: str = "date") -> None:
    features.select(date, "feature").write.mode("overwrite").partitionBy(date).text(path)


# SNK-6
def publish_latest(df: DataFrame, path: str) -> int:
    """A new version of the latest output: its rows are written to a folder of
    their own, then a manifest row that names it is appended.  Readers follow
    the manifest, so they see the old version until the new one is whole, and a
    run that dies in between changes nothing.  One writer at a time; earlier
    versions stay until the caller removes them.  Returns the version."""
    spark = df.sparkSession
    version = (_version(spark, path) or 0) + 1
    folder = f"{path}/versions/{version}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(folder)
    spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder")).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema("version long, folder string").parquet(f"{path}/manifest")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _version(spark: SparkSession, path: str) -> int | None:
    seen = _manifest(spark, path)
    return None if seen is None else seen.agg(F.max("version")).head()[0]


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The version that the manifest names last."""
    seen = _manifest(spark, path)
    row = None if seen is None else seen.orderBy(F.col("version").desc(), "folder").head()
    if row is None:
        raise FileNotFoundError(f"nothing has been published under {path}")
    return spark.read.parquet(row["folder"])


def write_dated_and_latest(df: DataFrame, dated_path: str, latest_path: str, date: str = "date",
                           newest_overall: bool = False) -> None:
    """Dated copy (dynamic partition overwrite), then the newest day of this
    run's rows becomes the ``latest`` version, also on a re-run of an older
    day; ``newest_overall`` takes the newest dated day instead."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date).parquet(dated_path))
    spark = df.sparkSession
    dated = spark.read.parquet(dated_path)
    newest = (dated if newest_overall else df).select(F.max(date)).scalar()
    publish_latest(dated.filter(F.col(date) == newest), latest_path)


# SNK-7 / ORD-6
def matrix(pred: DataFrame, lons: Sequence[float], lat: str = "lat", lon: str = "lon", value: str = "prediction") -> DataFrame:
    """lat (descending) x lon (ascending) matrix; holes are null.  ``lons`` is
    the explicit, sorted column list (the grid's longitudes), so the pivot
    needs no extra pass to discover it."""
    lons = sorted(lons)
    wide = pred.groupBy(lat).pivot(lon, list(lons)).agg(F.first(value))
    return wide.orderBy(F.col(lat).desc())


def matrix_rows(pred: DataFrame, lat: str = "lat", lon: str = "lon", value: str = "prediction") -> DataFrame:
    """The matrix with its cells as one array per latitude row, in order of
    longitude, holes null: every latitude meets the one sorted list of
    longitudes, so neither the driver nor a pivot has to know them."""
    lons = pred.select(F.sort_array(F.collect_set(lon))).scalar()
    places = pred.select(lat).distinct().select(lat, F.explode(lons).alias(lon))
    cells = places.join(pred.groupBy(lat, lon).agg(F.first(value).alias("__v")), [lat, lon], "left")
    rows = cells.groupBy(lat).agg(F.sort_array(F.collect_list(F.struct(lon, "__v"))).alias("__row"))
    return rows.select(lat, F.transform("__row", lambda x: x["__v"]).alias("cells"))


# WIN-7
def trend(places: DataFrame, pred: DataFrame, anchor: Column, days: int = 6, key: str = "name",
          lat: str = "la", lon: str = "lo", p_lat: str = "la", p_lon: str = "lo", d: str = "d",
          risk: str = "risk", max_deg: float | None = None) -> DataFrame:
    """Per place: the risk of its nearest cell (planar; no cutoff, a place is
    accepted or not before its trend is asked for) on each of the ``days`` calendar days ending at the anchor (missing days skipped);
    at least two days give a direction from the first to the last risk."""
    window = pred.filter(F.col(d).between(F.date_sub(anchor, days - 1), anchor))
    q = places.select(key, lat, lon, F.explode(F.sequence(F.date_sub(anchor, days - 1), anchor)).alias(d))
    feats = window.select(d, p_lat, p_lon, risk, F.struct(F.col(p_lat), F.col(p_lon)).alias("__pos"))
    nn = G.nearest_planar(q, feats, key, "__pos", lat, lon, p_lat, p_lon, payload=[risk], max_deg=max_deg, group=[d])
    per = nn.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min_by(risk, d).alias("first_risk"),
        F.max_by(risk, d).alias("last_risk"),
    ).filter(F.col("n_days") >= 2)
    delta = F.col("last_risk") - F.col("first_risk")
    return per.withColumn("direction", F.when(delta > 0, "rising").when(delta < 0, "falling").otherwise("steady"))


# FN-19
def popup_fields(df: DataFrame, risk: str = "risk") -> DataFrame:
    r = S.popup_risk(risk)
    label = S.risk_label(r)
    out = df.withColumns({"popup_risk": r, "popup_label": label,
                          "popup_text": F.format_string("%s (%d/5)", label, r)})
    if {"la", "lo"} <= set(df.columns):
        out = out.withColumn("popup_coords", F.format_string("%.2f, %.2f", "la", "lo"))
    if "rain14_mm" in df.columns:
        out = out.withColumn("has_why", F.col("rain14_mm").isNotNull())
    return out
