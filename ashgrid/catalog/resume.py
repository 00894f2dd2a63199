"""Incremental resume queries (INC-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import weather as W
from ..session import scratch_path
from ..sinks import publish as P
from ..sources import weather as WS
from ..streaming import incremental as INC
from ..streaming import ledger as LG
from .registry import ORACLE_SQL, register
from .serving import TARGET, _daily, _hourly, _locs

_FEATURES = ["max_temp", "precipitation_sum", "mean_low_cloud_cover", "precip_7day_sum", "temp_14day_mean"]


def _features_sql() -> str:
    base = ORACLE_SQL["weather_feature_map"]
    return f"SELECT loc, resolved_day, {', '.join(_FEATURES)} FROM ({base}) t"


def _compute_for(spark, sf_dir):
    daily, hourly = _daily(spark, sf_dir), _hourly(spark, sf_dir)

    def compute(todo: DataFrame) -> DataFrame:
        d = daily.join(todo.select("loc"), "loc", "left_semi")
        h = hourly.join(todo.select("loc"), "loc", "left_semi")
        f = W.location_features(d, h, F.lit(TARGET).cast("date"))
        return f.select("loc", "resolved_day", *[S.round8(c).alias(c) for c in _FEATURES])

    return compute


def resume_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-1: a first run is interrupted after half of the locations; the
    rerun computes only the rest; the result equals a one-shot run."""
    ckpt = scratch_path(spark, "resume")
    grid = _locs(spark, sf_dir).select("loc")
    compute = _compute_for(spark, sf_dir)
    first = grid.filter(F.col("loc") < 75)
    INC.resume_batch(spark, first, compute, ckpt, ["loc"], TARGET, run_seq=1)  # the "interrupted" run
    out = INC.resume_batch(spark, grid, compute, ckpt, ["loc"], TARGET, run_seq=2)
    return out.select("loc", "resolved_day", *_FEATURES)


def _land(spark, sf_dir, landing: str, which) -> None:
    locs = _locs(spark, sf_dir)
    part = locs.filter(which)
    WS.write_payloads(part, _daily(spark, sf_dir), _hourly(spark, sf_dir), "loc", landing)


def _requests(spark, sf_dir) -> DataFrame:
    return _locs(spark, sf_dir).select("chunk", "pos", "loc")


def _answers_to_rows(spark, sf_dir):
    chunks = _requests(spark, sf_dir).select("loc", "chunk")

    def compute(answers: DataFrame) -> DataFrame:
        d, h = WS.daily_rows(answers, ["loc"]), WS.hourly_rows(answers, ["loc"])
        f = W.location_features(d, h, F.lit(TARGET).cast("date"))
        return f.select("loc", "resolved_day", *[S.round8(c).alias(c) for c in _FEATURES]).join(chunks, "loc")

    return compute


def resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-2: payload files land in two deliveries, each processed once.  The
    first holds chunk 0 without one of its locations, which is refused; the
    second holds it whole and chunk 1 again."""
    root = scratch_path(spark, "stream")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    requests, compute = _requests(spark, sf_dir), _answers_to_rows(spark, sf_dir)
    _land(spark, sf_dir, f"{landing}/d1", (F.col("loc") < 80) & (F.col("loc") != 7))
    LG.stream_chunks(spark, f"{landing}/*", requests, compute, out, ck)
    _land(spark, sf_dir, f"{landing}/d2", F.lit(True))
    LG.stream_chunks(spark, f"{landing}/*", requests, compute, out, ck)
    return LG.stream_rows(spark, out).select("loc", "resolved_day", *_FEATURES)


def latest_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INC-3: inside the stream, the newest resolved day becomes ``latest``."""
    root = scratch_path(spark, "stream-latest")
    landing, out, ck = f"{root}/landing", f"{root}/out", f"{root}/checkpoint"
    _land(spark, sf_dir, f"{landing}/d1", F.lit(True))
    LG.stream_chunks(spark, f"{landing}/*", _requests(spark, sf_dir), _answers_to_rows(spark, sf_dir), out, ck,
                     publish=lambda rows: P.write_dated_and_latest(rows, f"{root}/dated", f"{root}/latest", "resolved_day", True))
    return P.read_latest(spark, f"{root}/latest").select("loc", "resolved_day", *_FEATURES)


def register_all() -> None:
    sql = _features_sql()
    register("resume_batch", sql)(resume_batch)
    register("resume_stream", sql)(resume_stream)
    register("latest_pointer", sql + " WHERE resolved_day = (SELECT max(resolved_day) FROM ("
             + ORACLE_SQL["weather_feature_map"] + ") u)")(latest_pointer)
