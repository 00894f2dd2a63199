"""Training feature job: station-day table -> model-ready feature table.

Plan shape: one hash exchange on the station key; every window of the job
(interpolation, fills, rolling 7/14/30/60) shares that exchange and one sort.
The filters on key and date sit above the scan (pushed to parquet), and below
the windows, where they must stay: moving the date filter above the windows
would change the rolling results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import scalar as S
from ..operators import filters as FL
from ..operators import timeseries as TS


def clean(df: DataFrame, key: str = "station_code", d: str = "date") -> DataFrame:
    """FLT-1 + FLT-2."""
    return FL.date_range_and_exclude(FL.exclude_keys(df, key), d)


def derive(
    df: DataFrame,
    key: str = "station_code",
    order: tuple[str, ...] = ("date",),
    d: str = "date",
    interpolate_cols: tuple[str, ...] = ("EVI", "NDVI"),
    winds: dict[str, tuple[str, str]] | None = None,
    rolling: dict[str, tuple[str, int, str]] | None = None,
    drought: bool = False,
    humidity: bool = False,
    causal: bool = False,
    block_rows: int | str | None = None,
) -> DataFrame:
    """WIN-4..6, FN-1, FN-2, WIN-1..3, FN-4..6 in one window pass.

    Station-days are bounded by the calendar per station, so the plain
    one-partition-per-station windows are the default; ``block_rows`` (or
    a number of rows) runs them block-parallel for keys with very many rows."""
    if winds is None:
        winds = {
            "average_wind_speed": ("mean_wind_east", "mean_wind_north"),
            "max_wind_speed": ("max_wind_east", "max_wind_north"),
        }
    if rolling is None:
        rolling = dict(TS.TRAINING_ROLLING)
        if drought:
            rolling.update(TS.DROUGHT_ROLLING)
    out = TS.interpolate(df, key, list(order), [c for c in interpolate_cols if c in df.columns], causal=causal,
                         block_rows=block_rows)
    out = out.withColumns({name: S.wind_magnitude(e, n) for name, (e, n) in winds.items()})
    out = out.drop(*{c for pair in winds.values() for c in pair})
    out = out.withColumns({"sin_doy": S.season_sin(d), "cos_doy": S.season_cos(d)})
    out = TS.add_rolling(out, key, list(order), rolling, block_rows=block_rows)
    if humidity:
        out = out.withColumns(
            {
                "vpd": S.vpd("max_temp", "mean_dewpoint"),
                "relative_humidity": S.relative_humidity("max_temp", "mean_dewpoint"),
                "temp_dewpoint_spread": S.dewpoint_spread("max_temp", "mean_dewpoint"),
            }
        )
    return out


def training_features(
    raw: DataFrame,
    label: str = "DANGER_RATING",
    drought: bool = False,
    humidity: bool = False,
    causal: bool = False,
    keep_date: bool = False,
) -> DataFrame:
    """Full training preprocessing on the raw station-day schema.

    Returns the contract features (37, or the chosen groups) plus ``label`` as
    int (and ``date`` when ``keep_date``, for temporal splits).
    """
    df = C.rename_alias(raw, "elevation", "ELEVATION_M")
    C.require_columns(df, C.REQUIRED_RAW, "station-day table")
    df = df.withColumn("date", F.col("date").cast("date"))
    df = clean(df)
    df = derive(df, drought=drought, humidity=humidity, causal=causal)
    kept_date = df.withColumn("__date", F.col("date")) if keep_date else df
    df = kept_date.drop("date", "station_name", "station_code")
    df = FL.dropna_all(df)
    cols = C.feature_groups(drought, humidity) if (drought or humidity) else C.FEATURE_ORDER
    C.require_columns(df, cols, "derived features")
    out = df.select(*cols, F.col(label).cast("int").alias(label), *(["__date"] if keep_date else []))
    return out.withColumnRenamed("__date", "date") if keep_date else out
