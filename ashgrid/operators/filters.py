"""Row filters (FLT-*).  Plain predicates, so Catalyst pushes the ones on
scanned columns into the parquet reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.scalar import inf_to_null


# FLT-1
def exclude_keys(df: DataFrame, key: str, excluded: Sequence[str] = C.EXCLUDED_STATIONS) -> DataFrame:
    """Drop the listed keys (compared as strings); a null key is dropped too,
    because it would otherwise form a window group of its own."""
    k = F.col(key)
    if df.schema[key].dataType.typeName() in ("long", "integer", "short", "byte"):
        # an integer's text is canonical, so the string test equals a numeric
        # one, which the parquet reader can push down
        nums = [int(x) for x in excluded if x.lstrip("-").isdigit() and str(int(x)) == x]
        return df.filter(k.isNotNull() & ~k.isin(nums))
    return df.filter(k.isNotNull() & ~k.cast("string").isin(list(excluded)))


# FLT-2
def date_range_and_exclude(
    df: DataFrame,
    d: str,
    start: str = C.TRAIN_START,
    end: str = C.TRAIN_END,
    excluded_day: str | None = C.EXCLUDED_DAY,
) -> DataFrame:
    c = F.col(d)
    cond = c.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if excluded_day:
        cond = cond & (c != F.lit(excluded_day).cast("date"))
    return df.filter(cond)


# FLT-3
def upto_date(df: DataFrame, d: str, upto: str | None) -> DataFrame:
    return df if upto is None else df.filter(F.col(d) <= F.lit(upto).cast("date"))


# FLT-4
def latest_or_pinned(df: DataFrame, d: str, pinned: str | None = None, per: Sequence[str] = ()) -> DataFrame:
    """Rows of the pinned date (possibly none); else rows of the newest
    non-null date (per group when ``per`` is given); all rows when the frame has
    no date column or only null dates."""
    if d not in df.columns:
        return df
    if pinned is not None:
        return df.filter(F.col(d) == F.lit(pinned).cast(df.schema[d].dataType))
    if per:
        # one row per group (e.g. per layer), joined back null-safe: a null group
        # is a group too.  A window would put a whole layer into one task.
        newest = df.groupBy(*per).agg(F.max(d).alias("__newest")).withColumnsRenamed({k: f"__g_{k}" for k in per})
        same = F.lit(True)
        for k in per:
            same = same & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
        j = df.join(newest, same)
        return j.filter(F.col("__newest").isNull() | (F.col(d) == F.col("__newest"))).select(*df.columns)
    newest = df.select(F.max(d)).scalar()  # scalar subquery, evaluated once
    return df.filter(newest.isNull() | (F.col(d) == newest))


# FLT-5
def temporal_split(df: DataFrame, d: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    c = F.lit(cutoff).cast("date")
    return df.filter(F.col(d) < c), df.filter(F.col(d) >= c)


# FLT-6
def dropna_all(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


# FLT-7
def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(cols))


# FLT-8
def inf_nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: inf_to_null(c) for c in cols})


# FLT-10
def level_filter(df: DataFrame, levels: Sequence[int], risk: str = "risk") -> DataFrame:
    return df.filter(F.col(risk).isin(list(levels)))

