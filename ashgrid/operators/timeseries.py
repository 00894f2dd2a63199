"""Per-key time-series operators (WIN-*, AGG-6).

All operators take a key (e.g. station) and a total order (e.g. date, then a
tie-break id) and run as Spark window functions.  Every window in this module
uses the same ``partitionBy(key).orderBy(order)`` spec, so Catalyst puts them
in one hash exchange on the key and one sort; extra frames add no shuffle.

Scale note: the partition of a window is one key's history.  After the
station-day aggregation the key has at most one row per day (a few thousand
rows per station per decade), so no single window partition can grow with the
table; the exchange itself spreads keys over ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Keys = str | Sequence[str]


def _list(x: Keys) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def spec(key: Keys, order: Keys) -> WindowSpec:
    return Window.partitionBy(*_list(key)).orderBy(*_list(order))


# WIN-1 / WIN-3
def rolling_sum(c: str, n: int, w: WindowSpec) -> Column:
    """Sum over the last ``n`` rows (not days); nulls skipped; null if none."""
    return F.sum(c).over(w.rowsBetween(-(n - 1), 0))


# WIN-2
def rolling_mean(c: str, n: int, w: WindowSpec) -> Column:
    return F.avg(c).over(w.rowsBetween(-(n - 1), 0))


def add_rolling(df: DataFrame, key: Keys, order: Keys, specs: dict[str, tuple[str, int, str]],
                block_rows: int | None = None) -> DataFrame:
    """Add many row-window aggregates in one window pass.

    ``specs`` maps output name -> (input column, n rows, "sum" | "mean").
    With ``block_rows`` every key is cut into blocks of so many rows, which
    run in parallel (``hotkeys.rolling_blocked``); it needs a single key column.
    """
    if block_rows is not None:
        from .hotkeys import rolling_blocked

        return rolling_blocked(df, _list(key)[0], _list(order), specs, block_rows)
    w = spec(key, order)
    fns = {"sum": rolling_sum, "mean": rolling_mean}
    return df.withColumns({name: fns[how](c, n, w) for name, (c, n, how) in specs.items()})


TRAINING_ROLLING = {
    "precip_7day_sum": ("precipitation_sum", 7, "sum"),
    "precip_14day_sum": ("precipitation_sum", 14, "sum"),
    "precip_7day_mean": ("precipitation_sum", 7, "mean"),
    "precip_14day_mean": ("precipitation_sum", 14, "mean"),
    "temp_7day_sum": ("mean_temp", 7, "sum"),
    "temp_14day_sum": ("mean_temp", 14, "sum"),
    "temp_7day_mean": ("mean_temp", 7, "mean"),
    "temp_14day_mean": ("mean_temp", 14, "mean"),
}

DROUGHT_ROLLING = {
    "precip_30day_sum": ("precipitation_sum", 30, "sum"),
    "precip_60day_sum": ("precipitation_sum", 60, "sum"),
}


# WIN-5
def ffill(c: str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


# WIN-6
def bfill(c: str, w: WindowSpec) -> Column:
    return F.first(c, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))


# WIN-4 (+5, +6)
def interpolate(
    df: DataFrame,
    key: Keys,
    order: Keys,
    cols: Sequence[str],
    fill_edges: bool = True,
    causal: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Linear interpolation by row position within each key.

    Interior gaps are filled on the straight line between the previous and the
    next non-null value (dates are ignored: rows are equally spaced).  With
    ``fill_edges`` trailing gaps take the last value and leading gaps the first
    one (the latter reads the future).  ``causal=True`` only carries the last
    value forward, for leak-free evaluation.  An all-null key stays null.
    """
    if block_rows is not None and not causal:
        from .hotkeys import interpolate_blocked

        return interpolate_blocked(df, _list(key)[0], _list(order), cols, fill_edges, block_rows)
    w = spec(key, order)
    rn = "__rn"
    out = df.withColumn(rn, F.row_number().over(w))
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    if causal:
        return out.withColumns({c: F.last(c, True).over(back) for c in cols}).drop(rn)
    # the four neighbours of every column are window outputs computed once
    nb = {}
    for c in cols:
        at = F.when(F.col(c).isNotNull(), F.col(rn))
        nb.update({
            f"__lo_v_{c}": F.last(c, True).over(back), f"__lo_r_{c}": F.last(at, True).over(back),
            f"__hi_v_{c}": F.first(c, True).over(fwd), f"__hi_r_{c}": F.first(at, True).over(fwd),
        })
    out = out.withColumns(nb)
    exprs = {}
    for c in cols:
        v, lo_v, lo_r, hi_v, hi_r = (F.col(x) for x in (c, f"__lo_v_{c}", f"__lo_r_{c}", f"__hi_v_{c}", f"__hi_r_{c}"))
        line = lo_v + (hi_v - lo_v) * (F.col(rn) - lo_r) / (hi_r - lo_r)
        filled = F.when(v.isNotNull(), v).when(lo_r.isNotNull() & hi_r.isNotNull(), line)
        if fill_edges:
            filled = filled.when(lo_r.isNotNull(), lo_v).otherwise(hi_v)
        exprs[c] = filled
    return out.withColumns(exprs).drop(rn, *nb.keys())


# AGG-6
def trailing(
    df: DataFrame,
    key: Keys,
    order: str,
    specs: dict[str, tuple[str, int, str]],
    upto: Column | None = None,
) -> DataFrame:
    """Serving-side trailing aggregates, one row per key of ``df``.

    Rows with ``order <= upto`` (when given) are ranked newest first; for each
    spec (input, n, "sum"|"mean") the last ``n`` of them are aggregated in one
    grouped pass: sum of all-null is 0.0, mean of all-null is null; a key
    without such a row gets 0.0 for both.
    """
    keys = _list(key)
    inside = F.lit(True) if upto is None else F.coalesce(F.col(order) <= upto, F.lit(False))
    src = df.withColumn("__in", inside)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("__in").desc(), F.col(order).desc()))
    # the filter on the rank lets Spark limit each key to its newest rows
    # before the shuffle (window group limit), however long the history
    ranked = src.withColumn("__rn", rn).filter(F.col("__rn") <= max(n for _, n, _ in specs.values()))
    aggs = []
    for name, (c, n, how) in specs.items():
        x = F.when(F.col("__in") & (F.col("__rn") <= n), F.col(c))
        mean = F.when(F.bool_or("__in"), F.avg(x)).otherwise(0.0)
        aggs.append((F.coalesce(F.sum(x), F.lit(0.0)) if how == "sum" else mean).alias(name))
    return ranked.groupBy(*keys).agg(*aggs)


# WIN-8
def importance_rank(df: DataFrame, value: str = "importance", name: str = "feature") -> DataFrame:
    """1-based rank by descending value, ties by name.  The input is one row
    per model feature (tens of rows), so a global window is fine here."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.col(value).desc(), F.col(name))))
