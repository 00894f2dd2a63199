"""Row windows that stay parallel when one key holds a large share of rows.

A plain ``Window.partitionBy(key)`` sends a key's whole history to one task.
That is the best plan for keys of at most ``block_rows`` rows, and they take it:
one exchange and one sort.  Keys with more rows (at most one in ``block_rows``
rows is such a key) are found by a map-side count and run in blocks:

1. global positions: the rows are range-partitioned by (key, order), so a hot
   key is split into ordered slices; each slice numbers its rows locally and
   a small table of per-(key, slice) counts turns local numbers into global
   1-based positions.  The numbered slices are written to the shared folder:
   both uses see the same slices, also after an executor was lost;
2. rows are cut into blocks of ``block_rows`` positions per key;
3. rolling frames of n rows: the last n-1 rows of every block are copied into
   the next block as a halo, the window runs per (key, block) and halo rows
   are dropped;
4. interpolation: per block, the first and last non-null value are a small
   summary; a window over the blocks of a key carries them into neighbouring
   blocks, so gaps that span blocks are filled exactly as in one pass.

Each step is a DataFrame operation.  Results equal ``timeseries``'s; a null key is
a history of its own, as in a plain window.  The hot keys are counted when the
plan is made (the driver learns whether there are any, nothing else).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import timeseries as TS


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def split_hot(df: DataFrame, key: str, rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(others, hot): rows of keys with at most ``rows`` rows, and of the keys with
    more; hot is None where no key has."""
    hot = df.groupBy(F.col(key).alias("__hkey")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows).select("__hkey")
    if hot.isEmpty():
        return df, None
    hot = _written(hot, "hot-keys")  # both joins must agree on them
    same = F.col(key).eqNullSafe(F.col("__hkey"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def global_positions(df: DataFrame, key: str, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Adds ``__pos``: the 1-based position of each row in its key's order."""
    order = _list(order)
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.repartitionByRange(parts, key, *order).withColumn("__pid", F.spark_partition_id())
    r = r.withColumn("__lpos", F.row_number().over(Window.partitionBy("__pid", key).orderBy(*order)))
    # both uses below must see the same range bounds
    r = _written(r, "positions")
    counts = r.groupBy(key, "__pid").agg(F.count(F.lit(1)).alias("__c"))
    # range partitions are ordered, so earlier slices of a key have smaller ids
    before = Window.partitionBy(key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(key, "__pid", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__off"))
    offs = offs.withColumnsRenamed({key: "__okey", "__pid": "__opid"})
    # null-safe: rows with a null key are a history of their own, as in a plain window
    return r.join(offs, F.col(key).eqNullSafe(F.col("__okey")) & (F.col("__pid") == F.col("__opid"))).withColumn(
        "__pos", F.col("__off") + F.col("__lpos")
    ).drop("__pid", "__lpos", "__off", "__okey", "__opid")


def ranked(df: DataFrame, by: str, out: str, buckets: int = 256) -> DataFrame:
    """Adds ``out``: the 0-based rank of each row by the numeric column ``by`` over
    the whole table, without a task that holds it.  Approximate quantiles cut
    the values into buckets, each bucket starts after the counted rows of the
    buckets before it, and rows are numbered inside their bucket.  Equal values
    share a bucket and are numbered in no particular order; nulls come first."""
    cuts = df.agg(F.percentile_approx(by, [i / buckets for i in range(1, buckets)], 10_000)).scalar()
    at = F.when(F.col(by).isNull(), -1).otherwise(F.size(F.filter("__cuts", lambda c: c <= F.col(by))))
    rows = df.withColumn("__cuts", cuts).withColumn("__b", at).drop("__cuts")
    counts = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__c"))  # one row per bucket
    start = F.coalesce(F.sum("__c").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("__b").orderBy(by))
    return rows.join(counts.select("__b", start.alias("__s")), "__b").withColumn(out, F.col("__s") + nth - 1).drop("__b", "__s")


def _blocks(df: DataFrame, block_rows: int) -> DataFrame:
    return df.withColumn("__blk", ((F.col("__pos") - 1) / block_rows).cast("bigint"))


def rolling_blocked(df: DataFrame, key: str, order: Sequence[str], specs: dict[str, tuple[str, int, str]],
                    block_rows: int = 1_000_000, parts: int | None = None) -> DataFrame:
    """Same as ``timeseries.add_rolling`` (row frames of n rows), block-parallel."""
    halo = max(n for _, n, _ in specs.values()) - 1
    if halo > block_rows:
        raise ValueError("block_rows must be at least the longest frame")
    others, hot = split_hot(df, key, block_rows)
    plain = TS.add_rolling(others, key, _list(order), specs)
    if hot is None:
        return plain
    pos = _blocks(global_positions(hot, key, order, parts), block_rows)
    main = pos.withColumn("__halo", F.lit(False))
    in_tail = ((F.col("__pos") - 1) % block_rows) >= (block_rows - halo)
    extra = pos.filter(in_tail).withColumns({"__blk": F.col("__blk") + 1, "__halo": F.lit(True)}) if halo else None
    both = main.unionByName(extra) if extra is not None else main
    w = Window.partitionBy(key, "__blk").orderBy("__pos")
    fns = {"sum": F.sum, "mean": F.avg}
    out = both.withColumns({name: fns[how](c).over(w.rowsBetween(-(n - 1), 0)) for name, (c, n, how) in specs.items()})
    return plain.unionByName(out.filter(~F.col("__halo")).drop("__halo", "__blk", "__pos"))


def interpolate_blocked(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                        fill_edges: bool = True, block_rows: int = 1_000_000, parts: int | None = None) -> DataFrame:
    """Same as ``timeseries.interpolate`` (non-causal), block-parallel."""
    others, hot = split_hot(df, key, block_rows)
    plain = TS.interpolate(others, key, _list(order), cols, fill_edges=fill_edges)
    if hot is None:
        return plain
    pos = _blocks(global_positions(hot, key, order, parts), block_rows)
    w = Window.partitionBy(key, "__blk").orderBy("__pos")
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    nb = {}
    for c in cols:
        at = F.when(F.col(c).isNotNull(), F.col("__pos"))
        nb.update({f"__lo_v_{c}": F.last(c, True).over(back), f"__lo_r_{c}": F.last(at, True).over(back),
                   f"__hi_v_{c}": F.first(c, True).over(fwd), f"__hi_r_{c}": F.first(at, True).over(fwd)})
    x = pos.withColumns(nb)
    # per block: its first and last non-null (value, position), carried across blocks
    summ = pos.groupBy(key, "__blk").agg(*[
        e for c in cols for e in (
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__pos"))).alias(f"__f_v_{c}"),
            F.min(F.when(F.col(c).isNotNull(), F.col("__pos"))).alias(f"__f_r_{c}"),
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__pos"))).alias(f"__l_v_{c}"),
            F.max(F.when(F.col(c).isNotNull(), F.col("__pos"))).alias(f"__l_r_{c}"),
        )])
    prev = Window.partitionBy(key).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    nxt = Window.partitionBy(key).orderBy("__blk").rowsBetween(1, Window.unboundedFollowing)
    carry = summ.select(key, "__blk", *[
        e for c in cols for e in (
            F.last(f"__l_v_{c}", True).over(prev).alias(f"__cin_v_{c}"),
            F.last(f"__l_r_{c}", True).over(prev).alias(f"__cin_r_{c}"),
            F.first(f"__f_v_{c}", True).over(nxt).alias(f"__cout_v_{c}"),
            F.first(f"__f_r_{c}", True).over(nxt).alias(f"__cout_r_{c}"),
        )])
    carry = carry.withColumnsRenamed({key: "__ckey", "__blk": "__cblk"})
    x = x.join(carry, F.col(key).eqNullSafe(F.col("__ckey")) & (F.col("__blk") == F.col("__cblk")), "left")
    exprs = {}
    for c in cols:
        lo_r = F.coalesce(f"__lo_r_{c}", f"__cin_r_{c}")
        lo_v = F.when(F.col(f"__lo_r_{c}").isNotNull(), F.col(f"__lo_v_{c}")).otherwise(F.col(f"__cin_v_{c}"))
        hi_r = F.coalesce(f"__hi_r_{c}", f"__cout_r_{c}")
        hi_v = F.when(F.col(f"__hi_r_{c}").isNotNull(), F.col(f"__hi_v_{c}")).otherwise(F.col(f"__cout_v_{c}"))
        v = F.col(c)
        line = lo_v + (hi_v - lo_v) * (F.col("__pos") - lo_r) / (hi_r - lo_r)
        filled = F.when(v.isNotNull(), v).when(lo_r.isNotNull() & hi_r.isNotNull(), line)
        if fill_edges:
            filled = filled.when(lo_r.isNotNull(), lo_v).otherwise(hi_v)
        exprs[c] = filled
    drop = [k for k in x.columns if k.startswith("__")]
    return plain.unionByName(x.withColumns(exprs).drop(*drop))

