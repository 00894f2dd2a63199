"""Train/test splits (ML-2, ML-3 / FLT-5).

The exact stratified split never sorts a whole class in one task: rows are
first counted per (class, order bucket) — a map-side-combined aggregate of at
most classes x buckets rows — then a running count over buckets says, per
bucket, whether it is wholly test, wholly train or the boundary.  The final
row_number runs per (class, bucket), so even a class holding a third of the
table is spread over ``buckets`` window partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(id_col: str, seed: int = 42) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(seed))


def hash_bucket(order: Column, bits: int = 16) -> Column:
    """Top ``bits`` bits of a 64-bit hash: monotonic in the hash."""
    return F.shiftright(order, 64 - bits)


def stratified_split(
    df: DataFrame,
    y: str,
    id_col: str,
    test_frac: float = 0.2,
    order: Column | None = None,
    bucket: Column | None = None,
    out: str = "split",
) -> DataFrame:
    """Exactly round(test_frac * n_c) rows of every class c go to 'test': the
    first ones in (order, id) order; the rest are 'train'.

    ``order`` defaults to xxhash64(id, 42) and ``bucket`` to its top 16 bits;
    any bucket expression that is monotonic in ``order`` gives the same result.
    """
    if order is None:
        order = hash_order(id_col)
        bucket = hash_bucket(order)
    elif bucket is None:
        bucket = order
    src = df.withColumns({"__o": order, "__b": bucket})
    counts = src.groupBy(y, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    by_class = Window.partitionBy(y)
    running = by_class.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    plan = counts.select(
        y,
        "__b",
        F.coalesce(F.sum("__cnt").over(running), F.lit(0)).alias("__before"),
        F.round(F.sum("__cnt").over(by_class) * F.lit(test_frac)).cast("bigint").alias("__k"),
    )
    rn = F.row_number().over(Window.partitionBy(y, "__b").orderBy("__o", id_col))
    tagged = src.join(plan, [y, "__b"]).withColumn(
        out, F.when(F.col("__before") + rn <= F.col("__k"), "test").otherwise("train")
    )
    return tagged.drop("__o", "__b", "__before", "__k")


def temporal_split_tag(df: DataFrame, d: str, cutoff: str, out: str = "split") -> DataFrame:
    """FLT-5 as one tagged frame: 'train' before the cutoff, 'test' from it, null without a date."""
    return df.withColumn(out, F.when(F.col(d) < F.lit(cutoff).cast("date"), "train")
                         .when(F.col(d).isNotNull(), "test"))


def require_both_sides(df: DataFrame, split: str = "split") -> None:
    """Empty-split guard: raise when one side has no rows (one small aggregate)."""
    row = df.agg(
        F.count_if(F.col(split) == "train").alias("tr"), F.count_if(F.col(split) == "test").alias("te")
    ).first()
    if not row["tr"] or not row["te"]:
        raise ValueError(f"empty split side: train={row['tr']} test={row['te']}")
