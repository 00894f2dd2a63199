"""Ordinal metrics and class statistics (MET-*, AGG-9..13).

Every metric is a single grouped aggregate over (y, p) pairs: partial
aggregation happens map-side, so the shuffle carries one small row per
partition (or per group) however many predictions are scored.  Nothing is
collected to the driver; results are one-row (or one-row-per-group) frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_round_rating, region_band

LEVELS = [1, 2, 3, 4, 5]


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# MET-1
def exact_accuracy(y="y", p="p") -> Column:
    return F.avg((F.col(y) == F.col(p)).cast("double"))


# MET-2
def within_one(y="y", p="p") -> Column:
    return F.avg((F.abs(F.col(y) - F.col(p)) <= 1).cast("double"))


# MET-8
def signed_bias(y="y", p="p") -> Column:
    return F.avg(_d(p) - _d(y))


def bias_word(bias: Column) -> Column:
    return F.when(bias > 0, "over-calls").otherwise("under-calls")


# MET-4
def mse(y="y", p="p") -> Column:
    return F.avg(F.pow(_d(y) - _d(p), 2))


def rmse(y="y", p="p") -> Column:
    return F.sqrt(mse(y, p))


def mae(y="y", p="p") -> Column:
    return F.avg(F.abs(_d(y) - _d(p)))


def confusion_counts(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """(group, y, p) -> n.  The one pass over the scored rows: partial counts
    are combined map-side, so the shuffle carries at most groups x K^2 rows."""
    return df.groupBy(*group, F.col(y).alias("__y"), F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))


def _with_positions(conf: DataFrame, g: list[str]) -> DataFrame:
    """Each label's 1-based position among the labels present in y or p of
    its group, from a window over the (at most K^2 rows per group) counts."""
    from pyspark.sql import Window

    w = Window.partitionBy(*g)
    labs = F.array_sort(F.array_union(F.collect_set("__y").over(w), F.collect_set("__p").over(w)))
    return conf.withColumn("__labs", labs).withColumns({
        "__py": F.array_position("__labs", F.col("__y")).cast("double"),
        "__pp": F.array_position("__labs", F.col("__p")).cast("double"),
    })


def _kappa_sums():
    a, b, n = F.col("__py"), F.col("__pp"), F.col("__n").cast("double")
    return [F.sum(n * F.pow(a - b, 2)).alias("num"), F.sum(n * a * a).alias("sy2"), F.sum(n * b * b).alias("sp2"),
            F.sum(n * a).alias("sy"), F.sum(n * b).alias("sp"), F.sum(n).alias("nn")]


def _kappa_col() -> Column:
    den = F.col("sy2") + F.col("sp2") - F.lit(2.0) * F.col("sy") * F.col("sp") / F.col("nn")
    return F.lit(1.0) - F.try_divide(F.col("num"), F.nullif(den, F.lit(0.0)))


# MET-3
def quadratic_kappa(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """Quadratic weighted kappa in closed form.

    Labels are replaced by their position among the labels present in y or p
    (per group), as the usual definition does; then
    kappa = 1 - sum((y-p)^2) / (sum(y^2) + sum(p^2) - 2 sum(y) sum(p) / n).
    Everything after the confusion counts runs on at most K^2 rows per group.
    Null when the denominator is 0 (constant, equal y and p).
    """
    g = list(group)
    x = _with_positions(confusion_counts(df, y, p, g), g)
    return x.groupBy(*g).agg(*_kappa_sums()).select(*g, _kappa_col().alias("qwk"))


def ordinal_report(df: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """MET-1, MET-2, MET-3, MET-8 and n in one frame (one row per group): one
    pass over the data (the confusion counts), then one aggregate over them."""
    g = list(group)
    x = _with_positions(confusion_counts(df, y, p, g), g)
    n = F.col("__n")
    s = x.groupBy(*g).agg(
        *_kappa_sums(),
        F.sum(F.when(F.col("__y") == F.col("__p"), n).otherwise(0)).alias("__hit"),
        F.sum(F.when(F.abs(F.col("__y") - F.col("__p")) <= 1, n).otherwise(0)).alias("__near"),
        F.sum(n * (F.col("__p") - F.col("__y")).cast("double")).alias("__dev"),
    )
    return s.select(
        *g, F.col("nn").cast("bigint").alias("n"), (F.col("__hit") / F.col("nn")).alias("exact"),
        (F.col("__near") / F.col("nn")).alias("within_one"), (F.col("__dev") / F.col("nn")).alias("bias"),
        _kappa_col().alias("qwk"),
    )


# MET-5
def rounded(df: DataFrame, pred: str, out: str = "p_round", lo: int = 1, hi: int = 5) -> DataFrame:
    return df.withColumn(out, clip_round_rating(pred, lo, hi))


# MET-6
def per_class_accuracy(df: DataFrame, classes: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Recall per class; classes without rows get null (left join to the list)."""
    acc = df.groupBy(F.col(y).alias("cls")).agg(exact_accuracy(y, p).alias("accuracy"))
    return classes.select(F.col(classes.columns[0]).alias("cls")).distinct().join(acc, "cls", "left")


# MET-7
def confusion_row_pct(df: DataFrame, y: str = "y", p: str = "p", levels: Sequence[int] = LEVELS) -> DataFrame:
    """Rows = official, columns = predicted, % of the row, plus n.
    Only classes with rows appear (FLT-11)."""
    piv = df.groupBy(F.col(y).alias("official")).pivot(p, list(levels)).count()
    n = sum((F.coalesce(F.col(str(c)), F.lit(0)) for c in levels), F.lit(0))
    return piv.select(
        "official",
        *[(F.coalesce(F.col(str(c)), F.lit(0)) * 100.0 / n).alias(f"pct_{c}") for c in levels],
        n.cast("bigint").alias("n"),
    )


# MET-9
def bias_by_region(df: DataFrame, y="y", p="p", lat="la", lon="lo") -> DataFrame:
    return df.groupBy(region_band(lat, lon).alias("region")).agg(
        signed_bias(y, p).alias("bias"), F.count(F.lit(1)).alias("n")
    )


# MET-10
def by_class_mean_pred(df: DataFrame, y="y", p="p") -> DataFrame:
    return df.groupBy(F.col(y).alias("official")).agg(
        F.avg(_d(p)).alias("mean_pred"),
        (F.avg((F.col(p) >= 3).cast("double")) * 100).alias("pct_high_plus"),
        F.count(F.lit(1)).alias("n"),
    )


# AGG-9
def class_counts(df: DataFrame, y: str = "y") -> DataFrame:
    return df.groupBy(F.col(y).alias("cls")).agg(F.count(F.lit(1)).alias("n"))


# AGG-10
def balanced_weights(df: DataFrame, y: str = "y", squared: bool = False) -> DataFrame:
    """w(c) = N / (K * n_c); the class table (K rows) is broadcast back.
    ``squared`` reproduces sample weight x per-tree class weight."""
    from pyspark.sql import Window

    counts = class_counts(df, y)  # K rows, one per class
    every = Window.partitionBy()
    w = counts.select(
        F.col("cls"),
        (F.sum("n").over(every).cast("double") / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("w"),
    )
    if squared:
        w = w.withColumn("w", F.col("w") * F.col("w"))
    return df.join(F.broadcast(w), df[y] == w["cls"]).drop("cls")


# AGG-12
def majority_class(df: DataFrame, y: str = "y") -> DataFrame:
    """Most frequent label; ties go to the smallest label."""
    c = class_counts(df, y)
    return c.agg(F.max_by("cls", F.struct(F.col("n"), -F.col("cls"))).alias("majority"))
