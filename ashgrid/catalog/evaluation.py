"""Ordinal metric, class-statistic and split queries over the ``ratings`` view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as FX
from ..functions import scalar as S
from ..operators import metrics as M
from ..operators import splits as SP
from .registry import register

CUTOFF = "1999-01-01"

R = FX.with_views("ratings")


def _ratings(spark, sf_dir) -> DataFrame:
    return FX.ratings(spark, sf_dir)


def _with_pr(df: DataFrame) -> DataFrame:
    """A continuous 'regressor' prediction around p."""
    return df.withColumn("pr", F.col("p") + (F.col("id") % 7 - 3).cast("double") / 10)


PR = "p + CAST(id % 7 - 3 AS DOUBLE) / 10"


@register("exact_accuracy", R + "SELECT round(avg(CAST(y = p AS DOUBLE)), 8) AS exact FROM ratings")
def exact_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings(spark, sf_dir).agg(S.round8(M.exact_accuracy()).alias("exact"))


@register("within_one", R + "SELECT round(avg(CAST(abs(y - p) <= 1 AS DOUBLE)), 8) AS within_one FROM ratings")
def within_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratings(spark, sf_dir).agg(S.round8(M.within_one()).alias("within_one"))


_QWK_SQL = R + """
, labs AS (SELECT lab, CAST(dense_rank() OVER (ORDER BY lab) AS DOUBLE) AS pos
           FROM (SELECT y AS lab FROM ratings UNION SELECT p FROM ratings)),
j AS (SELECT a.pos AS py, b.pos AS pp FROM ratings r JOIN labs a ON r.y = a.lab JOIN labs b ON r.p = b.lab),
s AS (SELECT sum((py - pp) * (py - pp)) AS num, sum(py * py) AS sy2, sum(pp * pp) AS sp2,
             sum(py) AS sy, sum(pp) AS sp, CAST(count(*) AS DOUBLE) AS n FROM j)
SELECT round(1 - num / nullif(sy2 + sp2 - 2 * sy * sp / n, 0), 8) AS qwk FROM s
"""


@register("quadratic_kappa", _QWK_SQL, headline=True)
def quadratic_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = M.quadratic_kappa(_ratings(spark, sf_dir))
    return k.select(S.round8("qwk").alias("qwk"))


@register("mse___rmse___mae", R + f"""
SELECT round(avg(pow(y - ({PR}), 2)), 8) AS mse, round(sqrt(avg(pow(y - ({PR}), 2))), 8) AS rmse,
       round(avg(abs(y - ({PR}))), 8) AS mae FROM ratings""")
def mse_rmse_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_pr(_ratings(spark, sf_dir))
    return df.agg(S.round8(M.mse("y", "pr")).alias("mse"), S.round8(M.rmse("y", "pr")).alias("rmse"),
                  S.round8(M.mae("y", "pr")).alias("mae"))


_RND = f"CAST(least(greatest(round_even({PR}, 0), 1), 5) AS INTEGER)"


@register("rounded_rmse___mae", R + f"""
SELECT round(sqrt(avg(pow(y - {_RND}, 2))), 8) AS rmse_r, round(avg(abs(y - {_RND})), 8) AS mae_r FROM ratings""")
def rounded_rmse_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = M.rounded(_with_pr(_ratings(spark, sf_dir)), "pr")
    return df.agg(S.round8(M.rmse("y", "p_round")).alias("rmse_r"), S.round8(M.mae("y", "p_round")).alias("mae_r"))


@register("clip_round_rating", R + f"SELECT id, {_RND} AS rating FROM ratings")
def clip_round_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_pr(_ratings(spark, sf_dir))
    return df.select("id", S.clip_round_rating("pr").alias("rating"))


@register("int_label", R + f"SELECT id, CAST(trunc({PR}) AS INTEGER) AS label FROM ratings")
def int_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _with_pr(_ratings(spark, sf_dir))
    return df.select("id", S.int_label("pr").alias("label"))


@register("abs_error", R + "SELECT id, abs(y - p) AS abs_err, p - y AS signed_err FROM ratings")
def abs_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ratings(spark, sf_dir)
    return df.select("id", S.abs_error("y", "p").alias("abs_err"), S.signed_error("y", "p").alias("signed_err"))


@register("per_class_accuracy", R + f"""
, cls AS (SELECT DISTINCT y AS cls FROM ratings UNION ALL SELECT 6),
te AS (SELECT * FROM ratings WHERE d >= DATE '{CUTOFF}'),
acc AS (SELECT y AS cls, avg(CAST(y = p AS DOUBLE)) AS accuracy FROM te GROUP BY y)
SELECT cls.cls, round(acc.accuracy, 8) AS accuracy FROM cls LEFT JOIN acc USING (cls)""")
def per_class_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class 6 has no rows at all: it must come out with a null accuracy."""
    df = _ratings(spark, sf_dir)
    te = df.filter(F.col("d") >= F.lit(CUTOFF).cast("date"))
    out = M.per_class_accuracy(te, df.select("y").union(spark.range(1).select(F.lit(6).cast("int"))))
    return out.select("cls", S.round8("accuracy").alias("accuracy"))


@register("confusion_row_pct", R + """
SELECT y AS official,
  round(100.0 * count(*) FILTER (WHERE p = 1) / count(*), 8) AS pct_1,
  round(100.0 * count(*) FILTER (WHERE p = 2) / count(*), 8) AS pct_2,
  round(100.0 * count(*) FILTER (WHERE p = 3) / count(*), 8) AS pct_3,
  round(100.0 * count(*) FILTER (WHERE p = 4) / count(*), 8) AS pct_4,
  round(100.0 * count(*) FILTER (WHERE p = 5) / count(*), 8) AS pct_5,
  count(*) AS n
FROM ratings GROUP BY y""")
def confusion_row_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.confusion_row_pct(_ratings(spark, sf_dir))
    return out.select("official", *[S.round8(f"pct_{c}").alias(f"pct_{c}") for c in M.LEVELS], "n")


@register("signed_bias", R + """
SELECT round(avg(CAST(p - y AS DOUBLE)), 8) AS bias,
       CASE WHEN avg(CAST(p - y AS DOUBLE)) > 0 THEN 'over-calls' ELSE 'under-calls' END AS direction
FROM ratings""")
def signed_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _ratings(spark, sf_dir).agg(M.signed_bias().alias("b"))
    return b.select(S.round8("b").alias("bias"), M.bias_word(F.col("b")).alias("direction"))


_REGION_SQL = ("CASE WHEN la <= 50 AND lo <= -122.5 THEN 'coast/SW' WHEN la >= 54 THEN 'north' "
               "ELSE 'interior' END")


@register("bias_by_region", R + f"""
SELECT {_REGION_SQL} AS region, round(avg(CAST(p - y AS DOUBLE)), 8) AS bias, count(*) AS n
FROM ratings GROUP BY 1""")
def bias_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.bias_by_region(_ratings(spark, sf_dir))
    return out.select("region", S.round8("bias").alias("bias"), "n")


@register("region_band", FX.with_views("points") + f"SELECT k, {_REGION_SQL} AS region FROM points")
def region_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.points(spark, sf_dir).select("k", S.region_band("la", "lo").alias("region"))


@register("by_class_mean_pred", R + """
SELECT y AS official, round(avg(CAST(p AS DOUBLE)), 8) AS mean_pred,
       round(avg(CAST(p >= 3 AS DOUBLE)) * 100, 8) AS pct_high_plus, count(*) AS n
FROM ratings GROUP BY y""")
def by_class_mean_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.by_class_mean_pred(_ratings(spark, sf_dir))
    return out.select("official", S.round8("mean_pred").alias("mean_pred"),
                      S.round8("pct_high_plus").alias("pct_high_plus"), "n")


@register("class_counts", R + "SELECT y AS cls, count(*) AS n FROM ratings GROUP BY y")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.class_counts(_ratings(spark, sf_dir))


@register("balanced_weight", R + """
, c AS (SELECT y, count(*) AS n FROM ratings GROUP BY y),
w AS (SELECT y, CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n) AS w FROM c)
SELECT r.id, round(w.w, 8) AS w FROM ratings r JOIN w USING (y)""")
def balanced_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.balanced_weights(_ratings(spark, sf_dir))
    return out.select("id", S.round8("w").alias("w"))


@register("majority_class", R + """
, c AS (SELECT y, count(*) AS n FROM ratings GROUP BY y)
SELECT CAST(arg_max(y, n * 100 - y) AS INTEGER) AS majority FROM c""")
def majority_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.majority_class(_ratings(spark, sf_dir))


@register("majority_baseline", R + """
, c AS (SELECT y, count(*) AS n FROM ratings GROUP BY y),
m AS (SELECT arg_max(y, n * 100 - y) AS majority FROM c)
SELECT CAST(m.majority AS INTEGER) AS majority, round(avg(CAST(r.y = m.majority AS DOUBLE)), 8) AS exact
FROM ratings r, m GROUP BY m.majority""")
def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-10: predict the majority class everywhere and score it."""
    df = _ratings(spark, sf_dir)
    maj = M.majority_class(df).select("majority").scalar()
    return df.agg(
        F.first(maj).alias("majority"),
        S.round8(F.avg((F.col("y") == maj).cast("double"))).alias("exact"),
    )


@register("min_max_range", R + """
SELECT y, min(la) AS la_min, max(la) AS la_max, min(lo) AS lo_min, max(lo) AS lo_max FROM ratings GROUP BY y""")
def min_max_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ratings(spark, sf_dir)
    return df.groupBy("y").agg(F.min("la").alias("la_min"), F.max("la").alias("la_max"),
                               F.min("lo").alias("lo_min"), F.max("lo").alias("lo_max"))


@register("split_counts", R + f"""
SELECT count(*) FILTER (WHERE d < DATE '{CUTOFF}') AS n_train, count(*) FILTER (WHERE d >= DATE '{CUTOFF}') AS n_test,
       count(*) FILTER (WHERE d IS NULL) AS n_undated FROM ratings""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = SP.temporal_split_tag(_ratings(spark, sf_dir), "d", CUTOFF)
    return df.agg(
        F.count_if(F.col("d").isNotNull() & (F.col("split") == "train")).alias("n_train"),
        F.count_if(F.col("d").isNotNull() & (F.col("split") == "test")).alias("n_test"),
        F.count_if(F.col("d").isNull()).alias("n_undated"),
    )


@register("temporal_split", R + f"""
SELECT id, CASE WHEN d < DATE '{CUTOFF}' THEN 'train' WHEN d IS NOT NULL THEN 'test' END AS split FROM ratings
UNION ALL SELECT -id, NULL FROM ratings WHERE id % 7 = 0""")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _ratings(spark, sf_dir).select("id", "d")
    undated = r.filter("id % 7 = 0").select((-F.col("id")).alias("id"), F.lit(None).cast("date").alias("d"))
    df = SP.temporal_split_tag(r.unionByName(undated), "d", CUTOFF)
    SP.require_both_sides(df)
    return df.select("id", "split")


_ORDER = "(id * 2654435761) % 1000003"


@register("stratified_split", R + f"""
SELECT id, y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {_ORDER}, id)
                      <= round(count(*) OVER (PARTITION BY y) * 0.2) THEN 'test' ELSE 'train' END AS split
FROM ratings""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 80/20 per class; a plain arithmetic order key so DuckDB can check it
    (the library default orders by xxhash64(id, 42))."""
    df = _ratings(spark, sf_dir)
    order = (F.col("id") * 2654435761) % 1000003
    out = SP.stratified_split(df, "y", "id", 0.2, order=order, bucket=F.floor(order / 4096))
    return out.select("id", "y", "split")


@register("standard_scaler", R + """
SELECT id, round((la - avg(la) OVER ()) / stddev_pop(la) OVER (), 8) AS z_la,
           round((lo - avg(lo) OVER ()) / stddev_pop(lo) OVER (), 8) AS z_lo FROM ratings""")
def standard_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-9: z-scores with the population standard deviation.  The moments are
    one global aggregate (one row), not a global window."""
    from ..operators.models import standardize

    z = standardize(_ratings(spark, sf_dir), ["la", "lo"])
    return z.select("id", S.round8("la").alias("z_la"), S.round8("lo").alias("z_lo"))
