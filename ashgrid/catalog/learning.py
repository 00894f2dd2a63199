"""Model queries (ML-*, SNK-8, SRC-9, PRJ-7, PRJ-8, PRJ-10, PRJ-16, AGG-14).

Model fits are checked by rows (and by the pytest suite); the data
preparation around them is checked against DuckDB where SQL can say it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import scalar as S
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import timeseries as TS
from ..plans import bakeoff as BO
from ..plans import training
from ..session import scratch_path
from .registry import register
from .series import _SF_SQL, _station_day_train, _station_features_df

ML_FEATURES = ["EVI", "NDVI", "average_wind_speed", "sin_doy", "cos_doy", "precip_7day_sum", "precip_14day_sum",
               "precip_7day_mean", "precip_14day_mean", "temp_7day_sum", "temp_14day_sum", "temp_7day_mean",
               "temp_14day_mean"]
CUT = "2024-01-21"
LABEL = ML.LABEL

_SF_SUB = "(" + _SF_SQL + ")"
_LABELLED_SQL = f"""
WITH sf AS (SELECT *, CAST(least(5, greatest(1, 1 + floor(temp_7day_mean / 80))) AS INTEGER) AS {LABEL} FROM {_SF_SUB} t)
"""


def _labelled(spark, sf_dir) -> DataFrame:
    """Training table: station features with an ordinal 1..5 rating that
    depends on the 7-day temperature mean (a learnable target)."""
    sf = _station_features_df(spark, sf_dir)
    y = F.least(F.lit(5), F.greatest(F.lit(1), 1 + F.floor(F.col("temp_7day_mean") / 80))).cast("int")
    return sf.withColumn(LABEL, y)


def _labelled_rows(spark, sf_dir) -> DataFrame:
    """The training table written once: a forest's weights, its rows and the rows
    that it scores would each compute the features again."""
    path = scratch_path(spark, "labelled")
    _labelled(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    c = F.lit(CUT).cast("date")
    return df.filter(F.col("d") < c), df.filter(F.col("d") >= c)


def _split(spark, sf_dir):
    return _sides(_labelled(spark, sf_dir))


def _weighted(df: DataFrame) -> DataFrame:
    return M.balanced_weights(df, LABEL)


@register("assemble_vector", _LABELLED_SQL + "SELECT st, d, 13 AS n_features FROM sf")
def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-1: the feature matrix in a fixed order."""
    v = ML.assembler(ML_FEATURES).transform(_labelled(spark, sf_dir))
    return ML.vector_size(v).select("st", "d", F.col("n_features").cast("int").alias("n_features"))


@register("balanced_training", _LABELLED_SQL + f"""
, c AS (SELECT {LABEL} AS cls, count(*) AS n FROM sf WHERE d < DATE '{CUT}' GROUP BY 1)
SELECT cls, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 8) AS w FROM c""")
def balanced_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-5: the class weights the forest trains with (w = N / (K n_c))."""
    train, _ = _split(spark, sf_dir)
    w = _weighted(train).groupBy(F.col(LABEL).alias("cls")).agg(F.count(F.lit(1)).alias("n"), F.first("w").alias("w"))
    return w.select("cls", "n", S.round8("w").alias("w"))


def _fit_rf(spark, sf_dir, trees=100, depth=25, min_leaf=50):
    train, test = _sides(_labelled_rows(spark, sf_dir))
    model = ML.fit(ML.rf_classifier(ML_FEATURES, trees, depth, min_leaf), _weighted(train))
    return model, test


@register("rf_classifier")
def rf_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-4: class-balanced forest (100 trees, depth 25, min leaf 50), scored
    on the temporal test side."""
    model, test = _fit_rf(spark, sf_dir)
    return ML.score(model, test).select("st", "d", LABEL, "prediction_level")


@register("rf_regressor")
def rf_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-6: forest regressor, then half-even round and clip to 1..5."""
    train, test = _sides(_labelled_rows(spark, sf_dir))
    model = ML.fit(ML.rf_regressor(ML_FEATURES, trees=100), train)
    return ML.score(model, test).select("st", "d", LABEL, "prediction_level")


@register("linear_regression")
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-7: OLS on population z-scores, then round and clip."""
    c = F.lit(CUT).cast("date")
    raw = _labelled(spark, sf_dir)
    df = ML.standardize(raw, ML_FEATURES, fit_on=raw.filter(F.col("d") < c))
    model = ML.fit(ML.linear_regression(ML_FEATURES), df.filter(F.col("d") < c))
    return ML.score(model, df.filter(F.col("d") >= c)).select("st", "d", LABEL, "prediction_level")


@register("ridge")
def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-8: ridge (alpha = 1) on population z-scores."""
    c = F.lit(CUT).cast("date")
    raw = _labelled(spark, sf_dir)
    df = ML.standardize(raw, ML_FEATURES, fit_on=raw.filter(F.col("d") < c))
    train = df.filter(F.col("d") < c).withColumn("__y", F.col(LABEL).cast("double") - 1.0)
    model = ML.fit(ML.ridge(ML_FEATURES, train), df.filter(F.col("d") < c))
    return ML.score(model, df.filter(F.col("d") >= c)).select("st", "d", LABEL, "prediction_level")


@register("model_bakeoff")
def model_bakeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-11: linear, ridge, a 100-tree regression forest, a 100-tree and a
    300-tree balanced forest against the majority guess, on one prepared table:
    error metrics, ordinal metrics and nodes per model."""
    table, _ = BO.bakeoff(BO.prepare(*_split(spark, sf_dir), ML_FEATURES))
    return table.drop("seconds")


@register("bakeoff_by_class")
def bakeoff_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-11 + MET-6: accuracy by official class of the linear models and the
    100-tree forest."""
    data = BO.prepare(*_split(spark, sf_dir), ML_FEATURES)
    chosen = {k: v for k, v in BO.models().items() if k in ("linear", "ridge", "forest")}
    return BO.bakeoff(data, chosen)[1]


def _saved_model(spark, rows: DataFrame) -> tuple[str, dict[str, int]]:
    path = scratch_path(spark, "model")
    return path, ML.fit_to(path, ML.rf_classifier(ML_FEATURES, 100, 25, 50), _weighted(rows))


@register("refit_full")
def refit_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-12: after validation, refit on all rows and save."""
    path, size = _saved_model(spark, _labelled_rows(spark, sf_dir))
    return spark.range(1).select(F.lit(path).alias("path"), F.lit(size["trees"]).alias("trees"),
                                 F.lit(size["total_nodes"]).alias("total_nodes"))


@register("model_save")
def model_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8: the saved model directory (listed stage by stage)."""
    path, _ = _saved_model(spark, _labelled_rows(spark, sf_dir))
    return spark.read.json(f"{path}/stages/*/metadata").select("class", "uid")


@register("model_load")
def model_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: load a saved model and score with it."""
    rows = _labelled_rows(spark, sf_dir)
    path, _ = _saved_model(spark, rows)
    model = PipelineModel.load(path)
    return ML.score(model, rows).select("st", "d", "prediction_level")


@register("score_table")
def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-13: every station-day scored with the loaded model, risk 1..5."""
    rows = _labelled_rows(spark, sf_dir)
    path, _ = _saved_model(spark, rows)
    scored = ML.score(PipelineModel.load(path), rows)
    return scored.select("st", "d", F.col("prediction_level").alias("risk"))


@register("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-14: ranked importances of the forest (top-k is ORD-3 on this)."""
    model, _ = _fit_rf(spark, sf_dir)
    return ML.feature_importance(model, spark)


@register("model_size")
def model_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-15: node count and bytes on disk for two size caps, with the ratio."""
    df = _weighted(_labelled_rows(spark, sf_dir))
    rows = []
    for depth, leaf in ((20, 1), (6, 50)):
        p = scratch_path(spark, "model-size")
        size = ML.fit_to(p, ML.rf_classifier(ML_FEATURES, 100, depth, leaf), df)
        nbytes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p).agg(F.sum("length")).scalar()
        rows.append(spark.range(1).select(F.lit(depth).alias("max_depth"), F.lit(leaf).alias("min_leaf"),
                                          F.lit(size["total_nodes"]).alias("total_nodes"),
                                          nbytes.alias("bytes")))
    both = rows[0].unionByName(rows[1])
    return both.withColumn("ratio", F.max("bytes").over(Window.partitionBy(F.lit(0))) / F.col("bytes"))


@register("feature_group_ab")
def feature_group_ab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-16: the same forest with and without the drought/humidity groups, and
    the best rank that an added feature reaches among the importances."""
    raw = _station_day_train(spark, sf_dir).withColumns({
        "max_temp": F.col("mean_temp") / 10 + 273.15, "mean_dewpoint": F.col("precipitation_sum") / 100 + 273.15})
    base = training.derive(training.clean(raw), winds={"average_wind_speed": ("we", "wn")}, drought=True, humidity=True)
    y = F.least(F.lit(5), F.greatest(F.lit(1), 1 + F.floor(F.col("temp_7day_mean") / 80))).cast("int")
    path = scratch_path(spark, "feature-groups")
    base.withColumn(LABEL, y).na.drop().write.parquet(path)  # four fits read it
    df = spark.read.parquet(path)
    c = F.lit(CUT).cast("date")
    out = None
    for name, extra in (("base", []), ("drought", C.DROUGHT_FEATURES), ("humidity", C.HUMIDITY_FEATURES),
                        ("both", C.DROUGHT_FEATURES + C.HUMIDITY_FEATURES)):
        feats = ML_FEATURES + extra
        train, test = _weighted(df.filter(F.col("date") < c)), df.filter(F.col("date") >= c)
        model = ML.fit(ML.rf_classifier(feats, 100, 25, 50), train)
        best = ML.feature_importance(model, spark).filter(F.col("feature").isin(extra)).agg(F.min("rank")).scalar()
        r = ML.evaluate(ML.score(model, test).select(LABEL, "prediction_level")).withColumns({
            "features": F.lit(name), "best_added_rank": best if extra else F.lit(None).cast("int")})
        out = r if out is None else out.unionByName(r)
    return out.select("features", "n", "exact", "within_one", "qwk", F.col("best_added_rank").cast("int").alias("best_added_rank"))


@register("size_accuracy_sweep")
def size_accuracy_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ML-17: trees / depth / min-leaf grid -> nodes vs accuracy, fits side by side."""
    return BO.sweep(BO.prepare(*_split(spark, sf_dir), ML_FEATURES))


@register("assert_contract", _LABELLED_SQL + "SELECT st, d, true AS in_order FROM sf")
def assert_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-8: the model's input columns equal the contract order, and so do the
    values of every vector that its assembler makes."""
    df = _labelled(spark, sf_dir)
    model = PipelineModel([ML.assembler(ML_FEATURES)])
    ML.assert_model_contract(model, ML_FEATURES)
    expected = F.array(*[F.col(c).cast("double") for c in ML_FEATURES])
    return model.transform(df).select("st", "d", (vector_to_array("features") == expected).alias("in_order"))


@register("select_contract", _LABELLED_SQL + """
SELECT st, d, EVI, NDVI, temp_7day_mean, DANGER_RATING FROM sf""")
def select_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-7: exactly the contract columns, in order, keys kept apart."""
    return C.select_contract(_labelled(spark, sf_dir), ["EVI", "NDVI", "temp_7day_mean", LABEL], keep=["st", "d"])


def _columns_sql() -> str:
    """Every column of the feature table with its type and number of values."""
    columns = [("st", "bigint"), ("d", "date"), *[(c, "double") for c in ML_FEATURES], (LABEL, "int")]
    return _LABELLED_SQL + " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, '{t}' AS type, count(\"{n}\") AS n_values FROM sf" for i, (n, t) in enumerate(columns))


@register("list_columns", _columns_sql())
def list_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-16: the columns of the feature table: name, type and number of values."""
    df = _labelled(spark, sf_dir)
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                              F.col(f"`{f.name}`").alias("n_values")) for i, f in enumerate(df.schema.fields)])
    return counts.select(F.inline(rows))


def _group_sql() -> str:
    from .. import fixtures as FX
    from .sqltext import rolling

    t = "(temp / 10 + 273.15)"
    td = "(precip / 100 + 273.15)"
    es = f"(0.6108 * exp(17.27 * ({t} - 273.15) / (({t} - 273.15) + 237.3)))"
    ea = f"(0.6108 * exp(17.27 * ({td} - 273.15) / (({td} - 273.15) + 237.3)))"
    return FX.with_views("station_day") + f"""
SELECT st, d, round({rolling('sum', 'precip', 30, 'st', 'd')}, 8) AS precip_30day_sum,
       round({rolling('sum', 'precip', 60, 'st', 'd')}, 8) AS precip_60day_sum,
       round(CASE WHEN {es} - {ea} < 0 THEN 0.0 ELSE {es} - {ea} END, 8) AS vpd,
       round(CASE WHEN {ea} / {es} * 100 < 0 THEN 0.0 WHEN {ea} / {es} * 100 > 100 THEN 100.0 ELSE {ea} / {es} * 100 END, 8)
         AS relative_humidity,
       round({t} - {td}, 8) AS temp_dewpoint_spread
FROM station_day"""


@register("feature_group_select", _group_sql())
def feature_group_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-10 (+WIN-3, FN-4..6): the drought and humidity groups."""
    raw = _station_day_train(spark, sf_dir).withColumns({
        "max_temp": F.col("mean_temp") / 10 + 273.15, "mean_dewpoint": F.col("precipitation_sum") / 100 + 273.15})
    df = TS.add_rolling(raw, "station_code", ["date"], TS.DROUGHT_ROLLING)
    df = df.withColumns({"vpd": S.vpd("max_temp", "mean_dewpoint"),
                         "relative_humidity": S.relative_humidity("max_temp", "mean_dewpoint"),
                         "temp_dewpoint_spread": S.dewpoint_spread("max_temp", "mean_dewpoint")})
    groups = [c for c in C.feature_groups(drought=True, humidity=True) if c in C.DROUGHT_FEATURES + C.HUMIDITY_FEATURES]
    return df.select(F.col("station_code").alias("st"), F.col("date").alias("d"), *[S.round8(c).alias(c) for c in groups])


@register("profile_drift")
def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-14: per feature of the training table that serving has too, the
    distributions of both sides from stored sketches per day, and a unit flag
    (a ratio of medians far from 1, such as mm vs m)."""
    from .serving import TARGET, _daily, _hourly
    from ..operators import drift
    from ..operators import weather as W

    train = _station_features_df(spark, sf_dir)
    serve = W.location_features(_daily(spark, sf_dir), _hourly(spark, sf_dir), F.lit(TARGET).cast("date"))
    shared = [c for c in ML_FEATURES if c in serve.columns]
    stored = []
    for name, df, day in (("train", train, "d"), ("serve", serve, "resolved_day")):
        path = scratch_path(spark, f"sketches-{name}")
        drift.sketches(df, shared, day).write.parquet(path)
        stored.append(spark.read.parquet(path))
    return drift.profile(*stored)
