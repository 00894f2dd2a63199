"""Fixture views over the driver tables, as Spark DataFrames and as DuckDB SQL.

No input data ships with the operators, so every one is exercised on views derived
from the driver's TPC-H-like tables.  Each view has one Spark builder and one
SQL text with the same meaning; ``with_views`` prefixes an oracle query with
the CTEs it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(k: Column, mult: int) -> Column:
    return F.lit(48.3) + (k * mult % 1170).cast("double") / 100


def _lon(k: Column, mult: int) -> Column:
    return F.lit(-139.0) + (k * mult % 2500).cast("double") / 100


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------


def station_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (station, day): events grouped by (user_id, calendar day)."""
    e = table(spark, sf_dir, "events")
    v, t = F.col("value"), F.col("event_type")
    return (
        e.groupBy(F.col("user_id").alias("st"), F.col("ts").cast("date").alias("d"))
        .agg(
            F.round(F.sum(v), 2).alias("precip"),
            F.max(v).alias("temp"),
            F.max(F.when(t == "view", v)).alias("evi"),
            F.max(F.when(t == "signup", v)).alias("ndvi"),
            F.coalesce(F.max(F.when(t == "click", v)), F.lit(0.0)).alias("we"),
            F.coalesce(F.max(F.when(t == "purchase", v)), F.lit(0.0)).alias("wn"),
        )
    )


def station_day_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("st"),
        F.col("o_orderdate").cast("date").alias("d"),
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("precip"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("loc"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("a"),
        F.when(F.col("event_type").isin("click", "view"), F.col("value")).alias("b"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("k"), _lat(k, 37).alias("la"), _lon(k, 91).alias("lo")
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("sk"),
        _lat(k, 577).alias("la"),
        _lon(k, 1013).alias("lo"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("v"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("y"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("p"),
        _lat(c, 37).alias("la"),
        _lon(c, 91).alias("lo"),
        F.col("o_orderdate").cast("date").alias("d"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8 lon/lat tiles: pixel size 0.05 deg, origin from the tile id.  Every
    11th tile declares 9 rows (a bad tile), every 5th a projected CRS."""
    e = table(spark, sf_dir, "embeddings")
    t = F.col("vec_id")
    return e.select(
        t.alias("tile"),
        F.when(t % 11 == 0, F.lit(9)).otherwise(F.lit(8)).alias("rows"),
        F.lit(8).alias("cols"),
        F.lit(0.05).alias("a"),
        F.lit(0.0).alias("b"),
        (F.lit(-139.0) + (t % 50).cast("double") / 2).alias("c"),
        F.lit(0.0).alias("d"),
        F.lit(-0.05).alias("e"),
        (F.lit(60.0) - (t % 23).cast("double") / 2).alias("f"),
        F.when(t % 5 == 4, F.lit(32610)).when(t % 3 == 1, F.lit(None).cast("int")).otherwise(F.lit(4326)).alias("epsg"),
        F.element_at("embedding", 2).cast("double").alias("nodata"),
        F.transform("embedding", lambda x: x.cast("double")).alias("values"),
    )


def tile_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    doy = F.lpad((k % 365 + 1).cast("string"), 3, "0")
    mm = F.lpad((k % 12 + 1).cast("string"), 2, "0")
    dd = F.lpad((k % 28 + 1).cast("string"), 2, "0")
    path = (
        F.when(k % 4 == 0, F.concat(F.lit("MOD13Q1.061__250m_16_days_"), F.col("p_type"), F.lit("_doy2023"), doy, F.lit("_aid0001.tif")))
        .when(k % 4 == 1, F.concat(F.lit("/data/tiles/"), F.lower(F.col("p_type")), F.lit("_surface_temp_max_2023-"), mm, F.lit("-"), dd, F.lit(".tif")))
        .when(k % 4 == 2, F.concat(F.lit("s3a://bucket/"), F.col("p_brand"), F.lit("__"), F.lower(F.col("p_type")), F.lit("_2022"), mm, dd, F.lit(".tiff")))
        .otherwise(F.concat(F.lit("dem/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit(".tif")))
    )
    return p.select(k.alias("pk"), path.alias("path"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sd = station_day(spark, sf_dir).select("st", "d")
    pt = points(spark, sf_dir)
    return sd.join(pt, sd.st == pt.k).select(
        "d", "la", "lo", ((F.col("st") + F.dayofmonth("d")) % 5 + 1).cast("int").alias("risk")
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("n_nationkey").cast("bigint")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("name"),
        F.col("r_name").alias("admin1"),
        F.col("n_nationkey").alias("rank"),
        _lat(k, 37).alias("la"),
        _lon(k, 91).alias("lo"),
    )


# Polygon mask used by the clip fixtures: one polygon with one hole.
# FIXED VALUES of the fixture (lon, lat).
MASK_OUTER = [(-136.0, 49.0), (-118.0, 50.0), (-121.0, 59.0), (-133.0, 58.0)]
MASK_HOLE = [(-127.0, 53.0), (-125.0, 53.0), (-125.0, 55.0), (-127.0, 55.0)]
MASK_GEOJSON = {
    "type": "FeatureCollection",
    "features": [
        {
            "type": "Feature",
            "properties": {"name": "mask"},
            "geometry": {
                "type": "Polygon",
                "coordinates": [
                    [list(p) for p in MASK_OUTER + MASK_OUTER[:1]],
                    [list(p) for p in MASK_HOLE + MASK_HOLE[:1]],
                ],
            },
        }
    ],
}


# --------------------------------------------------------------------------
# DuckDB text of the same views
# --------------------------------------------------------------------------

VIEW_SQL = {
    "station_day": """
      SELECT user_id AS st, CAST(ts AS DATE) AS d,
             round(sum(value), 2) AS precip, max(value) AS temp,
             max(value) FILTER (WHERE event_type = 'view') AS evi,
             max(value) FILTER (WHERE event_type = 'signup') AS ndvi,
             coalesce(max(value) FILTER (WHERE event_type = 'click'), 0.0) AS we,
             coalesce(max(value) FILTER (WHERE event_type = 'purchase'), 0.0) AS wn
      FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "station_day_long": """
      SELECT o_custkey AS st, CAST(o_orderdate AS DATE) AS d, o_orderkey AS id, o_totalprice AS precip
      FROM orders""",
    "hourly": """
      SELECT user_id AS loc, ts, event_id AS seq, value AS a,
             CASE WHEN event_type IN ('click', 'view') THEN value END AS b
      FROM events""",
    "points": """
      SELECT c_custkey AS k,
             48.3 + CAST(c_custkey * 37 % 1170 AS DOUBLE) / 100 AS la,
             -139.0 + CAST(c_custkey * 91 % 2500 AS DOUBLE) / 100 AS lo
      FROM customer""",
    "sites": """
      SELECT s_suppkey AS sk,
             48.3 + CAST(s_suppkey * 577 % 1170 AS DOUBLE) / 100 AS la,
             -139.0 + CAST(s_suppkey * 1013 % 2500 AS DOUBLE) / 100 AS lo,
             CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal END AS v
      FROM supplier""",
    "ratings": """
      SELECT o_orderkey AS id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS y,
             CAST(o_orderkey % 5 + 1 AS INTEGER) AS p,
             48.3 + CAST(o_custkey * 37 % 1170 AS DOUBLE) / 100 AS la,
             -139.0 + CAST(o_custkey * 91 % 2500 AS DOUBLE) / 100 AS lo,
             CAST(o_orderdate AS DATE) AS d
      FROM orders""",
    "tiles": """
      SELECT vec_id AS tile, CASE WHEN vec_id % 11 = 0 THEN 9 ELSE 8 END AS rows, 8 AS cols, CAST(0.05 AS DOUBLE) AS a, CAST(0.0 AS DOUBLE) AS b,
             -139.0 + CAST(vec_id % 50 AS DOUBLE) / 2 AS c, CAST(0.0 AS DOUBLE) AS d, CAST(-0.05 AS DOUBLE) AS e,
             60.0 - CAST(vec_id % 23 AS DOUBLE) / 2 AS f,
             CASE WHEN vec_id % 5 = 4 THEN 32610 WHEN vec_id % 3 = 1 THEN NULL ELSE 4326 END AS epsg,
             CAST(embedding[2] AS DOUBLE) AS nodata,
             CAST(embedding AS DOUBLE[]) AS "values"
      FROM embeddings""",
    "tile_names": """
      SELECT p_partkey AS pk, CASE
        WHEN p_partkey % 4 = 0 THEN 'MOD13Q1.061__250m_16_days_' || p_type || '_doy2023'
             || lpad(CAST(p_partkey % 365 + 1 AS VARCHAR), 3, '0') || '_aid0001.tif'
        WHEN p_partkey % 4 = 1 THEN '/data/tiles/' || lower(p_type) || '_surface_temp_max_2023-'
             || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '-'
             || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || '.tif'
        WHEN p_partkey % 4 = 2 THEN 's3a://bucket/' || p_brand || '__' || lower(p_type) || '_2022'
             || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0')
             || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || '.tiff'
        ELSE 'dem/' || replace(p_name, ' ', '_') || '.tif' END AS path
      FROM part""",
    "predictions": """
      SELECT sd.d, pt.la, pt.lo, CAST((sd.st + dayofmonth(sd.d)) % 5 + 1 AS INTEGER) AS risk
      FROM station_day sd JOIN points pt ON sd.st = pt.k""",
    "places": """
      SELECT n_name AS name, r_name AS admin1, n_nationkey AS rank,
             48.3 + CAST(CAST(n_nationkey AS BIGINT) * 37 % 1170 AS DOUBLE) / 100 AS la,
             -139.0 + CAST(CAST(n_nationkey AS BIGINT) * 91 % 2500 AS DOUBLE) / 100 AS lo
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "edges": """
      SELECT * FROM (VALUES
        (0, 0, -136.0::DOUBLE, 49.0::DOUBLE, -118.0::DOUBLE, 50.0::DOUBLE), (0, 0, -118.0, 50.0, -121.0, 59.0),
        (0, 0, -121.0, 59.0, -133.0, 58.0), (0, 0, -133.0, 58.0, -136.0, 49.0),
        (0, 1, -127.0, 53.0, -125.0, 53.0), (0, 1, -125.0, 53.0, -125.0, 55.0),
        (0, 1, -125.0, 55.0, -127.0, 55.0), (0, 1, -127.0, 55.0, -127.0, 53.0)
      ) AS t(poly, ring, x1, y1, x2, y2)""",
}

VIEW_DEPS = {"predictions": ["station_day", "points"]}


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named fixture views (and their deps)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order) + "\n"
