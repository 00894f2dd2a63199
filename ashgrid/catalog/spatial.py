"""Grid, clip and nearest-neighbour queries (GEO-*, FN-7, JOIN-8, JOIN-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as FX
from ..functions import scalar as S
from ..operators import cache as CA
from ..operators import geo as G
from ..operators.hotkeys import ranked
from .registry import register

R_KM = 6371.0088


def hav_sql(la1: str, lo1: str, la2: str, lo2: str) -> str:
    return (
        f"2 * {R_KM} * asin(sqrt(least(1.0, pow(sin((radians({la2}) - radians({la1})) / 2), 2) + "
        f"cos(radians({la1})) * cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2))))"
    )


def _edges(spark: SparkSession) -> DataFrame:
    rings = [(0, 0, [list(p) for p in FX.MASK_OUTER]), (0, 1, [list(p) for p in FX.MASK_HOLE])]
    polys = spark.createDataFrame(rings, "poly int, ring int, coords array<array<double>>")
    return G.polygon_edges(polys)


def _grid_over_points(spark: SparkSession, sf_dir: str, step: float) -> DataFrame:
    box = G.bbox_of(FX.points(spark, sf_dir), "la", "lo")
    return G.build_grid(box, step)


def _grid_sql(step: float, *extra_views: str) -> str:
    return FX.with_views("points", *extra_views) + f"""
, b AS (SELECT min(la) AS lat_min, max(la) AS lat_max, min(lo) AS lon_min, max(lo) AS lon_max FROM points),
n AS (SELECT *, CAST(ceil((lat_max + 1e-9 - lat_min) / {step}) AS BIGINT) AS n_lat,
             CAST(ceil((lon_max + 1e-9 - lon_min) / {step}) AS BIGINT) AS n_lon FROM b),
ij AS (SELECT *, unnest(range(n_lon)) AS j FROM (SELECT *, unnest(range(n_lat)) AS i FROM n)),
grid AS (SELECT i * n_lon + j AS gid, round(lat_min + i * CAST({step} AS DOUBLE), 4) AS lat,
                round(lon_min + j * CAST({step} AS DOUBLE), 4) AS lon FROM ij)
"""


@register("build_grid", _grid_sql(0.5) + "SELECT gid, lat, lon FROM grid")
def build_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-1 over the extent of the customer points, step 0.5."""
    return _grid_over_points(spark, sf_dir, 0.5)


_RAY = ("((e.y1 > {y}) <> (e.y2 > {y})) AND {x} < (e.x2 - e.x1) * ({y} - e.y1) / (e.y2 - e.y1) + e.x1")


def _clip_sql(src: str, key: str, x: str, y: str) -> str:
    ray = _RAY.format(x=f"p.{x}", y=f"p.{y}")
    return f"""
, c AS (SELECT p.{key} AS key, e.poly, e.ring, count(*) % 2 = 1 AS odd
        FROM {src} p JOIN edges e ON {ray} GROUP BY 1, 2, 3),
pp AS (SELECT key, poly, bool_or(odd) FILTER (WHERE ring = 0) AS in_ext,
              bool_or(odd) FILTER (WHERE ring > 0) AS in_hole FROM c GROUP BY 1, 2),
kept AS (SELECT DISTINCT key FROM pp WHERE in_ext AND NOT coalesce(in_hole, false))
"""


_CLIP_POINTS_SQL = FX.with_views("points", "edges") + _clip_sql("points", "k", "lo", "la") + """
SELECT k, la, lo FROM points WHERE k IN (SELECT key FROM kept)"""


@register("clip_rings", _CLIP_POINTS_SQL, headline=True)
def clip_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-3: customer points inside the mask polygon, outside its hole."""
    pts = FX.points(spark, sf_dir)
    return G.clip_to_polygons(pts, _edges(spark), x="lo", y="la", key="k").select("k", "la", "lo")


@register("clip_contains", _grid_sql(0.25, "edges") + _clip_sql("grid", "gid", "lon", "lat") + """
SELECT gid, lat, lon FROM grid WHERE gid IN (SELECT key FROM kept)""")
def clip_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-2: a 0.25-degree grid over the points' extent, clipped to the mask."""
    grid = _grid_over_points(spark, sf_dir, 0.25)
    return G.clip_to_polygons(grid, _edges(spark), x="lon", y="lat", key="gid")


def _nearest_sql(cands: str, payload: str) -> str:
    return FX.with_views("points", "sites") + f"""
, c AS ({cands}),
d AS (SELECT p.k, c.sk, {payload}, {hav_sql('p.la', 'p.lo', 'c.la', 'c.lo')} AS dist FROM points p, c),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY dist, sk) AS rn FROM d)
"""


@register("nearest_pixel_join", _nearest_sql(
    "SELECT * FROM sites WHERE la IS NOT NULL AND lo IS NOT NULL AND v IS NOT NULL", "c.v") + """
SELECT k, sk, v, round(dist, 4) AS dist_km FROM r WHERE rn = 1""", headline=True)
def nearest_pixel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-4: null-valued pixels are dropped first; exact blocked nearest join."""
    sites = FX.sites(spark, sf_dir).na.drop(subset=["la", "lo", "v"])
    out = G.nearest_join(FX.points(spark, sf_dir), sites, "k", "sk", "la", "lo", "la", "lo", payload=["v"])
    return out.select("k", F.col("nn_key").alias("sk"), "v", F.round("dist_km", 4).alias("dist_km"))


@register("nearest_attach_many", _nearest_sql("SELECT * FROM sites", "c.v, c.la AS site_la, c.lo AS site_lo") + """
SELECT k, sk, v, site_la, site_lo FROM r WHERE rn = 1""")
def nearest_attach_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-5: nearest site regardless of nulls; all its columns are attached."""
    sites = FX.sites(spark, sf_dir).withColumns({"site_la": F.col("la"), "site_lo": F.col("lo")})
    out = G.nearest_by_pyramid(FX.points(spark, sf_dir), sites, "k", "sk", "la", "lo", "la", "lo",
                         payload=["v", "site_la", "site_lo"])
    return out.select("k", F.col("nn_key").alias("sk"), "v", "site_la", "site_lo")


@register("nearest_with_median_fill", _nearest_sql("SELECT * FROM sites", "c.v") + """
SELECT k, sk, round(coalesce(v, (SELECT median(v) FROM sites), 0.0), 8) AS v FROM r WHERE rn = 1""")
def nearest_with_median_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-6: nearest station regardless of nulls, then null -> median over
    stations, else 0.0."""
    grid = FX.points(spark, sf_dir).select("k", F.col("la").alias("lat"), F.col("lo").alias("lon"))
    sites = FX.sites(spark, sf_dir).select("sk", F.col("la").alias("lat"), F.col("lo").alias("lon"), "v")
    out = CA.seed_from_stations(grid, sites, ["v"], "k", "sk")
    return out.select("k", F.col("nn_key").alias("sk"), S.round8("v").alias("v"))


_PLANAR_SQL = FX.with_views("points", "sites") + """
, d AS (SELECT p.k, s.sk, pow(p.la - s.la, 2) + pow(p.lo - s.lo, 2) AS d2 FROM points p, sites s),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d2, sk) AS rn FROM d WHERE d2 <= 1.0)
SELECT k, sk, round(sqrt(d2), 8) AS dist_deg FROM r WHERE rn = 1"""


@register("nearest_planar", _PLANAR_SQL)
def nearest_planar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-7: squared-degree distance, first feature wins ties, cutoff 1 degree."""
    out = G.nearest_planar(FX.points(spark, sf_dir), FX.sites(spark, sf_dir), "k", "sk", "la", "lo", "la", "lo")
    return out.select("k", F.col("nn_pos").alias("sk"), S.round8("dist_deg").alias("dist_deg"))


@register("nearest_joins", _nearest_sql("SELECT * FROM sites", "c.v") + """
, pl AS (SELECT p.k, s.sk, row_number() OVER (PARTITION BY p.k ORDER BY pow(p.la - s.la, 2) + pow(p.lo - s.lo, 2), s.sk) AS rn
         FROM points p, sites s WHERE pow(p.la - s.la, 2) + pow(p.lo - s.lo, 2) <= 1.0)
SELECT r.k, r.sk AS hav_sk, pl.sk AS planar_sk FROM r LEFT JOIN pl ON r.k = pl.k AND pl.rn = 1 WHERE r.rn = 1""")
def nearest_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-9: haversine and planar nearest side by side."""
    pts, sites = FX.points(spark, sf_dir), FX.sites(spark, sf_dir)
    hav = G.nearest_join(pts, sites, "k", "sk", "la", "lo", "la", "lo").select("k", F.col("nn_key").alias("hav_sk"))
    pl = G.nearest_planar(pts, sites, "k", "sk", "la", "lo", "la", "lo").select("k", F.col("nn_pos").alias("planar_sk"))
    return hav.join(pl, "k", "left")


@register("haversine", FX.with_views("points", "sites") + f"""
SELECT p.k, s.sk, round({hav_sql('p.la', 'p.lo', 's.la', 's.lo')}, 6) AS dist_km
FROM points p JOIN (SELECT *, row_number() OVER (ORDER BY sk) - 1 AS rank FROM sites) s
  ON s.rank = p.k % (SELECT count(*) FROM sites)""")
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-7 on pairs: point k with the site of rank k modulo the number of sites."""
    sites = FX.sites(spark, sf_dir)
    p = FX.points(spark, sf_dir).withColumn("rank", F.col("k") % sites.agg(F.count(F.lit(1))).scalar())
    s = ranked(sites.select("sk", F.col("la").alias("sla"), F.col("lo").alias("slo")), "sk", "rank")
    j = p.join(s, "rank")
    return j.select("k", "sk", F.round(S.haversine_km("la", "lo", "sla", "slo"), 6).alias("dist_km"))


@register("bbox_zone", FX.with_views("points") + """
SELECT k, la BETWEEN 48.3 AND 49.6 AND lo BETWEEN -125.6 AND -121.7 AS low_confidence FROM points""")
def bbox_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.points(spark, sf_dir).select("k", S.in_low_confidence_zone("la", "lo").alias("low_confidence"))


@register("coord_key", FX.with_views("points") + """
SELECT k, round(la, 4) AS klat, round(lo, 4) AS klon, CAST(round(la * 10000) AS BIGINT) * 10000000
       + CAST(round(lo * 10000) AS BIGINT) AS key64 FROM points""")
def coord_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEO-12: rounded pair and a packed bigint key."""
    p = FX.points(spark, sf_dir)
    key64 = F.round(F.col("la") * 10000).cast("bigint") * 10000000 + F.round(F.col("lo") * 10000).cast("bigint")
    return p.select("k", S.round4("la").alias("klat"), S.round4("lo").alias("klon"), key64.alias("key64"))


_STEP_SQL = """
, l AS (SELECT DISTINCT la FROM predictions),
g AS (SELECT round(la - lag(la) OVER (ORDER BY la), 4) AS gap FROM l),
st AS (SELECT least(CAST(0.5 AS DOUBLE), coalesce(min(gap) FILTER (WHERE gap > 0), CAST(0.5 AS DOUBLE))) AS step FROM g)
"""


@register("infer_step", FX.with_views("predictions") + _STEP_SQL + "SELECT step FROM st")
def infer_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.infer_step(FX.predictions(spark, sf_dir), "la")


@register("cell_bounds", FX.with_views("predictions") + _STEP_SQL + """
SELECT DISTINCT la, lo, round(la - step / 2, 8) AS south, round(la + step / 2, 8) AS north,
       round(lo - step / 2, 8) AS west, round(lo + step / 2, 8) AS east FROM predictions, st""")
def cell_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = FX.predictions(spark, sf_dir)
    step = G.infer_step(pred, "la").select("step").scalar()
    cells = pred.select("la", "lo").distinct()
    out = G.cell_bounds(cells, step, "la", "lo")
    return out.select("la", "lo", *[S.round8(c).alias(c) for c in ("south", "north", "west", "east")])


_PICK_SQL = FX.with_views("places", "points") + """
, h AS (SELECT *, rank % 5 AS q, position('AMERICA' IN admin1) > 0 AS hit FROM places),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY NOT hit, rank) AS rn FROM h) WHERE rn = 1),
d AS (SELECT pick.q, p.k, pow(p.la - pick.la, 2) + pow(p.lo - pick.lo, 2) AS d2 FROM pick, points p),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, k) AS rn FROM d WHERE d2 <= 1.0) WHERE rn = 1)
SELECT pick.q, pick.name, pick.name || ', ' || pick.admin1 AS label, nn.k AS grid_k
FROM pick LEFT JOIN nn ON pick.q = nn.q"""


@register("place_pick", _PICK_SQL)
def place_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-8: per query, the first-ranked hit whose admin1 contains the region
    (else the first hit), then its nearest grid point within 1 degree."""
    pl = FX.places(spark, sf_dir).withColumn("q", F.col("rank") % 5)
    hit = F.col("admin1").contains("AMERICA")
    pick = pl.groupBy("q").agg(
        F.min_by(F.struct("name", "admin1", "la", "lo"), F.struct(~hit, F.col("rank"))).alias("h")
    ).select("q", "h.*")
    nn = G.nearest_planar(pick, FX.points(spark, sf_dir), "q", "k", "la", "lo", "la", "lo")
    return pick.join(nn, "q", "left").select(
        "q", "name", S.place_label("name", "admin1").alias("label"), F.col("nn_pos").alias("grid_k")
    )
