"""Grid, polygon clip and nearest-neighbour joins (GEO-*, FN-7, JOIN-9).

Design for scale
----------------
* ``build_grid`` generates the lattice with ``sequence``/``explode`` (no join).
* ``clip_to_polygons`` is a ray-casting test.  Edges are keyed by the latitude
  bands they span, points by their band: an equi-join on the band gives each
  point only the edges that cross its horizontal ray line, never all pairs.
  Whether the edge table (polygon vertices) is broadcast is left to adaptive
  execution.
* ``nearest_join`` is an exact k=1 nearest-neighbour join by an equi-join on the
  3x3 cells around each query; queries that the distance does not prove are tried
  again on larger cells.  It counts the open queries between the levels, which
  suits a grid of thousands of points over many candidates.
* ``nearest_by_pyramid`` and ``nearest_planar`` are the same in one plan, by
  equi-joins on cells with a pyramid that decides each query's search ring
  before any pair is made: for many queries, uneven densities, or where no job
  may run while the plan is made.  The cells of the pyramid halve from level to level.
  A query looks up the finest level at which its 3x3 block holds a candidate;
  that bounds the distance of the nearest one, and the finest level whose block
  must hold everything within that bound is the one the query is joined on.
  Every query is joined once, on a level of its own that follows the density
  around it; no level is tried in vain and nothing is decided by an action while
  the plan is made.  Candidates are read twice, for their cells and for the
  join, where they are only repeated for the levels at which some query's block
  holds their cell; others are left out.
* Both find the least distance of each query by a hash aggregate of one number,
  then make the pairs again and keep those at that distance; ties among these few
  go to the smaller key by ``min_by``.  Queries are dealt over
  ``spark.sql.shuffle.partitions`` tasks, since their pairs are many times their bytes.
  Which side is broadcast, and how a hot cell is split, is left to adaptive
  execution; ``salt`` splits the candidates of every cell on top of that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.scalar import haversine_km, planar_d2


# ---------------------------------------------------------------- GEO-1 grid


def build_grid(spark_or_df, step: float, bbox: dict | None = None) -> DataFrame:
    """Regular lat/lon lattice, upper bound inclusive (+1e-9), rounded to 4 dp,
    with its lat-major position ``gid``.

    ``bbox`` is a dict (fixed box) or None for the default box; when a DataFrame
    with columns lat_min, lat_max, lon_min, lon_max (one row) is passed instead
    of a session, the box comes from that frame.
    """
    from pyspark.sql import SparkSession

    if isinstance(spark_or_df, SparkSession):
        b = bbox or C.DEFAULT_BBOX
        box = spark_or_df.range(1).select(
            *[F.lit(float(b[k])).alias(k) for k in ("lat_min", "lat_max", "lon_min", "lon_max")]
        )
    else:
        box = spark_or_df
    st = F.lit(float(step))
    n_lat = F.ceil((F.col("lat_max") + F.lit(1e-9) - F.col("lat_min")) / st)
    n_lon = F.ceil((F.col("lon_max") + F.lit(1e-9) - F.col("lon_min")) / st)
    rows = box.select(
        "lat_min", "lon_min", n_lon.alias("n_lon"), F.explode(F.sequence(F.lit(0), (n_lat - 1).cast("int"))).alias("i")
    )
    # spread the latitude rows before the second explode, so a fine global
    # lattice is generated by many tasks, not by the task holding the box row
    parts = int(box.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "i")
    cells = rows.select(
        "lat_min", "lon_min", "n_lon", "i", F.explode(F.sequence(F.lit(0), (F.col("n_lon") - 1).cast("int"))).alias("j")
    )
    return cells.select(
        (F.col("i").cast("bigint") * F.col("n_lon") + F.col("j")).alias("gid"),
        F.round(F.col("lat_min") + F.col("i") * st, 4).alias("lat"),
        F.round(F.col("lon_min") + F.col("j") * st, 4).alias("lon"),
    )


def bbox_of(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One-row extent of a point table (a single global aggregate)."""
    return df.agg(
        F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max")
    )


# ------------------------------------------------------- GEO-2 / GEO-3 clip

BAND = 0.5  # degrees of latitude per edge band


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """Rings -> edges.  Input: poly (any id), ring (0 = exterior, >0 = holes),
    coords array<array<double>> of [lon, lat] points (closed or open).
    Output: poly, ring, x1, y1, x2, y2 (one row per edge, ring closed)."""
    pts = F.col("coords")
    n = F.size(pts)
    closed = F.when(
        (F.element_at(pts, 1) == F.element_at(pts, -1)) & (n > 1), F.slice(pts, 1, n - 1)
    ).otherwise(pts)
    ring = polygons.select("poly", "ring", closed.alias("p"))
    e = ring.select(
        "poly", "ring", "p", F.posexplode("p").alias("i", "a")
    ).select(
        "poly", "ring",
        F.col("a")[0].alias("x1"), F.col("a")[1].alias("y1"),
        F.element_at("p", ((F.col("i") + 1) % F.size("p") + 1).cast("int")).alias("b"),
    )
    return e.select("poly", "ring", "x1", "y1", F.col("b")[0].alias("x2"), F.col("b")[1].alias("y2"))


def _banded_edges(edges: DataFrame, band: float) -> DataFrame:
    lo = F.floor(F.least("y1", "y2") / band)
    hi = F.floor(F.greatest("y1", "y2") / band)
    return edges.filter(F.col("y1") != F.col("y2")).withColumn(
        "band", F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint")))
    )


def _inside_keys(points: DataFrame, edges: DataFrame, x: str, y: str, key: str, band: float) -> DataFrame:
    """Keys of the points inside the union: a point is inside when some
    polygon's exterior ring has an odd number of crossings of the point's ray
    and none of that polygon's holes has."""
    be = _banded_edges(edges, band)
    p = points.select(F.col(key).alias("__k"), F.col(x).alias("__x"), F.col(y).alias("__y"))
    pb = p.withColumn("band", F.floor(F.col("__y") / band).cast("bigint"))
    cross = ((F.col("y1") > F.col("__y")) != (F.col("y2") > F.col("__y"))) & (
        F.col("__x") < (F.col("x2") - F.col("x1")) * (F.col("__y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    )
    j = pb.join(be, "band").filter(cross)
    odd = j.groupBy("__k", "poly", "ring").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") % 2 == 1)
    # per point, the odd rings are at most the rings its ray crosses: a bounded list
    per = odd.groupBy("__k").agg(F.collect_list(F.struct("poly", "ring")).alias("__r"))
    ext = F.filter("__r", lambda e: e["ring"] == 0)
    inside = F.exists(ext, lambda e: ~F.exists("__r", lambda h: (h["poly"] == e["poly"]) & (h["ring"] > 0)))
    return per.filter(inside).select(F.col("__k").alias(key))


def clip_flags(points: DataFrame, edges: DataFrame, x: str = "lon", y: str = "lat", key: str = "gid",
               band: float = BAND) -> DataFrame:
    """Inside flag per point (even-odd ray casting, holes per polygon)."""
    inside = _inside_keys(points, edges, x, y, key, band).withColumn("inside", F.lit(True))
    return points.select(key).join(inside, key, "left").select(key, F.coalesce("inside", F.lit(False)).alias("inside"))


def clip_to_polygons(points: DataFrame, edges: DataFrame, x: str = "lon", y: str = "lat", key: str = "gid",
                     band: float = BAND) -> DataFrame:
    """Keep the points inside the union of the polygons (semi-join)."""
    return points.join(_inside_keys(points, edges, x, y, key, band), key, "left_semi")


# -------------------------------------------------- nearest-neighbour joins


def _cell_cols(lat: Column, lon: Column, ncols: int) -> tuple[Column, Column, float]:
    """Cells of c = 360/ncols degrees: c divides the circle, so longitude cells
    wrap at the antimeridian without a narrow seam cell."""
    c = 360.0 / ncols
    ci = F.floor((lat + F.lit(90.0)) / c).cast("bigint")
    cj = F.pmod(F.floor((lon + F.lit(180.0)) / c).cast("bigint"), F.lit(ncols))
    return ci, cj, c


def _lower_bound_km(lat: Column, lon: Column, ncols: int, radius: float) -> Column:
    """Least possible great-circle distance from the point to anything outside
    its 3x3 block: the latitude margin, or the distance to the meridian at the
    longitude margin, asin(cos(lat) sin(dlon))."""
    ci, _, c = _cell_cols(lat, lon, ncols)
    big = F.lit(1e30)
    south = F.when((ci - 1) * c <= 0, big).otherwise((lat + 90.0) - (ci - 1) * c)
    north = F.when((ci + 2) * c >= 180.0, big).otherwise((ci + 2) * c - (lat + 90.0))
    lat_b = F.radians(F.least(south, north)) * radius
    if ncols <= 3:
        return lat_b
    x = F.pmod(lon + F.lit(180.0), F.lit(360.0))
    col = F.floor(x / c)
    dl = F.least(F.least(x - (col - 1) * c, (col + 2) * c - x), F.lit(90.0))
    lon_b = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(dl))) * radius
    return F.least(lat_b, lon_b)


def _ncols_for(best_km: float | None, max_abs_lat: float | None, radius: float) -> int:
    """Columns (cells of 360/ncols degrees) whose 3x3 block proves a best
    distance of ``best_km`` at latitudes up to ``max_abs_lat``; a large
    number when there is no candidate yet (the caller still halves ncols)."""
    if best_km is None:
        return 1 << 30
    cosphi = math.cos(math.radians(min(max_abs_lat or 0.0, 89.9)))
    x = math.sin(min(best_km / radius, math.pi / 2)) / max(cosphi, 1e-9)
    if x >= 1.0:
        return 3
    need = math.degrees(max(math.asin(x), best_km / radius)) * 1.001
    return max(3, int(360.0 / need))


_OFFSETS = [(di, dj) for di in (-1, 0, 1) for dj in (-1, 0, 1)]


def _block(df: DataFrame, ci: Column, cj: Column, ncols: int | None = None) -> DataFrame:
    """One row per cell of the 3x3 block around each row (columns __ci, __cj);
    with ``ncols`` the column index wraps around the antimeridian."""
    offs = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a, b in _OFFSETS])
    x = df.withColumns({"__ci0": ci, "__cj0": cj}).withColumn("__o", F.explode(offs))
    cjn = F.col("__cj0") + F.col("__o.dj")
    if ncols is not None:
        cjn = F.pmod(cjn, F.lit(ncols))
    # with ncols >= 3 the wrapped neighbours are distinct, so no duplicates arise
    return x.withColumns({"__ci": F.col("__ci0") + F.col("__o.di"), "__cj": cjn}).drop("__ci0", "__cj0", "__o")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: distances this close to the least one are compared once more, with their keys
SLACK = 1 + 1e-9


def _best(queries: DataFrame, block: Callable[[DataFrame], DataFrame], near: DataFrame, at: list[str], g: list[str],
          distance: Column, payload: Sequence[str], most: Column | None = None) -> DataFrame:
    """(group, __q, __w) with the best candidate in the block of each query.

    The least distance of a query comes first, a number kept in a hash table; only
    the pairs at that distance are made again and compared by key with ``min_by``,
    which sorts its input: all pairs together are never sorted."""
    own = queries.columns

    def pairs(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        found = block(rows).join(near.select(*at, "__cla", "__clo", *columns), at).withColumn("__d", distance)
        return found if most is None else found.filter(most)

    least = pairs(queries, []).groupBy(*own).agg(F.min("__d").alias("__m"))
    tied = pairs(least, ["__c", *payload]).filter(F.col("__d") <= F.col("__m") * F.lit(SLACK))
    return tied.groupBy(*g, "__q").agg(F.min_by(F.struct("__c", "__d", *payload), F.struct("__d", "__c")).alias("__w"))


def _salted(df: DataFrame, salt: int) -> DataFrame:
    return df if salt <= 1 else df.withColumn("__s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))


def choose_cell(candidates: DataFrame, lat: str, lon: str, per_cell: float = 8.0,
                lo: float = 0.01, hi: float = 10.0, with_count: bool = False):
    """Cell size (degrees) giving about ``per_cell`` candidates per cell, from
    one small aggregate (count and extent); with ``with_count`` also the count."""
    r = candidates.agg(
        F.count(F.lit(1)).alias("n"), F.min(lat).alias("a"), F.max(lat).alias("b"),
        F.min(lon).alias("c"), F.max(lon).alias("d"),
    ).first()
    if not r["n"]:
        c = hi
    else:
        area = max((r["b"] - r["a"]) * (r["d"] - r["c"]), 1e-6)
        c = float(min(hi, max(lo, math.sqrt(area * per_cell / r["n"]))))
    return (c, int(r["n"] or 0)) if with_count else c


def nearest_join(
    queries: DataFrame,
    candidates: DataFrame,
    q_key: str,
    c_key: str,
    q_lat: str = "lat",
    q_lon: str = "lon",
    c_lat: str = "lat",
    c_lon: str = "lon",
    payload: Sequence[str] = (),
    cell: float | None = None,
    radius: float = C.EARTH_RADIUS_KM,
    checkpoint: bool = True,
    group: Sequence[str] = (),
    salt: int = 1,
) -> DataFrame:
    """Exact haversine nearest candidate for every query row.

    Output: q_key, ``nn_key`` (candidate key, null when there is none),
    ``dist_km`` and the ``payload`` columns of the winning candidate.
    Ties on distance go to the smaller candidate key.  With ``group`` columns
    (e.g. a layer) present on both sides, the search runs per group value in
    the same job (the group is part of the join key).

    ``salt`` > 1 splits every cell's candidates into that many buckets (by a
    hash of the candidate key) and repeats each query block per bucket, so a
    cell holding a large share of all candidates is joined by ``salt``
    tasks; the per-query ``min_by`` then combines the buckets.

    ``checkpoint`` (default) keeps each level's winners (one row per pending
    query) persisted, so a level is computed once; without it the levels are
    planned lazily and recomputed by later levels.
    """
    g = list(group)
    payload = [p for p in payload if p not in (c_key,)]
    n_cand = None
    if cell is None:
        cell, n_cand = choose_cell(candidates, c_lat, c_lon, with_count=True)
    q = queries.select(*g, F.col(q_key).alias("__q"), F.col(q_lat).alias("__la"), F.col(q_lon).alias("__lo"))
    cand = candidates.select(
        *g, F.col(c_key).alias("__c"), F.col(c_lat).alias("__cla"), F.col(c_lon).alias("__clo"),
        *[F.col(p) for p in payload],
    )
    if (n_cand == 0) if n_cand is not None else cand.isEmpty():  # nothing to find: null neighbours
        return q.select(*g, F.col("__q").alias(q_key), F.lit(None).cast(candidates.schema[c_key].dataType).alias("nn_key"),
                        F.lit(None).cast("double").alias("dist_km"),
                        *[F.lit(None).cast(candidates.schema[p].dataType).alias(p) for p in payload])
    pending = q.repartition(_parts(q), *g, "__q")  # pairs are many times the bytes that adaptive execution sees
    done: list[DataFrame] = []
    ncols = max(3, math.ceil(360.0 / float(cell)))
    while True:
        final = ncols <= 3  # the block covers the whole sphere
        ci, cj, _ = _cell_cols(F.col("__la"), F.col("__lo"), ncols)
        cci, ccj, _ = _cell_cols(F.col("__cla"), F.col("__clo"), ncols)
        cx = cand.withColumns({"__ci": cci, "__cj": ccj})
        keys = [*g, "__ci", "__cj"]
        if salt > 1:
            cx = cx.withColumn("__s", F.pmod(F.xxhash64("__c"), F.lit(salt)))
            keys.append("__s")
        dist = haversine_km("__la", "__lo", "__cla", "__clo", radius)
        best = _best(pending.select(*g, "__q", "__la", "__lo"), lambda x: _salted(_block(x, ci, cj, ncols), salt), cx, keys, g, dist, payload)
        scored = pending.join(best, [*g, "__q"], "left").select(
            *g, "__q", "__la", "__lo", "__w",
            (F.lit(final) | F.coalesce(F.col("__w.__d") < _lower_bound_km(F.col("__la"), F.col("__lo"), ncols, radius),
                                       F.lit(False))).alias("__ok"),
        )
        if checkpoint and not final:
            # one row per pending query point: keep it for the next level and
            # the final union instead of recomputing the join
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        done.append(scored.filter("__ok"))
        if final:
            break
        left = scored.filter(~F.col("__ok"))
        pending = left.select(*g, "__q", "__la", "__lo")
        if not checkpoint:
            ncols = max(3, (ncols + 1) // 2)
            continue
        st = left.agg(F.count(F.lit(1)).alias("n"), F.max("__w.__d").alias("d"), F.max(F.abs("__la")).alias("phi"),
                      F.count_if(F.col("__w").isNull()).alias("lonely")).first()
        if not st["n"]:
            break
        # points with no candidate in their block grow 4x, the others as far as
        # their best distance needs (at least 2x)
        grow = (ncols + 3) // 4 if st["lonely"] else (ncols + 1) // 2
        ncols = max(3, min(grow, _ncols_for(st["d"], st["phi"], radius)))
    allw = done[0]
    for d in done[1:]:
        allw = allw.unionByName(d)
    return allw.select(
        *g,
        F.col("__q").alias(q_key),
        F.col("__w.__c").alias("nn_key"),
        F.col("__w.__d").alias("dist_km"),
        *[F.col(f"__w.{p}").alias(p) for p in payload],
    )


GLOBE = 120.0  # degrees of a cell of the globe's coarsest level: its 3x3 block is the whole globe
FINEST = 16  # levels below it: cells of 0.0018 degrees


def _finest_cells(df: DataFrame, lat: str, lon: str, top: float, finest: int, wraps: bool) -> DataFrame:
    """Cell of the finest level, __fi and __fj; coarser ones follow by shifting bits."""
    c = top / (1 << finest)
    fj = F.floor((F.col(lon) + F.lit(180.0)) / c).cast("bigint")
    return df.withColumns({"__fi": F.floor((F.col(lat) + F.lit(90.0)) / c).cast("bigint"),
                           "__fj": F.pmod(fj, F.lit(3 << finest)) if wraps else fj})


def _at_level(df: DataFrame, finest: int) -> DataFrame:
    """The cell at level __l, __ci and __cj."""
    return df.withColumns({c: F.expr(f"shiftright({f}, {finest} - __l)") for c, f in (("__ci", "__fi"), ("__cj", "__fj"))})


def _all_levels(df: DataFrame, finest: int) -> DataFrame:
    return _at_level(df.withColumn("__l", F.explode(F.sequence(F.lit(0), F.lit(finest)))), finest)


def _around(df: DataFrame, wraps: bool) -> DataFrame:
    """One row per cell of the 3x3 block around (__ci, __cj) at level __l; columns
    wrap at the antimeridian (from 3 columns on the neighbours are distinct)."""
    offs = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    cj = F.col("__cj") + F.col("__o.dj")
    return df.withColumn("__o", F.explode(offs)).withColumns({
        "__ci": F.col("__ci") + F.col("__o.di"), "__cj": F.pmod(cj, F.expr("shiftleft(3L, __l)")) if wraps else cj}).drop("__o")


def _globe_level(lat: Column, top: Column) -> Column:
    """Finest level whose block is sure to hold the nearest candidate of a point
    whose block at level ``top`` holds some candidate: that one is at most two
    cells away in both directions, and what lies outside a block is at least a
    cell away, in latitude or from a meridian."""
    cell = F.radians(F.lit(GLOBE) / F.pow(F.lit(2.0), top))
    phi = F.radians(F.abs(lat))
    other = F.cos(F.greatest(phi - 2 * cell, F.lit(0.0)))
    reach = 2 * F.asin(F.least(F.sin(cell) * F.sqrt(1 + F.cos(phi) * other), F.lit(1.0)))
    turn = F.sin(reach) / F.cos(phi)
    need = F.degrees(F.greatest(reach, F.asin(F.least(turn, F.lit(1.0))))) * 1.000001
    level = F.floor(F.log2(F.lit(GLOBE) / need))
    return F.when((top < 2) | (reach >= math.pi / 2) | (turn >= 1), 0).otherwise(
        F.greatest(F.least(level, top), F.lit(0))).cast("int")


def _nearest(q: DataFrame, cand: DataFrame, g: list[str], top: float, finest: int, wraps: bool, level: Column,
             distance: Column, payload: Sequence[str], salt: int = 1, most: Column | None = None) -> DataFrame:
    """(group, __q, __w) with the best candidate of each query that has one;
    ``level`` speaks of __la, __lo and __top, the finest level with a candidate near."""
    q = _finest_cells(q, "__la", "__lo", top, finest, wraps)
    cand = _finest_cells(cand, "__cla", "__clo", top, finest, wraps)
    fine, at = [*g, "__fi", "__fj"], [*g, "__l", "__ci", "__cj"]
    held = _all_levels(cand.select(*fine).distinct(), finest)
    n = _parts(q)  # few bytes, many cells and pairs: adaptive execution would put them into one task
    spots = q.select(*fine).filter(F.col("__fi").isNotNull() & F.col("__fj").isNotNull()).repartition(n, *fine).distinct()
    depth = (_around(_all_levels(spots, finest), wraps).join(held.select(*at).distinct(), at, "left_semi")
             .groupBy(*fine).agg(F.max("__l").alias("__top")))
    placed = q.join(depth, fine).withColumn("__l", level).drop("__top").repartition(n, *g, "__q")
    rings = _around(_at_level(placed.select(*fine, "__l").distinct(), finest), wraps).select(*at).distinct()
    levels = held.join(rings, at, "left_semi").groupBy(*fine).agg(F.collect_set("__l").alias("__ls"))
    near = _at_level(cand.join(levels, fine).withColumn("__l", F.explode("__ls")).drop("__ls"), finest).drop("__fi", "__fj")
    if salt > 1:
        near = near.withColumn("__s", F.pmod(F.xxhash64("__c"), F.lit(salt)))
        at = [*at, "__s"]
    return _best(placed, lambda x: _salted(_around(_at_level(x, finest), wraps), salt), near, at, g, distance, payload, most)


def nearest_by_pyramid(
    queries: DataFrame,
    candidates: DataFrame,
    q_key: str,
    c_key: str,
    q_lat: str = "lat",
    q_lon: str = "lon",
    c_lat: str = "lat",
    c_lon: str = "lon",
    payload: Sequence[str] = (),
    radius: float = C.EARTH_RADIUS_KM,
    group: Sequence[str] = (),
    salt: int = 1,
    finest: int = FINEST,
) -> DataFrame:
    """Exact haversine nearest candidate for every query row.

    Output: q_key, ``nn_key`` (candidate key, null when there is none),
    ``dist_km`` and the ``payload`` columns of the winning candidate.
    Ties on distance go to the smaller candidate key.  With ``group`` columns
    (e.g. a layer) present on both sides, the search runs per group value in
    the same job (the group is part of the join key).  Query keys are unique;
    candidates without coordinates are nobody's neighbour, and queries without
    them have none.

    ``salt`` > 1 splits every cell's candidates into that many buckets (by a
    hash of the candidate key) and repeats each query block per bucket.
    ``finest`` is the number of halvings below 120 degrees; a coarser pyramid
    gives the same result with more pairs."""
    g = list(group)
    payload = [p for p in payload if p not in (c_key,)]
    q = queries.select(*g, F.col(q_key).alias("__q"), F.col(q_lat).alias("__la"), F.col(q_lon).alias("__lo"))
    cand = candidates.select(*g, F.col(c_key).alias("__c"), F.col(c_lat).alias("__cla"), F.col(c_lon).alias("__clo"), *payload)
    best = _nearest(q, cand, g, GLOBE, finest, True, _globe_level(F.col("__la"), F.col("__top")),
                    haversine_km("__la", "__lo", "__cla", "__clo", radius), payload, salt)
    return q.join(best, [*g, "__q"], "left").select(
        *g, F.col("__q").alias(q_key), F.col("__w.__c").alias("nn_key"), F.col("__w.__d").alias("dist_km"),
        *[F.col(f"__w.{p}").alias(p) for p in payload])


def nearest_planar(
    queries: DataFrame,
    features: DataFrame,
    q_key: str,
    f_pos: str,
    q_lat: str = "lat",
    q_lon: str = "lon",
    f_lat: str = "lat",
    f_lon: str = "lon",
    payload: Sequence[str] = (),
    max_deg: float | None = 1.0,
    group: Sequence[str] = (),
    finest: int = 10,
) -> DataFrame:
    """GEO-7: nearest feature by squared planar degrees, ties to the first
    feature (smallest ``f_pos``), rejected beyond ``max_deg`` (None: never).
    Blocks of the coarsest cells hold everything within ``max_deg``; where
    features are dense the search stays within a few of the finer cells.
    ``group`` columns (e.g. a day) must match between query and feature."""
    g = list(group)
    q = queries.select(*g, F.col(q_key).alias("__q"), F.col(q_lat).alias("__la"), F.col(q_lon).alias("__lo"))
    cand = features.select(*g, F.col(f_pos).alias("__c"), F.col(f_lat).alias("__cla"), F.col(f_lon).alias("__clo"), *payload)
    # two cells away in both directions is less than three cells, so two halvings up all of it is in the block
    level = F.greatest(F.col("__top") - 2, F.lit(0))
    d2 = planar_d2("__la", "__lo", "__cla", "__clo")
    most = None if max_deg is None else F.col("__d") <= max_deg * max_deg
    top = 720.0 if max_deg is None else max_deg
    finest = finest if max_deg is not None else finest + 9
    best = _nearest(q, cand, g, top, finest, False, level, d2, payload, most=most)
    return best.select(
        *g, F.col("__q").alias(q_key), F.col("__w.__c").alias("nn_pos"), F.sqrt(F.col("__w.__d")).alias("dist_deg"),
        *[F.col(f"__w.{p}").alias(p) for p in payload],
    )


# ------------------------------------------------------------ map helpers


def infer_step(cells: DataFrame, lat: str = "lat", cap: float = 0.5) -> DataFrame:
    """GEO-10: min positive gap (4 dp) between sorted distinct latitudes,
    capped at ``cap``.  The window runs over *distinct* latitudes only, whose
    number is bounded by the grid resolution (not by the table)."""
    d = cells.select(F.col(lat).alias("__l")).distinct()
    gap = F.round(F.col("__l") - F.lag("__l").over(Window.orderBy("__l")), 4)
    g = d.select(gap.alias("gap")).filter(F.col("gap") > 0)
    return g.agg(F.least(F.lit(cap), F.coalesce(F.min("gap"), F.lit(cap))).alias("step"))


def cell_bounds(cells: DataFrame, step: Column, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """GEO-11: rectangle lat +- step/2, lon +- step/2."""
    h = step / 2
    return cells.withColumns({
        "south": F.col(lat) - h, "north": F.col(lat) + h, "west": F.col(lon) - h, "east": F.col(lon) + h,
    })
