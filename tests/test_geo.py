"""Nearest joins against brute force, clip edge cases, grid sizes."""

import math
import random

import pytest

from ashgrid.operators import geo as G

R = 6371.0088


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(min(1.0, h)))


def brute(qs, cs):
    out = {}
    for k, la, lo in qs:
        best = None
        for sk, sla, slo in cs:
            dd = hav(la, lo, sla, slo)
            if best is None or (dd, sk) < best:
                best = (dd, sk)
        out[k] = None if best is None else best[1]
    return out


@pytest.mark.parametrize("finest", [0, 5, 16])
def test_nearest_equals_brute_force(spark, finest):
    rnd = random.Random(finest)
    qs = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(150)]
    # clustered candidates: most of the queries are far from any of them
    cs = [(j, rnd.gauss(50, 2), rnd.gauss(-120, 3)) for j in range(60)] + [(100, -45.0, 179.9)]
    q = spark.createDataFrame(qs, "k long, lat double, lon double")
    c = spark.createDataFrame(cs, "sk long, lat double, lon double")
    got = {r.k: r.nn_key for r in G.nearest_by_pyramid(q, c, "k", "sk", finest=finest).collect()}
    assert got == brute(qs, cs)


def test_nearest_salted_equals_unsalted(spark):
    rnd = random.Random(3)
    qs = [(i, rnd.uniform(45, 55), rnd.uniform(-125, -115)) for i in range(80)]
    # one hot cell holds most candidates
    cs = [(j, 50.0 + rnd.random() * 0.01, -120.0 + rnd.random() * 0.01) for j in range(300)]
    cs += [(1000 + j, rnd.uniform(45, 55), rnd.uniform(-125, -115)) for j in range(30)]
    q = spark.createDataFrame(qs, "k long, lat double, lon double")
    c = spark.createDataFrame(cs, "sk long, lat double, lon double")
    got = {r.k: r.nn_key for r in G.nearest_by_pyramid(q, c, "k", "sk", salt=7).collect()}
    assert got == brute(qs, cs)


def test_both_nearest_joins_agree(spark):
    rnd = random.Random(11)
    qs = [(i, rnd.uniform(45, 55), rnd.uniform(-125, -115)) for i in range(120)]
    cs = [(j, rnd.gauss(50, 2), rnd.gauss(-120, 3)) for j in range(150)]
    q = spark.createDataFrame(qs, "k long, lat double, lon double")
    c = spark.createDataFrame(cs, "sk long, lat double, lon double")
    want = brute(qs, cs)
    for f in (G.nearest_join, G.nearest_by_pyramid):
        assert {r.k: r.nn_key for r in f(q, c, "k", "sk").collect()} == want
    for cell, salt in ((0.05, 1), (3.0, 1), (0.5, 7)):
        assert {r.k: r.nn_key for r in G.nearest_join(q, c, "k", "sk", cell=cell, salt=salt).collect()} == want


def test_nearest_across_antimeridian(spark):
    q = spark.createDataFrame([(1, 10.0, 179.95)], "k long, lat double, lon double")
    c = spark.createDataFrame([(1, 10.0, -179.95), (2, 10.0, 179.0)], "sk long, lat double, lon double")
    got = G.nearest_by_pyramid(q, c, "k", "sk").collect()
    assert got[0].nn_key == 1


def test_nearest_ties_and_empty(spark):
    q = spark.createDataFrame([(1, 0.0, 0.0)], "k long, lat double, lon double")
    c = spark.createDataFrame([(7, 0.0, 1.0), (3, 0.0, -1.0)], "sk long, lat double, lon double")
    assert G.nearest_by_pyramid(q, c, "k", "sk").collect()[0].nn_key == 3
    empty = spark.createDataFrame([], "sk long, lat double, lon double")
    r = G.nearest_by_pyramid(q, empty, "k", "sk").collect()
    assert len(r) == 1 and r[0].nn_key is None


@pytest.mark.parametrize("lat", [-89.99, -66.0, 0.0, 48.0, 89.5])
def test_nearest_at_any_latitude(spark, lat):
    """Meridians come together near the poles; densities differ by a factor of a million."""
    rnd = random.Random(lat)
    near = lambda s: (max(-90.0, min(90.0, rnd.gauss(lat, s))), rnd.uniform(-180, 180) if abs(lat) > 85 else rnd.gauss(179.9, s))
    qs = [(i, *near(s)) for i, s in enumerate([0.001, 0.05, 1.0, 20.0] * 12)] + [(99, 90.0, 0.0), (98, -90.0, 12.0), (97, lat, -180.0), (96, lat, 180.0)]
    cs = [(j, *near(s)) for j, s in enumerate([0.002, 0.002, 0.1, 3.0] * 30)]
    cs += [(500 + j, cs[j][1], cs[j][2]) for j in range(10)]  # same places, larger keys
    q = spark.createDataFrame(qs, "k long, lat double, lon double")
    c = spark.createDataFrame([*cs, (900, None, 1.0), (901, 1.0, None)], "sk long, lat double, lon double")
    got = {r.k: r.nn_key for r in G.nearest_by_pyramid(q, c, "k", "sk").collect()}
    dist = {(k, sk): hav(la, lo, sla, slo) for k, la, lo in qs for sk, sla, slo in cs}
    want = brute(qs, cs)
    assert all(got[k] == want[k] or abs(dist[k, got[k]] - dist[k, want[k]]) < 1e-6 for k in want)
    assert all(sk < 500 for sk in got.values())


def test_nearest_per_group_without_coordinates(spark):
    q = spark.createDataFrame([(1, "a", 1.0, 1.0), (1, "b", 1.0, 1.0), (1, "c", 1.0, 1.0), (2, "a", None, 1.0)], "k long, g string, lat double, lon double")
    c = spark.createDataFrame([(5, "a", 80.0, 1.0), (6, "b", 1.0, 1.5), (7, "b", None, 1.0)], "sk long, g string, lat double, lon double")
    got = {(r.k, r.g): r.nn_key for r in G.nearest_by_pyramid(q, c, "k", "sk", group=["g"]).collect()}
    assert got == {(1, "a"): 5, (1, "b"): 6, (1, "c"): None, (2, "a"): None}


def test_nearest_plan_is_one_join_without_actions(spark):
    """No job runs while the plan is made."""
    rnd = random.Random(1)
    cs = spark.createDataFrame([(j, 50 + rnd.random() * s, 10 + rnd.random() * s) for j, s in enumerate([0.01, 0.5, 30] * 2000)], "sk long, lat double, lon double")
    qs = spark.createDataFrame([(j, 50 + rnd.random() * s, 10 + rnd.random() * s) for j, s in enumerate([0.01, 0.5, 30] * 30)], "k long, lat double, lon double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    out = G.nearest_by_pyramid(qs, cs, "k", "sk")
    assert not tracker.getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == 90


@pytest.mark.parametrize("max_deg", [1.0, 0.2, None])
def test_nearest_planar_equals_brute_force(spark, max_deg):
    rnd = random.Random(8)
    qs = [(i, rnd.uniform(48, 52), rnd.uniform(-181, -176)) for i in range(120)]
    fs = [(j, 50 + rnd.gauss(0, s), -178 + rnd.gauss(0, s)) for j, s in enumerate([0.01, 0.3, 2.0] * 60)]
    fs += [(900 + j, fs[j][1], fs[j][2]) for j in range(20)]
    want = {}
    for k, la, lo in qs:
        d, pos = min(((la - a) ** 2 + (lo - b) ** 2, j) for j, a, b in fs)
        if max_deg is None or d <= max_deg ** 2:
            want[k] = pos
    got = G.nearest_planar(spark.createDataFrame(qs, "k long, lat double, lon double"), spark.createDataFrame(fs, "pos long, lat double, lon double"),
                           "k", "pos", max_deg=max_deg)
    assert {r.k: r.nn_pos for r in got.collect()} == want


def test_nearest_planar_cutoff_and_first_wins(spark):
    q = spark.createDataFrame([(1, 50.0, -120.0), (2, 10.0, 10.0)], "k long, lat double, lon double")
    f = spark.createDataFrame([(5, 50.5, -120.0), (4, 49.5, -120.0)], "pos long, lat double, lon double")
    out = {r.k: r.nn_pos for r in G.nearest_planar(q, f, "k", "pos").collect()}
    assert out == {1: 4}


def test_grid_sizes_default_box(spark):
    assert G.build_grid(spark, 0.5).count() == 1224
    assert G.build_grid(spark, 0.25).count() == 4747


def _edges(spark, rings):
    df = spark.createDataFrame(rings, "poly int, ring int, coords array<array<double>>")
    return G.polygon_edges(df)


def test_clip_hole_and_multipolygon(spark):
    sq = lambda x0, y0, x1, y1: [[float(a), float(b)] for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    rings = [(0, 0, sq(0, 0, 10, 10)), (0, 1, sq(4, 4, 6, 6)), (1, 0, sq(20, 0, 30, 10))]
    pts = spark.createDataFrame(
        [(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 25.0, 5.0), (4, 15.0, 5.0), (5, 5.0, 4.5)], "gid long, lon double, lat double")
    kept = {r.gid for r in G.clip_to_polygons(pts, _edges(spark, rings)).collect()}
    assert kept == {2, 3}


def test_clip_hole_of_other_polygon_does_not_cut(spark):
    sq = lambda x0, y0, x1, y1: [[float(a), float(b)] for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    # polygon 1 covers polygon 0's hole: a point there is inside the union
    rings = [(0, 0, sq(0, 0, 10, 10)), (0, 1, sq(4, 4, 6, 6)), (1, 0, sq(3, 3, 7, 7))]
    pts = spark.createDataFrame([(1, 5.0, 5.0)], "gid long, lon double, lat double")
    assert G.clip_to_polygons(pts, _edges(spark, rings)).count() == 1


def test_infer_step_capped(spark):
    df = spark.createDataFrame([(48.3,), (48.55,), (49.3,), (49.3,)], "lat double")
    assert G.infer_step(df).collect()[0].step == 0.25
    df2 = spark.createDataFrame([(48.0,), (50.0,)], "lat double")
    assert G.infer_step(df2).collect()[0].step == 0.5


def test_nearest_takes_the_least_distance_without_sorting_all_pairs(spark):
    """Only the pairs at the least distance reach ``min_by``, which sorts its input."""
    q = spark.range(400).selectExpr("id AS k", "50 + id % 20 / 100 AS lat", "-120 + id % 31 / 100 AS lon")
    c = spark.range(300).selectExpr("id AS sk", "50 + id % 17 / 100 AS lat", "-120 + id % 29 / 100 AS lon")
    for out in (G.nearest_by_pyramid(q, c, "k", "sk"), G.nearest_planar(q, c, "k", "sk"), G.nearest_join(q, c, "k", "sk")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "functions=[partial_min(__d" in plan and "REPARTITION_BY_NUM" in plan


def test_nearest_planar_repeated_and_null_keys_are_one_query(spark):
    q = spark.createDataFrame([(1, 50.0, -120.0), (1, 50.4, -120.0), (None, 50.0, -120.0)], "k long, lat double, lon double")
    f = spark.createDataFrame([(5, 50.1, -120.0), (4, 50.41, -120.0), (3, 50.1, -120.0)], "pos long, lat double, lon double")
    assert {r.k: r.nn_pos for r in G.nearest_planar(q, f, "k", "pos").collect()} == {1: 4, None: 3}
