"""Forests grown a tree in a task: every split against brute force, the bake-off against MLlib."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from ashgrid.operators import forest as FR
from ashgrid.operators import metrics as M
from ashgrid.plans import bakeoff as BO


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.random()
        rows.append((a, b, c, round(c * 7), min(5, max(1, round(3 + 1.2 * a - 0.5 * b + rng.gauss(0, 0.4)))), i % 3 == 0))
    return spark.createDataFrame(rows, "a double, b double, c double, e int, DANGER_RATING int, held boolean").repartition(5, "c").localCheckpoint()


def _small_blocks(monkeypatch):
    for name, value in (("LEAST_ROWS", 1), ("BLOCK", 128), ("SLICE", 97), ("COUNTS", 1 << 12), ("MANY", 2)):
        monkeypatch.setattr(FR, name, value)


def _impurity(rows, p):
    w = sum(k * p.pairs[c][1] for c, k in rows)
    if p.regression:
        mean = sum(k * p.pairs[c][1] * p.pairs[c][0] for c, k in rows) / w
        return w, sum(k * p.pairs[c][1] * (p.pairs[c][0] - mean) ** 2 for c, k in rows) / w
    return w, 1 - sum((sum(k * p.pairs[c][1] for c, k in rows if p.pairs[c][0] == y) / w) ** 2 for y in {y for y, _ in p.pairs})


@pytest.mark.parametrize("regression", [False, True])
@pytest.mark.parametrize("nominal", [False, True])
def test_every_split_is_the_best_one(monkeypatch, regression, nominal):
    """All features in every node: each node's gain equals the best of a search over all splits."""
    _small_blocks(monkeypatch)
    rng = np.random.default_rng(3)
    n, width = 400, 3
    bins = rng.integers(0, 9, (n, width)).astype(np.uint8)
    codes = ((bins[:, 0] + bins[:, 1] // 2 + rng.integers(0, 3, n)) // 4).clip(0, 2).astype(np.uint8)
    p = FR.Plan(4, 5, 3, width, width, 10, 42, regression, ((0.0, 0.1), (1.0, 0.7), (2.0, 1 / 3)), n, nominal)
    t = FR.grow(p, bins, codes, 1)
    times = np.random.default_rng([42, 1]).poisson(1.0, n)
    assert t.counts[0].tolist() == np.bincount(codes, weights=times, minlength=3).tolist()
    members = {0: [i for i in range(n) if times[i]]}
    right = lambda node, v: t.bin[node][v] if nominal else v > t.bin[node]
    for node in range(len(t.feature)):
        rows = members[node]
        assert t.counts[node].sum() == sum(times[rows])
        if t.feature[node] < 0:
            continue
        sides = [i for i in rows if not right(node, bins[i, t.feature[node]])], [i for i in rows if right(node, bins[i, t.feature[node]])]
        members[t.left[node]], members[t.left[node] + 1] = sides
        assert all(times[s].sum() >= 3 for s in sides)
        w, whole = _impurity([(codes[i], times[i]) for i in rows], p)

        def gain(left, rest):
            (lw, l), (rw, r) = (_impurity([(codes[i], times[i]) for i in s], p) for s in (left, rest))
            return whole - (lw * l + rw * r) / w

        best = -1
        for f in range(width):
            order = sorted({int(bins[i, f]) for i in rows})
            if nominal:  # by mean, or by impurity of the category
                said = {v: [(codes[i], times[i]) for i in rows if bins[i, f] == v] for v in order}
                mean = lambda s: sum(k * p.pairs[c][1] * p.pairs[c][0] for c, k in s) / sum(k * p.pairs[c][1] for c, k in s)
                order.sort(key=lambda v: round(mean(said[v]) if regression else _impurity(said[v], p)[1], 12))
            for j in range(1, len(order)):
                left = [i for i in rows if bins[i, f] in order[:j]]
                rest = [i for i in rows if bins[i, f] not in order[:j]]
                if times[left].sum() >= 3 and times[rest].sum() >= 3:
                    best = max(best, gain(left, rest))
        assert t.gain[node] == pytest.approx(gain(*sides), abs=1e-9) == pytest.approx(best, abs=1e-9)
    assert (t.feature >= 0).sum() > 5
    found = FR.leaves(t, bins)
    assert all(found[i] == leaf for leaf, rows in members.items() if t.feature[leaf] < 0 for i in rows)


def test_bakeoff_and_sweep_grow_and_score_in_tasks(spark, table, monkeypatch):
    """No forest is fitted in the driver; results are near MLlib's on the same bins."""
    data = BO.prepare(table.filter("NOT held"), table.filter("held"), ["a", "b", "c"])
    some = {k: v for k, v in BO.models(8, 40, 50).items() if "forest" in k}
    plain = {r["model"]: r for r in BO.bakeoff(data, some)[0].collect()}
    _small_blocks(monkeypatch)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: 1 / 0)
    table_, by_class = BO.bakeoff(data, some)
    for r in table_.collect():
        was = plain[r["model"]]
        assert r["n"] == was["n"] == 1000 and r["exact"] == pytest.approx(was["exact"], abs=0.05)
        assert r["mse"] == pytest.approx(was["mse"], rel=0.1) if was["mse"] else r["mse"] is None
        assert r["total_nodes"] == pytest.approx(was["total_nodes"], rel=0.1) if was["total_nodes"] else r["total_nodes"] is None
    assert by_class.count() == 20
    assert {(r["trees"], r["max_depth"], r["min_leaf"], r["total_nodes"] > r["trees"]) for r in BO.sweep(data, (3, 5), (2, 6), (1, 40)).collect()} == {
        (t, d, leaf, True) for t in (3, 5) for d in (2, 6) for leaf in (1, 40)}


def test_test_rows_keep_labels_that_are_null(spark, table, monkeypatch):
    _small_blocks(monkeypatch)
    test = table.filter("held").withColumn("DANGER_RATING", F.expr("CASE WHEN a < 0 THEN NULL ELSE DANGER_RATING END"))
    data = BO.prepare(table.filter("NOT held"), test, ["a", "b"])
    _, scored, _, nodes = BO._fit_and_score("forest", BO.forest(4, 6, 2, True), data)
    assert scored.count() == 1000 and nodes > 4
    assert scored.filter("y IS NULL").count() == test.filter("a < 0").count()
    assert BO._fit_and_score("forest", BO.forest(4, 6, 2, True), BO.Prepared(data.train, data.test.limit(0), data.features))[1].count() == 0


def test_what_stays_with_mllib(spark, table, monkeypatch):
    rows = table.withColumn("__y", F.col("DANGER_RATING") - 1.0)
    rf = RandomForestClassifier(labelCol="__y", numTrees=5)
    assert FR.plan(rf, rows, 3, 32) is None  # few rows
    monkeypatch.setattr(FR, "LEAST_ROWS", 3000)
    assert FR.plan(rf, rows, 3, 32).rows == 3000
    assert FR.plan(rf.copy().setSubsamplingRate(0.5), rows, 3, 32) is None
    assert FR.plan(rf, rows.withColumn("__y", F.col("a")), 3, 32) is None  # not classes
    assert FR.plan(rf, rows.withColumn("__y", F.expr("nullif(__y, 1.0)")), 3, 32) is None  # MLlib says what is wrong
    monkeypatch.setattr(FR, "MOST_BYTES", 3000 * 4 - 1)
    assert FR.plan(rf, rows, 3, 32) is None  # a task would hold too much


def test_pure_categories_keep_their_order():
    """One class has impurity 0 whatever its weight: categories of one class each are not dealt at random."""
    have = np.zeros((200, 12, 3))
    have[:, np.arange(12), np.arange(12) // 4] = np.random.default_rng(1).integers(1, 9999, (200, 12))
    p = FR.Plan(2, 5, 1, 1, 1, 12, 1, False, ((0.0, 0.1), (1.0, 0.7123), (2.0, 1 / 3)), 200, True)
    assert (FR._order(p, have, p.stats()) == np.arange(12)).all()
