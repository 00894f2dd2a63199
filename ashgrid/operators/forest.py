"""Forests over large tables, one tree a time in a task (ML-4, ML-6, ML-11..17).

MLlib grows all trees of a forest level by level: each level passes every row of
every tree through JVM objects, sends the bins of every open node between tasks and
keeps all nodes in the driver.  Here the rows are packed once, a byte for each
feature (its bin) and one for label and weight; the trees are dealt over groups,
every group gets the packed rows by one shuffle and grows its trees from
them.  The method is MLlib's: Poisson(1) bags, random features per node, best of
all bins by Gini or variance with weights, the least rows per node without
weights, leaves of one parent with equal predictions merged.  Bags and features
are drawn from (seed, tree) over the packed rows, whichever task grows the tree.

A forest is either written in MLlib's own format by the tasks, or scores the
packed rows of a test side in the tasks that grew it; its nodes never pass the
driver.  ``plan`` says whether a fit can be done so: a group holds the packed rows,
at most ``MOST_BYTES``; small tables, larger ones and other settings stay with MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: fewer rows than this are MLlib's; so are tables whose packed rows have more bytes
LEAST_ROWS, MOST_BYTES = 1 << 18, 1 << 28
#: rows of a packed block; rows and bytes of counts that a tree handles at once
BLOCK, SLICE, COUNTS = 1 << 16, 1 << 17, 1 << 24
#: open nodes in more blocks than this have their rows sorted, else each block looks at all rows
MANY = 24
POINTS = 512
#: side 0 is for training, 1 for the test; ``codes`` are bytes there and labels as doubles here, NaN for null
PACKED = "side int, chunk long, n int, bins binary, codes binary"


@dataclass(frozen=True)
class Plan:
    trees: int
    depth: int
    min_leaf: int
    slots: int  # features looked at in a node
    features: int
    bins: int
    seed: int
    regression: bool
    pairs: tuple[tuple[float, float], ...]  # (label, weight) of each code
    rows: int
    nominal: bool = False  # bins are categories: ordered in each node by what their rows say, as MLlib does

    @property
    def classes(self) -> int:
        return 1 if self.regression else int(max(y for y, _ in self.pairs)) + 1

    def stats(self) -> np.ndarray:
        """What a row of each code adds: weight by class, or weight, sum and sum of squares."""
        if self.regression:
            return np.array([(w, w * y, w * y * y) for y, w in self.pairs])
        s = np.zeros((len(self.pairs), self.classes))
        for i, (y, w) in enumerate(self.pairs):
            s[i, int(y)] = w
        return s


#: MLlib tries all subsets of so few categories; those fits stay there
FEW_CATEGORIES = 6


def _nominal(train: DataFrame, column: str, features: int) -> list[int] | None:
    """Categories of each feature of a vector column; none if all are numbers, None if mixed or few."""
    attrs = (train.schema[column].metadata.get("ml_attr") or {}).get("attrs") or {}
    found = [len(a.get("vals") or range(a.get("num_vals", 0))) for kind in ("nominal", "binary") for a in attrs.get(kind, [])]
    return found if not found or (len(found) == features and min(found) > FEW_CATEGORIES) else None


def plan(learner, train: DataFrame, features: int, bins: int) -> Plan | None:
    """How to grow the forest of ``learner`` here, or None: MLlib fits it.  A vector column
    of features that is there already has bins."""
    regression = isinstance(learner, RandomForestRegressor)
    known = {"auto": math.ceil(features / 3) if regression else math.ceil(math.sqrt(features)),
             "sqrt": math.ceil(math.sqrt(features)), "onethird": math.ceil(features / 3), "all": features}
    slots = known.get(learner.getFeatureSubsetStrategy())
    plain = (learner.getBootstrap() and learner.getSubsamplingRate() == 1 and learner.getMinInfoGain() == 0
             and learner.getMinWeightFractionPerNode() == 0 and learner.getImpurity() in ("gini", "variance"))
    vector = learner.getFeaturesCol()
    categories = _nominal(train, vector, features) if vector in train.columns else []
    if slots is None or categories is None or not plain or learner.getNumTrees() < 2 or max([bins, *categories]) > 256:
        return None
    w = F.col(learner.getWeightCol()) if learner.isSet("weightCol") else F.lit(1.0)
    found = train.groupBy(F.col(learner.getLabelCol()).cast("double").alias("y"), w.cast("double").alias("w")).count().limit(257).collect()
    rows = sum(r["count"] for r in found)
    ok = all(r["y"] is not None and r["w"] is not None and r["w"] >= 0 and math.isfinite(r["y"] + r["w"]) for r in found)
    ok = ok and (regression or all(r["y"] >= 0 and r["y"] == int(r["y"]) < 100 for r in found)) and any(r["w"] > 0 for r in found)
    if not ok or len(found) > 256 or rows < LEAST_ROWS or rows * (features + 1) > MOST_BYTES:
        return None
    return Plan(learner.getNumTrees(), learner.getMaxDepth(), learner.getMinInstancesPerNode(), slots, features, max([bins, *categories]),
                learner.getSeed(), regression, tuple(sorted((r["y"], r["w"]) for r in found)), rows, bool(categories))


# ---- packing ----------------------------------------------------------------

def thresholds(df: DataFrame, columns: Sequence[str], bins: int) -> list[list[float]]:
    """Per column the values that a split can have (x <= value goes left): midpoints at
    quantiles by weight of all rows, or between all values where these are few.  Each (__y, __w)
    has ``POINTS`` quantiles of its own, which are put together here."""
    at = F.array(*[F.lit((2 * i + 1) / (2 * POINTS)) for i in range(POINTS)])
    found = df.groupBy("__y", "__w").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(F.col(c).cast("double"), at, F.lit(4 * POINTS)).alias(f"q{i}") for i, c in enumerate(columns)]).collect()
    out = []
    for i in range(len(columns)):
        have = [(r[f"q{i}"], r["n"] * r["__w"]) for r in found if r["__w"] and r[f"q{i}"]]
        x = np.concatenate([q for q, _ in have])
        w = np.concatenate([np.full(len(q), share / len(q)) for q, share in have])
        values, which = np.unique(x, return_inverse=True)
        upto = np.cumsum(np.bincount(which, weights=w))
        cut = np.arange(len(values) - 1)
        if len(values) > bins:
            cut = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins))
            cut = cut[cut < len(values) - 1]
        out.append(((values[cut] + values[cut + 1]) / 2).tolist())
    return out


def _blocks(batches: Iterator, of_batch) -> Iterator:
    """Arrays of a batch put together to blocks of rows, each with a number of its own."""
    task, made, held, n = TaskContext.get().partitionId(), 0, [], 0

    def block():
        return (task << 32) + made, [np.concatenate(x) for x in zip(*held)]

    for batch in batches:
        if batch.num_rows:
            held.append(of_batch(batch))
            n += batch.num_rows
        if n >= BLOCK:
            yield block()
            made, held, n = made + 1, [], 0
    if n:
        yield block()


def pack(df: DataFrame, columns: Sequence[str] | str, cuts: list[list[float]] | None, pairs=None, label: str | None = None) -> DataFrame:
    """Blocks of rows as bytes: bins of the ``columns`` by ``cuts`` (or a vector column of
    whole numbers that are bins already), and the code of (y, w) or, without ``pairs``, the label."""
    vector = isinstance(columns, str)
    given = [F.transform(vector_to_array(columns), lambda x: x.cast("int")).alias("bins")] if vector else [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    more = [F.col("__y").cast("double").alias("y"), F.col("__w").cast("double").alias("w")] if pairs is not None else [F.col(label).cast("double").alias("y")]
    known = None if pairs is None else np.array([complex(*p) for p in pairs])
    edges = None if vector else [np.array(c) for c in cuts]

    def arrays(batch):
        if vector:
            flat = np.asarray(batch.column("bins").flatten())
            bins = flat.astype(np.uint8).reshape(batch.num_rows, -1)
        else:
            bins = np.empty((batch.num_rows, len(edges)), np.uint8)
            for i, e in enumerate(edges):
                col = batch.column(f"x{i}")
                x = col.to_numpy(zero_copy_only=False)
                if col.null_count or np.isnan(x).any():
                    raise ValueError(f"null or NaN among the values of {columns[i]}")
                bins[:, i] = np.searchsorted(e, x, side="left")
        y = batch.column("y").to_numpy(zero_copy_only=False)
        return bins, y if known is None else np.searchsorted(known, y + 1j * batch.column("w").to_numpy(zero_copy_only=False)).astype(np.uint8)

    def run(batches):
        for chunk, (bins, y) in _blocks(batches, arrays):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(known is None)], pa.int32()), pa.array([chunk]), pa.array([len(y)], pa.int32()), pa.array([bins.tobytes()]), pa.array([y.tobytes()])],
                ["side", "chunk", "n", "bins", "codes"])

    return df.select(*given, *more).mapInArrow(run, PACKED)


# ---- one tree ----------------------------------------------------------------

@dataclass
class Tree:
    """Nodes by level; ``feature`` is -1 at leaves, the right child comes after the left one."""
    feature: np.ndarray
    bin: np.ndarray  # the last bin on the left, or by bin whether it goes right
    left: np.ndarray
    counts: np.ndarray  # rows by code
    gain: np.ndarray


def _quality(s: np.ndarray, regression: bool) -> tuple[np.ndarray, np.ndarray]:
    """(weight, what a good split raises) of summed stats in the last axis: weight minus
    weighted impurity, up to what both sides of a split have in common."""
    with np.errstate(divide="ignore", invalid="ignore"):
        w, q = (s[..., 0], s[..., 1] ** 2) if regression else (s @ np.ones(s.shape[-1]), np.einsum("...k,...k->...", s, s))
        return w, np.where(w > 0, q / w, 0.0)


def impurity(s: np.ndarray, regression: bool) -> np.ndarray:
    """Gini by shares as MLlib has it: exactly 0 for one class whatever its weight, so that
    pure categories stay in their own order."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if regression:
            w, q = _quality(s, True)
            return np.where(w > 0, (s[..., 2] - q) / w, 0.0)
        w = s.sum(-1)
        found = np.ones(w.shape)
        for k in range(s.shape[-1]):
            found -= (s[..., k] / w) ** 2
        return np.where(w > 0, found, 0.0)


def _order(p: Plan, have: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Categories in MLlib's order: by impurity, by rows of the second class of two, or by mean; empty ones last."""
    s = have @ stats
    key = prediction(s, True) if p.regression else s[..., 1] if p.classes == 2 else impurity(s, False)
    return np.argsort(np.where(have @ np.ones(have.shape[-1]) > 0, key, np.inf), axis=1, kind="stable")


def _best(p: Plan, stats: np.ndarray, total: np.ndarray, hist: np.ndarray):
    """Best gain of nodes, its slot, its bin (or which bins go right) and the counts left of it;
    ``hist`` is (slot, node, bin, code)."""
    n = len(total)
    st = total @ stats
    tw, tq = _quality(st, p.regression)
    gain, where = np.full(n, -np.inf), np.zeros(n, np.int64)
    at = np.zeros((n, p.bins), bool) if p.nominal else np.zeros(n, np.int64)
    lefts = np.zeros_like(total)
    rows = total.sum(-1)
    every = np.arange(n)
    for s in range(len(hist)):
        have = hist[s]
        if p.nominal:
            order = _order(p, have, stats)
            have = np.take_along_axis(have, order[:, :, None], 1)
        left = np.cumsum(have, axis=1)[:, :-1]
        raw = left @ np.ones(left.shape[-1])
        ls = left @ stats
        lw, lq = _quality(ls, p.regression)
        rw, rq = _quality(st[:, None] - ls, p.regression)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = (lq + rq - tq[:, None]) / tw[:, None]
        g[(raw < p.min_leaf) | (rows[:, None] - raw < p.min_leaf) | (lw <= 0) | (rw <= 0)] = -np.inf
        b = g.argmax(1)
        better = g[every, b] > gain
        gain[better], where[better] = g[every, b][better], s
        at[better] = order.argsort(1)[better] > b[better][:, None] if p.nominal else b[better]
        lefts[better] = left[every, b][better]
    return gain, where, at, lefts


def grow(p: Plan, bins: np.ndarray, codes: np.ndarray, tree: int) -> Tree:
    """One tree over the rows of its bag, level by level.  A row of the bag has a number, how
    often it is in it and its open node; rows whose node is a leaf are left out in place."""
    rng = np.random.default_rng([abs(p.seed), tree])
    times = np.empty(len(codes), np.uint8)
    for lo in range(0, len(codes), SLICE):
        times[lo:lo + SLICE] = rng.poisson(1.0, len(codes[lo:lo + SLICE]))
    d, stats = len(p.pairs), p.stats()
    rows, k, n = np.empty(np.count_nonzero(times), np.uint32), np.empty(np.count_nonzero(times), np.uint8), 0
    total = np.zeros((1, d))
    for lo in range(0, len(codes), SLICE):
        bag = np.flatnonzero(times[lo:lo + SLICE]) + lo
        rows[n:n + len(bag)], k[n:n + len(bag)] = bag, times[bag]
        total[0] += np.bincount(codes[bag], weights=times[bag], minlength=d)
        n += len(bag)
    del times
    at = np.zeros(n, np.int32)
    levels: list[tuple] = []
    made = 1  # nodes numbered so far, this level's included
    pure = lambda t: impurity(t @ stats, p.regression) < 2e-16
    leaf = np.array([p.depth == 0 or pure(total)[0]])
    per_node = p.slots * p.bins * d * 8
    most = max(1, COUNTS // per_node)
    while True:
        n = len(total)
        feature, left, won = np.full(n, -1, np.int16), np.full(n, -1, np.int32), np.full(n, -1.0)
        cut = np.zeros((n, p.bins), bool) if p.nominal else np.zeros(n, np.uint8)
        opened = np.flatnonzero(~leaf)
        a = len(opened)
        lefts = np.zeros((a, d))
        if a:
            of_open = total[opened]
            if a > MANY * most:
                order = np.argsort(at, kind="stable").astype(np.uint32)
                rows, k, at = rows[order], k[order], at[order]
                del order
            for lo in range(0, a, most):
                hi = min(a, lo + most)
                part = slice(*np.searchsorted(at, [lo, hi])) if a > MANY * most else slice(None)
                chosen = (np.tile(np.arange(p.features), (hi - lo, 1)) if p.slots == p.features
                          else rng.random((hi - lo, p.features)).argpartition(p.slots - 1, axis=1)[:, :p.slots])
                hist = _counts(p, bins, codes, rows[part], k[part], at[part], chosen, lo, hi)
                gain, where, b, lf = _best(p, stats, of_open[lo:hi], hist)
                split = gain > 1e-13
                nodes = opened[lo:hi][split]
                feature[nodes], cut[nodes], won[nodes] = chosen[split, where[split]], b[split], gain[split]
                lefts[lo:hi] = lf
                del hist
        split = feature >= 0
        m = int(split.sum())
        left[split] = made + 2 * np.arange(m)
        levels.append((feature, cut, left, total, won))
        if not m:
            break
        kept = split[opened]
        child = np.empty((2 * m, d))
        child[0::2], child[1::2] = lefts[kept], total[split] - lefts[kept]
        made += 2 * m
        leaf = np.full(2 * m, True) if len(levels) == p.depth else pure(child)
        number = np.where(leaf, -1, np.cumsum(~leaf) - 1).astype(np.int32)
        of_split = np.full((a, 2), -1, np.int32)  # by open node: the numbers of its open children
        of_split[kept] = number.reshape(-1, 2)
        f, b = feature[opened].astype(np.int64).clip(0), cut[opened]
        n = 0
        for lo in range(0, len(at), SLICE):
            r = slice(lo, lo + SLICE)
            node = at[r]
            value = bins[rows[r], f[node]]
            to = of_split[node, (b[node, value] if p.nominal else value > b[node]).view(np.int8)]
            stay = to >= 0
            m = int(stay.sum())
            rows[n:n + m], k[n:n + m], at[n:n + m] = rows[r][stay], k[r][stay], to[stay]
            n += m
        rows, k, at = rows[:n], k[:n], at[:n]
        total = child
    feature, cut, left, counts, won = (np.concatenate(z) for z in zip(*levels))
    return pruned(Tree(feature, cut, left, counts, won), np.cumsum([0, *[len(z[0]) for z in levels]]), p)


def _counts(p: Plan, bins, codes, rows, k, at, chosen, first: int, end: int) -> np.ndarray:
    """Rows of the open nodes from ``first`` to ``end`` by (slot, node, bin, code)."""
    d, n = len(p.pairs), end - first
    size = n * p.bins * d
    hist = np.zeros((p.slots, size))
    step = max(SLICE, size // 2)  # counts are added up for each slice
    for lo in range(0, len(at), step):
        node, some, times = at[lo:lo + step], rows[lo:lo + step], k[lo:lo + step]
        if len(node) and (node.min() < first or node.max() >= end):
            inside = np.flatnonzero((node >= first) & (node < end))
            node, some, times = node[inside], some[inside], times[inside]
        node = node - first
        xs = np.take(bins, some, axis=0).reshape(-1)
        start = np.arange(0, len(xs), p.features)
        base = node.astype(np.int64) * (p.bins * d) + codes[some]
        times = times.astype(np.float64)
        for s in range(p.slots):
            key = np.take(xs, np.take(chosen[:, s], node) + start).astype(np.int64)
            key *= d
            key += base
            hist[s] += np.bincount(key, weights=times, minlength=size)
    return hist.reshape(p.slots, n, p.bins, d)


def prediction(s: np.ndarray, regression: bool) -> np.ndarray:
    return s[..., 1] / np.maximum(s[..., 0], 1e-300) if regression else s.argmax(-1).astype(np.float64)


def pruned(t: Tree, starts: np.ndarray, p: Plan) -> Tree:
    """Leaves of one parent with equal predictions become one, from the last level up."""
    says = prediction(t.counts @ p.stats(), p.regression)
    for i in range(len(starts) - 2, -1, -1):
        nodes = np.arange(starts[i], starts[i + 1])
        nodes = nodes[t.feature[nodes] >= 0]
        l = t.left[nodes]  # noqa: E741
        same = (t.feature[l] < 0) & (t.feature[l + 1] < 0) & (says[l] == says[l + 1])
        t.feature[nodes[same]] = -1
    live = np.zeros(len(t.feature), bool)
    live[0] = True
    for lo, hi in zip(starts[:-1], starts[1:]):
        nodes = np.flatnonzero(live[lo:hi] & (t.feature[lo:hi] >= 0)) + lo
        live[t.left[nodes]] = live[t.left[nodes] + 1] = True
    number = np.cumsum(live) - 1
    left = np.where(t.feature[live] >= 0, number[t.left[live].clip(0)], -1).astype(np.int32)
    return Tree(t.feature[live], t.bin[live], left, t.counts[live], np.where(t.feature[live] >= 0, t.gain[live], -1.0))


def leaves(t: Tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    out = np.zeros(len(bins), np.int32)
    for lo in range(0, len(bins), SLICE):
        x = bins[lo:lo + SLICE]
        rows, at = np.arange(len(x)), np.zeros(len(x), np.int32)
        end = out[lo:lo + SLICE]
        while len(rows):
            f = t.feature[at]
            done = f < 0
            if done.any():
                end[rows[done]] = at[done]
                rows, at, f = rows[~done], at[~done], f[~done]
            value = x[rows, f]
            at = t.left[at] + (value > t.bin[at] if t.bin.ndim == 1 else t.bin[at, value])
    return out


# ---- the job -------------------------------------------------------------------

def _dealt(spark: SparkSession, folder: str, p: Plan, work, schema: str) -> DataFrame:
    """``work(trees, bins, codes, test blocks)`` for each group of trees, with all packed rows."""
    starts, n = {}, 0
    blocks = spark.read.schema(PACKED).parquet(folder)
    for r in blocks.filter("side = 0").select("chunk", "n").orderBy("chunk").collect():  # one row for 65,536 rows or a small task
        starts[r["chunk"]], n = n, n + r["n"]
    groups = min(p.trees, 2 * spark.sparkContext.defaultParallelism)

    def run(batches):
        bins, codes, tests, seen = np.empty((n, p.features), np.uint8), np.empty(n, np.uint8), {}, set()
        for batch in batches:
            for i in range(batch.num_rows):
                seen.add(batch.column("g")[i].as_py())
                chunk, many = batch.column("chunk")[i].as_py(), batch.column("n")[i].as_py()
                rows = np.frombuffer(batch.column("bins")[i].as_buffer(), np.uint8).reshape(many, p.features)
                if batch.column("side")[i].as_py() == 0:
                    bins[starts[chunk]:starts[chunk] + many] = rows
                    codes[starts[chunk]:starts[chunk] + many] = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8)
                else:
                    tests[chunk] = (rows.copy(), batch.column("codes")[i].as_py() if 0 in seen else None)
        batch = rows = None  # what Arrow holds is not needed while trees grow
        pa.default_memory_pool().release_unused()
        for g in sorted(seen):
            yield from work(g, range(g, p.trees, groups), bins, codes, tests)

    # a group's task is named by its number, so none waits behind another
    return blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionById(groups, F.col("g")).mapInArrow(run, schema)


NODES = ("treeID int, id int, prediction double, impurity double, stats array<double>, rawCount long, gain double, "
         "leftChild int, rightChild int, feature int, threshold double")


def node_rows(spark: SparkSession, folder: str, p: Plan, cuts: list[list[float]]) -> DataFrame:
    """The nodes of the forest in MLlib's layout."""
    edge = np.array([[*c, *[math.inf] * (p.bins - len(c))] for c in cuts])

    def work(_, trees, bins, codes, tests):
        for tree in trees:
            t = grow(p, bins, codes, tree)
            s = t.counts @ p.stats()
            inner = t.feature >= 0
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.reshape(-1)))
            cols = [np.full(len(s), tree, np.int32), np.arange(len(s), dtype=np.int32), prediction(s, p.regression), impurity(s, p.regression), stats,
                    t.counts.sum(1).round().astype(np.int64), t.gain, t.left, np.where(inner, t.left + 1, -1).astype(np.int32),
                    t.feature.astype(np.int32), np.where(inner, edge[t.feature.clip(0), t.bin], 0.0)]
            whole = pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], [c.split()[0] for c in NODES.split(", ")])
            yield from whole.to_batches(max_chunksize=BLOCK)

    rows = _dealt(spark, folder, p, work, NODES)
    inner = F.col("feature") >= 0
    return rows.select("treeID", F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), "rawCount", "gain", "leftChild", "rightChild",
        F.struct(F.col("feature").alias("featureIndex"), F.when(inner, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                 F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))


def score_rows(spark: SparkSession, folder: str, p: Plan) -> DataFrame:
    """(y, raw, nodes): the forest's prediction for each packed test row; one more row has
    the number of nodes and nothing else."""
    schema = "chunk long, votes binary, y binary, nodes long"
    width = p.classes

    def work(g, trees, bins, codes, tests):
        votes = {c: np.zeros((len(rows), width), np.float64 if p.regression else np.float32) for c, (rows, _) in tests.items()}
        nodes = 0
        for tree in trees:
            t = grow(p, bins, codes, tree)
            nodes += len(t.feature)
            s = t.counts @ p.stats()
            says = prediction(s, True)[:, None] if p.regression else s / np.maximum(s.sum(1, keepdims=True), 1e-300)
            says = says.astype(np.float64 if p.regression else np.float32)
            for c, (rows, _) in tests.items():
                votes[c] += says[leaves(t, rows)]
        kinds = {"chunk": pa.int64(), "votes": pa.binary(), "y": pa.binary(), "nodes": pa.int64()}
        rows = ((c, votes.pop(c).tobytes(), tests[c][1] if g == 0 else None, 0) for c in sorted(tests))
        for row in chain([(-1, None, None, nodes)], rows):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds.values())], [*kinds])

    def added(table: pa.Table) -> pa.Table:
        out = {"y": pa.array([None], pa.int32()), "raw": pa.array([None], pa.float64()), "nodes": pa.array([sum(table["nodes"].to_pylist())], pa.int64())}
        if table["chunk"][0].as_py() >= 0:
            kind = np.float64 if p.regression else np.float32
            whole = sum(np.frombuffer(v.as_buffer(), kind).astype(np.float64) for v in table["votes"]).reshape(-1, width)
            raw = whole[:, 0] / p.trees if p.regression else whole.argmax(1).astype(np.float64)
            y = np.frombuffer(next(v.as_buffer() for v in table["y"] if v.is_valid), np.float64)
            out = {"y": pa.array(np.nan_to_num(y).astype(np.int32), mask=np.isnan(y)), "raw": pa.array(raw), "nodes": pa.nulls(len(raw), pa.int64())}
        return pa.table(out)

    votes = _dealt(spark, folder, p, work, schema)
    return votes.groupBy("chunk").applyInArrow(added, "y int, raw double, nodes long")


def packed(spark: SparkSession, train: DataFrame, test: DataFrame | None = None) -> str:
    """The packed sides written once; the folder."""
    path = scratch_path(spark, "forest-packed")
    (train if test is None else train.unionByName(test)).write.parquet(path)
    return path
