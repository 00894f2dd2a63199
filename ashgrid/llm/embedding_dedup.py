"""Embedding near-dedup by collision-counting projections.

Every vector, scaled to length one, is projected on many random lines.  Two
vectors at the wanted cosine fall into each other's window on most lines, and
two unrelated ones on few, so a pair is verified (exact cosine in double
precision) if it collides on at least ``MIN_COLLISIONS`` of ``LINES`` lines.

To meet at all, pairs need not be sorted against a whole label: ``TABLES``
times, a few other lines cut the space into cells, and the vectors of a cell are
sorted along the first line and compared inside query-centred windows.  The
number of lines that make a cell grows with the logarithm of the largest label,
the number of tables follows from the recall, so candidates per vector stay
bounded.  A pair that meets in several tables counts in the first one only, so
the tasks emit counts and a spanning set of links, never all pairs.

Cells of one vector are not shipped, and a cell larger than ``BLOCK`` is split
into blocks whose pairs are dealt to different tasks, each exact.

Recall of a pair exactly at cosine 0.98 (distance 0.2), with the defaults:
0.999 to meet, 0.9999 to pass the count; more for nearer pairs.

Defined results: a null label, a null or zero vector, one with null or
non-finite components, and vectors of other length than their label's partners
link with nothing; repeated rows with one id are one vector each in the counts
and share a component; a null id gets no component of its own and is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import components, roots

COSINE = 0.98
LINES, MIN_COLLISIONS = 32, 20
#: half a window, in distances at the wanted cosine: 87 in 100 such pairs collide on a line
WINDOW = 1.5
#: width of a cell in such distances, and how often a cell then holds both of a pair at that distance
CELL_WIDTH, SAME_CELL = 4.0, 0.80
#: how often a cell of that width holds both of two unrelated unit vectors
SAME_CELL_FAR = 0.22
RECALL = 0.999
BLOCK = 1024
SEED = 20240229


def cell_plan(largest: int, recall: float = RECALL) -> tuple[int, int]:
    """(lines per cell, tables) for labels of at most that many vectors."""
    lines = max(4, math.ceil(math.log(max(largest, 2)) / -math.log(SAME_CELL_FAR)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - SAME_CELL ** lines))
    return lines, tables


class Projections:
    """The random lines for one dimension; the same in every task."""

    def __init__(self, dim: int, lines: int, tables: int, cosine: float):
        rng = np.random.default_rng([SEED, dim])
        self.distance = math.sqrt(2 - 2 * cosine)
        self.tables, self.lines = tables, lines
        self.count = rng.standard_normal((dim, LINES))
        self.cut = rng.standard_normal((dim, lines * tables))
        self.shift = rng.random(lines * tables)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """One 64-bit cell number per table."""
        at = np.floor(x @ self.cut / (CELL_WIDTH * self.distance) + self.shift).astype(np.int64).view(np.uint64)
        at = at.reshape(len(x), self.tables, self.lines)
        with np.errstate(over="ignore"):
            out = np.arange(self.tables, dtype=np.uint64)[None, :] + np.zeros((len(x), 1), np.uint64)
            for k in range(self.lines):
                out = (out ^ at[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
        return out.view(np.int64)


def unit_vectors(col: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in col])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, v, label, dim) of the vectors that can link."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & v.isNotNull())
            .filter(finite & F.exists(v, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"),
                    F.col(label_col).cast("string").alias("label"), F.size(v).alias("dim")))


def in_cells(rows: DataFrame, lines: int, tables: int, cosine: float) -> DataFrame:
    """(rid, label, dim, cells): the cell of each vector in each table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, Projections] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                p = known.setdefault(dim, Projections(dim, lines, tables, cosine))
                yield pd.DataFrame({"rid": part["rid"].values, "label": part["label"].values, "dim": part["dim"].values,
                                    "cells": list(p.cells(unit_vectors(part["v"])))})

    return rows.select("rid", "label", "dim", "v").mapInPandas(run, "rid long, label string, dim int, cells array<long>")


def compare(group: pd.DataFrame, p: Projections, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs among the rows of whole (cell, block pair) groups,
    sorted by group and by the place on the first line."""
    x = unit_vectors(group["v"])
    at = x @ p.count
    half = WINDOW * p.distance
    order = np.lexsort((at[:, 0], group["g"].values))
    x, at, g = x[order], at[order], group["g"].values[order]
    cells = p.cells(x)
    side, cross, table = group["side"].values[order], group["cross"].values[order], group["t"].values[order]
    left, right = [], []
    rows = np.arange(len(g))
    ahead = 1
    while rows.size:
        rows = rows[rows + ahead < len(g)]
        near = (g[rows] == g[rows + ahead]) & (at[rows + ahead, 0] - at[rows, 0] <= half * FIRST_LINE)
        rows = rows[near]
        a, b = rows, rows + ahead
        ok = ~cross[a] | (side[a] != side[b])
        a, b = a[ok], b[ok]
        hits = (np.abs(at[a] - at[b]) <= half).sum(axis=1) >= MIN_COLLISIONS
        a, b = a[hits], b[hits]
        same = cells[a] == cells[b]
        first = same.argmax(axis=1) == table[a]
        a, b = a[first], b[first]
        close = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
        left.append(order[a[close]]), right.append(order[b[close]])
        ahead += 1
    return (np.concatenate(left), np.concatenate(right)) if left else (np.array([], int), np.array([], int))


#: the sweep along the first line goes this many half windows far, beyond 4 sigma of a pair at the wanted distance
FIRST_LINE = 3.0


def links(rows: DataFrame, cells: DataFrame, lines: int, tables: int, cosine: float) -> DataFrame:
    """(u, v, n): partial results of the tasks, one row per vector and stretch of
    cells and not per pair: n links found at u, which is connected to v."""
    each = cells.select("rid", "label", "dim", F.posexplode("cells").alias("t", "cell"))
    shared = each.groupBy("label", "dim", "t", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = each.join(shared, ["label", "dim", "t", "cell"]).select(
        "rid", "label", "dim", "t", "cell", blocks.alias("blocks"),
        F.pmod(F.xxhash64("rid"), blocks).cast("int").alias("block"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rid", "t", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        F.xxhash64("label", "dim", "t", "cell").alias("g1"), "dim")
    full = (dealt.join(rows.select("rid", "v"), "rid")
            .repartition("g1", "p", "q").sortWithinPartitions("dim", "g1", "p", "q"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, Projections] = {}
        held = None

        def solve(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for dim, d in part.groupby("dim", sort=False):
                p = known.setdefault(dim, Projections(dim, lines, tables, cosine))
                d = d.reset_index(drop=True)
                d["g"] = d.groupby(["g1", "p", "q"], sort=False).ngroup()
                d["cross"], d["side"] = d["p"] != d["q"], d["block"]
                a, b = compare(d, p, cosine)
                if not len(a):
                    continue
                rid = d["rid"].values
                count = np.bincount(np.r_[a, b], minlength=len(d))
                some = np.flatnonzero(count)
                yield pd.DataFrame({"u": rid[some], "v": rid[roots(len(d), a, b)[some]], "n": count[some]})

        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            key = batch[["g1", "p", "q"]].values
            new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if not new.size:  # one group so far; groups are bounded by two blocks
                held = batch
                continue
            held = batch.iloc[new[-1]:]
            yield from solve(batch.iloc[:new[-1]])
        if held is not None:
            yield from solve(held)

    return full.select("rid", "t", "block", "p", "q", "g1", "dim", "v").mapInPandas(run, "u long, v long, n long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    A task reports for each vector the first vector that the links it found
    connect it with: these spans of partial components join to the whole ones."""
    rows = valid(vectors, id_col, vector_col, label_col)
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    largest = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    lines, tables = cell_plan(int(largest), recall)
    cells = materialize(in_cells(rows, lines, tables, cosine), "cells")
    found = materialize(links(rows, cells, lines, tables, cosine), "vector-links")
    ids = rows.select("rid", "id")
    n_links = found.groupBy("u").agg(F.sum("n").alias("n_links"))
    per_row = materialize(ids.join(n_links, ids["rid"] == n_links["u"], "left").select(
        "rid", "id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "vector-counts")
    edges = (found.select("u", "v").filter("u <> v").distinct()
             .join(ids.select(F.col("rid").alias("u"), F.col("id").alias("a")), "u")
             .join(ids.select(F.col("rid").alias("v"), F.col("id").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    comp = components(edges)
    per_id = per_row.groupBy("id").agg(F.max("n_links").alias("n_links"))
    per_id = per_id.join(comp, per_id["id"] == comp["node"], "left").select("id", "n_links", "component")
    key = F.col(id_col).cast("long")
    return (vectors.select(key.alias("id")).join(per_id, "id", "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
