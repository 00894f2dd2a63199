"""Vector code compression: product codes, the nearest entry found by a GNAT.

A vector's components become integers, its equal consecutive parts are replaced
by the index of the nearest entry of the part's codebook, and the codebooks are
refined by a fixed number of exact rounds.  The entries of a codebook stand in
a geometric near-neighbor access tree: a node has split points, every other
entry belongs to the child of its nearest split point, and for each split point
and child the range of distances between them is stored.  A query's distance to
a split point rules out every child whose range cannot hold anything as near as
the best entry so far.  Distances are compared through square roots rounded
down or up so that a subtree only goes if it is strictly farther; what remains
is verified by integer squared distances, ties to the lower index.

Tasks assign whole batches and send, once a task, count and component sums of
each entry; the driver gets parts x entries x components numbers a round.

Defined results: a vector that is null or holds a null or non-finite component
is dropped; the dimension is that of the longest kept vector, rounded up to a
multiple of the parts, and shorter vectors are filled up with zeros; rows with
a null id come after all others and repeated rows count one by one; with fewer
kept rows than entries the codebooks are that much smaller; null labels are one
label; an empty table gives an empty result; other columns are not looked at.
A component of more than 2^26 after scaling raises an error: the squared
distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 26
#: split points of a node, and entries that stay together as a leaf
FANOUT, LEAF = 4, 3
SALTS = 32


def root_down(d: np.ndarray) -> np.ndarray:
    """An integer not above the square root (at most 2 below it)."""
    return np.maximum(np.sqrt(d.astype(np.float64)).astype(np.int64) - 1, 0)


def root_up(d: np.ndarray) -> np.ndarray:
    """An integer not below the square root (at most 2 above it)."""
    return np.sqrt(d.astype(np.float64)).astype(np.int64) + 2


class Gnat:
    """Nearest entry of a codebook (rows of an integer matrix) for many queries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.verified = 0  # distances computed, for tests
        gaps = self.entries[:, None, :] - self.entries[None, :, :]
        self.between = (gaps * gaps).sum(axis=2)
        self.root = self._grow(np.arange(len(entries))) if len(entries) else None

    def _grow(self, own: np.ndarray) -> tuple:
        """(splits, children, lo, hi) or (leaf entries,)."""
        if len(own) <= LEAF:
            return (own,)
        splits = [int(own[0])]
        while len(splits) < min(FANOUT, len(own)):  # the entry farthest from all split points so far
            far = self.between[np.ix_(own, splits)].min(axis=1)
            if far.max() == 0:  # only copies are left
                break
            splits.append(int(own[far.argmax()]))
        rest = own[~np.isin(own, splits)]
        if len(splits) == 1:  # all entries are equal
            return (own,)
        side = self.between[np.ix_(rest, splits)].argmin(axis=1)
        members = [rest[side == j] for j in range(len(splits))]
        children = [self._grow(m) if len(m) else None for m in members]
        whole = [np.append(m, s) for m, s in zip(members, splits)]
        lo = [[int(root_down(self.between[s, w].min())) for w in whole] for s in splits]
        hi = [[int(root_up(self.between[s, w].max())) for w in whole] for s in splits]
        return splits, children, lo, hi

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each query's nearest entry, ties to the lower index."""
        q = queries.astype(np.int64)
        best = np.full(len(q), np.iinfo(np.int64).max)
        index = np.full(len(q), len(self.entries), dtype=np.int64)
        if len(q):
            self._visit(self.root, np.arange(len(q)), q, best, index)
        return index, best

    def _verify(self, entry: int, rows: np.ndarray, q: np.ndarray, best: np.ndarray, index: np.ndarray) -> np.ndarray:
        gap = q[rows] - self.entries[entry]
        d = np.einsum("ij,ij->i", gap, gap)
        self.verified += len(rows)
        nearer = (d < best[rows]) | ((d == best[rows]) & (entry < index[rows]))
        best[rows[nearer]], index[rows[nearer]] = d[nearer], entry
        return d

    def _visit(self, node: tuple, rows: np.ndarray, q: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if len(node) == 1:
            for entry in node[0]:
                self._verify(int(entry), rows, q, best, index)
            return
        splits, children, lo, hi = node
        alive = np.ones((len(splits), len(rows)), dtype=bool)
        for i, split in enumerate(splits):
            at = np.flatnonzero(alive[i])
            d = self._verify(split, rows[at], q, best, index)
            below, above, reach = root_down(d), root_up(d), root_up(best[rows[at]])
            for j in range(len(splits)):
                if j != i:
                    alive[j, at] &= ~((below - reach > hi[i][j]) | (above + reach < lo[i][j]))
                elif children[i] is not None:
                    alive[i, at] = ~((below - reach > hi[i][i]) | (above + reach < lo[i][i]))
        for j, child in enumerate(children):
            if child is not None and alive[j].any():
                self._visit(child, rows[alive[j]], q, best, index)


def integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(id, label, v array<int>): the kept vectors, scaled and filled up."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = vectors.filter(v.isNotNull() & finite).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.alias("x"))
    longest = kept.agg(F.max(F.size("x"))).head()[0] or 0
    dims = max(-(-longest // parts) * parts, parts)
    scaled = F.transform("x", lambda c: F.floor(c * scale))
    checked = F.when(F.exists(scaled, lambda c: F.abs(c) > LARGEST), F.raise_error(F.lit(
        f"a component times {scale} is larger than {LARGEST}"))).otherwise(scaled.cast("array<int>"))
    full = F.concat(checked, F.array_repeat(F.lit(0), F.lit(dims) - F.size("x")))
    return kept.select("id", "label", full.alias("v"))


def matrices(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Each batch with its vectors as (rows, parts, components of a part)."""
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.reshape(batch.num_rows, parts, -1)


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, component) of the vectors with the smallest ids; ties in
    the id by the vector, so that reruns agree."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = len(first[0]["v"]) // parts if first else 0
    return np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to the mean
    of its parts, rounded down."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        count, total = np.zeros((parts, entries), dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for _, m in matrices(batches, parts):
            for p, tree in enumerate(trees):
                index, _ = tree.nearest(m[:, p])
                count[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, m[:, p])
        p, e, c = np.nonzero(np.broadcast_to(count[:, :, None] > 0, books.shape))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (p, e, c, count[p, e], total[p, e, c])], ["p", "e", "c", "n", "s"])

    found = (rows.select("v").mapInArrow(sums, "p long, e long, c long, n long, s long")
             .groupBy("p", "e", "c").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    out = books.copy()
    for r in found:
        out[r["p"], r["e"], r["c"]] = r["s"] // r["n"]
    return out


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) of ``integers`` rows."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = refine(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code array<int>, error): indexes in part order and the sum of the squared distances."""
    parts = len(books)
    id_type, label_type = rows.schema["id"].dataType.simpleString(), rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch, m in matrices(batches, parts):
            found = [tree.nearest(m[:, p]) for p, tree in enumerate(trees)]
            code = np.stack([index for index, _ in found], axis=1).astype(np.int32)
            ends = pa.array(np.arange(0, code.size + 1, parts), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(code.ravel())),
                 pa.array(np.sum([d for _, d in found], axis=0))], ["id", "label", "code", "error"])

    return rows.mapInArrow(run, f"id {id_type}, label {label_type}, code array<int>, error long")


def decode(code: list[int], books: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for (middle of the integer cells)."""
    return (np.concatenate([books[p][e] for p, e in enumerate(code)]) + 0.5) / scale


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error, label_error) of the kept vectors, and the codebooks."""
    rows = materialize(integers(vectors, id_col, vector_col, label_col, parts, scale), "vector-integers")
    books = train(rows, parts, entries, rounds)
    coded = materialize(encode(rows, books), "vector-codes")
    # a label's sum meets the label's rows in SALTS parts, so that a hot label is joined by many tasks
    by_label = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")).select(
        "l", "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    part = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int")
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("l")) & (part == F.col("salt")))
            .select("id", "label", "code", "error", "label_error")), books
