"""Phrase mining on a weighted de Bruijn graph of words.

Nodes are the grams one word shorter than the longest phrase, an edge leads
from a node to the node that overlaps it in all words but the first, and is
weighted by the occurrences of its longest gram.  Tasks walk over whole texts
and emit, for the position of every word, the longest gram that starts there:
an edge, or near the end of a piece the shorter gram that is left (the piece-end
correction).  A local graph adds up equal edges first.  The count of any
shorter gram is then the flow out of it: the weights of all edges and
corrections that begin with it.  Paths are compacted where a node (or gram) is
part of an edge that carries enough of its flow: it is absorbed, and a unary
node, whose only edge carries all of it, always is.  A longer path than the
longest phrase would be never read, so none is spelled out.

Edges are dealt by their node, so that one exchange serves edges and flows; a
task adds up what it gets in Arrow tables, which hold the different edges of its
partition.  Nodes that hold more than 1/1024 of the edges of a sample of the
documents (at most 1024 such nodes) are dealt by their next word too, in SALTS
parts, and their partial flows are added up; the sample only spreads the work.

Counts are exact longs; scores are whole numbers computed from decimals of 38
digits.  Defined results: a null text is empty; a null group is the group
``und``; repeated rows count each; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

#: a piece ends at one of these
BREAKS = ".,;:!?\n\x0b\f\r"
#: bytes that end pieces become 0xFF, which no UTF-8 text holds; tabs become spaces
BYTES = bytes.maketrans((string.ascii_uppercase + BREAKS + "\t").encode(),
                        string.ascii_lowercase.encode() + b"\xff" * len(BREAKS) + b" ")
#: bytes of text and tokens looked at in one go, distinct local edges before they are sent, and words of a local vocabulary
SLICE_BYTES, SLICE_TOKENS, LOCAL_EDGES, LOCAL_WORDS = 2 << 20, 400_000, 1_000_000, 1 << 19
SENT_ROWS = 100_000
EDGE = ["node", "salt", "next", "n"]
SALTS = 64
#: share of the documents in which crowded nodes are looked for, and the share of edges that makes one
SAMPLE, CROWDED = 32, 1024


class LocalGraph:
    """Weights of the edges of one group, by ids of a local vocabulary.

    An edge of ``size`` words is one number, its word ids as digits (0: none)."""

    def __init__(self, size: int, crowded: list[str]):
        self.size, self.crowded = size, crowded
        self.ids: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.held = 0

    def add(self, tokens: list[bytes], starts: int) -> None:
        """The grams that start at the first ``starts`` tokens; b"\\xff" ends a piece."""
        ids = self.ids
        for w in set(tokens).difference(ids, [b"\xff"]):
            ids[w] = len(ids) + 1
        ids[b"\xff"] = 0
        t = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        del ids[b"\xff"]
        # word ids stay below LOCAL_WORDS + SLICE_TOKENS + size < 2^21, so three of them fit 63 bits
        grams, inside = t, t > 0
        for k in range(1, self.size):
            following = np.concatenate([t[k:], np.zeros(min(k, len(t)), dtype=np.int64)])
            inside = inside & (following > 0)
            grams = (grams << 21) | np.where(inside, following, 0)
        keys, weights = np.unique(grams[:starts][t[:starts] > 0], return_counts=True)
        self.keys.append(keys)
        self.weights.append(weights)
        self.held += len(keys)

    def combine(self) -> None:
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(self.weights)).astype(np.int64)
        self.keys, self.weights, self.held = [keys], [total], len(keys)

    def rows(self, group: str) -> Iterator[pa.RecordBatch]:
        """(node, salt, next, n), ordered by node; a node is its words (empty
        where a piece ended) and the group, with line feeds between."""
        self.combine()
        words = sorted(self.ids)
        rank = np.zeros(len(words) + 1, dtype=np.int64)
        rank[[self.ids[w] for w in words]] = np.arange(1, len(words) + 1)
        digits = np.stack([rank[(self.keys[0] >> (21 * (self.size - 1 - k))) & 0x1FFFFF] for k in range(self.size)])
        order = np.lexsort(digits[::-1])
        digits, weights = digits[:, order], self.weights[0][order]
        table = pa.array([None, *words], pa.binary()).cast(pa.string())
        for at in range(0, len(weights), SENT_ROWS):
            own, n = digits[:, at:at + SENT_ROWS], weights[at:at + SENT_ROWS]
            texts = [pc.fill_null(table.take(pa.array(d)), "") for d in own[:-1]]
            node = pc.binary_join_element_wise(*texts, pa.scalar(group), "\n")
            salt = np.zeros(len(n), dtype=np.int32)
            if self.crowded:
                hit = pc.is_in(node, value_set=pa.array(self.crowded, pa.string())).to_numpy(zero_copy_only=False)
                part = {d: 1 + zlib.crc32(words[d - 1] if d else b"") % SALTS for d in set(own[-1][hit].tolist())}
                salt[hit] = [part[d] for d in own[-1][hit].tolist()]
            yield pa.RecordBatch.from_arrays([node, pa.array(salt), table.take(pa.array(own[-1])), pa.array(n)], EDGE)


def slices(texts: list[str], size: int) -> Iterator[tuple[list[bytes], int]]:
    """(tokens, how many of them start a gram): about SLICE_BYTES of texts at
    once, and of a longer text SLICE_TOKENS with the words its last grams need."""
    held, n = [], 0
    for i, t in enumerate(texts):
        held.append(t.encode().translate(BYTES))
        n += len(held[-1])
        if n >= SLICE_BYTES or i == len(texts) - 1:
            tokens = b"\xff".join(held).replace(b"\xff", b" \xff ").split()
            for at in range(0, len(tokens), SLICE_TOKENS):
                yield tokens[at:at + SLICE_TOKENS + size - 1], SLICE_TOKENS
            held, n = [], 0


def local_edges(docs: DataFrame, group: Column, text: Column, size: int, crowded: list[str]) -> DataFrame:
    """(node, salt, next, n): the edges and piece ends of each task's documents,
    added up as far as its memory allows."""
    if not 2 <= size <= 3:
        raise ValueError("phrases have 2 or 3 words")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graphs: dict[str, LocalGraph] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(g, []).append(t)
            for g, texts in by.items():
                for tokens, starts in slices(texts, size):
                    graph = graphs.setdefault(g, LocalGraph(size, crowded))
                    graph.add(tokens, starts)
                    if graph.held > LOCAL_EDGES:
                        graph.combine()
                    if graph.held > LOCAL_EDGES / 2 or len(graph.ids) > LOCAL_WORDS:
                        yield from graphs.pop(g).rows(g)
                    elif sum(x.held for x in graphs.values()) > LOCAL_EDGES:
                        largest = max(graphs, key=lambda k: graphs[k].held)
                        yield from graphs.pop(largest).rows(largest)
        for g, graph in graphs.items():
            yield from graph.rows(g)

    return docs.select(F.coalesce(group.cast("string"), F.lit("und")), text_or_empty(text)).mapInArrow(
        run, "node string, salt int, next string, n long")


def crowded_nodes(docs: DataFrame, group: Column, text: Column, size: int) -> list[str]:
    """Nodes with more than 1/CROWDED of the edges in a share of the documents
    (by hash of the text); there are fewer than CROWDED of them."""
    part = docs.filter(F.pmod(F.xxhash64(text_or_empty(text)), F.lit(SAMPLE)) == 0)
    nodes = local_edges(part, group, text, size, []).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    nodes = materialize(nodes, "phrase-sample")
    total = nodes.agg(F.sum("n")).head()[0] or 0
    return [r["node"] for r in nodes.filter(F.col("n") > max(total // CROWDED, 1)).select("node").collect()]


def flows(edges: DataFrame, size: int, min_count: int) -> DataFrame:
    """(k, g, phrase, f) of edges dealt by node and salt: k = 1, parts of the
    counts of single words; 1 < k < size, counts (of crowded nodes: parts) of the
    nodes of two words; k = size, the frequent edges.  Rarer nodes and edges
    only live on in the flow of their first word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = least = 0

        def combined() -> pa.Table:
            whole = pa.concat_tables(held).combine_chunks()
            out = whole.group_by(["node", "salt", "next"], use_threads=False).aggregate([("n", "sum")]).rename_columns(EDGE)
            held.clear()
            del whole
            pa.default_memory_pool().release_unused()
            return out

        for batch in batches:
            held.append(pa.table(batch))
            rows += batch.num_rows
            if rows > max(LOCAL_EDGES // 2, 2 * least):
                held.append(combined())
                rows = least = held[0].num_rows
        if not rows:
            return
        table = combined()
        nodes = table.group_by(["node", "salt"], use_threads=False).aggregate([("n", "sum")])

        def words(node: pa.ChunkedArray) -> list[pa.Array]:
            """The words of the nodes, and last the group."""
            parts = pc.split_pattern(node.combine_chunks(), "\n", max_splits=size - 1)
            return [pc.list_element(parts, i) for i in range(size)]

        def sent(k: int, group: pa.Array, phrase: pa.Array, f: pa.Array) -> Iterator[pa.RecordBatch]:
            out = pa.table({"k": pa.array(np.full(len(phrase), k, dtype=np.int32)), "g": group, "phrase": phrase, "f": f})
            yield from out.to_batches(max_chunksize=SENT_ROWS)

        for at in range(0, nodes.num_rows, 4 * SENT_ROWS):
            part = nodes.slice(at, 4 * SENT_ROWS)
            *own, group = words(part["node"])
            first = pa.table({"g": group, "phrase": own[0], "f": part["n_sum"]}).group_by(["g", "phrase"], use_threads=False).aggregate([("f", "sum")])
            yield from sent(1, first["g"], first["phrase"], first["f_sum"])
            if size == 3:
                often = pc.and_(pc.not_equal(own[1], ""), pc.or_(pc.greater(part["salt"], 0), pc.greater_equal(part["n_sum"], min_count)))
                pair = pc.binary_join_element_wise(own[0].filter(often), own[1].filter(often), " ")
                yield from sent(2, group.filter(often), pair, part["n_sum"].filter(often))
        del nodes
        often = table.filter(pc.and_(pc.is_valid(table["next"]), pc.greater_equal(table["n"], min_count)))
        if often.num_rows:
            *own, group = words(often["node"])
            yield from sent(size, group, pc.binary_join_element_wise(*own, often["next"].combine_chunks(), " "), often["n"])

    return edges.repartition("node", "salt").mapInArrow(run, "k int, g string, phrase string, f long")


def counts(docs: DataFrame, group: Column, text: Column, size: int = 3, min_count: int = 10) -> list[DataFrame]:
    """(g, phrase, f): all single words, and the frequent grams of 2 to ``size`` words."""
    edges = local_edges(docs, group, text, size, crowded_nodes(docs, group, text, size))
    found = materialize(flows(edges, size, min_count), "phrase-flows")
    out = []
    for k in range(1, size + 1):
        level = found.filter(F.col("k") == k).select("g", "phrase", "f")
        if k < size:
            level = level.groupBy("g", "phrase").agg(F.sum("f").alias("f"))
        out.append(level if k == 1 else level.filter(F.col("f") >= min_count))
    return out


def collocations(docs: DataFrame, group: Column, text: Column, size: int = 3, min_count: int = 10, absorb_pct: int = 50,
                 scale: int = 1_000_000) -> DataFrame:
    """(g, phrase, a, l, r, n, score) of the phrases of 2 to ``size`` words that
    are found ``min_count`` times at least and are not part of a longer one with
    ``absorb_pct`` percent of their count; l and r belong to the cut with the
    lowest score floor(scale * a * a / (l * r)), the first of equals."""
    levels = [level.withColumn("k", F.lit(k + 1)) for k, level in enumerate(counts(docs, group, text, size, min_count))]
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    grams = materialize(grams, "phrase-counts")
    totals = grams.filter("k = 1").groupBy("g").agg(F.sum("f").alias("n"))
    known = grams.filter((F.col("k") < size) & (F.col("f") >= min_count))
    found = grams.filter("k > 1").withColumnRenamed("f", "a")

    # compaction: each longer phrase meets the two that it consists of
    inside = F.array(F.expr("left(phrase, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)"),
                     F.expr("substr(phrase, instr(phrase, ' ') + 1)"))
    longer = (found.filter("k > 2").select("g", F.explode(inside).alias("phrase"), F.col("a").alias("b"))
              .groupBy("g", "phrase").agg(F.max("b").alias("b")))
    left = (found.join(longer, ["g", "phrase"], "left")
            .filter(F.col("b").isNull() | (F.col("b") * 100 < F.col("a") * absorb_pct)).drop("b"))

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    rows = left.select("g", "phrase", "a", cut).withColumn("x", F.expr("substring_index(phrase, ' ', cut)"))
    rows = rows.withColumn("y", F.expr("substr(phrase, length(x) + 2)"))
    first = known.select("g", F.col("phrase").alias("x"), F.col("f").alias("l"))
    rest = known.select("g", F.col("phrase").alias("y"), F.col("f").alias("r"))
    wide = "cast({} as decimal(19, 0))"
    score = F.expr(f"cast(cast({scale} as decimal(38, 0)) * ({wide.format('a')} * {wide.format('a')}) "
                   f"div ({wide.format('l')} * {wide.format('r')}) as long)")
    scored = rows.join(first, ["g", "x"]).join(rest, ["g", "y"]).select("g", "phrase", "a", "cut", "l", "r", score.alias("score"))
    best = scored.groupBy("g", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.join(totals, "g").select("g", "phrase", "a", "b.l", "b.r", "n", "b.score")


def top(found: DataFrame, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of each group by score, count and bytes, with ``rank``
    from 1.  A group is ranked in SALTS parts first, so that the task that ends
    it gets SALTS * ``first`` rows at most."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = parts.withColumn("nth", F.row_number().over(Window.partitionBy("g", "part").orderBy(*order))).filter(F.col("nth") <= first)
    rank = F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("long")
    return parts.drop("part", "nth").withColumn("rank", rank).filter(F.col("rank") <= first)
