"""Packing documents into sequences of fixed length.

Tasks tokenize and cut documents into pieces.  What decides the packing is the
histogram of piece lengths, at most ``limit`` numbers however many documents
there are: a configuration linear program over it (a column is a set of lengths
that fits one sequence) is solved by multiplicative weights in several phases, with a knapsack dynamic
program that prices the best columns for the current weights.  Where the best
phase is more than ``GAP`` above the size bound, columns are generated from the
program's own dual prices, within ``GAP`` of its optimum or for a bounded number
of steps.  The
fractional solution is rounded down, what is left is packed best fit on the
histogram, badly filled columns too if that saves sequences, and every piece
finds its place by its rank among the pieces of its length.  No step depends on
the number of pieces.

Defined results: a null text is empty and still has its end token; repeated
rows are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import draw32, positions, text_or_empty

LIMIT, END_ID = 1024, 2
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
LONG_WORD = 200
#: entries of a worker's cache of tokenized words; when full it starts anew
CACHE_ENTRIES = 400_000
#: white space that pre-tokenization looks at as a whole
UNSAFE = re.compile(r"\s \s|\s $")
RANK_BUCKETS = 256
#: columns filled less than this are also tried unpacked again
LOOSE = 0.998
#: how far, as a share, the fractional solution may lie above the program's lower bound
GAP = 0.0005
#: pivots between two looks at how far the inverse has drifted
REFRESH = 200
#: columns that one pricing adds at most
NEW_COLUMNS = 60
#: first weights are (length / limit) ** POWER: of two full columns the one with longer pieces is dearer
POWER = 1.1


class TextTokens:
    """Token ids of whole texts as little-endian 32-bit bytes.

    Byte-level BPE never merges across the boundary before a space that ends a
    run of white space, so a text is tokenized word by word and words are
    looked up in a bounded cache; texts with longer runs of white space or with
    an added token (one id, as the tokenizer has it) are tokenized whole.  New words go to the same vocabulary as ranks, which takes
    a quarter of the time for single words; texts and long words go to the
    tokenizer itself."""

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.word_ids = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        return np.array(self.word_ids(word), dtype="<u4").tobytes() if len(word) <= LONG_WORD else self.whole(word)

    def batch(self, texts: list[str]) -> list[bytes]:
        known, out = self.cache, []
        for t in texts:
            if UNSAFE.search(t) or any(a in t for a in self.added):
                out.append(self.whole(t))
                continue
            first, *rest = t.split(" ")
            new = set(rest).difference(known)
            if len(known) + len(new) > CACHE_ENTRIES:
                known.clear()
                new.update(rest)
            known.update((w, self.word(" " + w)) for w in new)
            out.append(self.word(first) + b"".join(map(known.__getitem__, rest)))
        return out


_TOKENS: dict[tuple[str, str], TextTokens] = {}


def tokens_of(path: str, ranks: str) -> TextTokens:
    """One per Python worker; bare names are files of the public tokenizers."""
    if (path, ranks) not in _TOKENS:
        import public_tokenizers

        _TOKENS[path, ranks] = TextTokens(*(x if "/" in x else public_tokenizers.path(x) for x in (path, ranks)))
    return _TOKENS[path, ranks]


def cuts(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first may be shorter."""
    if total <= limit:
        return [(0, total)]
    first = total % limit or limit
    return [(0, first), *[(s, limit) for s in range(first, total, limit)]]


def pieces(docs: DataFrame, id_col: Column, text: Column, limit: int = LIMIT, end_id: int = END_ID,
           tokenizer: str = TOKENIZER, ranks: str = RANKS, with_ids: bool = False, slice_texts: int = 512) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked
    for, the ids as little-endian 32-bit bytes."""
    d = docs.select(id_col.alias("doc_id"), text_or_empty(text).alias("text"))
    fields = [T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens_of(tokenizer, ranks).batch
        for whole in batches:
            for at in range(0, whole.num_rows, slice_texts):
                batch = whole.slice(at, slice_texts)
                row, nth, start, length, crc, ids = [], [], [], [], [], []
                for i, tokens in enumerate(encode(batch.column(1).to_pylist())):
                    tokens += end
                    for k, (s, n) in enumerate(cuts(len(tokens) // 4, limit)):
                        own = tokens[4 * s: 4 * (s + n)]
                        row.append(i), nth.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(own)
                out = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())] + ([pa.array(ids, pa.binary())] if with_ids else [])
                yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return d.mapInArrow(run, T.StructType(fields))


def dear_columns(prices: np.ndarray, limit: int, share: float = 0.0, most: int = LIMIT) -> list[tuple[tuple[int, int], ...]]:
    """The dearest column that fits (unbounded knapsack), and after it, for each
    length, the dearest column with that length if it is worth at least 1 - ``share``
    of the dearest (the ``most`` dearest of these).  ``prices`` by length, -inf where there is no piece of that length."""
    best = np.zeros(limit + 1)  # best[limit - c]: of capacity c
    took = np.zeros(limit + 1, dtype=np.int64)
    for c in range(1, limit + 1):
        value = best[limit - c + 1:] + prices[1:c + 1]
        j = int(value.argmax())
        before = best[limit - c + 1]
        if value[j] > before:
            best[limit - c], took[c] = value[j], j + 1
        else:
            best[limit - c] = before

    def column(c: int, first: int) -> tuple[tuple[int, int], ...]:
        out: dict[int, int] = {first: 1} if first else {}
        while c > 0:
            n = int(took[c])
            if n:
                out[n] = out.get(n, 0) + 1
            c -= n or 1
        return tuple(sorted(out.items()))

    found = {column(limit, 0): None}
    if share:
        value = prices[1:] + best[1:]  # of length k together with the rest of the room, limit - k
        near = np.flatnonzero(value >= (1 - share) * best[0])
        for k in near[np.argsort(-value[near], kind="stable")][:most].tolist():
            found[column(limit - k - 1, k + 1)] = None
    return list(found)


def waste_of(column: tuple[tuple[int, int], ...], limit: int) -> float:
    return 1 - sum(k * n for k, n in column) / limit


def cover(demand: np.ndarray, weight: np.ndarray, limit: int) -> tuple[dict[tuple[tuple[int, int], ...], float], dict[int, tuple[tuple[int, int], ...]]]:
    """All demand covered at fixed weights: again and again the dearest columns (to
    within GAP) of the lengths that are left, as often as their scarcest length
    allows.  With it, for each length in the order in which they were used up, the
    column that used up its last pieces."""
    left, x, last = demand.copy(), {}, {}
    while (left > 0).any():
        for column in dear_columns(np.where(left > 0, weight, -np.inf), limit, GAP):
            step = min(left[k] / n for k, n in column)
            if step > 0:
                x[column] = x.get(column, 0.0) + step
                used = [k for k, n in column if left[k] - step * n <= 1e-9 * demand[k]]
                for k, n in column:
                    left[k] -= step * n
                left[used] = 0.0
                last[used[0]] = column
                last.update((k, ((k, limit // k),)) for k in used[1:])
    return x, last


def solve(counts: dict[int, int], limit: int, phases: int = 4, eta: float = 8.0) -> dict[tuple[tuple[int, int], ...], float]:
    """Fractional solution of the configuration program: column -> sequences.

    Multiplicative weights: every phase covers the whole demand at its weights;
    lengths that had to travel in columns that were not full gain weight by
    exp(eta * waste * share), so that the next phase prices them into better
    company first.  Phases go on until the best one is within GAP of the size
    bound, or two in a row are no better.  ``generate`` brings the best phase
    nearer to the optimum where the size bound is out of reach."""
    demand = np.zeros(limit + 1)
    demand[list(counts)] = list(counts.values())
    bound = sum(k * n for k, n in counts.items()) / limit
    weight = (np.arange(limit + 1) / limit) ** POWER
    best, basis, worse = None, {}, 0
    for _ in range(phases):
        x, last = cover(demand, weight, limit)
        if best is None or sum(x.values()) < (1 - GAP / 10) * sum(best.values()):
            best, basis, worse = x, last, 0
        else:
            worse += 1
        if sum(best.values()) <= (1 + GAP) * bound:
            return best
        if worse == 2:
            break
        gain = np.zeros(limit + 1)
        for column, times in x.items():
            for k, n in column:
                gain[k] += waste_of(column, limit) * times * n / demand[k]
        weight = weight * np.exp(eta * gain)
        weight /= weight.max()
    return min(best, generate(counts, limit, basis), key=lambda x: sum(x.values()))


def inverse_of(columns: list[tuple[list[int], np.ndarray]]) -> np.ndarray:
    """Inverse of a triangular basis: column j is the first to hold length j of
    those in the order given by ``cover``, whose rows it then only shares with
    columns before it."""
    size = len(columns)
    before: list[list[tuple[int, float]]] = [[] for _ in range(size)]
    for j, (at, n) in enumerate(columns):
        for i, times in zip(at, n):
            before[i].append((j, times))
    inverse = np.zeros((size, size))
    for i in range(size):
        row = np.zeros(size)
        row[i] = 1
        for j, times in before[i]:
            if j != i:
                row -= times * inverse[j]
        inverse[i] = row / dict(before[i])[i]
    return inverse


def generate(counts: dict[int, int], limit: int, start: dict[int, tuple[tuple[int, int], ...]],
             most_pivots: int = 1000) -> dict[tuple[tuple[int, int], ...], float]:
    """Column generation, from the basis that ``cover`` ended with (a column for
    each length; in the order in which they were used up it is triangular).

    The dual prices of the basis price the next columns; the sum of the basis
    divided by the dearest column's price bounds the optimum from below.  It ends
    within GAP of that bound, after ``most_pivots`` pivots, or when the sum has not
    fallen by GAP * GAP in as many pivots as there are lengths: every basis is a
    whole solution, so it may stop anywhere.  Sums over the matrices are numpy's
    own loops, as a threaded library can block inside a Spark driver."""
    lengths = list(start)
    place = {k: i for i, k in enumerate(lengths)}
    demand = np.array([counts[k] for k in lengths], dtype=float)
    demand *= (1 + 1e-5 * np.random.default_rng(0).random(len(lengths))) / demand.sum()  # no ties between rows
    basis = list(start.values())

    def sparse(column: tuple[tuple[int, int], ...]) -> tuple[list[int], np.ndarray]:
        return [place[k] for k, _ in column], np.array([n for _, n in column], dtype=float)

    inverse = inverse_of([sparse(column) for column in basis])
    x, prices = np.maximum(np.einsum("ij,j->i", inverse, demand), 0), inverse.sum(axis=0)
    product = np.empty_like(inverse)
    before, since = x.sum(), 0
    waiting: list[tuple[tuple[int, int], ...]] = []
    for pivot in range(1, most_pivots + 1):
        worth = [sum(prices[place[k]] * n for k, n in column) for column in waiting]
        if not waiting or max(worth) <= 1 + GAP:  # no known column helps
            by_length = np.full(limit + 1, -np.inf)
            by_length[lengths] = prices
            waiting = dear_columns(by_length, limit, 0.02, NEW_COLUMNS)
            worth = [sum(prices[place[k]] * n for k, n in column) for column in waiting]
            if worth[0] <= 1 + GAP:
                break
        enter = int(np.argmax(worth))
        column, value = waiting.pop(enter), worth[enter]
        at, n = sparse(column)
        change = (inverse[:, at] * n).sum(axis=1)
        able = change > 1e-7 * max(np.abs(change).max(), 1.0)
        if not able.any():
            continue
        ratio = np.where(able, x / np.where(able, change, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        x = np.maximum(x - step * change, 0)
        x[leave] = step
        row = inverse[leave] / change[leave]
        np.multiply(change[:, None], row, out=product)
        inverse -= product
        inverse[leave] = row
        prices = prices + (1 - value) * row
        basis[leave] = column
        if pivot % REFRESH == 0:
            held = np.zeros(len(lengths))
            for times, c in zip(x, basis):
                own, n = sparse(c)
                held[own] += times * n
            if np.abs(held - demand).max() > 1e-6 * demand.max():  # rounding has gone too far: what there is is good enough
                break
        if x.sum() < (1 - GAP * GAP) * before:
            before, since = x.sum(), 0
        else:
            since += 1
            if since > len(lengths):
                break
    out: dict[tuple[tuple[int, int], ...], float] = {}
    for column, times in zip(basis, x):
        if times > 0:
            out[column] = out.get(column, 0.0) + float(times) * sum(counts.values())
    return out


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Best fit decreasing: each piece into the fullest sequence that takes it."""
    room: list[tuple[int, int]] = []
    out: list[list[int]] = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = limit, len(out)
            out.append([])
        out[b].append(n)
        insort(room, (left - n, b))
    return out


def best_fit_counts(counts: dict[int, int], limit: int) -> dict[tuple[tuple[int, int], ...], int]:
    """Best fit decreasing on the histogram: column -> sequences, the work as
    much as there are different columns.  The fullest sequence that takes a
    length takes as many of it as it has room for."""
    bins: dict[int, dict[tuple[tuple[int, int], ...], int]] = {}
    rooms: list[int] = []

    def put(room: int, column: tuple[tuple[int, int], ...], n: int) -> None:
        if room not in bins:
            bins[room] = {}
            insort(rooms, room)
        bins[room][column] = bins[room].get(column, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else limit
            column, there = bins[room].popitem() if at < len(rooms) else ((), left)
            times = min(room // length, left)
            n = min(there, left // times)
            if at < len(rooms):
                if there > n:
                    bins[room][column] = there - n
                if not bins[room]:
                    del bins[room], rooms[at]
            put(room - times * length, (*column, (length, times)), n)
            left -= n * times
    out: dict[tuple[tuple[int, int], ...], int] = {}
    for columns in bins.values():
        for column, n in columns.items():
            out[tuple(reversed(column))] = out.get(tuple(reversed(column)), 0) + n
    return out


def plan(counts: dict[int, int], limit: int, phases: int = 4) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, lo, hi, times, sequence, offset): the pieces of that length
    with ranks lo..hi-1 go ``times`` to a sequence from ``sequence`` on, the
    first of them at ``offset``.  At most 45 rows a column (distinct lengths
    that fit one sequence), whatever the number of pieces."""
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0

    def place(column: tuple[tuple[int, int], ...], copies: int) -> None:
        nonlocal sequence
        offset = 0
        for length, times in column:
            lo = used[length]
            used[length] = lo + times * copies
            rows.append((length, lo, used[length], times, sequence, offset))
            offset += length * times
        sequence += copies

    if full := counts.get(limit, 0):
        place(((limit, 1),), full)
    rest = {k: n for k, n in counts.items() if k < limit and n}
    if rest:
        solution = solve(rest, limit, phases)

        def filled(least: float) -> list[tuple[tuple[tuple[int, int], ...], int]]:
            """The solution's whole columns filled as much at least, and best fit for the rest."""
            free, out = dict(rest), []
            for column in sorted(solution, key=lambda c: (sum(k * n for k, n in c), c)):
                copies = min(int(solution[column] + 1e-6), min(free[k] // n for k, n in column))
                if copies and sum(k * n for k, n in column) >= least * limit:
                    out.append((column, copies))
                    for k, n in column:
                        free[k] -= n * copies
            return out + list(best_fit_counts({k: n for k, n in free.items() if n}, limit).items())

        # columns kept as they are, loose ones unpacked, or all pieces best fit: the fewest sequences
        for column, copies in min((filled(least) for least in (LOOSE, 0, 2)), key=lambda c: sum(n for _, n in c)):
            place(column, copies)
    return rows


def pack(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``cut`` (materialized pieces) with sequence_id and offset.

    The driver gets at most ``limit`` counts; the plan that it broadcasts has
    at most 45 rows for each of the few thousand columns."""
    spark = cut.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(plan(counts, limit),
                                   "length long, lo long, hi long, times long, first long, begin long")
    bucket = draw32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece").cast("string")) % RANK_BUCKETS
    ranked = positions(cut.withColumn("__bucket", bucket), ["length"], "__bucket",
                       [F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")], "__rank").drop("__bucket")
    nth = F.col("__rank") - F.col("lo")
    return (ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi")))
            .select(*[ranked[c] for c in cut.columns],
                    (F.col("first") + F.floor(nth / F.col("times"))).cast("long").alias("sequence_id"),
                    (F.col("begin") + nth % F.col("times") * ranked["length"]).cast("long").alias("offset")))
