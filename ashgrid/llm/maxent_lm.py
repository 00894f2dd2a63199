"""Language-model scoring by a hashed maximum-entropy model.

The probability of a word is that of its class times that of the word in its
class.  Head classes form families of ``FAMILY`` classes; a choice among the
families and the other classes comes first, then one among the classes of a
family, so no softmax is wide.  These choices and the words of the head classes
are log-linear in hashed features of the three words before: each of them
(n-gram and skips) and the pair next to the word.  The next known words by count
form classes of similar frequency, all other words one class; inside those a
word has its share of the class's counts, in the last one with one added and one
place for unseen words.

The model grows with the corpus: for every ``TYPES`` distinct words the hashed
tables have their least number of rows once more and a head class one more group
of ``CLASS_WORDS`` words, so a word of a class is reached by its group.

Training is distributed: in every round each task runs gradient steps (with
per-row step sizes) over its part of the training texts, starting from the
round's weights, and the tasks' changes are averaged in the cluster by blocks.
A part has about ``PART_TOKENS`` tokens (or a partition of the files, if that is
larger), so their number follows the corpus and not the cluster, and a lost
executor costs the parts that it held.
All training texts take part, each in one round (a second pass fits the
training texts at the cost of held-out ones).  Word counts cover all of them;
only the counts of the known words and one set of weights go through the driver.
Scoring runs over sparse numpy batches; words beyond the known ones are joined
with the whole count table.

Defined results: a null or blank text is its end token alone; words differ only
by ASCII case; repeated rows count and score each; without any training text
every score is that of an empty model; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialize, text_or_empty

#: the end token and the place before a text, as hashes of strings that are no words
END, START = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\n", b"\n\n"))
KNOWN, TYPES = 1 << 18, 1 << 20
#: sizes up to ``TYPES`` distinct words
HEAD_CLASSES, CLASS_WORDS, MID_CLASSES = 64, 32, 8
HEAD = HEAD_CLASSES * CLASS_WORDS
CLASSES = HEAD_CLASSES + MID_CLASSES + 1
RARE = CLASSES - 1
#: classes of a family, and what the first choice is among
FAMILY = 8
FAMILIES = HEAD_CLASSES // FAMILY
CHOICES = FAMILIES + CLASSES - HEAD_CLASSES
CLASS_ROWS, WORD_ROWS = 1 << 14, 1 << 14
ROUNDS, STEP, BATCH = 2, 0.1, 8192
BLOCKS = 32
#: upper bits of a hash that lead to the first known word with them
PLACES = 20
#: tokens of a part: each sends as much as all weights, however few texts it has
PART_TOKENS = 1 << 23
LN10 = np.log(10.0)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-cased words and the end token."""
    words = text.encode().lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some texts, and the number of tokens of each."""
    parts = [token_hashes(t) for t in texts]
    return np.concatenate(parts), np.array([len(p) for p in parts])


def slices(texts: pd.Series, most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters (one text at least)."""
    size, start = 0, 0
    for i, n in enumerate(texts.str.len()):
        if size and size + n > most:
            yield start, i
            size, start = 0, i
        size += n
    if len(texts):
        yield start, len(texts)


def word_counts(train: DataFrame) -> DataFrame:
    """(h, c): how often each word of the training texts occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                h, c = np.unique(joined(list(batch["text"]))[0], return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "c": c})

    return train.select("text").mapInPandas(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def groups_of(types: int) -> int:
    """Groups of words in a head class, and how many times the tables have their least rows."""
    return max(1, -(-types // TYPES))


class Vocabulary:
    """Ranks, counts, classes and groups of the most frequent words."""

    def __init__(self, h: np.ndarray, c: np.ndarray, tokens: int, types: int):
        order = np.lexsort((h, -c))
        h, c = h[order], c[order]
        rank = np.arange(len(h))
        self.groups = groups_of(types)
        self.head = head = HEAD * self.groups
        mid = np.minimum(MID_CLASSES - 1, np.log2(np.maximum(rank, head) / head).astype(np.int64))
        classes = np.where(rank < head, rank // (CLASS_WORDS * self.groups), HEAD_CLASSES + mid)
        size = np.bincount(classes, c, CLASSES)
        size[RARE] = tokens - c.sum()
        by_hash = np.argsort(h.view(np.uint64))
        self.h, self.c, self.rank, self.classes = h.view(np.uint64)[by_hash], c[by_hash], rank[by_hash], classes[by_hash]
        share = np.maximum(size, 0.5) / np.maximum(size, 0.5).sum()
        families = share[:HEAD_CLASSES].reshape(FAMILIES, FAMILY)
        self.choice_log = np.log(np.r_[families.sum(axis=1), share[HEAD_CLASSES:]]).astype(np.float32)
        self.family_log = np.log(families / families.sum(axis=1, keepdims=True)).astype(np.float32)
        inside = np.zeros(head)
        inside[:min(head, len(c))] = c[:head]
        with np.errstate(divide="ignore"):
            self.word_log = np.log(inside.reshape(-1, CLASS_WORDS)).astype(np.float32)
            self.group_log = np.log(inside.reshape(HEAD_CLASSES, self.groups, CLASS_WORDS).sum(axis=2)).astype(np.float32)
        self.mid_log = (np.log(c) - np.log(size[classes]))[by_hash]
        self.rare_log = float(np.log(size[RARE] + (types - len(h)) + 1))
        self.first = np.zeros(1 << PLACES, np.int32)
        self.first[self.h[::-1] >> np.uint64(64 - PLACES)] = np.arange(len(self.h))[::-1]

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Row of each token, -1 for others: the first row with its upper bits, searched on where that is another's."""
        if not len(self.h):
            return np.full(len(tokens), -1)
        at = self.first[tokens >> np.uint64(64 - PLACES)].astype(np.int64)
        other = np.flatnonzero(self.h[at] != tokens)
        if other.size:
            near = np.minimum(np.searchsorted(self.h, tokens[other]), len(self.h) - 1)
            at[other] = np.where(self.h[near] == tokens[other], near, -1)
        return at

    def shapes(self) -> list[tuple[int, int]]:
        """Rows and columns of the weights of classes (the first choice and the classes
        of a family), of the words of a group and of the groups of a class."""
        rows = [(CLASS_ROWS * self.groups, CHOICES + FAMILY), (WORD_ROWS * self.groups, CLASS_WORDS)]
        return rows + [(WORD_ROWS * self.groups, self.groups)] * (self.groups > 1)

    def size(self) -> int:
        return sum(n * m for n, m in self.shapes())

    def tables(self, weights: np.ndarray) -> list[np.ndarray]:
        """Views of the parts of one set of weights: first choice, classes of a family, words, groups."""
        (n, _), *more = self.shapes()
        parts = [(n, CHOICES), (n, FAMILY), *more]
        ends = np.cumsum([n * m for n, m in parts])
        return [x.reshape(shape) for x, shape in zip(np.split(weights[:ends[-1]], ends[:-1]), parts)]

    def levels(self, classes: np.ndarray, ranks: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of words of the head: table, key of the choice, its logs by count, and the place chosen."""
        group, family = ranks // CLASS_WORDS, classes // FAMILY
        out = [(1, family, self.family_log.take(family, axis=0), classes % FAMILY),
               (2, group, self.word_log.take(group, axis=0), ranks % CLASS_WORDS)]
        if self.groups > 1:
            out.append((3, -1 - classes, self.group_log.take(classes, axis=0), group % self.groups))
        return out


def choices(classes: np.ndarray) -> np.ndarray:
    """Place of each class in the first choice."""
    return np.where(classes < HEAD_CLASSES, classes // FAMILY, classes - (HEAD_CLASSES - FAMILIES))


def contexts(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashed features of every position: one, two and three words back, and the last two together."""
    first = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.arange(len(tokens))
    back = [np.where(at - k >= first, tokens[np.maximum(at - k, 0)], START) for k in (1, 2, 3)]
    with np.errstate(over="ignore"):
        raw = [back[0], back[1] * np.uint64(3), back[2] * np.uint64(5), back[0] * np.uint64(7) ^ back[1] * np.uint64(11)]
        out = np.stack([(x ^ np.uint64(k + 1)) * _MIX for k, x in enumerate(raw)], axis=1)
    return out ^ (out >> np.uint64(31))


def rows_of(features: np.ndarray, rows: int) -> np.ndarray:
    high = features >> np.uint64(7)
    return (high % np.uint64(rows) if rows & rows - 1 else high & np.uint64(rows - 1)).astype(np.uint16 if rows <= 1 << 16 else np.uint32)


def inner_rows(features: np.ndarray, keys: np.ndarray, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (features ^ (keys[:, None].astype(np.uint64) + np.uint64(1))) * _MIX
    return rows_of(x ^ (x >> np.uint64(29)), rows)


def pulls(weights: np.ndarray, rows: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Logits: the logs by count and the weights of each example's features."""
    out = weights.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += weights.take(rows[:, k], axis=0)
    out += logs
    return out


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, their exponentials and the sum of each row; rows are shifted by their
    largest value where single precision would not hold them."""
    one = np.ones(x.shape[1], x.dtype)
    if x.max() < 60:
        e = np.exp(x)
        total = e @ one
        if total.min() > 1e-30:
            return x, e, total
    x = x - x.max(axis=1, keepdims=True)
    e = np.exp(x)
    return x, e, e @ one


def log_chosen(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """ln of the chosen place's share of each row."""
    x, _, total = exponentials(x)
    return x[np.arange(len(x)), place].astype(np.float64) - np.log(total)


def softmax(x: np.ndarray) -> np.ndarray:
    _, e, total = exponentials(x)
    e *= (1 / total)[:, None]
    return e


def sums_of_runs(values: np.ndarray, picked: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of each run of picked rows: short runs place by place, longest first (several
    times faster than ``reduceat``); what is left of the few long ones run by run."""
    n = np.diff(starts, append=len(picked))
    total = values.take(picked[starts], axis=0)
    more = np.flatnonzero(n > 1)
    if not more.size:
        return total
    more = more[np.argsort(-np.minimum(n[more], 1 << 15).astype(np.int16), kind="stable")]
    at, size = starts[more], n[more]
    part = total.take(more, axis=0)
    k, m = 1, len(more)
    while m > 64:
        part[:m] += values.take(picked[at[:m] + k], axis=0)
        k += 1
        m = int(np.searchsorted(-size[:m], -k))
    if m:
        left = size[:m] - k
        first = np.cumsum(left) - left
        rest = np.repeat(at[:m] + k - first, left) + np.arange(left.sum())
        part[:m] += np.add.reduceat(values.take(picked[rest], axis=0), first, axis=0)
    total[more] = part
    return total


def gradient_step(weights: np.ndarray, scale: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """Move the rows of each example's features along its slope; rows that have moved more move slower."""
    flat = rows.reshape(-1)
    order = np.argsort(flat, kind="stable")  # a radix sort while the rows are 16-bit numbers
    ordered = flat[order]
    starts = np.r_[0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1]
    total = sums_of_runs(slope, order // rows.shape[1], starts)
    own = ordered[starts]
    scale[own] = moved = scale[own] + np.einsum("ij,ij->i", total, total) / np.float32(total.shape[1])
    total *= (STEP / np.sqrt(moved))[:, None]
    row = np.dtype((np.void, weights.itemsize * weights.shape[1]))  # rows are put back whole
    weights.view(row)[own, 0] = (weights.take(own, axis=0) - total).view(row)[:, 0]


def train_task(texts: Iterator[list[str]], vocabulary: Vocabulary, weights: np.ndarray) -> int:
    """Gradient steps over the texts, in place; the number of tokens seen."""
    tables = vocabulary.tables(weights)
    scales = [np.full(len(w), 1.0, np.float32) for w in tables]
    seen = 0
    for part in texts:
        tokens, counts = joined(part)
        features, found = contexts(tokens, counts), vocabulary.find(tokens)
        classes = np.where(found >= 0, vocabulary.classes[found] if len(vocabulary.h) else RARE, RARE)
        ranks = np.where(found >= 0, vocabulary.rank[found] if len(vocabulary.h) else 0, vocabulary.head)
        seen += len(tokens)
        for at in range(0, len(tokens), BATCH):
            f, c, r = features[at:at + BATCH], classes[at:at + BATCH], ranks[at:at + BATCH]
            rows = rows_of(f, len(tables[0]))
            p = softmax(pulls(tables[0], rows, vocabulary.choice_log))
            p[np.arange(len(c)), choices(c)] -= 1
            gradient_step(tables[0], scales[0], rows, p)
            head = np.flatnonzero(r < vocabulary.head)
            if head.size:
                for k, keys, logs, place in vocabulary.levels(c[head], r[head]):
                    rows = inner_rows(f[head], keys, len(tables[k]))
                    p = softmax(pulls(tables[k], rows, logs))
                    p[np.arange(len(head)), place] -= 1
                    gradient_step(tables[k], scales[k], rows, p)
    return seen


def train_round(train: DataFrame, vocabulary: Vocabulary, w: np.ndarray, tokens: int) -> np.ndarray:
    """The weights after every task's steps, averaged by the tokens they saw."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = w.copy()
        texts = (list(b["text"].iloc[i:j]) for b in batches for i, j in slices(b["text"]))
        seen = train_task(texts, vocabulary, mine)
        if seen:
            mine -= w
            for k, x in enumerate(np.array_split(mine, BLOCKS)):
                yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "block": [k], "seen": [float(seen)],
                                    "change": [(x * seen).astype(np.float32).tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["change"])
        return pd.DataFrame({"part": [group["part"].iloc[0]], "block": [group["block"].iloc[0]], "seen": [group["seen"].sum()],
                             "change": [total.astype(np.float32).tobytes()]})

    schema = "part int, block int, seen double, change binary"
    tasks = max(1, -(-tokens // PART_TOKENS))
    changes = train.select("text").coalesce(tasks).mapInPandas(run, schema)
    some = changes.groupBy("block", (F.col("part") % math.ceil(math.sqrt(tasks))).alias("lane")).applyInPandas(add, schema)
    rows = some.groupBy("block").applyInPandas(add, schema).collect()  # BLOCKS rows, together one set of weights
    if not rows:
        return w
    total = np.concatenate([np.frombuffer(r["change"], np.float32) / np.float32(r["seen"]) for r in sorted(rows, key=lambda r: r["block"])])
    return w + total


def log_probabilities(tokens: np.ndarray, counts: np.ndarray, found: np.ndarray, v: Vocabulary, w: np.ndarray) -> np.ndarray:
    """ln P of each token; of rare ones without the part that their count decides."""
    tables = v.tables(w)
    features = contexts(tokens, counts)
    out = np.empty(len(tokens))
    for at in range(0, len(tokens), BATCH):
        f, k = features[at:at + BATCH], found[at:at + BATCH]
        known = k >= 0
        c, r = np.full(len(k), RARE), np.full(len(k), v.head)
        if len(v.h):
            c, r = np.where(known, v.classes[k], RARE), np.where(known, v.rank[k], v.head)
        p = log_chosen(pulls(tables[0], rows_of(f, len(tables[0])), v.choice_log), choices(c))
        head = np.flatnonzero(r < v.head)
        if head.size:
            for n, keys, logs, place in v.levels(c[head], r[head]):
                p[head] += log_chosen(pulls(tables[n], inner_rows(f[head], keys, len(tables[n])), logs), place)
        mid = np.flatnonzero(known & (r >= v.head))
        p[mid] += v.mid_log[k[mid]] if mid.size else 0
        p[~known] -= v.rare_log
        out[at:at + BATCH] = p
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    fold = F.crc32(id_text(F.col(id_col)).cast("binary")) % folds
    d = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), (fold == held_out_fold).alias("held_out"),
                    F.pmod(F.xxhash64(id_text(F.col(id_col)), F.lit("round")), F.lit(ROUNDS)).alias("round"))
    train = d.filter(~F.col("held_out"))
    counted = materialize(word_counts(train), "word-counts")
    total = counted.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, types = int(total["n"] or 0), int(total["v"])
    top = materialize(counted.orderBy(F.desc("c"), "h").limit(max(KNOWN, HEAD * groups_of(types))), "known-words").toPandas()  # selected by the executors
    vocabulary = Vocabulary(top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64), tokens, types)
    weights = np.zeros(vocabulary.size(), np.float32)
    for k in range(ROUNDS):
        weights = train_round(train.filter(F.col("round") == k), vocabulary, weights, tokens // ROUNDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, j in slices(batch["text"]):
                part = batch.iloc[i:j]
                tokens, counts = joined(list(part["text"]))
                found = vocabulary.find(tokens)
                ln = log_probabilities(tokens, counts, found, vocabulary, weights)
                c = np.where(found >= 0, vocabulary.c[found] if len(vocabulary.h) else 0, 0)
                starts = np.cumsum(counts) - counts
                rare, times = [], []
                for s, n in zip(starts, counts):
                    own = tokens[s:s + n]
                    u, m = np.unique(own[found[s:s + n] < 0], return_counts=True)
                    rare.append(u.view(np.int64)), times.append(m)
                yield pd.DataFrame({
                    "id": part["id"].values, "held_out": part["held_out"].values, "n_tokens": counts,
                    "known": np.add.reduceat((found >= 0).astype(np.int64), starts),
                    "logs": np.add.reduceat(np.log10(c + 1.0), starts), "model": np.add.reduceat(ln, starts) / LN10,
                    "rare": rare, "times": times})

    id_type = d.schema["id"].dataType.simpleString()
    scored = d.select("id", "text", "held_out").mapInPandas(
        run, f"id {id_type}, held_out boolean, n_tokens long, known long, logs double, model double, rare array<long>, times array<long>")
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored-texts")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("h"), F.col("x.times").alias("m"))
    more = (rare.join(counted, "h").groupBy("row")
            .agg(F.sum("m").alias("more_known"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("more_logs")))
    known = F.coalesce("more_known", F.lit(0))
    logs = F.coalesce("more_logs", F.lit(0.0))
    return scored.drop("rare", "times").join(more, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("known") + known).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * float(np.log10(tokens + types + 1.0))).alias("base_score"),
        (F.col("model") + logs).alias("score"))
