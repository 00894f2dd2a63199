"""Substring dedup: word spans that an earlier document has are removed.

A span is removed where every window of ``window`` words in it also starts in a
document with a smaller id.  Windows are found by suffix automata of reference
shards: documents stream through an automaton word by word, and its matching
statistics (the longest suffix of what was read that the shard holds) say where
a window ends that the shard knows.  Each state keeps the smallest document that
its strings came from, so that the state of a window also tells whose it is.
Neighbouring windows make up the maximal spans above the threshold.

Sending every document past every shard would be quadratic in the corpus, so
documents and shards are cut to what can meet:

1. Every window has a minimizer, the smallest hash of its 8-word grams.  Equal
   windows have equal minimizers, so a window whose minimizer occurs in one text
   only cannot repeat.  Neighbouring windows with one minimizer form a segment.
2. Equal segments are one, read from the text of the smallest document.
3. Of these, windows whose hash is found in one text only are cut off at the
   sides (a passage that many documents quote has as many different
   surroundings); what is left are pieces, again each kept once.
4. Shards hold the pieces of some minimizers, about SHARD_WORDS words each.
   The task of a shard streams its pieces through the automaton in the order of
   their documents; a window that the automaton does not know is new, and its
   words are added.  The automaton is never larger than its shard, and since no
   piece can match outside its own shard none has to be sent to all tasks.
5. The documents of each piece learn the first document of each window.

Equal texts need none of this: all words of a copy with a larger id go, if it
has a window at all.  Words are compared by 64-bit hashes inside the automata,
texts, segments and pieces by 128 bits; hashes of windows only choose candidates.

Defined results: a null text has no words; ids are whole numbers, a null id
counts as larger than every other, and equal ids are no smaller ones (repeated
rows keep their words); a text shorter than the window is kept as it is, with
its words joined by one space; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

WINDOW, GRAM = 50, 8
#: words of a shard of the reference (its automaton has at most twice as many states)
SHARD_WORDS = 100_000
SLICE_BYTES = 4 << 20
NULL_ID = (1 << 63) - 1
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(words: np.ndarray, k: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every k consecutive numbers, from those of 1, 2, 4, ... numbers."""
    out = np.zeros(max(len(words) - k + 1, 0), dtype=np.uint64)
    part, n, power, at, shift = words, 1, int(base), 0, 1
    while len(out):
        if k & n:
            out += np.uint64(shift) * part[at:at + len(out)]
            at, shift = at + n, shift * power % (1 << 64)
        if 2 * n > k:
            break
        part, n, power = part[:-n] + np.uint64(power) * part[n:], 2 * n, power * power % (1 << 64)
    return out


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    part, n = x, 1
    while 2 * n <= k:
        part, n = np.minimum(part[:-n], part[n:]), 2 * n
    size = max(len(x) - k + 1, 0)
    return np.minimum(part[:size], part[k - n:k - n + size])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text ends."""
    split = [t.encode().split() for t in texts]  # bytes are split at space and \\t \\n \\v \\f \\r only
    ends = np.cumsum([len(w) for w in split], dtype=np.int64)
    flat = [w for ws in split for w in ws]
    known = {w: xxhash.xxh64_intdigest(w) for w in set(flat)}
    return np.fromiter(map(known.__getitem__, flat), dtype=np.uint64, count=len(flat)), ends


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut to about SLICE_BYTES of text."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        at, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= SLICE_BYTES or i == len(texts) - 1:
                yield batch.slice(at, i + 1 - at), texts[at:i + 1]
                at, held = i + 1, 0


def segments(words: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, start, windows, minimizer, hash, hash): the segments of all texts.
    A segment has at most ``window`` windows: its first and last one hold all its words."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    if len(words) < window:
        return none
    text = np.searchsorted(ends, np.arange(len(words)), side="right")
    least = sliding_min(mixed(rolling(words, min(GRAM, window), BASES[0])), window - min(GRAM, window) + 1)
    at = np.flatnonzero(text[:len(least)] == text[window - 1:])
    if not len(at):
        return none
    least, whose = least[at], text[at]
    first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (whose[1:] != whose[:-1])]))
    length = np.diff(np.append(first, len(at)))
    if length.max() > window:  # a text that repeats itself: cut
        parts = -(-length // window)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, length = np.repeat(first, parts) + nth * window, np.minimum(np.repeat(length, parts) - nth * window, window)
    starts = at[first]
    hashes = []
    for base in BASES:
        own = rolling(words, window, base)
        hashes.append(mixed(own[starts] * np.uint64(3) + own[starts + length - 1] * np.uint64(5) + length.astype(np.uint64)))
    begin = np.concatenate([[0], ends[:-1]])
    return (whose[first], starts - begin[whose[first]], length, least[first].view(np.int64), *[h.view(np.int64) for h in hashes])


class Automaton:
    """Suffix automaton of several word sequences, added in order of their
    documents: of each state the smallest document that its strings occur in."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def _state(self, length: int, following: dict[int, int], link: int, first: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of p's longest string and ``word``, taken out of q."""
        clone = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q], self.first[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int], document: int) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # known from another sequence
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new = self._state(self.length[last] + 1, {}, 0, document)
            p = last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def matches(self, words: list[int], window: int) -> list[int | None]:
        """For each window the smallest document that has it, None if there is none.

        The matching statistic is cut to ``window``, so the state at hand is
        always the one that holds the window itself."""
        following, link, length = self.next, self.link, self.length
        out: list[int | None] = []
        state = held = 0
        for i, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                held = length[state]
            if word in following[state]:
                state = following[state][word]
                held += 1
            while state and length[link[state]] >= window:
                state = link[state]
            held = min(held, window)
            if i >= window - 1:
                out.append(self.first[state] if held == window else None)
        return out


def owners(pieces: list[tuple[int, list[int]]], window: int) -> list[list[int]]:
    """For each piece (smallest document, words; ordered by document) and each of
    its windows the smallest document that has it."""
    shard, out = Automaton(), []
    for document, words in pieces:
        found = shard.matches(words, window)
        i = 0
        while i < len(found):  # words of windows that are new here
            if found[i] is None:
                j = i
                while j < len(found) and found[j] is None:
                    found[j] = document
                    j += 1
                shard.add(words[i:j - 1 + window], document)
                i = j
            else:
                i += 1
        out.append(found)
    return out


def stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal values."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.append(first[1:], len(values)) - 1


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(t1, t2, d, text): hash of the text and the id, null last."""
    text = text_or_empty(F.col(f"`{text_col}`"))
    return docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("d"), text.alias("text"))


def all_segments(rows: DataFrame, window: int) -> DataFrame:
    """(t1, t2, d, s, n, m, g1, g2): the segments of each row of ``named``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            whose, start, n, m, g1, g2 = segments(*word_hashes(texts), window)
            own = [batch.column(c).take(pa.array(whose)) for c in ("t1", "t2", "d")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(start), *[pa.array(x) for x in (n, m, g1, g2)]], ["t1", "t2", "d", "s", "n", "m", "g1", "g2"])

    return rows.mapInArrow(run, "t1 long, t2 long, d long, s long, n long, m long, g1 long, g2 long")


def candidates(runs: DataFrame) -> DataFrame:
    """(m, g1, g2, rep, many): the different segments whose minimizer occurs in
    two texts or more; ``rep`` is where the smallest document has it."""
    text = F.struct("t1", "t2")
    found = runs.groupBy("m", "g1", "g2").agg(
        F.min(F.struct("d", "t1", "t2", "s", "n")).alias("rep"), F.min(text).alias("lo"), F.max(text).alias("hi"))
    found = materialize(found, "segments")
    shared = found.groupBy("m").agg(F.min("lo").alias("a"), F.max("hi").alias("b")).filter("a < b").select("m")
    return found.join(shared, "m", "left_semi").select("m", "g1", "g2", "rep", (F.col("lo") < F.col("hi")).alias("many"))


def segment_words(rows: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(m, g1, g2, d, t1, t2, many, words, windows): each segment with the hashes of its words and windows."""
    wanted = found.groupBy("rep.t1", "rep.t2", "rep.d").agg(
        F.collect_list(F.struct("m", "g1", "g2", "many", "rep.s", "rep.n")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            words, ends = word_hashes(texts)
            begin = np.concatenate([[0], ends[:-1]])
            own = batch.column("own")
            row = np.repeat(np.arange(batch.num_rows), own.value_lengths().to_numpy(zero_copy_only=False))
            each = own.flatten()
            start, n = (each.field(c).to_numpy() for c in ("s", "n"))
            start = start + begin[row]
            hashes = mixed(rolling(words, window, BASES[0])).view(np.int64)

            def lists(values: np.ndarray, size: np.ndarray) -> pa.ListArray:
                offsets = np.concatenate([[0], np.cumsum(size)])
                at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, size)
                return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[at]))

            yield pa.RecordBatch.from_arrays(
                [each.field("m"), each.field("g1"), each.field("g2"),
                 *[batch.column(c).take(pa.array(row)) for c in ("d", "t1", "t2")], each.field("many"),
                 lists(words.view(np.int64), n + window - 1), lists(hashes, n)],
                ["m", "g1", "g2", "d", "t1", "t2", "many", "words", "windows"])

    return rows.join(wanted, ["t1", "t2", "d"]).select("t1", "t2", "d", "text", "own").mapInArrow(
        run, "m long, g1 long, g2 long, d long, t1 long, t2 long, many boolean, words array<long>, windows array<long>")


def cut_pieces(found: DataFrame, window: int) -> DataFrame:
    """(m, g1, g2, at, p1, p2, d, words): the parts of the segments whose windows
    are found in two texts or more; ``at`` is the piece's first window in its segment."""
    each = found.select("m", "g1", "g2", "t1", "t2", "many", F.posexplode("windows").alias("pos", "w"))
    often = each.groupBy("w").agg(F.max("many").alias("many"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("t1", "t2") for f in (F.min, F.max)])
    often = often.filter("many OR min_t1 < max_t1 OR min_t2 < max_t2").select("w")
    kept = each.join(often, "w", "left_semi").groupBy("m", "g1", "g2").agg(F.array_sort(F.collect_set("pos")).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, p1, p2, words = [], [], [], [], []
            own, keep = batch.column("words"), batch.column("kept")
            for i in range(batch.num_rows):
                ws, pos = own[i].values.to_numpy(), keep[i].values.to_numpy()
                for a, b in zip(*stretches(pos - np.arange(len(pos)))):
                    piece = ws[pos[a]:pos[b] + window]
                    digest = np.frombuffer(xxhash.xxh3_128_digest(piece.tobytes()), dtype=np.int64)
                    row.append(i), at.append(int(pos[a])), p1.append(digest[0]), p2.append(digest[1]), words.append(piece)
            taken = [batch.column(c).take(pa.array(row, pa.int64())) for c in ("m", "g1", "g2", "d")]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(at, pa.int64()), pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(words, pa.list_(pa.int64()))],
                ["m", "g1", "g2", "d", "at", "p1", "p2", "words"])

    return found.select("m", "g1", "g2", "d", "words").join(kept, ["m", "g1", "g2"]).mapInArrow(
        run, "m long, g1 long, g2 long, d long, at long, p1 long, p2 long, words array<long>")


def first_documents(pieces: DataFrame, window: int) -> DataFrame:
    """(p1, p2, m, a, b, first): windows a to b of a piece are first found in document ``first``."""
    different = pieces.groupBy("m", "p1", "p2").agg(F.min("d").alias("d"), F.first("words").alias("words"))
    different = materialize(different, "pieces")
    total = different.agg(F.sum(F.size("words"))).head()[0] or 0
    shards = int(total // SHARD_WORDS) + 1

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["d", "p1", "p2"], ignore_index=True)
        found = owners([(int(d), w.tolist()) for d, w in zip(group["d"], group["words"])], window)
        rows = []
        for p1, p2, m, own in zip(group["p1"], group["p2"], group["m"], found):
            first, last = stretches(np.array(own, dtype=np.int64))
            rows += [(p1, p2, m, a, b, own[a]) for a, b in zip(first.tolist(), last.tolist())]
        return pd.DataFrame(rows, columns=["p1", "p2", "m", "a", "b", "first"], dtype="int64")

    return (different.withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards))).groupBy("shard")
            .applyInPandas(run, "p1 long, p2 long, m long, a long, b long, first long"))


def spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(t1, t2, first, gone): of each text the smallest document, and the windows
    of that document that an earlier one has, as ordered (from, to) word positions
    of their first words (null: none).  Copies in later documents go as a whole."""
    texts = rows.groupBy("t1", "t2").agg(F.min("d").alias("first"))
    runs = materialize(all_segments(rows, window), "runs")
    found = materialize(segment_words(rows, candidates(runs), window), "segment-words")
    pieces = materialize(cut_pieces(found, window), "segment-pieces")
    known = materialize(first_documents(pieces, window), "first-documents")
    of_segment = pieces.select("m", "g1", "g2", "at", "p1", "p2").distinct().join(known, ["m", "p1", "p2"]).select(
        "m", "g1", "g2", (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b"), "first")
    gone = (runs.join(of_segment, ["m", "g1", "g2"]).filter(F.col("first") < F.col("d"))
            .groupBy("t1", "t2", "d").agg(F.array_sort(F.collect_set(F.struct(
                (F.col("s") + F.col("a")).alias("a"), (F.col("s") + F.col("b")).alias("b")))).alias("gone")))
    texts = texts.join(gone.withColumnRenamed("d", "first"), ["t1", "t2", "first"], "left")
    return materialize(texts, "spans")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept): each document's text without the spans
    that an earlier document has, words joined by one space."""
    rows = named(docs, id_col, text_col)
    joined = rows.join(spans(rows, window).withColumnRenamed("first", "f"), ["t1", "t2"]).select(
        "d", "text", F.when(F.col("f") < F.col("d"), F.lit(True)).otherwise(F.lit(False)).alias("copy"), "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            n, removed, kept = [], [], []
            for text, copy, gone in zip(texts, batch.column("copy").to_pylist(), batch.column("gone").to_pylist()):
                words = text.encode().split()
                n.append(len(words))
                if copy and len(words) >= window:
                    words = []
                elif gone and not copy:
                    left, at = [], 0
                    for g in gone:
                        left += words[at:max(g["a"], at)]
                        at = max(at, g["b"] + window)
                    words = left + words[at:]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             ["id", "n_words", "n_removed", "kept"])

    out = joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return out.withColumn("id", F.nullif("id", F.lit(NULL_ID)))
