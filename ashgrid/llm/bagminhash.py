"""MinHash near-dedup of multisets: BagMinHash signatures, bands, exact overlap.

A text is the multiset of its 5-word shingles.  For every shingle and every
stretch (0,1], (1,2], (2,4], (4,8], ... of its weight runs a Poisson process
whose rate is the length of the stretch; where the weight ends inside a
stretch, the process is split in half by half, each point going to one side by
a coin that its own number decides.  Each point lies in one of ``M`` components
at random; the earliest point below the weight names the component, so two
texts agree in a component with a probability equal to their weighted Jaccard
similarity.  Points are generated only up to the time by which all components
are sure to be filled, so the work hardly grows with the weights.

Texts with equal multisets form a class and only its smallest document goes
on.  Classes that share a band are compared with the smallest class of that
band.  Where that leaves a band in several components, its smaller components
are compared with the texts of the largest and with each other, exactly and in
blocks: every link that can join two components of a band is found, and what
moves is texts and spans of links, never all pairs.

Defined results: a text of fewer than five words (null included) is one shingle of
all its words, so that short texts match when equal; documents are compared
whatever their language or source; rows that share an id are one node with the
texts of all of them; rows with a null id are nobody's copies and always stay;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, text_or_empty
from .components import components, roots

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5: a pair at 0.8 shares a band with probability 0.99995
BANDS, ROWS = 25, 5
M = BANDS * ROWS
#: texts of one side of an exact comparison in one task
BLOCK = 512
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer (a public, fixed mixing function)."""
    with np.errstate(over="ignore"):
        x = x + _C1
        x = (x ^ (x >> np.uint64(30))) * _C2
        x = (x ^ (x >> np.uint64(27))) * _C3
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def shingles(text: str, n: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the word n-grams, sorted, with repeats."""
    words = text.encode().split()
    if not words:
        return np.zeros(1, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = max(len(h) - n + 1, 1)
    out = np.full(k, min(len(h), n), np.uint64)
    for i in range(min(n, len(h))):
        out = mix64(out ^ h[i:i + k])
    out.sort()
    return out


def stretches(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, j) of the stretches that each weight reaches into: j = 0 is
    (0, 1], j > 0 is (2^(j-1), 2^j]."""
    n = np.where(weight <= 1, 1, np.ceil(np.log2(np.maximum(weight, 2))).astype(np.int64) + 1)
    index = np.repeat(np.arange(len(weight)), n)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n)


def below(seed: np.ndarray, j: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether each point of stretch j lies below the weight: halve the stretch,
    by one bit of the point's own number each time, until a half is whole
    inside or outside."""
    lo = np.where(j == 0, 0, 1 << np.maximum(j - 1, 0))
    hi = np.int64(1) << j
    coins = mix64(seed ^ _C3)
    inside = hi <= weight
    cut = np.flatnonzero(~inside & (lo < weight))
    step = 0
    while cut.size:
        mid = (lo[cut] + hi[cut]) // 2
        up = ((coins[cut] >> np.uint64(step % 64)) & np.uint64(1)).astype(bool)
        lo[cut] = np.where(up, mid, lo[cut])
        hi[cut] = np.where(up, hi[cut], mid)
        inside[cut] = hi[cut] <= weight[cut]
        cut = cut[~inside[cut] & (lo[cut] < weight[cut])]
        step += 1
        if step % 64 == 0:
            coins = mix64(coins)
    return inside


def signatures(bags: list[np.ndarray], m: int = M) -> np.ndarray:
    """One row of ``m`` numbers per bag (sorted shingle hashes with repeats)."""
    ids, weights, bag = [], [], []
    for b, x in enumerate(bags):
        u, c = np.unique(x, return_counts=True)
        ids.append(u), weights.append(c), bag.append(np.full(len(u), b))
    ids, weights, bag = np.concatenate(ids), np.concatenate(weights).astype(np.int64), np.concatenate(bag)
    total = np.array([len(x) for x in bags], dtype=np.float64)
    time = np.full((len(bags), m), np.inf)
    name = np.zeros((len(bags), m), np.uint64)
    todo = np.arange(len(bags))
    until = m * (np.log(m) + 3.0) / total
    index, j = stretches(weights)
    while todo.size:
        use = np.flatnonzero(np.isin(bag[index], todo)) if todo.size < len(bags) else np.arange(len(index))
        element, level = index[use], j[use]
        rate = np.where(level == 0, 1, 1 << np.maximum(level - 1, 0)).astype(np.float64)
        seed = mix64(ids[element] ^ mix64(level.astype(np.uint64)))
        owner, limit = bag[element], until[bag[element]]
        weight, t = weights[element], np.zeros(len(use))
        points = []
        while len(seed):
            seed = mix64(seed)
            t = t - np.log(unit(seed)) / rate
            alive = t < limit
            if not alive.all():
                seed, t, rate, owner, limit, weight, level = (a[alive] for a in (seed, t, rate, owner, limit, weight, level))
            hit = below(seed, level, weight) if (level > 1).any() else slice(None)
            slot = (mix64(seed ^ _C1)[hit] % np.uint64(m)).astype(np.int64)
            points.append((owner[hit] * m + slot, t[hit], seed[hit]))
        place, when, what = (np.concatenate([p[k] for p in points]) for k in range(3))
        order = np.lexsort((when, place))
        place, when, what = place[order], when[order], what[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.array([], np.int64)
        time.reshape(-1)[place[first]], name.reshape(-1)[place[first]] = when[first], what[first]
        todo = todo[np.isinf(time[todo]).any(axis=1)]
        until[todo] *= 2
    return name


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.arange(bands, dtype=np.uint64)[None, :] + np.zeros((len(signature), 1), np.uint64)
    for r in range(rows):
        out = mix64(out ^ signature[:, r::rows][:, :bands])
    return out.view(np.int64)


def bag_key(x: np.ndarray) -> tuple[int, int]:
    """128 bits that name a multiset."""
    raw = x.tobytes()
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64).tolist())


def bands_of(docs: DataFrame, id_col: Column, text: Column, slice_texts: int = 256) -> DataFrame:
    """(id, b1, b2, keys): the multiset's name and the band keys of each text."""
    d = docs.select(id_col.cast("long").alias("id"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), slice_texts):
                part = batch.iloc[at:at + slice_texts]
                bags = [shingles(t) for t in part["text"]]
                names = [bag_key(x) for x in bags]
                keys = band_keys(signatures(bags))
                yield pd.DataFrame({"id": part["id"].values, "b1": [a for a, _ in names], "b2": [b for _, b in names],
                                    "keys": list(keys)})

    return d.mapInPandas(run, "id long, b1 long, b2 long, keys array<long>")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The (u, v) of ``pairs`` whose texts' multisets overlap enough, exactly."""
    full = (pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("tu")), "u")
            .join(texts.select(F.col("id").alias("v"), F.col("text").alias("tv")), "v"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            last_text, last = None, None  # pairs of one class often come together
            keep = []
            for tu, tv in zip(batch["tu"], batch["tv"]):
                if tv != last_text:
                    last_text, last = tv, shingles(tv)
                keep.append(overlap(shingles(tu), last) >= similarity)
            yield batch.loc[keep, ["u", "v"]]

    return full.select("u", "v", "tu", "tv").mapInPandas(run, "u long, v long")


def set_features(bag: np.ndarray) -> np.ndarray:
    """A sorted bag as a set: each repeat of a shingle becomes a feature of its own."""
    new = np.r_[True, bag[1:] != bag[:-1]]
    start = np.maximum.accumulate(np.where(new, np.arange(len(bag)), 0))
    return mix64(bag ^ mix64((np.arange(len(bag)) - start).astype(np.uint64)))


def overlaps(left: list[np.ndarray], right: list[np.ndarray], chunk: int = 2_000_000) -> np.ndarray:
    """Exact weighted Jaccard similarities of all left bags with all right bags,
    by the postings of shared features, ``chunk`` postings at a time."""
    def flat(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        f = np.concatenate([set_features(x) for x in bags])
        who = np.repeat(np.arange(len(bags)), [len(x) for x in bags])
        order = np.argsort(f, kind="stable")
        return f[order], who[order]

    (fl, wl), (fr, wr) = flat(left), flat(right)
    lo, hi = np.searchsorted(fr, fl, "left"), np.searchsorted(fr, fl, "right")
    n = hi - lo
    both = np.zeros(len(left) * len(right), np.int64)
    ends = np.cumsum(n)
    at = 0
    while at < len(fl):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, "right")))
        m = n[at:to]
        first = np.repeat(lo[at:to] - (np.cumsum(m) - m), m)
        who = wr[first + np.arange(m.sum())]
        both += np.bincount(np.repeat(wl[at:to], m) * len(right) + who, minlength=len(both))
        at = to
    both = both.reshape(len(left), len(right))
    sizes = np.add.outer([len(x) for x in left], [len(x) for x in right])
    return both / (sizes - both)


def stray_links(in_bands: DataFrame, links: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (u, v) between the components that a band is left in.

    Each such band hands its smaller components to its largest one.  A largest
    component and all that was handed to it form a group, in which every
    handed text is compared exactly with all texts of other components, in
    blocks dealt to many tasks.  Tasks emit spans of links, not pairs."""
    comp = components(links)
    placed = in_bands.filter("n > 2").join(comp, in_bands["u"] == comp["node"], "left").select(
        "key", F.col("u").alias("id"), F.coalesce("component", "u").alias("c"))
    placed = materialize(placed, "placed")
    members = placed.select("id", "c").distinct()
    sizes = members.groupBy("c").agg(F.count(F.lit(1)).alias("size"))
    parts = placed.select("key", "c").distinct().join(sizes, "c")
    largest = (parts.groupBy("key").agg(F.max(F.struct("size", "c")).alias("b"), F.count(F.lit(1)).alias("parts"))
               .filter("parts > 1").select("key", F.col("b.c").alias("g")))
    handed = parts.join(largest, "key").filter("c <> g").select("g", "c").distinct()
    rows = (handed.join(members, "c").select("g", "id", "c", F.lit(True).alias("stray"))
            .unionByName(handed.select(F.col("g").alias("c")).distinct().join(members, "c")
                         .select(F.col("c").alias("g"), "id", "c", F.lit(False).alias("stray"))))
    rows = materialize(rows, "strays")
    blocks = rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nj"),
                                   F.ceil(F.sum(F.col("stray").cast("int")) / BLOCK).cast("int").alias("ni"))
    rows = rows.join(blocks, "g").withColumns({"i": F.pmod(F.xxhash64("id"), F.col("ni")).cast("int"),
                                               "j": F.pmod(F.xxhash64("id"), F.col("nj")).cast("int")})
    asking = rows.filter("stray").select("g", "id", "c", "i", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j"), F.lit(True).alias("asks"))
    asked = rows.select("g", "id", "c", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"), "j", F.lit(False).alias("asks"))
    full = (asking.unionByName(asked).join(texts, "id").repartition("g", "i", "j").sortWithinPartitions("g", "i", "j"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["asks"]], group[~group["asks"]]
        near = overlaps([shingles(t) for t in left["text"]], [shingles(t) for t in right["text"]]) >= similarity
        near &= left["c"].values[:, None] != right["c"].values[None, :]
        a, b = np.nonzero(near)
        ids, at = np.unique(np.r_[left["id"].values[a], right["id"].values[b]], return_inverse=True)
        root = roots(len(ids), at[:len(a)], at[len(a):])
        return pd.DataFrame({"u": ids, "v": ids[root]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            key = batch[["g", "i", "j"]].values
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            *whole, held = np.split(np.arange(len(batch)), cuts)
            held = batch.iloc[held]
            for rows_ in whole:
                yield solve(batch.iloc[rows_])
        if held is not None and len(held):
            yield solve(held)

    return full.select("g", "i", "j", "id", "c", "asks", "text").mapInPandas(run, "u long, v long").filter("u <> v")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(id, class_id): one row per distinct id that is not null; class_id is the
    smallest id of its group of near duplicates."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bands = materialize(bands_of(docs, F.col("id"), F.col("text")).filter(F.col("id").isNotNull()), "bands")
    classes = materialize(bands.groupBy("b1", "b2").agg(F.min("id").alias("rep")), "bag-classes")
    member = bands.select("id", "b1", "b2").join(classes, ["b1", "b2"]).select("id", "rep")
    first = classes.select(F.col("rep").alias("id"), "b1", "b2")
    reps = (bands.join(first, ["id", "b1", "b2"], "left_semi").dropDuplicates(["id", "b1", "b2"])
            .select("id", F.explode("keys").alias("key")))
    leaders = reps.groupBy("key").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    in_bands = materialize(reps.join(leaders, "key").select("key", F.col("id").alias("u"), "v", "n").distinct(), "band-members")
    pairs = in_bands.filter("u <> v").select("u", "v").distinct()
    wanted = in_bands.select(F.col("u").alias("id")).distinct()
    texts = materialize(docs.join(wanted, "id", "left_semi").select("id", text_or_empty().alias("text")).distinct(), "band-texts")
    links = materialize(verified(pairs, texts, similarity), "near-links")
    links = links.unionByName(stray_links(in_bands, links, texts, similarity))
    links = links.unionByName(member.select(F.col("id").alias("u"), F.col("rep").alias("v")).filter("u <> v"))
    comp = components(links)
    ids = bands.select("id").distinct()
    return ids.join(comp, ids["id"] == comp["node"], "left").select("id", F.coalesce("component", "id").alias("class_id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without the near copies: of each class
    the smallest id stays.  Rows that share id and text are one (the first by all
    other columns that can be ordered); rows that share only the id all stay."""
    classes = near_classes(docs, id_col, text_col, similarity)
    gone = classes.filter("id <> class_id").select(F.col("id").alias("__gone"))
    left = docs.join(gone, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
    some = left.filter(F.col(id_col).isNotNull())
    texts = [F.xxhash64(text_or_empty(F.col(text_col))), F.xxhash64(F.lit(7), text_or_empty(F.col(text_col)))]
    order = [F.col(f"`{f.name}`") for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    first = some.groupBy(F.col(id_col).alias("__id"), *texts).agg(F.min_by(row, F.struct(*order)).alias("__row"))
    return first.select("__row.*").unionByName(left.filter(F.col(id_col).isNull()))
