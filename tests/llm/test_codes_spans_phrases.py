"""Vector codes, substring dedup and phrases against brute force, on rows with
nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashgrid.llm import phrases, substring_dedup, vector_codes

from .test_operators import SCHEMA, awkward_rows, prose

WORD = re.compile("[^\x20\x09-\x0D]+")


# ---- vector codes ---------------------------------------------------------------

def nearest(entries, part):
    return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(entries))


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row number: (code, error)} and the codebooks, one vector after the other."""
    kept = [(i, v, r) for r, (i, v, _) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dims = max([-(-len(v) // parts) * parts for _, v, _ in kept] + [parts])
    ints = {r: [int(np.floor(scale * x)) for x in v] + [0] * (dims - len(v)) for _, v, r in kept}
    width = dims // parts
    part = lambda r, p: ints[r][p * width:(p + 1) * width]
    order = sorted(ints, key=lambda r: (rows[r][0] is None, rows[r][0] or 0, ints[r]))[:entries]
    books = [[part(r, p) for r in order] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            own = collections.defaultdict(list)
            for r in ints:
                own[nearest(books[p], part(r, p))[1]].append(part(r, p))
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if own[e] else b for e, b in enumerate(books[p])]
    out = {}
    for r in ints:
        found = [nearest(books[p], part(r, p)) for p in range(parts)]
        out[r] = ([e for _, e in found], sum(d for d, _ in found))
    return out, books


def vector_rows(seed, n, dims):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(9)]
    rows = [(i * 7 % n, [c + rng.gauss(0, 0.05) for c in rng.choice(centers)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [rows[4], rows[4], (None, rows[2][1], 1), (3, rows[3][1], 2), (n + 1, None, 1), (n + 2, [None] * dims, 1),
             (n + 3, [float("nan")] + [0.0] * (dims - 1), 1), (n + 4, [float("inf")] * dims, None), (n + 5, [0.0] * dims, None),
             (n + 6, [-0.0] * dims, 1), (n + 7, [0.1] * (dims - 3), 2), (n + 8, [], 2)]
    return rows


@pytest.mark.parametrize("n, dims", [(160, 16), (5, 21)])
def test_vector_codes(spark, n, dims):
    rows = vector_rows(n, n, dims)
    schema = "vec_id long, embedding array<double>, label int, id long, v string, code int, error string, salt int, l int"
    df = spark.createDataFrame([(*r, 1, "v", 2, "e", 3, 4) for r in rows], schema).repartition(4)
    got, books = vector_codes.compress(df, "vec_id", "embedding", "label")
    want, plain = plain_codes(rows)
    assert books.tolist() == plain
    by_label = collections.Counter()
    for r, (_, error) in want.items():
        by_label[rows[r][2]] += error
    key = lambda x: tuple((y is None, y if y is not None else 0) for y in x)
    assert sorted([(r["id"], tuple(r["code"]), r["error"], r["label_error"]) for r in got.collect()], key=key) == sorted(
        [(rows[r][0], tuple(code), error, by_label[rows[r][2]]) for r, (code, error) in want.items()], key=key)
    assert vector_codes.books_sha256(books) == hashlib.sha256(
        ",".join(str(x) for b in plain for e in b for x in e).encode()).hexdigest()


def test_vector_codes_of_an_empty_table(spark):
    got, books = vector_codes.compress(spark.createDataFrame([], "i long, e array<float>, l int"), "i", "e", "l")
    assert got.count() == 0 and books.size == 0


def test_tree_finds_the_nearest_entry_and_rules_entries_out():
    rng = np.random.default_rng(5)
    for _ in range(150):
        size = int(rng.choice([1, 3, 1000, 1 << 26]))
        entries = rng.integers(-size, size + 1, (rng.integers(1, 40), rng.integers(1, 9)))
        queries = rng.integers(-size, size + 1, (100, entries.shape[1]))
        d = ((queries[:, None] - entries[None]) ** 2).sum(axis=2)
        index, best = vector_codes.Gnat(entries).nearest(queries)
        assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    entries = rng.integers(-3000, 3000, (64, 2))
    tree = vector_codes.Gnat(entries)
    tree.nearest(np.repeat(entries, 10, axis=0))
    assert tree.verified < 64 * 640 / 2


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e9] * 8, 1)], "i long, e array<double>, l int")
    with pytest.raises(Exception, match="larger than"):
        vector_codes.compress(df, "i", "e", "l")


def test_decoded_vectors_are_near(spark):
    rows = [(i, v, label) for i, v, label in vector_rows(1, 300, 16)[:300]]
    got, books = vector_codes.compress(spark.createDataFrame(rows, "i long, e array<double>, l int"), "i", "e", "l")
    by_id = {i: v for i, v, _ in rows}
    far = [np.linalg.norm(vector_codes.decode(r["code"], books) - by_id[r["id"]]) for r in got.collect()]
    assert np.mean(far) < 0.3 * np.mean([np.linalg.norm(v) for v in by_id.values()])


# ---- substring dedup ------------------------------------------------------------

def plain_dedup(rows, window):
    """Sorted (id, n_words, n_removed, kept text), window by window."""
    large = 1 << 63
    order = lambda i: large if i is None else i
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, large), order(i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < order(i):
                gone.update(range(k, k + window))
        out.append((order(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def found_dedup(df, window, text="text", key="doc_id"):
    return sorted((1 << 63 if r["id"] is None else r["id"], r["n_words"], r["n_removed"], r["kept"])
                  for r in substring_dedup.dedup(df, key, text, window).collect())


def span_rows(seed, n, window):
    """Documents that quote passages, copies, near copies, and texts that repeat themselves."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xyz")
    passages = [[word() for _ in range(window + rng.randint(-2, 3 * window))] for _ in range(4)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [word() for _ in range(rng.randint(0, window))]
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            w += p[a:] if rng.random() < 0.5 else p[:len(p) - a]
        if rows and rng.random() < 0.3:
            w = (rng.choice(rows)[1] or "").split(" ")
            if rng.random() < 0.7 and len(w) > 3:
                w[rng.randrange(len(w))] = "changed"
        rows.append((rng.randint(0, n), rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(7, " ".join(["r"] * (9 * window))), (2, " ".join(["r"] * (3 * window + 1))), (9, " ".join(["p", "q"] * 4 * window)),
             (None, rows[3][1]), (None, "x " + rows[3][1]), (0, None), (0, ""), rows[5], rows[5]]
    return rows


@pytest.mark.parametrize("seed, window", [(1, 10), (2, 50)])
def test_substring_dedup(spark, seed, window):
    rows = span_rows(seed, 60, window)
    schema = "doc_id long, text string, t1 long, d string, m int, own int, w string, first int, words string, gone int"
    df = spark.createDataFrame([(*r, 1, "d", 2, 3, "w", 4, "x", 5) for r in rows], schema).repartition(5)
    assert found_dedup(df, window) == plain_dedup(rows, window)


def test_substring_dedup_of_awkward_rows(spark):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain_dedup([(r[0], r[1]) for r in rows], 50)
    assert sum(r[2] for r in want) > 300
    assert found_dedup(df, 50) == want
    assert found_dedup(df.limit(0), 50) == []


def test_a_passage_in_every_document_is_one_piece(spark):
    """Different surroundings of a common passage do not reach its shard."""
    passage = prose(1, 70).replace("\n", "")
    around = lambda i, side: " ".join(f"{side}{i}w{k}" for k in range(30))
    rows = [(i, f"{around(i, 'l')} {passage} {around(i, 'r')}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    named = substring_dedup.named(df, "doc_id", "text")
    runs = substring_dedup.all_segments(named, 50)
    found = substring_dedup.segment_words(named, substring_dedup.candidates(runs), 50)
    pieces = substring_dedup.cut_pieces(found, 50)
    different = pieces.select("p1", "p2", F.size("words").alias("n")).distinct().collect()
    assert found.count() > 120 and len(different) < 10 and all(r["n"] <= 70 for r in different)
    assert found_dedup(df, 50) == plain_dedup(rows, 50)


def test_automaton_knows_the_first_document_of_each_window():
    rng = random.Random(3)
    for _ in range(200):
        window = rng.choice([3, 5, 8])
        pieces = sorted([(rng.randint(0, 8), [rng.randrange(3) for _ in range(rng.randint(window, 40))])
                         for _ in range(rng.randint(1, 10))], key=lambda x: x[0])
        first = {}
        for d, w in pieces:
            for i in range(len(w) - window + 1):
                first.setdefault(tuple(w[i:i + window]), d)
        want = [[first[tuple(w[i:i + window])] for i in range(len(w) - window + 1)] for _, w in pieces]
        assert substring_dedup.owners(pieces, window) == want


def test_segments_hold_every_window_once():
    rng = random.Random(4)
    texts = [prose(1, 400), "", "a b", " ".join(["same"] * 500), prose(2, 49), prose(3, 50), prose(1, 200)]
    texts += [" ".join(rng.choice("ab") for _ in range(300))]
    words, ends = substring_dedup.word_hashes(texts)
    whose, start, n, *_ = substring_dedup.segments(words, ends, 50)
    seen = collections.Counter((int(t), int(s) + k) for t, s, m in zip(whose, start, n) for k in range(m))
    assert max(n) <= 50 and set(seen.values()) == {1}
    assert set(seen) == {(i, k) for i, t in enumerate(texts) for k in range(len(t.split()) - 49)}


# ---- phrases --------------------------------------------------------------------

def plain_phrases(rows, size=3, min_count=10):
    """{(group, phrase): (a, l, r, n, score)}, with every gram counted one by one."""
    f, n = collections.Counter(), collections.Counter()
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for group, text in rows:
        g = "und" if group is None else group
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(table)):
            w = re.findall("[^\x20\x09]+", piece)
            n[g] += len(w)
            for k in range(1, size + 1):
                f.update((g, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = {}
    for (g, w), a in found.items():
        inside = any(h == g and len(v) > len(w) and 100 * b >= 50 * a and any(v[i:i + len(w)] == w for i in range(len(v)))
                     for (h, v), b in found.items())
        if not inside:
            cuts = [(Fraction(10 ** 6 * a * a, f[g, w[:k]] * f[g, w[k:]]).__floor__(), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[g, " ".join(w)] = (a, f[g, w[:k]], f[g, w[k:]], n[g], score)
    return out


def found_phrases(df, **kw):
    return {(r["g"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"])
            for r in phrases.collocations(df, F.col("lang"), F.col("text"), **kw).collect()}


def phrase_rows():
    rng = random.Random(8)
    vocabulary = "New York city of the BIG Apple Öl ÉCOLE a\x1cb a\xa0b \U0001f600 and".split(" ")
    rows = [(r[2], r[1]) for r in awkward_rows()]
    for i in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        w = [x + rng.choice(["", "", "", "", ".", ",", "\n", "!?", "\t", "\x0b"]) for x in w]
        rows.append((rng.choice(["en", "en", None, "und", "", "x\ny"]), " ".join(w)))
    return rows


@pytest.mark.parametrize("size, min_count", [(3, 10), (2, 3)])
def test_phrases(spark, size, min_count):
    rows = phrase_rows()
    schema = "lang string, text string, g string, phrase string, n int, node int, salt string, next int, a int"
    df = spark.createDataFrame([(*r, "g", "p", 1, 2, "s", 3, 4) for r in rows], schema).repartition(6)
    want = plain_phrases(rows, size, min_count)
    assert len(want) > 40
    assert found_phrases(df, size=size, min_count=min_count) == want
    assert found_phrases(df.limit(0)) == {}


def test_phrases_do_not_depend_on_slices_or_crowded_nodes(spark, monkeypatch):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "SAMPLE", 2)
    monkeypatch.setattr(phrases, "CROWDED", 5000)
    crowded = phrases.crowded_nodes(df, F.col("lang"), F.col("text"), 3)
    edges = phrases.local_edges(df, F.col("lang"), F.col("text"), 3, crowded)
    assert edges.filter("salt > 0").count() > 0
    assert found_phrases(df) == plain_phrases(rows)
    monkeypatch.setattr(phrases, "crowded_nodes", lambda *a: [])
    assert found_phrases(df) == plain_phrases(rows)
    size, tokens = 3, "a b c . d e f g h . i".split()
    joined = list(phrases.slices(["a b c", "d e f g h", "i"], size))
    monkeypatch.setattr(phrases, "SLICE_TOKENS", 4)
    cut = list(phrases.slices(["a b c", "d e f g h", "i"], size))
    grams = lambda parts: [t[i:i + size] for t, starts in parts for i in range(min(starts, len(t)))]
    assert grams(cut) == grams(joined) and len(grams(cut)) == len(tokens)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 10 ** 13 + 7, 10 ** 13 + 9, 3 * 10 ** 13 + 1
    wide = "cast({} as decimal(19, 0))"
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(
        f"cast(cast(1000000 as decimal(38, 0)) * ({wide.format('a')} * {wide.format('a')}) div ({wide.format('l')} * {wide.format('r')}) as long) AS s")
    assert got.head()["s"] == 10 ** 6 * a * a // (left * right)


def test_top_phrases_break_ties_by_count_and_bytes(spark):
    rows = [("g", "b", 5, 1, 1, 9, 7), ("g", "\U0001f600", 5, 1, 1, 9, 7), ("g", "￿", 5, 1, 1, 9, 7), ("g", "a", 6, 1, 1, 9, 7), ("h", "z", 1, 1, 1, 9, 1)]
    df = spark.createDataFrame(rows, "g string, phrase string, a long, l long, r long, n long, score long")
    got = sorted((r["g"], r["rank"], r["phrase"]) for r in phrases.top(df, 3).collect())
    assert got == [("g", 1, "a"), ("g", 2, "b"), ("g", 3, "￿"), ("h", 1, "z")]
