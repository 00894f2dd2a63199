"""The training-data operators on a small table with every awkward case: nulls in
any column, empty and long texts, ties, repeated rows, clashing extra columns."""

import collections
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ashgrid.llm import (bagminhash, components, embedding_dedup, html_content, line_dedup, maxent_lm, mixing, packing, pii,
                         quality, sharding)
from ashgrid.llm.common import text_or_empty, words

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, row string, h1 long, keep string, "
          "bucket int, t string, w string, rid long, k string, label int")


def prose(seed, n, words_="the of and to in is that das der die le la el y con un une for was it on as".split()):
    rng = random.Random(seed)
    out = [rng.choice(words_) if rng.random() < 0.4 else "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
           for _ in range(n)]
    return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(out))


def awkward_rows():
    texts = [None, "", " \t\n", "a", "One two three.", prose(1, 60), prose(1, 60), prose(2, 400), "the of " * 400, "\n\n\n",
             "x" * 5000, "mail a.b@c.example.org +1 (826) 555-4081 190.137.223.204 4465758382889437 4465758382889437",
             prose(3, 30000), "### $$$ %%% " * 40, "Ärger über Ölfässer, ÉCOLE  nbsp 日本語 \U0001f600 emoji"]
    texts += [prose(i, 80) + "\nShared Line here " for i in range(10, 24)]
    near = prose(99, 200).split(" ")
    texts += [" ".join(near[:k] + ["changed"] + near[k + 1:]) for k in (5, 90, 150)]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, ["en", "de", None, "xx"][i % 4], ["b", "a", None, "c", "ä"][i % 5], None if t is None else len(t),
                     -1, "r", 5, "k", 3, "t", "w", 9, "k", 1))
    rows.append(rows[5])  # a repeated row
    rows.append((None, "a null id " + prose(4, 40), "en", "a", 1, *rows[0][5:]))
    rows.append((3, "same id, other text " + prose(5, 40), "en", None, 1, *rows[0][5:]))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def n_words(t):
    return len(WORD.findall(t or ""))


def test_mixing(docs, empty):
    size = F.size(words(text_or_empty()))
    got = mixing.mix(docs, F.col("doc_id"), F.col("source"), size).collect()
    assert len(got) == len(awkward_rows())
    assert all(0 <= r["copies"] <= 3 for r in got)
    sizes = collections.Counter()
    for r in awkward_rows():
        sizes[r[3]] += n_words(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:  # water filling, one cap at a time
        rest = total - sum(3 * sizes[s] for s in capped)
        share = rest / sum(weight[s] for s in order if s not in capped)
        over = [s for s in order if s not in capped and weight[s] * share > 3 * sizes[s]]
        if not over:
            break
        capped.update(over)
    target = {s: 3 * sizes[s] if s in capped else weight[s] * share for s in order}
    for r in got:
        s = r["row"]["source"]
        assert r["size"] == n_words(r["row"]["text"]) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(target[s])
    again = mixing.mix(docs, F.col("doc_id"), F.col("source"), size).collect()
    key = lambda r: (str(r["row"]["doc_id"]), str(r["row"]["text"]), r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    out = mixing.emit(mixing.mix(docs, F.col("doc_id"), F.col("source"), size))
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty, F.col("doc_id"), F.col("source"), size).count() == 0


def test_mixing_stays_near_targets(spark):
    rng = random.Random(3)
    rows = [(i, f"s{rng.choice([0] * 5 + list(range(6)))}", int(rng.lognormvariate(5, 1))) for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "id long, source string, n long"), F.col("id"), F.col("source"), F.col("n"))
    by = got.groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("x")).collect()
    assert all(abs(r["t"] - r["x"]) < 0.03 * r["x"] for r in by)


def test_sharding(docs, empty, spark):
    got = sharding.shard(docs, F.col("doc_id"), F.col("text")).collect()
    assert len(got) == len(awkward_rows())
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) and 0 <= s < 24 for s, v in by.items())
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in awkward_rows())
    assert sorted((str(r["key"]), r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard(empty, F.col("doc_id"), F.col("text")).count() == 0
    ids = spark.range(20000).withColumn("text", F.lit("x"))
    at = {n: {r["key"]: (r["shard"], r["grown_shard"]) for r in sharding.shard(ids, F.col("id"), F.col("text"), shards=n).collect()} for n in (24, 25)}
    assert all(g == at[25][k][0] and g in (s, 24) for k, (s, g) in at[24].items())
    moved = sum(s != g for s, g in at[24].values())
    assert 600 < moved < 1000
    count = collections.Counter(s for s, _ in at[24].values())
    assert min(count.values()) > 700 and max(count.values()) < 970


def base_counts(t):
    w = WORD.findall(t or "")
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            cover.update(range(i, i + 5))
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover))


def test_quality(docs, empty):
    got = quality.judge(docs, [F.col("doc_id"), F.col("text").alias("own")], F.col("text"), F.col("lang")).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        c = base_counts(r["own"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 10 or 100 * c[4] > 20 * c[0])
        assert not (r["base_failed"] and r["kept"])
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert quality.judge(empty, [F.col("doc_id")], F.col("text"), F.col("lang")).count() == 0


def test_quality_rejects_other_character_classes(spark):
    rng = random.Random(1)
    clean = [(i, prose(1000 + i, 150), "en") for i in range(60)]
    junk = [(100 + i, " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in prose(i, 150).split()), "en") for i in range(5)]
    d = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.keep(d).collect()}
    assert kept == {i for i, _, _ in clean}


def test_jensen_shannon(spark):
    rng = np.random.default_rng(1)
    p, q = rng.random((2, 8))
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    want = math.sqrt((p * np.log2(p / m)).sum() / 2 + (q * np.log2(q / m)).sum() / 2)
    row = spark.createDataFrame([(p.tolist(), q.tolist())], "p array<double>, q array<double>").select(
        quality.jensen_shannon(F.col("p"), F.col("q")), quality.jensen_shannon(F.col("p"), F.col("p"))).first()
    assert row[0] == pytest.approx(want) and row[1] == pytest.approx(0, abs=1e-6)


def line_key(x):
    return x.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})


def brute_lines(rows, min_docs=10):
    seen = collections.defaultdict(set)
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if line_key(x):
                seen[line_key(x)].add((r[0], r[1]))
    return ["\n".join(x for x in (r[1] or "").split("\n") if len(seen[line_key(x)]) < min_docs) for r in rows]


def test_line_dedup(docs, empty):
    rows = awkward_rows()
    got = line_dedup.dedup(docs)
    assert got.columns == docs.columns
    want = brute_lines(rows)
    assert any(w != (r[1] or "") for w, r in zip(want, rows))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got.collect()) == sorted((str(r[0]), w) for r, w in zip(rows, want))
    assert line_dedup.dedup(empty).count() == 0


def test_line_dedup_many_lines(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(f"Line {rng.randint(0, 400)} " for _ in range(rng.choice([1, 70, 300])))) for i in range(120)]
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(zip([r[0] for r in rows], brute_lines(rows)))


def brute_classes(rows, similarity=0.8):
    bags = [(r[0], collections.Counter(bagminhash.shingles(r[1] or "").tolist())) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in itertools.combinations(bags, 2):
        both = sum((a & b).values())
        if both >= similarity * (sum(a.values()) + sum(b.values()) - both):
            a_, b_ = root(i), root(j)
            parent[max(a_, b_)] = min(a_, b_)
    return {i: root(i) for i in parent}


def test_near_classes(docs, empty):
    rows = awkward_rows()
    got = {r["id"]: r["class_id"] for r in bagminhash.near_classes(docs).collect()}
    assert got == brute_classes(rows)
    left = bagminhash.dedup(docs)
    assert left.columns == docs.columns
    # rows that share only their id all stay, repeated rows are one, null ids stay
    want = sorted([i for i, _ in {(r[0], r[1]) for r in rows if r[0] is not None} if got[i] == i] + [-1])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in left.collect()) == want
    assert bagminhash.near_classes(empty).count() == 0


def test_near_classes_of_a_chain_and_repeated_shingles(spark):
    """A chain whose ends differ, and texts that differ only in how often a passage is repeated."""
    base = prose(7, 300).split(" ")
    rows, now = [], list(base)
    for i in range(12):
        rows.append((i, " ".join(now)))
        now = now[:20 * i] + [f"new{i}"] + now[20 * i + 1:]
    rows += [(50 + k, "one two three four five six seven " * n) for k, n in enumerate((10, 11, 40))]
    got = {r["id"]: r["class_id"] for r in bagminhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_bagminhash_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(30):
        ids = np.arange(150, dtype=np.uint64) * np.uint64(7919)
        a = rng.integers(1, 12, 150)
        b = np.where(rng.random(150) < 0.3, rng.integers(1, 12, 150), a)
        x, y = (np.sort(np.repeat(ids, w)) for w in (a, b))
        s = bagminhash.signatures([x, y], 1500)
        errors.append((s[0] == s[1]).mean() - bagminhash.overlap(x, y))
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.02


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for p in links for x in p if p[0] != p[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    rows = []
    for f in range(30):
        centre = rng.standard_normal(64)
        for _ in range(rng.integers(1, 12)):
            v = centre + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14])
            rows.append((v.astype(np.float32).tolist(), int(f % 3)))
    rows += [(rows[0][0], rows[0][1]), (rows[0][0], None), (None, 1), ([0.0] * 64, 1), ([float("nan")] * 64, 1),
             ([float("inf")] * 64, 1), ([None] + [1.0] * 63, 1), (rng.standard_normal(5).tolist(), 1)]
    rows = [(i, v, l) for i, (v, l) in enumerate(rows)]
    d = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<float>, label int, rid string")
    got = {r["id"]: r for r in embedding_dedup.near_vectors(d).collect()}
    good = [(i, np.array(v, float), l) for i, v, l in rows if v and l is not None and None not in v and np.isfinite(v).all() and any(v)]
    n, parent = collections.Counter(), {i: i for i, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a, la), (j, b, lb) in itertools.combinations(good, 2):
        if la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
            n[i] += 1
            n[j] += 1
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    assert sum(n.values()) > 50
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (n[i], root(i), root(i) == i) for i, _, _ in rows}
    assert embedding_dedup.near_vectors(d.limit(0)).count() == 0


def test_embedding_dedup_splits_a_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + rng.standard_normal(16) * 0.01).tolist(), 1) for i in range(150)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert all(r["n_links"] == 149 and r["component_id"] == 0 for r in got)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([ -]?[0-9])+", "phone": r"\+[0-9][ ().0-9-]+[0-9]"}


def base_spans(t):
    def ok(kind, x):
        d = re.sub("[^0-9]", "", x)
        if kind == "ip":
            return all(int(p) <= 255 for p in x.split("."))
        if kind == "card":
            return 13 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, t) if ok(k, m[0])]


def test_pii_base(docs, empty, spark):
    rng = random.Random(8)
    pieces = ["a@b.c", "a@b.c@d.e", "x.y_z@q.w.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4465758382889437", "4465 7583 8288 9437",
              "+1 (826) 555-4081", "+1 826", "+49-30-1234567 ", "0001.02.3.255", " ", "é", "\U0001f600", "a", "..", "@", "-", "5", "1 2 3 4", "\n"]
    odd = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    odd += ["1 " * 20000, "a" * 60000 + "@", "1." * 9000 + "1", "a@" + "b." * 9000 + "c", "+1" + "(" * 5000, None, ""]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string").repartition(4)
    for r in pii.find(d, F.col("text"), ["doc_id"]).select("row.doc_id", pii.span_text(F.col("base")).alias("b"),
                                                          pii.span_text(F.array_sort(F.concat("base", "added"))).alias("a")).collect():
        assert r["b"] == ",".join(base_spans(odd[r["doc_id"]] or "")), odd[r["doc_id"]][:200]
        assert set(r["b"].split(",")) - {""} <= set(r["a"].split(","))
    assert pii.find(docs, F.col("text"), docs.columns).count() == len(awkward_rows())
    assert pii.find(empty, F.col("text"), ["doc_id"]).count() == 0


def test_pii_phone_numbers_alone_in_a_text(spark):
    """Compact numbers and numbers with many separators, without another number in their text."""
    odd = ["call +4915112345678", "+1---2345678901", "+1...234567890 now", "+49(((30123456789", "+4915112345678", "+12345678", "+1"]
    d = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r["doc_id"]: r["b"] for r in pii.find(d, F.col("text"), ["doc_id"]).select("row.doc_id", pii.span_text(F.col("base")).alias("b")).collect()}
    assert got == {i: ",".join(base_spans(t)) for i, t in enumerate(odd)}
    assert got[0].endswith("phone:5:19") and got[1] == "phone:0:15"
    spans = pii.spans(d, F.col("text"), ["doc_id"]).select("row.doc_id", F.col("candidates.x").alias("x")).collect()
    assert all("+4915112345678" in r["x"] for r in spans if r["doc_id"] in (0, 4))


def test_html(spark):
    pages = [f"<html><body><nav><a href=x>Menu {i}</a></nav><article><h1>Title {i}</h1><p>{prose(i, 40)}.<p>Fish &amp; chips,<br>twice."
             f"<aside>Ad ad</aside></article><div class=sidebar><p>{prose(i + 1, 30)}.</p></div><footer>&copy; x</footer>" for i in range(40)]
    odd = [None, "", "plain text", "<div><p>cut off &am", "<script>no", "<p>a < b &lt;c&gt;</p><p>two</p>", "<!-- only", "<div>" * 3000 + "deep"]
    rows = [(i, f"u{i}", h) for i, h in enumerate(pages + odd)] + [(0, "u0", pages[0]), (None, None, pages[1])]
    got = html_content.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r["text"] for r in got}
    for i in range(40):
        assert by[i] == f"Title {i}\n{' '.join(prose(i, 40).split())}.\nFish & chips, twice."
    assert by[40] == by[41] == by[44] == by[46] == "" and by[42] == "plain text"
    assert html_content.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_marginals_are_exact():
    """Sum-product against the sum over all labellings of a small tree."""
    page = html_content.Page("<div><p>one two three</p><ul><li>x</li></ul></div><footer>f</footer>")
    rng = np.random.default_rng(3)
    w, p = rng.standard_normal(len(html_content.FEATURES)), rng.standard_normal((len(html_content.KINDS), 2, 2))
    single, both, _ = html_content.Forest([page]).marginals(w, p)
    n = len(page.parent)
    total, mass = 0.0, np.zeros((n, 2))
    for y in itertools.product((0, 1), repeat=n):
        s = sum(y[i] * sum(w[f] for f in page.features[i]) for i in range(n))
        s += sum(p[page.kind[i], y[page.parent[i]], y[i]] for i in range(n) if page.parent[i] >= 0)
        total += math.exp(s)
        for i in range(n):
            mass[i, y[i]] += math.exp(s)
    assert np.allclose(np.exp(single), mass / total)
    assert np.allclose(np.exp(both[1:]).sum(axis=(1, 2)), 1)


def test_language_model(docs, empty, spark):
    rows = [(i, r[1]) for i, r in enumerate(awkward_rows())] + [(100 + i, prose(500 + i, 120)) for i in range(80)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = maxent_lm.score(d).collect()
    assert len(got) == len(rows)
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for r in got:
        ws = tokens[r["id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0
    out = [r for r in got if r["held_out"] and r["id"] >= 100]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert maxent_lm.score(docs).count() == len(awkward_rows())
    assert maxent_lm.score(empty).count() == 0


def test_language_model_is_a_distribution():
    """Probabilities of all known words and the place of unseen ones add up to one."""
    rng = np.random.default_rng(2)
    types = 3000
    h = rng.integers(-2**62, 2**62, types)
    c = np.sort(rng.integers(1, 500, types))[::-1].copy()
    v = maxent_lm.Vocabulary(h[:2900], c[:2900], int(c.sum()), types)
    size = maxent_lm.CLASS_ROWS * maxent_lm.CLASSES + maxent_lm.WORD_ROWS * maxent_lm.CLASS_WORDS
    w = rng.standard_normal(size).astype(np.float32) * 0.3
    before = h[[3, 700, 2950]].view(np.uint64)
    total = 0.0
    for word, count in [*zip(h.view(np.uint64), c), (np.uint64(12345), 0)]:
        text = np.append(before, word)
        found = v.find(text)
        p = math.exp(maxent_lm.log_probabilities(text, np.array([4]), found, v, w)[3])
        total += p * (count + 1 if found[3] < 0 else 1)
    assert total == pytest.approx(1, abs=1e-3)


def test_language_model_grows_with_the_types(monkeypatch):
    """More distinct words: more rows and more words scored by context, still a distribution; the pair of words before counts."""
    rng = np.random.default_rng(2)
    h = rng.integers(-2**62, 2**62, 9000)
    c = np.sort(rng.integers(1, 500, 9000))[::-1].copy()
    small = maxent_lm.Vocabulary(h, c, int(c.sum()), 9000)
    monkeypatch.setattr(maxent_lm, "TYPES", 3000)
    v = maxent_lm.Vocabulary(h[:8900], c[:8900], int(c.sum()), 9000)
    assert v.head == 3 * small.head == 3 * 2048
    assert [n for n, _ in v.shapes()[:2]] == [3 * n for n, _ in small.shapes()] == [3 * 16384] * 2
    w = rng.standard_normal(v.size()).astype(np.float32) * 0.3
    before = h[[3, 700, 2950]].view(np.uint64)
    total = 0.0
    for word, count in [*zip(h.view(np.uint64), c), (np.uint64(12345), 0)]:
        text = np.append(before, word)
        found = v.find(text)
        p = math.exp(maxent_lm.log_probabilities(text, np.array([4]), found, v, w)[3])
        total += p * (count + 1 if found[3] < 0 else 1)
    assert total == pytest.approx(1, abs=1e-3)
    texts = [" ".join(f"{a} {b} {a if a == b else 'xy'[a == 'x']}" for a, b in itertools.product("xy", "xy")) for _ in range(3)]
    assert maxent_lm.contexts(*maxent_lm.joined(texts)).shape[1] == 4
    # the word after "a b" is x, after "c b" y: single words at their distances say nothing once "a" and "c" have both places
    rows = [" ".join(rng.choice(["a b x", "c b y", "c d x", "a d y"], 300)) for _ in range(40)]
    tokens, counts = maxent_lm.joined(rows)
    u, n = np.unique(tokens, return_counts=True)
    v = maxent_lm.Vocabulary(u.view(np.int64), n, int(n.sum()), len(u))
    w = np.zeros(v.size(), np.float32)
    for _ in range(4):
        maxent_lm.train_task(iter([rows]), v, w)
    ln = maxent_lm.log_probabilities(tokens, counts, v.find(tokens), v, w)
    last = np.isin(tokens, [maxent_lm.token_hashes(x)[0] for x in "xy"])
    assert ln[last].mean() > -0.3


def test_language_model_chooses_among_few():
    """No choice has more than 32 places; families and their classes give the shares of the classes."""
    rng = np.random.default_rng(4)
    c = np.sort(rng.integers(1, 500, 9000))[::-1].copy()
    v = maxent_lm.Vocabulary(rng.integers(-2**62, 2**62, 9000), c, int(c.sum()) + 10, 9003)
    tables = v.tables(np.zeros(v.size(), np.float32))
    assert max(t.shape[1] for t in tables) <= 32 and sum(t.size for t in tables) == v.size()
    classes = np.arange(maxent_lm.CLASSES)
    first = v.choice_log[maxent_lm.choices(classes)].astype(float)
    head = classes[:maxent_lm.HEAD_CLASSES]
    first[head] += v.family_log[head // maxent_lm.FAMILY, head % maxent_lm.FAMILY]
    size = np.maximum(np.bincount(v.classes, v.c, maxent_lm.CLASSES), 0.5)
    size[maxent_lm.RARE] = 10
    assert np.allclose(np.exp(first), size / size.sum(), rtol=1e-4)
    known = v.h[[0, 5, 8999]]
    assert list(v.find(np.append(known, known[0] ^ np.uint64(1)))) == [0, 5, 8999, -1]


def test_language_model_sums_and_shares():
    """Sums of runs against a loop; shares of rows that single precision cannot exponentiate."""
    rng = np.random.default_rng(5)
    for n in (1, 7, 400, 20_000):
        runs = np.sort(rng.zipf(1.2, n) % 3000)
        values, picked = rng.standard_normal((n, 9)).astype(np.float32), rng.integers(0, n, n)
        starts = np.r_[0, np.flatnonzero(np.diff(runs)) + 1]
        expected = [values[picked[a:b]].astype(float).sum(axis=0) for a, b in zip(starts, np.r_[starts[1:], n])]
        assert np.allclose(maxent_lm.sums_of_runs(values, picked, starts), expected, rtol=1e-4, atol=1e-2)
    x = np.array([[200, 199, -np.inf], [-300, -300, -301], [1, 2, 3]], np.float32)
    shifted = np.exp(x.astype(float) - x.max(axis=1, keepdims=True))
    shares = shifted / shifted.sum(axis=1, keepdims=True)
    assert np.allclose(maxent_lm.softmax(x.copy()), shares, atol=1e-6)
    assert np.allclose(maxent_lm.softmax(x[2:].copy()), shares[2:], atol=1e-6)
    assert np.allclose(np.exp(maxent_lm.log_chosen(x.copy(), np.array([1, 2, 0]))), shares[[0, 1, 2], [1, 2, 0]])


RAW_PAGES = [
    ("<p>one</p><svg class=icon/><p>two</p>", "one\ntwo"), ("<p>one</p><svg><p>three</p>", "one\nthree"),
    ("<p>one <svg><title>no</title><text>no</text></svg>two</p>", "one two"), ("<p>value <math><mi>x</mi><mo>=</mo><mn>2</mn></math> end</p>", "value x=2 end"),
    ("<p>one</p><object data=x><p>two</p>", "one\ntwo"), ("<p>a <object>b</object> c</p>", "a b c"), ("<p>a <canvas>b</canvas></p><p>c</p>", "a b\nc"),
    ("<p>a</p><noscript><p>b</p></noscript><p>c</p>", "a\nb\nc"), ("<p>a</p><noscript><p>b</p>", "a\nb"), ("<math/><p>a</p>", "a"),
    ("<p>a</p><script>b</script><style>c</style><p>d</p>", "a\nd"), ("<p>a</p><script>b <p>c</p>", "a"), ("<p>a</p><template><p>b</p></template><p>c</p>", "a\nc"),
    ("</div>" * 50 + "<p>a</p></section></p>b", "a\nb"), ("<table><tr><td>a<td>b<tr><td>c</table><p>d</p>", "a\nb\nc\nd"),
    ("<p hidden>a</p><p>b &amp; c<!-- d --></p>", "b & c"), ("<pre>a\n  b</pre>", "a b"),
]


@pytest.mark.parametrize("html, want", RAW_PAGES)
def test_pages_keep_the_text_around_odd_tags(html, want):
    page = html_content.Page("<article>" + html + "</article>")
    hidden = html_content.AT["hidden"]
    gone = [i for i, f in enumerate(page.features) if hidden in f]
    assert "\n".join(t for i, t in enumerate(page.text) if t is not None and page.parent[i] not in gone) == want


def test_deep_pages_with_stray_closing_tags_are_read_in_time():
    began = time.time()
    page = html_content.Page("<div>" * 20_000 + "a" + "</section>" * 20_000 + "<p>b</p>")
    assert [t for t in page.text if t] == ["a", "b"] and max(page.depth) > 20_000
    assert time.time() - began < 20


def test_near_dedup_keeps_other_texts_of_an_id(spark):
    rows = [(1, prose(1, 60), "b"), (1, prose(1, 60), "a"), (1, prose(2, 60), "c"), (2, prose(1, 60), "d"), (None, "x", "e"), (None, "x", "f")]
    got = bagminhash.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    assert sorted((r["doc_id"] or 0, r["source"]) for r in got.collect()) == [(0, "e"), (0, "f"), (1, "a"), (1, "c")]


def test_packing(docs, empty):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    cut = packing.pieces(docs.withColumn("doc_id", F.xxhash64("doc_id", "text")), F.col("doc_id"), F.col("text"), limit=256, with_ids=True).cache()
    keys = {r["k"]: r["text"] for r in docs.select(F.xxhash64("doc_id", "text").alias("k"), "text").collect()}
    by = collections.defaultdict(list)
    for r in packing.pack(cut, 256).collect():
        by[r["sequence_id"]].append((r["offset"], r["length"], r["doc_id"], r["piece"], r["start"], r["ids"], r["ids_crc32"]))
    total, texts = 0, collections.defaultdict(dict)
    for rows in by.values():
        at = 0
        for offset, length, key, piece, start, ids, crc in sorted(rows):
            assert offset == at and len(ids) == 4 * length and zlib.crc32(ids) == crc
            at += length
            texts[key][piece] = (start, ids)
        assert at <= 256
        total += at
    for key, text in keys.items():
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        parts = [texts[key][i] for i in sorted(texts[key])]
        assert b"".join(p[1] for p in parts) == ids
        assert all(len(p[1]) == 4 * 256 for p in parts[1:])
    lengths = [r["length"] for r in cut.select("length").collect()]
    assert len(by) <= len(packing.best_fit(lengths, 256))
    assert packing.pack(packing.pieces(empty, F.col("doc_id"), F.col("text"))).count() == 0


def test_word_tokens_equal_whole_text_tokens():
    rng = random.Random(1)
    tokens = packing.tokens_of(packing.TOKENIZER, packing.RANKS)
    texts = ["", " ", "  a", "a  b", "a   b", "\n \n x", "a\n  b\n", "end  ", "<|endoftext|> x", "tab\t x \t\ty", "y" * 3000 + " z"]
    texts += ["".join(rng.choice(" \n\tab1. 'é ") for _ in range(30)) for _ in range(2000)]
    want = tokens.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert tokens.batch(texts) == [np.array(x.ids, "<u4").tobytes() for x in want]


def test_added_tokens_have_their_own_id(spark):
    """Ids as the tokenizer gives them with its defaults, an added token included."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> x", "<|endoftext|>", "x<|endoftext|>y  z", "<|endoftext|> <|endoftext|>", "<|endoftext", "plain words"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 2124]
    tokens = packing.tokens_of(packing.TOKENIZER, packing.RANKS)
    assert tokens.batch(texts) == [np.array(x, "<u4").tobytes() for x in want]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["ids"]) for r in packing.pieces(d, F.col("doc_id"), F.col("text"), with_ids=True).collect()}
    assert got == {i: np.array([*x, 2], "<u4").tobytes() for i, x in enumerate(want)}


def placed(counts, limit):
    """Sequences of a plan that places every piece once and none beyond the limit."""
    rows, used = packing.plan(dict(counts), limit), collections.Counter()
    for length, lo, hi, times, _, offset in rows:
        assert lo == used[length] and (hi - lo) % times == 0 and offset + length * times <= limit
        used[length] = hi
    assert used == collections.Counter(counts)
    return max(first + (hi - lo) // times for _, lo, hi, times, first, _ in rows)


def test_packing_plan_does_not_depend_on_the_number_of_pieces():
    for k in (1, 100, 10_000):
        # optimum: 520 + 340 in half of the 340s' sequences, the others by threes
        assert placed({520: 600 * k, 340: 1200 * k}, 1024) <= 800 * k * 1.001 + 1
    rng = random.Random(4)
    counts = {n: rng.randint(50, 3000) for n in rng.sample(range(260, 700), 200)}
    one, *more = [placed({n: c * k for n, c in counts.items()}, 1024) / k for k in (1, 100, 10_000)]
    assert all(x <= one * 1.0001 for x in more)
    solution = packing.solve(counts, 1024)
    for n, c in counts.items():
        assert sum(x * dict(column).get(n, 0) for column, x in solution.items()) == pytest.approx(c, rel=1e-5)


def test_packing_plan_ends_on_awkward_histograms(spark):
    """In a process with a Spark session, within seconds, near the size bound."""
    rng = np.random.default_rng(1)
    draws = [(rng.lognormal(6, 0.4, 50_000), 1.012), (rng.lognormal(5.5, 0.4, 20_000), 1.004), (np.arange(2, 1024).repeat(40), 1.001),
             (np.full(5000, 1), 1.001), (np.full(999, 513), 2)]
    for lengths, most in draws:
        lengths = np.clip(lengths, 1, 1023).astype(int)
        began = time.time()
        n = placed(collections.Counter(lengths.tolist()), 1024)
        assert n <= math.ceil(lengths.sum() / 1024 * most) + 1
        assert time.time() - began < 90


def test_best_fit_on_counts_equals_best_fit():
    rng = random.Random(6)
    for size in (0, 1, 40, 3000):
        lengths = [rng.randint(1, 255) for _ in range(size)]
        columns = packing.best_fit_counts(collections.Counter(lengths), 256)
        assert sum(columns.values()) == len(packing.best_fit(lengths, 256))
        assert sum((collections.Counter({k: n * copies}) for column, copies in columns.items() for k, n in column),
                   collections.Counter()) == collections.Counter(lengths)


def test_packing_plan_is_near_the_bound():
    rng = random.Random(2)
    lengths = [min(1023, max(1, int(rng.lognormvariate(5.5, 0.9)))) for _ in range(6000)]
    counts = collections.Counter(lengths)
    rows = packing.plan(dict(counts), 1024)
    used = collections.Counter()
    for length, lo, hi, times, _, _ in rows:
        assert lo == used[length] and (hi - lo) % times == 0
        used[length] = hi
    assert used == counts
    n = max(first + (hi - lo) // times for _, lo, hi, times, first, _ in rows)
    assert n <= math.ceil(sum(lengths) / 1024) * 1.004 + 1
