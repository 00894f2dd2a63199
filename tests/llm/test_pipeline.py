"""The corpus pipeline, stage by stage and whole, against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as CP
from ashgrid.llm import quality

from ..conftest import SF0001
from .test_operators import WORD, awkward_rows, base_counts, brute_classes, brute_lines, n_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def histograms(t):
    w = WORD.findall(t)
    rest, chars = re.sub(r"[a-z\x20\x09-\x0D]+", "", t), []
    spaces = len(t) - sum(map(len, w))
    chars = [spaces, len(t) - spaces - len(rest)]
    for p in ("[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\x2D]+", "[#*$%&|<>]+", r"[\x00-\x7F]+"):
        left = re.sub(p, "", rest)
        chars.append(len(rest) - len(left))
        rest = left
    letters = sum(c.isalpha() for c in rest)
    chars += [letters, len(rest) - letters]
    common = collections.Counter(x for x in w if x in quality.COMMON_WORDS)
    return np.array(chars, float), np.array([*(common[x] for x in quality.COMMON_WORDS), len(w) - sum(common.values())], float)


def distance(p, q):
    p, q = p / max(1, p.sum()), q / max(1, q.sum())
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return math.sqrt(max(0.0, (np.nan_to_num(p * np.log2(p / m)) + np.nan_to_num(q * np.log2(q / m))).sum() / 2))


def brute_quality(rows):
    counts = [base_counts(r[1]) for r in rows]
    failed = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c in counts]
    hist = [histograms(r[1] or "") for r in rows]
    refs = {}
    for r, c, f, h in zip(rows, counts, failed, hist):
        if not f and c[0] >= quality.GUARD_WORDS:
            own = refs.setdefault(r[2], [0, 0])
            for k in (0, 1):
                own[k] = own[k] + np.round(h[k] / h[k].sum() * quality.SCALE)
    out = []
    for r, c, f, h in zip(rows, counts, failed, hist):
        far = False
        if not f and c[0] >= quality.GUARD_WORDS and r[2] in refs:
            far = distance(h[0], refs[r[2]][0]) > quality.MAX_CHAR_DISTANCE or \
                distance(h[1], refs[r[2]][1]) > quality.MAX_WORD_DISTANCE + quality.WORD_NOISE / math.sqrt(c[0])
        if not f and not far:
            out.append(r)
    return out


def brute_near(rows):
    classes = brute_classes(rows)
    return [r for r in {r[0]: r for r in rows if r[0] is not None}.values() if classes[r[0]] == r[0]] + [r for r in rows if r[0] is None]


def draw(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:8], 16)


def brute_mix(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by["1" if r[3] is None else "0" + r[3]].append(r)
    order = sorted(by)
    size = {s: sum(n_words(r[1]) for r in by[s]) for s in order}
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, total = set(), sum(size.values())
    while True:
        share = (total - sum(3 * size[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        over = [s for s in order if s not in capped and 3 * size[s] <= weight[s] * share]
        if not over:
            break
        capped.update(over)
    out = []
    for s in order:
        target = 3 * size[s] if s in capped else weight[s] * share
        rate = target / size[s] if size[s] else 0.0
        u = draw("mix", s) / 2**32

        def place(r):
            n = n_words(r[1])
            bits = max(1, n.bit_length())
            return (bits * 16 + ((n * 16) >> bits)) * 64 + draw("mix", "" if r[0] is None else str(r[0])) % 64, n, r[0] is not None, r[0] or 0

        for k, r in enumerate(sorted(by[s], key=place)):
            out += [r] * (math.floor((k + 1) * rate + u) - math.floor(k * rate + u))
    return out


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


STAGE = dict(CP.STAGES)
BRUTE = {
    "quality_rules": brute_quality,
    "line_dedup": lambda rows: [(r[0], None if r[1] is None else t, *r[2:4], r[4] if r[1] is None else len(t)) for r, t in zip(rows, brute_lines(rows))],
    "minhash_near_dedup": brute_near,
    "source_mixing": brute_mix,
}


def check_packed(packed, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in rows:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids + [2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        at, k = 0, 0
        while at < len(ids):
            n = first if k == 0 else 1024
            want[(r[0], k, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()))] += 1
            at, k = at + n, k + 1
    got = packed.collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(by) <= math.ceil(sum(r["length"] for r in got) / 1024) * 1.02 + 1


def test_the_pipeline_is_registered():
    assert E.queries()["pipeline"] and "pipeline" not in E.oracle_sql()
    assert list(STAGE) == ["quality_rules", "line_dedup", "minhash_near_dedup", "source_mixing", "best_fit_packing"]


@pytest.mark.parametrize("name", list(BRUTE))
def test_stage_on_awkward_rows(spark, name):
    rows = [r[:5] for r in awkward_rows() if r[0] is not None or name != "minhash_near_dedup"]
    if name == "minhash_near_dedup":  # of rows with one id either may stay
        rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = STAGE[name](spark, docs, SF0001)
    assert got.columns == docs.columns
    assert rows_of(got) == sorted(map(repr, BRUTE[name](rows)))
    assert STAGE[name](spark, docs.limit(0), SF0001).count() == 0


def test_run_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    for name in BRUTE:
        rows = BRUTE[name](rows)
    check_packed(CP.run(spark, SF0001), rows)
