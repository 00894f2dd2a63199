"""Quality rules: base counts and the divergence from language references.

Every document becomes two histograms, one of character classes and one of
common words.  The references are the mean histograms of each language over
all documents that pass the base rules and the length guard.  A document far
from its language's reference by Jensen-Shannon distance in either histogram
is rejected; shorter texts than the guard are not judged by it.

Defined results: a null or blank text has no words and fails the base rules; a
null language is a language of its own; a language without a reference (no
document passes) judges nobody; repeated rows are judged alike; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key, text_or_empty, words

#: fixed values: frequent function words of four languages
COMMON_WORDS = tuple(
    "the of and to in is that der die und den von zu das le les et des un une que la el los y del se con".split()
)
SYMBOLS = "#*$%&|<>"
#: classes counted in what is left when lower-case ASCII letters and white space are gone
CHAR_CLASSES = ("[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\x2D]+", f"[{SYMBOLS}]+", r"[\x00-\x7F]+", r"\p{L}+")
SCALE = 1_000_000

MIN_WORDS, MAX_REPEAT_PCT = 10, 20
GUARD_WORDS = 50
#: a mean histogram of few words strays from its reference by about 1 / sqrt(words)
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, WORD_NOISE = 0.3, 0.25, 1.0


def shifted(name: str, by: int) -> Column:
    return F.slice(F.col(name), F.lit(by + 1), F.size(name))


def repeated_words(w: str) -> list[tuple[str, Column]]:
    """Columns to add in turn; the last, n_repeat_words, is the number of words
    in 5-word windows that occur twice or more in the array column ``w``.

    Hashes of 4 neighbours are compared as a set first: where all differ no
    5-word window repeats.  Only the other texts build the 5-word hashes, sort
    (hash, position) and look at neighbours."""
    both = lambda a, b: F.xxhash64(a, b)
    ordered = F.array_sort(F.transform("g5", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.zip_with("pairs", shifted("pairs", 1), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    covered = F.zip_with("starts", shifted("starts", 1), lambda a, b: F.least(F.lit(5), b - a))
    return [
        ("g2", F.slice(F.zip_with(w, shifted(w, 1), both), F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))),
        ("g4", F.slice(F.zip_with("g2", shifted("g2", 2), both), F.lit(1), F.greatest(F.size("g2") - 2, F.lit(0)))),
        ("g5", F.when(F.size(F.array_distinct("g4")) < F.size("g4"),
                      F.slice(F.zip_with("g4", shifted(w, 4), both), F.lit(1), F.greatest(F.size(w) - 4, F.lit(0))))),
        ("pairs", F.when(F.col("g5").isNotNull(), ordered)),
        ("starts", F.when(F.col("pairs").isNotNull(), F.sort_array(F.array_distinct(F.flatten(same))))),
        ("n_repeat_words", F.when(F.col("starts").isNotNull(), F.aggregate(
            covered, F.lit(0), lambda s, x: s + x)).otherwise(0).cast("long")),
    ]


def features(docs: DataFrame, key: list[Column], text: Column, lang: Column) -> DataFrame:
    """Counts and the two histograms of each row, from the whole text; no shuffle."""
    d = docs.select(*key, F.coalesce(lang.cast("string"), F.lit("")).alias("lang"), F.isnull(lang).alias("no_lang"),
                    text_or_empty(text).alias("t"))
    names = [c for c in d.columns if c != "t"]
    d = d.withColumns({
        "w": words(F.col("t")),
        "lines": F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "rest": F.regexp_replace("t", r"[a-z\x20\x09-\x0D]+", ""),
    })
    for name, column in repeated_words("w"):
        d = d.withColumn(name, column)
    left, classes = F.col("rest"), []
    for pattern in CHAR_CLASSES:
        d = d.withColumn(f"r{len(classes)}", F.regexp_replace(left, pattern, ""))
        after = F.col(f"r{len(classes)}")
        classes.append(F.length(left) - F.length(after))
        left = after
    chars, in_words = F.length("t"), F.length(F.array_join("w", ""))
    d = d.withColumn("common", F.filter("w", lambda x: x.isin(*COMMON_WORDS)))
    bins = F.array(*[F.lit(x) for x in COMMON_WORDS])
    counted = F.transform(bins, lambda x: F.size("common") - F.size(F.array_remove(F.col("common"), x)))
    return d.select(
        *names,
        F.size("w").cast("long").alias("n_words"),
        in_words.cast("long").alias("word_chars"),
        F.length(F.regexp_replace("rest", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.concat(F.array(chars - in_words, in_words - F.length("rest")), F.array(*classes), F.array(F.length(left))).alias("chars"),
        F.concat(counted, F.array(F.size("w") - F.size("common"))).alias("commons"),
    )


def shares(hist: Column) -> Column:
    total = F.aggregate(hist, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.transform(hist, lambda x: x / F.greatest(total, F.lit(1)))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance in [0, 1] of two arrays of shares: the root of the divergence in bits."""
    half = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    terms = F.zip_with(p, q, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2))


def references(feats: DataFrame) -> DataFrame:
    """(lang, no_lang) -> mean histograms, each document with one vote in whole
    millionths: sums of integers, so that reruns agree to the last bit."""
    good = feats.filter(~F.col("base_failed") & (F.col("n_words") >= GUARD_WORDS))
    n_char, n_word = len(CHAR_CLASSES) + 3, len(COMMON_WORDS) + 1
    votes = {"chars": n_char, "commons": n_word}
    good = good.select("lang", "no_lang", *[
        F.transform(shares(F.col(c)), lambda x: F.round(x * SCALE).cast("long")).alias(c) for c in votes])
    sums = good.groupBy("lang", "no_lang").agg(*[
        F.sum(F.get(F.col(c), F.lit(i))).alias(f"{c}{i}") for c, n in votes.items() for i in range(n)])
    return sums.select("lang", "no_lang", *[
        F.array(*[F.col(f"{c}{i}") for i in range(n)]).alias(f"ref_{c}") for c, n in votes.items()])


def judge(docs: DataFrame, key: list[Column], text: Column, lang: Column,
          max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per input row: the key, the counts, base_failed, both distances
    (null where nothing is judged) and kept."""
    names = [c for c in docs.select(*key).columns]
    feats = features(docs, key, text, lang).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    feats = materialize(feats, "quality-features")
    judged = feats.join(references(feats), ["lang", "no_lang"], "left")
    guard = (F.col("n_words") >= GUARD_WORDS) & F.col("ref_chars").isNotNull()
    judged = judged.withColumns({
        "char_distance": F.when(guard, jensen_shannon(shares(F.col("chars")), shares(F.col("ref_chars")))),
        "word_distance": F.when(guard, jensen_shannon(shares(F.col("commons")), shares(F.col("ref_commons")))),
    })
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > max_char_distance) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > max_word_distance + WORD_NOISE / F.sqrt("n_words"))
    return judged.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    key = row_key(F.col(id_col), F.col(text_col), F.col(lang_col))
    verdicts = judge(docs, key, F.col(text_col), F.col(lang_col))
    gone = verdicts.filter(~F.col("kept")).select(F.col("h1").alias("__g1"), F.col("h2").alias("__g2")).distinct()
    h1, h2 = key
    return docs.join(gone, (h1 == F.col("__g1")) & (h2 == F.col("__g2")), "left_anti")
