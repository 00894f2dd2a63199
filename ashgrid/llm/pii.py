"""Personal data: candidate spans, boosted trees, calibrated thresholds.

The base finds e-mail addresses, IP addresses, card and phone numbers by strict
patterns and checks.  High-recall generators propose further, overlapping spans
(for example a phone number that the base pattern ran into the next number).
Boosted trees score every candidate by format and context.  They learn from the
base: its spans are the positives; candidates that fail their own check, or that
overlap a base span without being it, are the negatives.  For each kind a
threshold is calibrated on held-out labels; of the other candidates above it,
those that overlap no better one are added.  Base spans always stay.

Everything runs in DataFrame expressions and MLlib's DataFrame API.  The trees
are fitted on at most ``FIT_ROWS`` labelled candidates (those with the smallest
hashes); candidates, thresholds and scores cover all rows.

Defined results: a null text is empty and has no spans; repeated rows are
searched alike; without labels of both sorts nothing is added; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: the base patterns, possessive and anchored at the start of a run: linear time, and no recursion on long runs
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: what a text must hold for a pattern of the kind to be tried at all; every match that can count implies it
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]|[0-9][\x20.)-]{1,2}[0-9]"}
GENERATORS = (
    ("email", r"(?<![^\s@<>()\[\],;:\"'])[^\s@<>()\[\],;:\"']++@(?:[^\s@<>()\[\],;:\"'.]++\.(?=\p{L}))++\p{L}{2,}"),
    ("ip", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\([0-9]{2,4}\)[\x20.-]?[0-9]{2,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}(?:[\x20.-][0-9]{2,4}){2,3}?[\x20.-][0-9]{3,4}(?![0-9])"),
    ("phone", r"\+[0-9]{9,15}(?![0-9])"),
    ("phone", r"\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9+])[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = 24
CUES = {"cue_mail": r"(?i)mail|contact|write", "cue_phone": r"(?i)tel|phone|call|fon|mobile|fax",
        "cue_card": r"(?i)card|visa|credit|pay|karte|carte|tarjeta", "cue_ip": r"(?i)\bip\b|server|host|address"}
FIT_ROWS, TREES, DEPTH = 20_000, 20, 4
PRECISION = 0.99
SPAN = "struct<kind:int,s:int,e:int,x:string>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def passes(kind: int, x: Column) -> Column:
    """The check of a kind on a match's own text."""
    n = F.length(digits(x))
    return {
        "email": F.lit(True),
        "ip": x.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "card": n.between(13, 19) & F.call_function("luhn_check", digits(x)),
        "phone": n.between(9, 15),
    }[KINDS[kind]]


def matches(text: Column, kind: int, pattern: str) -> Column:
    """array<SPAN> of a pattern's matches: the lengths of the pieces between the
    matches and of the matches themselves add up to their places (code points)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(F.split(text, pattern, -1), found, lambda gap, x: F.struct(F.length(gap).alias("gap"), x.alias("x")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        s = state["at"] + piece["gap"]
        e = s + F.length(piece["x"])
        span = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), piece["x"].alias("x"))
        return F.struct(e.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    added = F.aggregate(F.filter(sizes, lambda p: p["x"].isNotNull()), start, step, lambda state: state["out"])
    return F.when(text.rlike(NEEDS[KINDS[kind]]), added).otherwise(F.array().cast(f"array<{SPAN}>"))


def spans(docs: DataFrame, text: Column, carry: list[str]) -> DataFrame:
    """The columns to carry in ``row``, base spans and candidates."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text_or_empty(text).alias("t"))
    none = F.array().cast(f"array<{SPAN}>")
    some = F.col("t").rlike("[0-9@]")
    def checked(kind: int) -> Column:
        return F.filter(matches(F.col("t"), kind, BASE[KINDS[kind]]), lambda m: passes(kind, m["x"]))

    base = [checked(k) for k in range(len(KINDS))]
    d = d.withColumn("base", F.when(some, F.concat(*base)).otherwise(none))
    more = [matches(F.col("t"), KINDS.index(kind), pattern) for kind, pattern in GENERATORS]
    d = d.withColumn("more", F.when(some, F.array_distinct(F.concat("base", *more))).otherwise(none))
    around = F.transform("more", lambda m: F.struct(
        m["kind"].alias("kind"), m["s"].alias("s"), m["e"].alias("e"), m["x"].alias("x"),
        F.substring(F.col("t"), F.greatest(m["s"] - CONTEXT, F.lit(0)) + 1, F.least(m["s"], F.lit(CONTEXT))).alias("l"),
        F.substring(F.col("t"), m["e"] + 1, F.lit(CONTEXT)).alias("r"),
        F.exists("base", lambda b: (b["kind"] == m["kind"]) & (b["s"] == m["s"]) & (b["e"] == m["e"])).alias("is_base"),
        F.exists("base", lambda b: (b["kind"] == m["kind"]) & (b["s"] < m["e"]) & (b["e"] > m["s"])).alias("near_base")))
    return d.select("row", F.transform("base", lambda m: F.struct(m["kind"], m["s"], m["e"])).alias("base"), around.alias("candidates"))


def candidate_features(candidates: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each candidate as numbers, and its label: 1 a base
    span, 0 one that fails its check or misses a base span, null otherwise."""
    x, left, right = F.col("x"), F.col("l"), F.col("r")
    valid = F.coalesce(*[F.when(F.col("kind") == k, passes(k, x)) for k in range(len(KINDS))])
    ends = {"space": r"^[\x20\x09-\x0D]", "letter": r"^\p{L}", "digit": "^[0-9]", "point": r"^[.,;:!?)]", "other": r"^[^\x20\x09-\x0D\p{L}0-9.,;:!?)]"}
    feats = {
        **{f"is_{kind}": F.col("kind") == k for k, kind in enumerate(KINDS)},
        "valid": valid, "n_chars": F.length(x), "n_digits": F.length(digits(x)),
        "n_groups": F.size(F.regexp_extract_all(x, F.lit("[0-9]+"), F.lit(0))),
        "last_group": F.length(F.regexp_extract(x, "([0-9]+)$", 1)), "plus": F.startswith(x, F.lit("+")),
        "paren": F.contains(x, F.lit("(")), "dash": F.contains(x, F.lit("-")), "dot": F.contains(x, F.lit(".")), "blank": F.contains(x, F.lit(" ")),
        "ascii": F.octet_length(x) == F.length(x),
        **{f"left_{k}": F.reverse(left).rlike(p) for k, p in ends.items()}, **{f"right_{k}": right.rlike(p) for k, p in ends.items()},
        "left_end": F.length(left) == 0, "right_end": F.length(right) == 0,
        **{k: left.rlike(p) for k, p in CUES.items()},
    }
    label = F.when(F.col("is_base"), 1.0).when(~F.coalesce(valid, F.lit(False)) | F.col("near_base"), 0.0)
    return candidates.withColumns({**{k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in feats.items()}, "label": label}), list(feats)


def added_spans(candidates: DataFrame) -> DataFrame:
    """(rid, kind, s, e) of the spans that the trees add."""
    rows, names = candidate_features(candidates)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select(
        "rid", "kind", "s", "e", "label", "features", F.xxhash64("rid", "kind", "s", "e").alias("h"))
    rows = materialize(rows, "pii-features")
    labelled = rows.filter(F.col("label").isNotNull())
    held = F.pmod("h", F.lit(4)) == 0
    sample = labelled.filter(~held).orderBy("h").limit(FIT_ROWS).select("label", "features").coalesce(1)
    sample = materialize(sample, "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return rows.filter(F.lit(False)).select("rid", "kind", "s", "e")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(sample)
    scored = model.transform(rows).select("rid", "kind", "s", "e", "label", "h", vector_to_array("probability")[1].alias("p"))
    scored = materialize(scored, "pii-scores")
    # per kind the lowest score (in hundredths) from which the held-out labels are precise enough
    step = F.floor(F.col("p") * 100)
    tally = (scored.filter(F.col("label").isNotNull() & held).groupBy("kind", step.alias("step"))
             .agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")))
    above = Window.partitionBy("kind").orderBy(F.desc("step"))
    tally = tally.withColumn("precision", F.sum("good").over(above) / F.sum("n").over(above))
    limits = tally.filter((F.col("precision") >= PRECISION) & (F.col("step") >= 50)).groupBy("kind").agg(F.min("step").alias("limit"))
    chosen = (scored.filter(F.col("label").isNull()).withColumn("step", step).join(limits, "kind")
              .filter(F.col("step") >= F.col("limit")))
    # a better candidate that overlaps wins: best first, then longer, then earlier
    rank = F.struct("p", (F.col("e") - F.col("s")).alias("n"), (-F.col("s")).alias("m"))
    better = chosen.select(F.col("rid").alias("rid2"), F.col("kind").alias("kind2"), F.col("s").alias("s2"), F.col("e").alias("e2"), rank.alias("rank2"))
    return chosen.withColumn("rank", rank).join(better, (F.col("rid") == F.col("rid2")) & (F.col("kind") == F.col("kind2")) & (F.col("s") < F.col("e2"))
                                                & (F.col("e") > F.col("s2")) & (F.col("rank") < F.col("rank2")), "left_anti").select("rid", "kind", "s", "e")


def find(docs: DataFrame, text: Column, carry: list[str]) -> DataFrame:
    """One row per input row: ``row`` (the columns to carry), ``base`` and ``added``,
    arrays of struct(kind, s, e) in order; kind counts ``KINDS``, places are code
    points, the end is exclusive."""
    found = materialize(spans(docs, text, carry).withColumn("rid", F.monotonically_increasing_id()), "pii-spans")
    candidates = found.select("rid", F.explode("candidates").alias("c")).select("rid", "c.*")
    added = added_spans(candidates).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("kind", "s", "e"))).alias("added"))
    return found.join(added, "rid", "left").select(
        "row", F.array_sort("base").alias("base"), F.coalesce("added", F.array().cast("array<struct<kind:int,s:int,e:int>>")).alias("added"))


def span_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["s"].cast("string"), m["e"].cast("string"))), ",")
