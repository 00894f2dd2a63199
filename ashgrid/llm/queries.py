"""One query per operator, each over its whole table, and DuckDB SQL where SQL
can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bagminhash, embedding_dedup, html_content, line_dedup, maxent_lm, mixing, packing, phrases, pii, quality,
               sharding, substring_dedup, vector_codes)
from .common import materialize, table, text_or_empty, words


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", F.size(words(text_or_empty())).alias("n")), "mix-sizes")
    mixed = mixing.mix(sizes, F.col("doc_id"), F.col("source"), F.col("n"), weights=(1, 2, 3), max_repeat=3)
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = """
WITH d AS (
  SELECT doc_id, source,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         coalesce(doc_id::VARCHAR, '') AS k
  FROM documents
), s0 AS (
  SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey
), s1 AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY skey) - 1) % 3 AS w, 3 * source_size AS cap,
         (SELECT sum(source_size) FROM s0)::BIGINT AS total FROM s0
), s2 AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_cap,
         sum(w) OVER (ORDER BY cap::DOUBLE / w, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS w_from FROM s1
), s3 AS (
  SELECT *, cap * w_from <= w * (total - before_cap) AS capped FROM s2
), s4 AS (
  SELECT skey, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE w * ((total - (SELECT coalesce(sum(cap), 0) FROM s3 WHERE capped))::BIGINT::DOUBLE
                        / (SELECT sum(w) FROM s3 WHERE NOT capped)::BIGINT) END AS target FROM s3
), r AS (
  SELECT d.*, s4.source_size, s4.target,
         row_number() OVER (PARTITION BY d.skey ORDER BY
           (length(bin(size)) * 16 + ((size * 16) >> length(bin(size)))) * 64
             + ('0x' || substr(md5('mix:' || k), 1, 8))::BIGINT % 64, size, doc_id) - 1 AS pos,
         CASE WHEN s4.source_size > 0 THEN s4.target / s4.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('mix:' || d.skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN s4 USING (skey)
)
SELECT doc_id, size, source_size, target,
       ((floor((pos + 1) * rate + u) - floor(pos * rate + u)) * size)::BIGINT AS taken
FROM r
"""


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", cosine=0.98)
    return near.withColumnRenamed("id", "vec_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), F.col("text"), carry=["doc_id"]).select(
        "row.doc_id", "base", "added")
    count = lambda k: F.size(F.filter("base", lambda m: m["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
                        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text"), shards=24, overhead=8)
    return sharded.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
                          "shard", "slot", "grown_shard")


def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def op6_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_content.main_text(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return text.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, [F.col("doc_id")], F.col("text"), F.col("lang")).drop("char_distance", "word_distance")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.with_bitmaps(docs, "doc_id", "text", min_docs=10)
    lines = line_dedup.kept_lines(F.col("row.text"), F.col("keep"))
    n_lines = F.size(F.split(text_or_empty(F.col("row.text")), "\n", -1))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "row", lines.alias("lines"), n_lines.cast("long").alias("n_lines")).select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("lines")).alias("n_dropped"),
        F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, md5(coalesce(text, '')) AS h, row_number() OVER () AS rid FROM documents
), l AS (
  SELECT rid, doc_id, h, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d
), k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l
), common AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT (doc_id, h)) >= 10
), m AS (
  SELECT k.*, common.key IS NOT NULL AS gone FROM k LEFT JOIN common ON k.key = common.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""

def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = bagminhash.near_classes(docs, "doc_id", "text", similarity=0.8).withColumnRenamed("id", "doc_id")
    return docs.select("doc_id").join(classes, "doc_id", "left").select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = materialize(packing.pieces(table(spark, sf_dir, "documents"), F.col("doc_id"), F.col("text")), "pieces")
    return packing.pack(cut)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    digits = F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0")))
    return coded.select(F.col("id").alias("vec_id"), F.concat_ws("", digits).alias("code"), "error", "label_error",
                        F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup(table(spark, sf_dir, "documents"), "doc_id", "text", window=50)
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"), F.col("lang"), F.col("text"), size=3, min_count=10)
    return phrases.top(found, 2000).select(F.col("g").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def _op7_sql() -> str:
    """The counts, the mean histograms of each language in whole millionths and
    the distances, with the operator's constants."""
    rests, classes = [], []
    left = "rest"
    for i, pattern in enumerate(quality.CHAR_CLASSES):
        quoted = pattern.replace("'", "''")
        rests.append(f", c{i} AS (SELECT *, regexp_replace({left}, '{quoted}', '', 'g') AS r{i} FROM {f'c{i - 1}' if i else 'd'})")
        classes.append(f"length({left}) - length(r{i})")
        left = f"r{i}"
    last = f"c{len(quality.CHAR_CLASSES) - 1}"
    bins = ", ".join(f"len(list_filter(w, lambda x: x = '{x}'))" for x in quality.COMMON_WORDS)
    common = " OR ".join(f"x = '{x}'" for x in quality.COMMON_WORDS)
    dims = {"ch": len(quality.CHAR_CLASSES) + 3, "wo": len(quality.COMMON_WORDS) + 1}
    votes = ", ".join(f"[{', '.join(f'sum(CAST(round({h}[{i + 1}] / list_sum({h}) * {quality.SCALE}) AS BIGINT))' for i in range(n))}] AS ref_{h}"
                      for h, n in dims.items())

    def distance(h: str) -> str:
        p, q = f"{h}[i] / list_sum({h})", f"ref_{h}[i] / list_sum(ref_{h})"
        half = "CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END"
        term = f"({half.format(a=p, p=p, q=q)} + {half.format(a=q, p=p, q=q)})"
        return f"sqrt(greatest(0, list_sum(list_transform(range(1, {dims[h] + 1}), lambda i: {term})) / 2))"

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         regexp_replace(coalesce(text, ''), '[a-z\\x20\\x09-\\x0D]+', '', 'g') AS rest FROM documents
){''.join(rests)}
, pos AS (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
, gram AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) AS n FROM pos)
, cover AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM gram WHERE n > 1) GROUP BY rid)
, line AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d)
, f AS (
  SELECT rid, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^{quality.SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         [length(t) - length(array_to_string(w, '')), length(array_to_string(w, '')) - length(rest), {', '.join(classes)}, length({left})] AS ch,
         [{bins}, len(list_filter(w, lambda x: NOT ({common})))] AS wo
  FROM {last} JOIN line USING (rid) LEFT JOIN cover USING (rid)
)
, b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PCT} * n_words AS base_failed FROM f)
, ref AS (SELECT lang, {votes} FROM b WHERE NOT base_failed AND n_words >= {quality.GUARD_WORDS} GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words >= {quality.GUARD_WORDS} AND ref_ch IS NOT NULL AND (
         {distance('ch')} > {quality.MAX_CHAR_DISTANCE}
         OR {distance('wo')} > {quality.MAX_WORD_DISTANCE} + {quality.WORD_NOISE} / sqrt(n_words))) AS kept
FROM b LEFT JOIN ref ON b.lang IS NOT DISTINCT FROM ref.lang
"""


OP7_SQL = _op7_sql()

def _op11_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds one after the other, every part against every entry."""
    gap = "list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))"

    steps = []
    for k in range(rounds + 1):
        steps.append(f"""n{k} AS MATERIALIZED (
  SELECT rid, part, arg_min(e, (d, e)) AS e, min(d)::BIGINT AS d
  FROM (SELECT p.rid, p.part, b.e, {gap} AS d FROM p JOIN b{k} b ON p.part = b.part) GROUP BY rid, part
)""")
        if k < rounds:
            steps.append(f"""s{k} AS (
  SELECT part, e, i, floor(sum(x) / count(*))::BIGINT AS x
  FROM (SELECT part, e, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM n{k} JOIN p USING (rid, part)) GROUP BY part, e, i
), b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.e, coalesce(m.v, b.v) AS v FROM b{k} b
  LEFT JOIN (SELECT part, e, list(x ORDER BY i) AS v FROM s{k} GROUP BY part, e) m ON m.part = b.part AND m.e = b.e
)""")
    return f"""
WITH r AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS v FROM r, range({parts}) t(part)
), b0 AS (
  SELECT part, rid - 1 AS e, v FROM p WHERE rid <= {entries}
), {', '.join(steps)}
, c AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256
FROM c JOIN r USING (rid)
"""


OP11_SQL = _op11_sql()

OP12_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
  SELECT rid, doc_id, i, hash(w[i:i + 49]) AS h, md5(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), m AS (
  SELECT h, s, min(doc_id) AS first FROM g GROUP BY h, s
), c AS (
  SELECT DISTINCT rid, unnest(range(i, i + 50)) AS j FROM g JOIN m USING (h, s) WHERE first < doc_id OR (first IS NOT NULL AND doc_id IS NULL)
), e AS (
  SELECT rid, list(j) AS gone FROM c GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]), ' ') END) AS kept_sha256
FROM d LEFT JOIN e USING (rid)
"""

OP13_SQL = """
WITH p AS (
  SELECT row_number() OVER () AS pid, * FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13) || chr(9),
                'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9) || ' '), chr(10))) AS piece FROM documents)
), w AS (
  SELECT pid, lang, list_filter(string_split(piece, ' '), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), range(1, 4) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), c AS (
  SELECT * FROM g WHERE k >= 2 AND f >= 10
), inside AS (
  SELECT lang, g, max(f) AS f FROM (
    SELECT lang, unnest([g[1:2], g[2:3]]) AS g, f FROM c WHERE k = 3) GROUP BY lang, g
), kept AS (
  SELECT c.* FROM c LEFT JOIN inside USING (lang, g) WHERE inside.f IS NULL OR 100 * inside.f < 50 * c.f
), cuts AS (
  SELECT kept.lang, kept.g, kept.f AS a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * kept.f * kept.f) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) kept
  JOIN g x ON x.lang = kept.lang AND x.g = kept.g[1:cut] JOIN g y ON y.lang = kept.lang AND y.g = kept.g[cut + 1:kept.k]
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS nth FROM cuts
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best WHERE nth = 1
)
SELECT ranked.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_pii": op3_pii,
    "op4_sharding": op4_sharding,
    "op5_maxent_lm": op5_maxent_lm,
    "op6_html_content": op6_html_content,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_bagminhash": op9_bagminhash,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL = {
    "op1_mixing": OP1_SQL,
    "op7_quality": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_phrases": OP13_SQL,
}
