"""Line dedup: lines found in many documents are dropped everywhere.

Only hashes travel: every line becomes (key hash, document hash, position).
The hashes are range-partitioned with a secondary sort by document and
position, so that the first occurrence of a key in a document is the first row
of its run, and counting documents is counting first occurrences.  A hot key is
cut by document over many ranges.  The result is a keep bitmap per document
that loses lines (64 lines a number, up to the last word with a lost line); it
is applied to the texts by one join.

Defined results: a null text is one empty line; a key without code points is
never dropped; rows equal in id and text are one document (all of them lose the
same lines), rows that share only the id are different documents; an empty
table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, row_key, text_or_empty

SALTS = 32
SPACES = " \t\n\x0b\f\r"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z only (``lower`` does that to texts without other letters)."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def line_keys(docs: DataFrame, id_col: Column, text: Column) -> DataFrame:
    """(h1, h2, pos, k1, k2): document hash, line number from 0, key hash; lines with a key only."""
    lines = docs.select(*row_key(id_col, text), F.posexplode(F.split(ascii_lower(text_or_empty(text)), "\n", -1)).alias("pos", "line"))
    key = F.btrim("line", F.lit(SPACES))
    return (lines.select("h1", "h2", "pos", key.alias("k")).filter(F.length("k") >= 1)
            .select("h1", "h2", "pos", F.xxhash64("k").alias("k1"), F.xxhash64(F.lit(7), "k").alias("k2")))


def keep_bitmaps(docs: DataFrame, id_col: Column, text: Column, min_docs: int = 10) -> DataFrame:
    """(h1, h2, keep array<long>): one row per document that loses lines."""
    rows = materialize(line_keys(docs, id_col, text), "line-keys")
    runs = (rows.repartitionByRange("k1", "k2", "h1", "h2")
            .sortWithinPartitions("k1", "k2", "h1", "h2", "pos"))
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "h1", "h2").orderBy("pos"))
    firsts = runs.select("k1", "k2", nth.alias("nth")).filter("nth = 1")
    common = firsts.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
    # the few common keys meet each key's lines in SALTS parts, so that a hot key is joined by many tasks
    salted = common.select("k1", "k2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    bits = (rows.withColumn("salt", F.pmod("h1", F.lit(SALTS)).cast("int")).join(salted, ["k1", "k2", "salt"])
            .groupBy("h1", "h2", F.expr("pos div 64").cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return (bits.groupBy("h1", "h2").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("lost"))
            .select("h1", "h2", F.transform(
                F.sequence(F.lit(0), F.array_max(F.map_keys("lost"))),
                lambda w: F.bitwise_not(F.coalesce(F.try_element_at("lost", w), F.lit(0).cast("long")))).alias("keep")))


def kept_lines(text: Column, keep: Column) -> Column:
    """The lines of a text that its bitmap keeps (null: all)."""
    def stays(_: Column, i: Column) -> Column:
        word = F.floor(i / 64).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)
        return (word >= F.size(keep)) | (F.get(keep, word).bitwiseAND(bit) != 0)

    lines = F.split(text_or_empty(text), "\n", -1)
    return F.when(keep.isNull(), lines).otherwise(F.filter(lines, stays))


def with_bitmaps(docs: DataFrame, id_col: str, text_col: str, min_docs: int = 10) -> DataFrame:
    """All rows and columns of ``docs`` in ``row``, with ``keep`` (null: all lines)."""
    bitmaps = keep_bitmaps(docs, F.col(id_col), F.col(text_col), min_docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *row_key(F.col(id_col), F.col(text_col)))
    return rows.join(bitmaps, ["h1", "h2"], "left").select("row", "keep")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10) -> DataFrame:
    """``docs`` with the common lines gone from the text; a text that loses
    nothing (null included) stays as it is."""
    kept = with_bitmaps(docs, id_col, text_col, min_docs)
    text = F.col(f"row.{text_col}")
    return kept.select(*[
        (F.when(F.col("keep").isNull(), text).otherwise(F.array_join(kept_lines(text, F.col("keep")), "\n"))
         if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
