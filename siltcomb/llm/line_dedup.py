"""Removal of lines that many documents share, by DataFrame operations alone.

A line's key is the line without white space at its ends and with A-Z in lower case. Lines become
rows of hashes only: two 64-bit hashes of the key and two of the document. These are dealt out by
ranges of (key, document) and sorted by position within, so the first occurrence of a key in a
document is known as the rows stream by (the row before it is of another key or document), and a key
that a third of all lines bear spreads over as many ranges as it fills. Each range adds up the first
occurrences of its keys before the sums meet. What comes back for a
document is its keep bitmap in run lengths, not its text.

Frequent keys are broadcast while there are at most ``broadcast_rows`` of them; beyond that their
rows are salted on both sides of the join.

Null and empty texts are one empty line. Empty keys are never dropped. Documents are told apart by
(id, text): rows that repeat both count as one document and get the same bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.llm._runtime import narrowed, persisted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\u000b\f\r"
SALTS = 16


def lines_of(text: Column) -> Column:
    """The lines of a text, split at \\n; null gives one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(BLANK)), UPPER, LOWER)


def _two(*c: Column) -> list[Column]:
    """Two independent 64-bit hashes; null is told from every value."""
    parts = [x for y in c for x in (y.isNull(), y)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)]


def keep_bitmaps(df: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 100_000) -> DataFrame:
    """(d1, d2, keep): for each document that loses lines, the runs of its keep bitmap.

    d1 and d2 are the document's hashes (:func:`document_hashes`); ``keep`` is an array of
    (start, n) in lines, ascending, of the lines that stay.
    """
    t = narrowed(df, doc_id=id_col, text=text_col)
    d1, d2 = document_hashes(F.col("doc_id"), F.col("text"))
    lines = t.select(d1.alias("d1"), d2.alias("d2"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.select("d1", "d2", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= max(1, min_chars))
    k1, k2 = _two(F.col("key"))
    hashes = persisted(lines.select(k1.alias("k1"), k2.alias("k2"), "d1", "d2", "pos"), "lines")

    firsts = first_occurrences(hashes)
    frequent = persisted(firsts.groupBy("k1", "k2").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs).select("k1", "k2"), "frequent")

    if frequent.limit(broadcast_rows + 1).count() <= broadcast_rows:
        hit = hashes.join(F.broadcast(frequent), ["k1", "k2"])
    else:
        salt = F.pmod(F.col("d1"), F.lit(SALTS)).cast("int")
        copies = frequent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hit = hashes.withColumn("salt", salt).join(copies, ["k1", "k2", "salt"])
    # bounded by the lines of one document
    dropped = hit.groupBy("d1", "d2").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    return dropped.select("d1", "d2", runs_between(F.col("gone")).alias("keep"), F.size("gone").alias("n_dropped"))


def first_occurrences(hashes: DataFrame) -> DataFrame:
    """(k1, k2) of each key's first occurrence in each document, of rows (k1, k2, d1, d2, pos)."""
    ordered = hashes.repartitionByRange("k1", "k2", "d1", "d2").sortWithinPartitions("k1", "k2", "d1", "d2", "pos")
    # the ranges and their order are the window's own: no further shuffle, and rows stream past with the one before in view
    before = F.lag("pos").over(Window.partitionBy("k1", "k2", "d1", "d2").orderBy("pos"))
    return ordered.withColumn("before", before).where("before is null").select("k1", "k2")


def document_hashes(doc_id: Column, text: Column) -> list[Column]:
    return _two(doc_id, text)


def runs_between(gone: Column) -> Column:
    """The runs of lines between dropped positions; the last goes on to the end of the document."""
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(F.lit(2**31 - 1)))
    runs = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("n")))
    return F.filter(runs, lambda r: r["n"] > 0)


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with ``text_col`` reduced to the lines that stay, and columns n_lines and n_dropped behind.

    Columns of ``df`` with those names are replaced.
    """
    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    d1, d2 = document_hashes(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    t = df.select(row.alias("row"), d1.alias("d1"), d2.alias("d2"), F.col(f"`{text_col}`").alias("text"))
    j = t.join(bitmaps, ["d1", "d2"], "left")
    n = F.size(lines_of(F.col("text")))
    kept = F.array_join(F.flatten(F.transform("keep", lambda r: F.slice(lines_of(F.col("text")), r["start"] + 1, r["n"]))), "\n")
    text = F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept)
    out = [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names]
    return j.select(*out, n.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(df: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the lines whose keys at least ``min_docs`` documents hold."""
    return apply_bitmaps(df, keep_bitmaps(df, min_docs, min_chars, id_col, text_col), id_col, text_col)
