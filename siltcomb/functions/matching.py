"""Matches of a pattern in a column, as arrays of code-point spans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import replace

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltcomb.functions.regex import Pattern, checked
from siltcomb.functions.workers import importable

SPAN = "array<struct<start:int,end:int,matched:string>>"
#: Matches whose positions are summed up at once.
BLOCK = 128
#: Characters of the texts whose spans a Python worker hands over at once; a text has at most one match more than characters.
AT_ONCE = 1 << 18
#: Marks of a quoted line, escaped as dumps have it or raw.
QUOTED_LINE = r"^[ \t]*(?:&gt;|>)"


def has_match(text: Column, pattern: Pattern) -> Column:
    """Whether the pattern is found; null for null."""
    if pattern.jvm is not None:
        return F.rlike(text, F.lit(pattern.jvm))
    found = pattern.compiled().search

    @F.pandas_udf("boolean")
    def search(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else found(t) is not None)

    return search(text)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that no filter behind it makes Spark work out again."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def _pieces(text: Column, pattern: Pattern) -> Column:
    """(gap, matched) of each match: what stands between it and the one before, and the match itself."""
    found = F.regexp_extract_all(text, F.lit(pattern.jvm), F.lit(0))
    # the piece behind the last match is left out
    return let(found, lambda m: F.zip_with(F.slice(F.split(text, pattern.jvm, -1), 1, F.size(m)), m, lambda a, b: F.struct(a.alias("gap"), b.alias("matched"))))


def _placed(pieces: Column) -> Column:
    """Pieces as spans. Positions are summed up by blocks and then over blocks: an array that grows by one match at a time is copied for each."""
    none, no_sums = F.array().cast(SPAN), F.array().cast("array<int>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["matched"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["matched"].alias("matched")))).alias("out"))

    def placed(p: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda i: F.slice(p, i * BLOCK + 1, F.lit(BLOCK)))
        return let(F.transform(blocks, lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), none.alias("out")), step)), shifted)

    def shifted(done: Column) -> Column:
        sums = F.aggregate(done, F.struct(F.lit(0).alias("at"), no_sums.alias("sums")), lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["sums"], F.array(acc["at"])).alias("sums")), lambda acc: acc["sums"])
        moved = lambda b, o: F.transform(b["out"], lambda s: F.struct((s["start"] + o).alias("start"), (s["end"] + o).alias("end"), s["matched"].alias("matched")))
        return F.flatten(F.zip_with(done, sums, moved))

    return let(pieces, lambda p: F.when(F.size(p) > 0, placed(p)).otherwise(none))


def finder(pattern: Pattern):
    """What a Python worker makes of batches of texts: their spans, in batches of their own.

    A batch of texts can have an empty match at each of its characters, so spans are numbers and one string, of a few texts at once.
    """
    every, at_once, cut = pattern.compiled().finditer, AT_ONCE, None
    if not pattern.compiled().groups:  # gaps and matches in turns, which takes half the time of match objects
        with suppress(re.error):  # inline flags can't stand in a group
            cut = replace(pattern, source=f"({pattern.source})").compiled().split

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from itertools import chain

        import numpy as np
        import pyarrow as pa

        def places(t: str) -> np.ndarray:
            if not cut:
                return np.fromiter(chain.from_iterable(map(re.Match.span, every(t))), np.int32).reshape(-1, 2)
            return np.cumsum(np.fromiter(map(len, cut(t)[:-1]), np.int32), dtype=np.int32).reshape(-1, 2)

        def column(texts: list[str]) -> pa.Array:
            found = [places(t) for t in texts]
            said = [t[a:b].encode() for t, x in zip(texts, found, strict=True) for a, b in x[x[:, 0] < x[:, 1]].tolist()]
            at, upto = np.concatenate(found), lambda sizes: np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            sizes = np.zeros(len(at), np.int64)
            sizes[at[:, 0] < at[:, 1]] = [len(w) for w in said]
            matched = pa.StringArray.from_buffers(len(at), pa.py_buffer(upto(sizes)), pa.py_buffer(b"".join(said)))
            each = pa.StructArray.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), matched], ["start", "end", "matched"])
            return pa.ListArray.from_arrays(pa.array(upto([len(x) for x in found])), each)

        for batch in batches:
            texts, n = [], 0
            for t in batch:
                texts.append(t.as_py())
                n += len(texts[-1])
                if n >= at_once:
                    yield column(texts)
                    texts, n = [], 0
            if texts:
                yield column(texts)

    return find


def spans(text: Column, pattern: Pattern) -> Column:
    """All matches in order: (start, end, matched), half-open, in code points. Null text has none."""
    text = F.coalesce(text, F.lit(""))
    if not pattern.spans_in_jvm:
        return F.arrow_udf(finder(pattern), SPAN)(text)
    return _placed(_pieces(text, pattern))


def unquoted_spans(text: Column, pattern: Pattern, semantics: str = "documented") -> Column:
    """The spans outside quoted lines, in one pass over the pieces between matches."""
    if not pattern.spans_in_jvm or semantics == "compat":
        return unquoted(text, spans(text, pattern), semantics)

    def step(acc: Column, x: Column) -> Column:
        # heads are the first characters of a line behind blanks: of the line that goes on, and of that of the last character
        said = F.concat(x["gap"], x["matched"])
        core = F.rtrim(said, F.lit("\n"))
        line = F.when(F.instr(core, "\n") > 0, F.substring_index(core, "\n", -1)).otherwise(F.concat(acc["open"], core))
        head = F.when(core == "", F.when(acc["open"] == "", acc["head"]).otherwise(acc["open"])).otherwise(F.left(F.ltrim(line, F.lit(" \t")), F.lit(4)))
        mark = F.when(head.startswith("&gt;") | head.startswith(">"), F.lit("1")).otherwise(F.lit("0"))
        ended = F.length(core) < F.length(said)
        return F.struct(F.when(ended, F.lit("")).otherwise(head).alias("open"), head.alias("head"), F.concat(acc["marks"], mark).alias("marks"))

    begin = F.struct(F.lit("").alias("open"), F.lit("").alias("head"), F.lit("").alias("marks"))
    # a string of marks: to copy it for each match costs a byte a match, where an array's elements are copied one by one
    marks = lambda p: F.split(F.aggregate(p, begin, step, lambda acc: acc["marks"]), "")
    free = lambda p: F.transform(F.filter(F.zip_with(_placed(p), marks(p), lambda s, m: F.struct(s.alias("s"), m.alias("m"))), lambda x: x["m"] == "0"), lambda x: x["s"])
    return let(_pieces(F.coalesce(text, F.lit("")), pattern), lambda p: F.when(F.size(p) > 0, free(p)).otherwise(F.array().cast(SPAN)))


def inside_quote(text: Column, end: Column, semantics: str = "documented") -> Column:
    """Whether a match that ends at ``end`` stands in a quoted line.

    Documented: the line of its last character begins with a quote mark, blanks allowed before it.
    Compat: the text up to its end is one line that begins with ``&gt;``.
    """
    head = F.substring(text, F.lit(1), end)
    if semantics == "compat":
        return head.rlike(r"(?d)^&gt;[^\n]+$")
    line = F.substring_index(F.regexp_replace(head, r"\n+\z", ""), "\n", -1)
    return line.rlike(QUOTED_LINE)


def unquoted(text: Column, found: Column, semantics: str = "documented") -> Column:
    """The spans of ``found`` outside quoted lines."""
    if semantics == "compat":
        # only while the first line lasts, or up to the line break that ends it
        def inside(end: Column, line: Column) -> Column:
            return text.startswith("&gt;") & (((line == 0) | (line > end)) & (end >= 5) | (line == end) & (end >= 6))

        return let(F.instr(text, "\n"), lambda line: F.filter(found, lambda s: ~inside(s["end"], line)))
    return F.filter(found, lambda s: ~inside_quote(text, s["end"], semantics))


def span_text(span: Column) -> Column:
    """A span as ``(start, end)``; null for null."""
    return F.when(span.isNotNull(), F.format_string("(%d, %d)", span["start"], span["end"]))


def register(spark: SparkSession) -> None:
    """SQL functions.

    ``match_spans(text, pattern, case_sensitive)`` is a table function for LATERAL joins, any pattern of Python's.
    ``inside_quote(text, end)``, ``filter_reason(text, author, score, least)`` and ``entry_permalink(permalink, subreddit, link_id, id)`` are those of extractions.
    """
    from pyspark.sql.functions import udtf

    from siltcomb.functions.entries import BOT, SITE

    importable(spark)

    @udtf(returnType="match_index int, span_start int, span_end int, matched string")
    class MatchSpans:
        def eval(self, text: str, pattern: str, case_sensitive: bool):
            for i, m in enumerate(checked(pattern, bool(case_sensitive)).compiled().finditer(text or "")):
                yield i, m.start(), m.end(), m[0]

    spark.udtf.register("match_spans", MatchSpans)
    define = lambda head, body: spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    define(
        "inside_quote(body STRING, upto INT) RETURNS BOOLEAN",
        r"rlike(substring_index(regexp_replace(substring(body, 1, upto), '\\n+\\z', ''), '\n', -1), '^[ \\t]*(?:&gt;|>)')",
    )
    bot = BOT.replace("\\", "\\\\").replace("'", "\\'")
    define(
        "filter_reason(body STRING, author STRING, score BIGINT, least BIGINT) RETURNS STRING",
        f"CASE WHEN score < least THEN 'score below defined threshold' WHEN author = 'AutoModerator' THEN 'AutoModerator' WHEN rlike(lower(body), '{bot}') THEN 'non-human generated' END",
    )
    define(
        "entry_permalink(permalink STRING, subreddit STRING, link_id STRING, id STRING) RETURNS STRING",
        f"coalesce('{SITE}' || permalink, '{SITE}/r/' || subreddit || '/comments/' || split_part(link_id, '_', 2) || '//' || id)",
    )
