"""From a table of entries to results, review, counts and statistics, all of them lazy.

:func:`save` works the relevant entries out once, stores them in the shared folder and derives every file from there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltcomb.functions import entries as E
from siltcomb.functions.matching import has_match, once, span_text, spans, unquoted_spans
from siltcomb.functions.regex import checked, let_quotes_lead
from siltcomb.operators import counts, predicates, sampling, sinks
from siltcomb.operators.dedup import drop_duplicates
from siltcomb.plans.spec import ExtractSpec
from siltcomb.sources import dumps
from siltcomb.sources.store import remove, stored


@dataclass(frozen=True)
class Extraction:
    """results and review have the output columns; entries are the relevant ones; matches has one row for each match.

    malformed counts the lines of each file that were left out, where the entries come from dumps.
    """

    spec: ExtractSpec
    entries: DataFrame
    matches: DataFrame
    results: DataFrame
    review: DataFrame
    stats: DataFrame
    counts: DataFrame
    malformed: DataFrame | None = None

    @property
    def raw_results(self) -> DataFrame:
        """For return_all: whole entries, once each (compat: once for each match)."""
        t = self.matches.where("filter_reason is null") if self.spec.soft_filter and self.spec.semantics == "documented" else self.matches
        if self.spec.semantics == "documented":
            t = t.where("match_index = 0")
        return t.select("raw")


def relevant(df: DataFrame, spec: ExtractSpec, tagger: Callable | None = None) -> DataFrame:
    """The entries that meet every condition, with their ``spans`` where a pattern has been given.

    Cheap JVM conditions come before those that need Python, so fewer rows reach a worker.
    """
    text = dumps.text_column(spec.table)
    column = F.col(text)

    def pattern(source: str, anchored: bool = True):
        if anchored or spec.semantics == "compat":
            source = let_quotes_lead(source, spec.semantics)
        return checked(source, spec.case_sensitive)

    t = df
    if spec.names:
        t = predicates.by_source(t, spec.source, list(spec.names), spec.case_sensitive)
    if spec.toplevel:
        t = t.where(predicates.top_level(F.col("parent_id")))
    conditions = [(F.col(c), pattern(s, False)) for c, s in (("title", spec.title_regex), ("author_flair_text", spec.flair_regex), ("author", spec.user_regex)) if s]
    body = pattern(spec.active_regex) if spec.active_regex else None
    if body:
        conditions.append((column, body))
    for c, p in sorted(conditions, key=lambda x: x[1].jvm is None):
        t = t.where(has_match(c, p))
    if spec.span_regex:
        p = pattern(spec.span_regex)
        # behind a generator, the filter on its size doesn't have the spans worked out twice
        t = once(t, "spans", spans(column, p) if spec.include_quoted else unquoted_spans(column, p, spec.semantics))
        if spec.active_regex == spec.span_regex:
            t = t.where(F.size("spans") > 0)
    elif body and not spec.include_quoted:
        t = t.where(F.size(unquoted_spans(column, body, spec.semantics)) > 0)
    if spec.pos:
        t = predicates.tagged(t, text, *spec.pos, tagger or predicates.spacy_tagger(spec.language))
    return t


def plan(df: DataFrame, spec: ExtractSpec, tagger: Callable | None = None) -> Extraction:
    """The tables of an extraction from ``df``, entries with a ``raw`` column of JSON."""
    spec.validate()
    # of copies, the first in the order of the dumps stays where that order is known
    order = [c for c in ("file_name", "line_idx" if "line_idx" in df.columns else "block_start") if c in df.columns]
    t = drop_duplicates(relevant(df, spec, tagger), order=order or None)
    if spec.sample is not None and spec.semantics == "documented":
        t = sampling.bernoulli(t, spec.sample, ["raw"])
    year, month = E.year_month(F.col("created_utc"))
    t = t.withColumn("year", year).withColumn("month", month)
    one_each = not spec.span_regex or spec.first_match
    t = t.withColumn("weight", F.lit(1).cast("bigint") if one_each else F.size("spans").cast("bigint"))
    return derived(t, spec)


def derived(t: DataFrame, spec: ExtractSpec) -> Extraction:
    """The tables of an extraction from its relevant entries."""
    text = dumps.text_column(spec.table)
    reason = E.filter_reason(F.col(text), spec.popularity) if spec.soft_filter and spec.semantics == "documented" else F.lit(None).cast("string")

    if not spec.span_regex:
        m = t.withColumn("match_index", F.lit(0)).withColumn("m", F.lit(None).cast("struct<start:int,end:int,matched:string>"))
    elif spec.first_match:
        m = t.withColumn("match_index", F.lit(0)).withColumn("m", F.try_element_at("spans", F.lit(1)))
    else:
        m = t.select("*", F.posexplode("spans").alias("match_index", "m"))
    if spec.reservoir is not None:
        if spec.semantics == "compat":
            scan_order = ["file_name", "line_idx"] if "line_idx" in m.columns else ["file_name", "block_start", "id"]
            m = sampling.reservoir_scan(m, spec.reservoir, [*scan_order, "match_index"])
        else:
            m = sampling.fixed_size(m, spec.reservoir, ["id", "match_index"])
    m = m.withColumn("filter_reason", reason)
    made_by_key = F.lit("permalink") if spec.semantics == "compat" else None
    has_key = F.array_contains(F.json_object_keys("raw"), made_by_key) if made_by_key is not None else None
    rows = m.select(
        F.lit("comment" if spec.table == "comments" else "post").alias("type"),
        "year",
        "month",
        "id",
        F.col(text).alias("text"),
        span_text(F.col("m")).alias("span"),
        F.col("m.matched").alias("matched"),
        "subreddit",
        "score",
        F.col("author").alias("user"),
        F.col("author_flair_text").alias("flairtext"),
        F.col("created_utc").alias("timestamp_utc"),
        E.permalink(spec.table, has_key).alias("permalink"),
        F.col("filter_reason").alias("filter reason"),
    )
    with_spans = bool(spec.span_regex)
    kept = rows.where(F.col("filter reason").isNull()).select(*sinks.columns(with_spans))
    review = rows.where(F.col("filter reason").isNotNull()).select(*sinks.columns(with_spans, review=True))
    return Extraction(spec, t, m, kept, review, counts.by_community(t), counted(t))


def counted(t: DataFrame) -> DataFrame:
    """Matches by the month of the dump, as a scan of one file after another counts them; without dumps, by the month of creation."""
    if "file_name" not in t.columns:
        return counts.by_month(t)
    year, month = dumps.file_date(F.col("file_name"))
    return counts.by_month(t.withColumn("__year", year).withColumn("__month", month), year="__year", month="__month")


def extract(spark: SparkSession, spec: ExtractSpec, tagger: Callable | None = None, codec: str = "auto") -> Extraction:
    """An extraction from a folder of dumps."""
    spec.validate()
    in_order = spec.semantics == "compat" and (spec.sample is not None or spec.reservoir is not None)
    lines = dumps.lines(spark, spec.input, spec.time_from, spec.time_to, codec, spread=not in_order)
    df = dumps.parsed(lines, spec.table)
    if in_order:
        df = dumps.line_index(df)
    if spec.sample is not None and spec.semantics == "compat":
        if spec.monthly_counts:  # a table of a row for each month, which saves a pass over the dumps
            known = {(r["year"], r["month"]): r["n"] for r in dumps.monthly_counts(spark, spec.monthly_counts).collect()}
            per_month = [(n, known[sinks.month_in(n)]) for n, _ in dumps.dump_files(spark, spec.input, spec.time_from, spec.time_to)]
        else:
            per_month = [(r["file_name"], r["n"]) for r in df.groupBy("file_name").agg(F.count("*").alias("n")).orderBy("file_name").collect()]  # a row for each file
        df = sampling.at_points(df, spec.sample, per_month)
    return replace(plan(df, spec, tagger), malformed=dumps.malformed(lines))


def save(x: Extraction, at=None) -> list[str]:
    """Write what the options ask for; the paths written. Dumps are read once: all files come from the stored entries."""
    spec = x.spec
    name = sinks.name_of(spec, at=at)
    out: list[str] = []
    base = f"{spec.output.rstrip('/')}/" if spec.output else ""
    if spec.count and not (spec.stats and base):  # nothing to write
        return out
    entries = stored(x.entries, "entries")
    x = derived(entries, spec)
    if not spec.count:
        if spec.return_all:
            sinks.write_jsonl(x.raw_results, base + name)
        else:
            order = ["year", "month", "id"]
            results = x.results.orderBy(*[F.desc(c) for c in order]) if spec.reverse_order else x.results
            apart = () if spec.cleanup else ("dump_month",)
            if apart:  # a folder for each month
                results = results.withColumn("dump_month", F.format_string("%04d-%02d", "year", "month"))
            sinks.write_csv(results, base + name, apart)
        out.append(base + name)
        review = x.matches.where("filter_reason is not null and match_index = 0") if spec.return_all else x.review
        if spec.soft_filter and sinks.write_review(review, base + sinks.review_name(name), spec.return_all):
            out.append(base + sinks.review_name(name))
    if spec.stats and base:
        sinks.write_stats(x.stats, f"{base}{name.rpartition('.')[0]}_search_stats.json")
        out.append(f"{base}{name.rpartition('.')[0]}_search_stats.json")
    remove(entries)
    return out
