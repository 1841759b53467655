"""Result files: names, CSV, JSON lines, statistics, consolidation."""

from __future__ import annotations

import json
import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("type", "year", "month", "id", "text", "span", "matched", "subreddit", "score", "user", "flairtext", "timestamp_utc", "permalink")


def columns(with_spans: bool, review: bool = False) -> list[str]:
    """Columns of a result table, with the reason behind them in the review table."""
    out = [c for c in COLUMNS if with_spans or c not in ("span", "matched")]
    return [*out, "filter reason"] if review else out


def name_of(spec, month: tuple[int, int] | None = None, at: datetime | None = None) -> str:
    """The name of a run's output, told from its options."""
    parts = ["comment_extraction" if spec.kind != "posts" else "submissions_extraction"]
    if spec.source:
        parts.append(f"_from_{spec.source}_{';'.join(spec.names[:5])}")
    if month:
        parts.append(f"_from_{month[0]}-{month[1]:02d}")
    else:
        if spec.time_from:
            parts.append(f"_from_{spec.time_from[0]}-{spec.time_from[1]}")
        if spec.time_to:
            parts.append(f"_up_to_{spec.time_to[0]}-{spec.time_to[1]}")
    if spec.popularity is not None:
        parts.append(f"_score_over_{spec.popularity}")
    if spec.toplevel:
        parts.append("_toplevel-only_")
    if spec.sample is not None:
        parts.append(f"_sample-{spec.sample}_")
    if spec.reservoir is not None:
        parts.append(f"_reservoirsize-{spec.reservoir}_")
    if at:
        parts.append(f"_executed-at_{at:%Y-%m-%d_%Hh-%Mm-%Ss}")
    return safe("".join(parts)) + (".jsonl" if spec.return_all else ".csv")


def safe(name: str) -> str:
    """Without characters that file systems or shells refuse."""
    return re.sub(r'[\x00-\x1f<>:"/\\|?*]', "", name).strip(" .")[:240]


def review_name(name: str) -> str:
    stem, _, suffix = name.rpartition(".")
    return f"{stem}_filtered-out_matches.{suffix}"


def write_csv(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """``by`` are columns whose values get a folder each."""
    df.write.partitionBy(*by).csv(path, sep=";", quote='"', escape='"', header=True, emptyValue="", nullValue="", mode="error")


def write_jsonl(df: DataFrame, path: str, raw: str = "raw") -> None:
    """The entries as they were read, one a line."""
    df.select(F.col(raw).alias("value")).write.mode("error").text(path)


def write_review(df: DataFrame, path: str, as_json: bool) -> bool:
    """Write the review table unless it is empty; whether it was written."""
    if df.isEmpty():
        return False
    (write_jsonl if as_json else write_csv)(df, path)
    return True


def write_stats(stats: DataFrame, path: str) -> None:
    """{community: entries} as one JSON object; communities are far fewer than entries, and written by one task."""
    whole = stats.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("subreddit", "n"))))).alias("value"))
    whole.coalesce(1).write.mode("error").text(path)


def stats_text(rows: list[tuple[str, int]]) -> str:
    return json.dumps(dict(rows), ensure_ascii=False, indent=1)


def consolidate(tables: list[DataFrame]) -> DataFrame:
    """Result tables of several runs as one, by column name; each column once."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def gather(spark: SparkSession, folder: str) -> DataFrame | None:
    """The result tables of all runs in a folder as one; review tables, statistics and raw entries are passed over. None if there are none."""
    from siltcomb.sources.dumps import results
    from siltcomb.sources.store import fs_and_path

    fs, p = fs_and_path(spark, folder)
    found = sorted((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p))
    runs = [full for name, full in found if re.match(r"(comment|submissions)_extraction.*\.csv$", name) and "_filtered-out_matches" not in name]
    tables = [results(spark, r) for r in runs]
    return consolidate([t.select(*[c for c in COLUMNS if c in t.columns]) for t in tables]) if runs else None


def month_in(name: str) -> tuple[int, int] | None:
    """The month in a file name."""
    m = re.search(r"(\d{4})-(\d{2})", name)
    return (int(m[1]), int(m[2])) if m else None


def month_label(month: tuple[int, int]) -> str:
    return f"{datetime(month[0], month[1], 1):%B %Y}"
