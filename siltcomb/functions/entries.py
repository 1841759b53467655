"""Columns of an entry: its epoch, link, soft-filter reason, canonical hash."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SITE = "https://www.reddit.com"
BOT = r"(?Ud)i( a)?['m]*\s*a\s*bot"


def epoch(created: Column) -> Column:
    """Seconds since 1970 of a number, or of a string holding one."""
    text = created.cast("string")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").cast("bigint"))


def year_month(created: Column) -> tuple[Column, Column]:
    at = F.timestamp_seconds(epoch(created))
    return F.year(at), F.month(at)


def permalink(kind: str, has_permalink: Column | None = None) -> Column:
    """The entry's address: of its permalink, else put together from community, thread and id, else null.

    With ``has_permalink`` (compat), an entry that has the key with a null value gets the text ``None`` behind the site.
    """
    given = F.concat(F.lit(SITE), F.col("permalink"))
    if has_permalink is not None:
        given = F.when(has_permalink, F.concat(F.lit(SITE), F.coalesce("permalink", F.lit("None"))))
    if kind == "posts":
        return given
    thread = F.split_part(F.col("link_id"), F.lit("_"), F.lit(2))
    return F.coalesce(given, F.concat(F.lit(SITE), F.lit("/r/"), F.col("subreddit"), F.lit("/comments/"), thread, F.lit("//"), F.col("id")))


def filter_reason(text: Column, threshold: int | None) -> Column:
    """Why an entry goes to the review table, null if it doesn't; the first reason counts."""
    auto = F.when(F.col("author") == "AutoModerator", F.lit("AutoModerator"))
    reason = auto.when(F.lower(text).rlike(BOT), F.lit("non-human generated"))
    if threshold is None:
        return reason
    return F.when(F.col("score") < threshold, F.lit("score below defined threshold")).otherwise(reason)


def canonical_hash(raw: Column, exact: bool = False) -> Column:
    """A hash of a JSON object that key order and white space don't change.

    The JVM form takes 1.0 for 1; ``exact`` re-serialises in Python workers. Text that isn't JSON is hashed as it is.
    """
    if not exact:
        return F.coalesce(F.md5(F.to_json(F.try_parse_json(raw))), F.md5(raw))

    @F.pandas_udf("string")
    def sorted_keys(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return json.dumps(json.loads(t), sort_keys=True)
            except (TypeError, ValueError):
                return t

        return s.map(one)

    return F.md5(sorted_keys(raw))
