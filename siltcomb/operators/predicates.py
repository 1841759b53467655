"""Which entries are relevant."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: More names than this become a join.
INLINE_NAMES = 1000


class Tagger(Protocol):
    """Tags the tokens of a text with parts of speech."""

    def __call__(self, text: str) -> list[tuple[str, str]]: ...


def by_source(df: DataFrame, source: str, names: list[str], case_sensitive: bool = False) -> DataFrame:
    """Entries of the named authors (``user``) or communities (``subreddit``)."""
    column = F.col({"user": "author", "subreddit": "subreddit"}[source])
    wanted = sorted({n if case_sensitive else n.lower() for n in names})
    value = column if case_sensitive else F.lower(column)
    if len(wanted) <= INLINE_NAMES:
        return df.where(value.isin(wanted))
    # a list typed or read on the driver, so broadcast at most 8 MB of it
    table = df.sparkSession.createDataFrame([(n,) for n in wanted], "__name string")
    if sum(map(len, wanted)) <= 8 << 20:
        table = F.broadcast(table)
    return df.join(table, value == F.col("__name"), "left_semi")


def top_level(parent_id: Column) -> Column:
    """Whether a comment answers the post itself."""
    return parent_id.startswith("t3")


def tagged(df: DataFrame, text: str, token: str, tag: str, tagger: Callable[[], Tagger]) -> DataFrame:
    """Entries in which ``token`` occurs with part of speech ``tag``.

    Texts without the token (as spelt) never leave the JVM. ``tagger`` makes a tagger; each Python worker calls it once.
    """

    @F.pandas_udf("boolean")
    def has(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tags = tagger()
        for s in batches:
            yield s.map(lambda t: any(a.lower() == token.lower() and b == tag for a, b in tags(t or "")))

    some = df.where(F.col(text).contains(token))
    return some.where(has(F.col(text)))


def spacy_tagger(model: str) -> Callable[[], Tagger]:
    """A tagger by a spaCy model, where that library is installed."""

    def make() -> Tagger:
        import spacy

        nlp = spacy.load(model)
        return lambda text: [(t.text, t.pos_) for t in nlp(text)]

    return make
