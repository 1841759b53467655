"""What to extract, as one value that is checked before any job runs."""

from __future__ import annotations

from dataclasses import dataclass

from siltcomb.functions.values import month_index
from siltcomb.sources.dumps import kind_of


@dataclass(frozen=True)
class ExtractSpec:
    """The options of an extraction. ``semantics="compat"`` reproduces what the original does where it departs from its documentation."""

    input: str
    output: str | None = None
    kind: str | None = None
    time_from: tuple[int, int] | None = None
    time_to: tuple[int, int] | None = None
    source: str | None = None
    names: tuple[str, ...] = ()
    body_regex: str | None = None
    post_regex: str | None = None
    title_regex: str | None = None
    flair_regex: str | None = None
    user_regex: str | None = None
    first_match: bool = False
    case_sensitive: bool = False
    popularity: int | None = None
    toplevel: bool = False
    pos: tuple[str, str] | None = None
    language: str | None = None
    count: bool = False
    include_quoted: bool = False
    sample: float | None = None
    reservoir: int | None = None
    return_all: bool = False
    soft_filter: bool = True
    reverse_order: bool = False
    cleanup: bool = True
    stats: bool = True
    semantics: str = "documented"
    monthly_counts: str | None = None

    @property
    def table(self) -> str:
        return self.kind or kind_of(self.input)

    @property
    def active_regex(self) -> str | None:
        """The pattern that the entries' text must match."""
        if self.table == "posts":
            return self.post_regex
        return self.body_regex

    @property
    def span_regex(self) -> str | None:
        """The pattern whose matches become rows; compat only knows the comment pattern."""
        return self.body_regex if self.semantics == "compat" else self.active_regex

    def validate(self) -> ExtractSpec:
        """``self``, or ValueError."""
        wrong = []
        if self.semantics not in ("documented", "compat"):
            wrong.append("semantics is documented or compat")
        if self.kind not in (None, "comments", "posts"):
            wrong.append("kind is comments or posts")
        if not self.count and not self.output:
            wrong.append("an output folder is needed unless matches are only counted")
        narrow = [self.names, self.body_regex, self.flair_regex, self.user_regex]
        if self.semantics == "documented":
            narrow += [self.post_regex, self.title_regex]
        if not any(narrow):
            wrong.append("nothing narrows the search: give names or a pattern")
        if bool(self.names) != bool(self.source):
            wrong.append("names and their kind (user or subreddit) go together")
        if self.source not in (None, "user", "subreddit"):
            wrong.append("source is user or subreddit")
        if self.time_from and self.time_to and month_index(self.time_from) > month_index(self.time_to):
            wrong.append("the first month lies behind the last")
        if self.pos and not self.language:
            wrong.append("a search by part of speech needs a language model")
        if self.sample is not None and self.reservoir is not None:
            wrong.append("a proportional and a fixed-size sample exclude each other")
        if self.sample is not None and not 0 <= self.sample <= 1:
            wrong.append("a share lies between 0 and 1")
        if self.monthly_counts and self.semantics != "compat":
            wrong.append("only the sequential sample asks how many entries a month has")
        if self.reservoir is not None and self.reservoir < 1:
            wrong.append("a fixed-size sample has at least one match")
        if self.table == "posts" and self.toplevel:
            wrong.append("posts have no parents, so none is top-level")
        if self.table == "comments" and self.title_regex:
            wrong.append("comments have no titles")
        if self.table == "posts" and self.body_regex and self.semantics == "documented":
            wrong.append("posts are searched with the post pattern")
        if self.table == "comments" and self.post_regex and self.semantics == "documented":
            wrong.append("comments are searched with the comment pattern")
        if wrong:
            raise ValueError("; ".join(wrong))
        return self
