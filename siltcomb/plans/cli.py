"""The command line: ``python -m siltcomb.plans.cli``. Long options take hyphens or underscores."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from siltcomb.functions import values
from siltcomb.operators.sinks import month_label
from siltcomb.plans.extract import extract, save
from siltcomb.plans.spec import ExtractSpec

#: option, short form, field, type (None: a switch), what it says
OPTIONS = (
    ("input", "I", "input", str, "folder of monthly dumps"),
    ("output", "O", "output", str, "folder for results"),
    ("time-from", "F", "time_from", values.month_of, "first month, YYYY-MM"),
    ("time-to", "T", "time_to", values.month_of, "last month, YYYY-MM"),
    ("source", "S", "source", str, "what the names are: user or subreddit"),
    ("name", "N", "names", str, "an author or a community; may be repeated"),
    ("commentregex", "CR", "body_regex", values.pattern_of, "pattern for comments, or a file with one"),
    ("flairregex", "FR", "flair_regex", values.pattern_of, "pattern for flairs"),
    ("postregex", "PR", "post_regex", values.pattern_of, "pattern for posts"),
    ("titleregex", "TR", "title_regex", values.pattern_of, "pattern for titles of posts"),
    ("userregex", "UR", "user_regex", values.pattern_of, "pattern for author names"),
    ("firstmatch", "FM", "first_match", None, "one row an entry"),
    ("case-sensitive", "CS", "case_sensitive", None, "tell upper from lower case"),
    ("popularity", "P", "popularity", int, "least score of a result"),
    ("toplevel", "TL", "toplevel", None, "only answers to posts"),
    ("spacy-search", "SS", "pos", values.tagged_token, "token,TAG"),
    ("language", "L", "language", str, "language model for tags"),
    ("count", "C", "count", None, "count matches only"),
    ("include-quoted", None, "include_quoted", None, "match in quoted lines too"),
    ("sample", "SMP", "sample", values.share_of, "share of entries to keep"),
    ("reservoir-size", "RS", "reservoir", int, "number of matches to keep"),
    ("return-all", None, "return_all", None, "whole entries as JSON lines"),
    ("dont-filter", None, "soft_filter", None, "no review table"),
    ("reverse-order", None, "reverse_order", None, "newest first"),
    ("no-cleanup", None, "cleanup", None, "leave files of months apart"),
    ("no-stats", None, "stats", None, "no counts by community"),
    ("monthly-counts", None, "monthly_counts", str, "table of entries by month, for compat samples"),
)
ALSO = {"source": ["--src"], "commentregex": ["--regex", "-R"]}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltcomb")
    for name, short, field, kind, says in OPTIONS:
        flags = list(dict.fromkeys([f"--{name}", f"--{name.replace('-', '_')}", *ALSO.get(name, []), *([f"-{short}"] if short else [])]))
        if kind is None:
            off = field in ("soft_filter", "cleanup", "stats")
            p.add_argument(*flags, dest=field, action="store_false" if off else "store_true", help=says)
        elif field == "names":
            p.add_argument(*flags, dest=field, action="append", default=[], help=says)
        else:
            p.add_argument(*flags, dest=field, type=kind, required=name == "input", help=says)
    p.add_argument("--semantics", choices=("documented", "compat"), default="documented")
    p.add_argument("--kind", choices=("comments", "posts"))
    p.add_argument("--codec", choices=("auto", "jvm", "python"), default="auto", help="what reads the dumps; told from their first bytes by default")
    return p


def spec_of(argv: list[str] | None = None) -> ExtractSpec:
    return parsed(argv)[0]


def parsed(argv: list[str] | None = None) -> tuple[ExtractSpec, str]:
    """The options of an extraction, checked, and what reads the dumps."""
    a = vars(parser().parse_args(argv))
    codec = a.pop("codec")
    return ExtractSpec(**(a | {"names": tuple(a["names"])})).validate(), codec


def report(row) -> str:
    """A line of the count log."""
    if row["total"]:
        return f"{row['n']} instances in total"
    return f"{row['n']} instances" + (f" for {month_label((row['year'], row['month']))}" if row["year"] else " without a month")


def run(spark: SparkSession, argv: list[str] | None = None, at: datetime | None = None) -> list[str]:
    """What the command line does, but for starting Spark; the lines that it prints."""
    spec, codec = parsed(argv)
    x = extract(spark, spec, codec=codec)
    said = []
    if spec.count:
        # a row for each month
        said += [report(r) for r in x.counts.orderBy("total", "year", "month").collect()]
    lost = {r["file_name"]: r["n"] for r in x.malformed.collect()} if x.malformed is not None else {}  # a row for each file
    said += [f"{n} lines of {f} are not JSON objects and were left out" for f, n in sorted(lost.items())]
    return said + save(x, at)


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("siltcomb").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for line in run(spark, argv, datetime.now()):
        print(line)


if __name__ == "__main__":
    main()
